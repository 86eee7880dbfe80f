"""Harmonic packing: documents cut into token pieces, pieces into sequences of a fixed capacity.

Lengths fall into reciprocal-capacity classes: a piece of ``s`` tokens belongs to the class of
``capacity // s`` pieces a bin, and a bin of that class is closed when it holds that many. Every task fills bins of
its own, so nothing is shuffled and nothing is shared between workers. A document is cut so that its pieces
fill their classes: whole bins first, then halves, quarters and so on down to ``grain`` tokens, and the rest
(under ``grain`` tokens, where each length is a class of its own) as one piece. What remains in a task's open
bins, less than one bin for each class, is put together first-fit by decreasing length.

Defined results: a NULL text is empty and has the end token only; a NULL id is kept; repeated rows are packed
each; an empty table gives no rows; long texts are cut, never shortened; other columns are left behind.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
#: Pieces shorter than this are not cut further.
GRAIN = 32
END_ID = 0
#: Texts with a longer stretch without (or of) white space go to the slower encoder, whose time stays in proportion.
LONG_RUN = 1000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                   ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
_ENCODERS: dict[tuple[str, str], Callable[[str], list[int]]] = {}


def encoder(vocabulary: str, ranks: str) -> Callable[[str], list[int]]:
    """Text to ids as the tokenizers library gives them for the byte-level vocabulary file.

    The same vocabulary as ranks is four times as fast, and both agree on every code point. Texts with a very long
    run, or with the text of a special token, go to the library itself.
    """
    if (vocabulary, ranks) not in _ENCODERS:
        import tiktoken
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(vocabulary)
        special = {t.content: i for i, t in slow.get_added_tokens_decoder().items()}
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # Fixed value: the pattern by which byte-level vocabularies of this family split a text.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        blank = re.compile(rf"\s{{{LONG_RUN}}}")
        marks = re.compile("|".join(map(re.escape, special)) or r"(?!)")

        def encode(text: str) -> list[int]:
            if blank.search(text) or marks.search(text) or max(map(len, text.split()), default=0) > LONG_RUN:
                return slow.encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)

        _ENCODERS[vocabulary, ranks] = encode
    return _ENCODERS[vocabulary, ranks]


def cuts(length: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    out = [capacity] * (length // capacity)
    rest, size = length % capacity, capacity
    while rest >= grain:
        size //= 2
        if size <= rest and size >= grain:
            out.append(size)
            rest -= size
        elif size < grain:
            break
    return out + [rest] if rest else out


class Packer:
    """The bins of one task. ``put`` takes a piece; finished sequences are handed to ``emit``."""

    def __init__(self, first_id: int, emit: Callable[[int, list], None], capacity: int):
        self.next_id, self.emit, self.capacity = first_id, emit, capacity
        self.open: dict[int, list] = {}

    def close(self, pieces: list) -> None:
        self.emit(self.next_id, pieces)
        self.next_id += 1

    def put(self, piece: tuple) -> None:
        count = self.capacity // piece[2]
        bin_ = self.open.setdefault(count, [])
        bin_.append(piece)
        if len(bin_) == count:
            self.close(self.open.pop(count))

    def finish(self) -> None:
        """The open bins' pieces, first fit by decreasing length."""
        bins: list[tuple[int, list]] = []
        for piece in sorted((p for b in self.open.values() for p in b), key=lambda p: -p[2]):
            for i, (room, pieces) in enumerate(bins):
                if piece[2] <= room:
                    pieces.append(piece)
                    bins[i] = (room - piece[2], pieces)
                    break
            else:
                bins.append((self.capacity - piece[2], [piece]))
        for _, pieces in bins:
            self.close(pieces)


def _pack(vocabulary: str, ranks: str, capacity: int, grain: int, end_id: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        rows: list[tuple] = []

        def emit(sequence: int, pieces: list) -> None:
            at = 0
            for doc, start, length, ids, total in pieces:
                rows.append((doc, start, length, ids, total, sequence, at))
                at += length

        def batch() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(ARROW)
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW)
            rows.clear()
            return out

        packer = Packer(TaskContext.get().partitionId() << 40, emit, capacity)
        for b in batches:
            for i in range(b.num_rows):
                doc, text = b["doc_id"][i].as_py(), b["text"][i].as_py()
                ids = array("I", encode(text or ""))
                ids.append(end_id)
                start, data = 0, ids.tobytes()
                for length in cuts(len(ids), capacity, grain):
                    packer.put((doc, start, length, data[4 * start : 4 * (start + length)], len(ids)))
                    start += length
                if len(rows) >= 2000:
                    yield batch()
        packer.finish()
        yield batch()

    return pack


def pack(docs: DataFrame, vocabulary: str, ranks: str, capacity: int = CAPACITY, grain: int = GRAIN,
         end_id: int = END_ID) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text), one row each: doc_id, start (ids of the document before it), length,
    ids (unsigned 32-bit, little-endian), doc_tokens (with the end token), sequence_id, offset in the sequence.

    ``vocabulary`` and ``ranks`` are the two files of one tokenizer, at a path that every worker has. Sequence ids
    are made of the task's number and a count.
    """
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return picked.mapInArrow(_pack(vocabulary, ranks, capacity, grain, end_id), SCHEMA)
