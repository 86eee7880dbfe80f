"""Alignment of two tokenizers' tokens over the same texts, and how often token ids are linked in the whole corpus.

A text is tokenized whole by both. Where a token that is marked by a leading blank begins at the same byte on both sides, both
sides' earlier tokens end there, too: these verified shared ends split a document into windows, mostly one word each. A
window is named by the two tuples of its token ids; what it holds (its groups, cut where tokens of both sides end, and its links,
all pairs of tokens in one group) is worked out once a block and looked up from then on.

Documents are aligned in blocks of about ``BLOCK`` bytes. A block keeps its documents as lists of window numbers, its
windows as lists of id pairs, and in how many of its documents each pair is linked. The corpus-wide counts of its pairs come
back to it through a join on the pair, with one row for each block and pair, and turn into sums for windows, then for
documents. Nothing is broadcast; no row is kept for each link.

Defined results: see ``align``.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.base import staged

#: Bytes of text in a block, if it isn't a single longer text.
BLOCK = 1 << 20
#: Texts with a longer run without (or of) white space go to the slower of the two encoders for A, whose time stays in proportion.
LONG_RUN = 1000
LINK = 32  # an id pair is one number: A's id in the upper half, B's in the lower
B_MARK = np.int32(1 << 30)  # tells B's ids from A's in a window's name


class Tokenizers:
    """Both tokenizers with their token bytes. A is a byte-level vocabulary (and the same as ranks), B a piece model."""

    def __init__(self, vocabulary: str, ranks: str, pieces: str):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self._slow = Tokenizer.from_file(vocabulary)
        self._slow.encode_special_tokens = True  # special tokens' strings are plain text
        self._blank = re.compile(rf"\s{{{LONG_RUN}}}")
        self._model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        a_bytes = [b""] * (max(table.values()) + 1)
        for token, i in table.items():
            a_bytes[i] = token
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        byte = [self._model.is_byte(i) for i in range(len(names))]
        self.b_bytes = [bytes([int(n[3:5], 16)]) if b else n.replace("▁", " ").encode() for n, b in zip(names, byte)]
        self.a_length, self.b_length = (np.array([len(t) for t in side]) for side in (a_bytes, self.b_bytes))
        self.a_marked, self.b_marked = (np.array([t[:1] == b" " for t in side]) for side in (a_bytes, self.b_bytes))
        # A token's text in a window's groups: with what follows it inside its group, and at its group's end.
        a, b = range(len(a_bytes)), range(len(names))
        self.told = [f"{i}," for i in a] + [f"{i}|" for i in a] + [f"{i}," for i in b] + [f"{i};" for i in b]

    def a(self, text: str) -> np.ndarray:
        if len(text) > LONG_RUN and (self._blank.search(text) or max(map(len, text.split()), default=0) > LONG_RUN):
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.int32)
        return self._fast.encode_to_numpy(text, disallowed_special=()).view(np.int32)

    def b(self, text: str) -> np.ndarray | None:
        """B's ids; None where they don't give back a blank and the text."""
        ids = self._model.encode(text)
        same = b"".join([self.b_bytes[i] for i in ids]) == f" {text}".encode()
        return np.array(ids, np.int32) if same else None

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """A's and B's ids, if both cover a blank and the text to the byte."""
        if not text:
            return None
        whole = f" {text}"
        b = self.b(text)
        if b is None:
            return None
        a = self.a(whole)
        same = self.a_length[a].sum() == self.b_length[b].sum()  # A's tokens are bytes, B's were compared
        return (a, b) if same else None


@cache
def tokenizers(vocabulary: str, ranks: str, pieces: str) -> Tokenizers:
    return Tokenizers(vocabulary, ranks, pieces)


class Numbers(dict):
    """Numbers names from 0 on as they come."""

    def __missing__(self, name: bytes) -> int:
        self[name] = number = len(self)
        return number


def splits(a: np.ndarray, b: np.ndarray, a_firsts: np.ndarray, b_firsts: np.ndarray, of: Tokenizers) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b``, the ids of documents put end to end, at which windows begin: the documents' first tokens and
    marked tokens that begin at the same byte."""
    a_length, b_length = of.a_length[a], of.b_length[b]
    a_mark, b_mark = of.a_marked[a], of.b_marked[b]
    a_mark[a_firsts] = b_mark[b_firsts] = True
    a_at, b_at = np.flatnonzero(a_mark), np.flatnonzero(b_mark)
    a_byte, b_byte = (np.cumsum(a_length) - a_length)[a_at], (np.cumsum(b_length) - b_length)[b_at]
    left, right = _meeting(a_byte, b_byte)
    return a_at[left], b_at[right]


def _meeting(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values that two rising arrays share."""
    at = np.searchsorted(y, x)
    left = np.flatnonzero(y[np.minimum(at, len(y) - 1)] == x) if len(y) else np.empty(0, np.int64)
    return left, at[left]


def _expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of runs that begin at ``starts``."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values``."""
    total, ends = np.append(0, np.cumsum(values)), np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


class Windows:
    """Groups and links of windows, all at once: ``a`` and ``b`` are their ids end to end, ``a_sizes`` and ``b_sizes`` the
    windows' numbers of tokens. A window has as many bytes on both sides, so ends are shared where running sums are equal."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, of: Tokenizers):
        a_last, b_last = _meeting(np.cumsum(of.a_length[a]), np.cumsum(of.b_length[b]))
        n_a, n_b = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
        self.groups = np.diff(np.searchsorted(a_last, np.cumsum(a_sizes) - 1, "right"), prepend=0)
        pairs = n_a * n_b
        group = np.repeat(np.arange(len(pairs)), pairs)
        within = _expand(np.zeros(len(pairs), np.int64), pairs)
        left = a[(a_last + 1 - n_a)[group] + within // n_b[group]].astype(np.int64)
        self.links = (left << LINK) | b[(b_last + 1 - n_b)[group] + within % n_b[group]]
        self.sizes = _sums(pairs, self.groups)
        # Each group's tokens as text: A's, a bar, B's, a semicolon.
        named = np.empty(len(a) + len(b), np.int64)
        a_code, b_code = a.astype(np.int64), b + 2 * len(of.a_length)
        a_code[a_last] += len(of.a_length)
        b_code[b_last] += len(of.b_length)
        group_of = lambda n: np.repeat(np.arange(len(n)), n)
        named[np.arange(len(a)) + (np.cumsum(n_b) - n_b)[group_of(n_a)]] = a_code
        named[np.arange(len(b)) + np.cumsum(n_a)[group_of(n_b)]] = b_code
        words = list(map(of.told.__getitem__, named.tolist()))
        ends = np.cumsum(a_sizes + b_sizes).tolist()
        self.text = ["".join(words[s:e]) for s, e in zip([0, *ends], ends)]


def _documents(windows: np.ndarray, n_windows: np.ndarray, sizes: np.ndarray, links: np.ndarray, n_pairs: int) -> np.ndarray:
    """In how many documents each pair is linked."""
    if not n_pairs:
        return np.empty(0, np.int64)
    once = _unique(np.repeat(np.arange(len(n_windows)), n_windows) * len(sizes) + windows)
    doc, window = np.divmod(once, len(sizes))
    each = np.repeat(doc, sizes[window]) * n_pairs + links[_expand((np.cumsum(sizes) - sizes)[window], sizes[window])]
    return np.bincount(_unique(each) % n_pairs, minlength=n_pairs)


def _unique(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])]


#: Lists of numbers of a block that only Python reads, each packed as the narrowest kind that holds it.
PACKED = "n_a n_b n_groups n_links n_windows windows sizes links".split()
BLOCK_SCHEMA = (
    "block long, doc_id array<long>, groups_sha256 array<string>, pairs array<long>, linked array<long>, "
    + ", ".join(f"{c} binary" for c in PACKED)
)


def _pack(x: np.ndarray) -> bytes:
    kind = next(k for k in ("u1", "<u2", "<u4", "<u8") if not len(x) or int(x.max()) <= np.iinfo(k).max)
    return kind[-1].encode() + x.astype(kind).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[:1].decode()}", offset=1).astype(np.int64)


def align_block(texts: list[str | None], of: Tokenizers) -> dict[str, object]:
    """One block: numbers and digest of each document, its windows' numbers, each window's links (as places in ``pairs``), the id
    pairs and in how many of the block's documents each is linked."""
    found = [of.tokens(t) for t in texts]
    held = [f for f in found if f]
    n_a, n_b = (np.array([len(f[side]) if f else 0 for f in found], np.int64) for side in (0, 1))
    a, b = (np.concatenate([f[side] for f in held]) if held else np.empty(0, np.int32) for side in (0, 1))
    a_first, b_first = ((np.cumsum(n) - n)[n > 0] for n in (n_a, n_b))
    left, right = splits(a, b, a_first, b_first, of)
    # A window's name is made of its two tuples of ids.
    a_cuts, b_cuts = np.append(left, len(a)), np.append(right, len(b))
    a_raw, b_raw = a.tobytes(), (b | B_MARK).tobytes()
    at = [(4 * c).tolist() for c in (a_cuts, b_cuts)]
    numbers = Numbers()
    number = np.array([numbers[a_raw[s:e] + b_raw[u:v]] for s, e, u, v in zip(at[0], at[0][1:], at[1], at[1][1:])], np.int64)
    _, first = np.unique(number, return_index=True)
    a_sizes, b_sizes = np.diff(a_cuts)[first], np.diff(b_cuts)[first]
    windows = Windows(a[_expand(left[first], a_sizes)], b[_expand(right[first], b_sizes)], a_sizes, b_sizes, of)
    n_windows = np.zeros(len(texts), np.int64)
    n_windows[n_a > 0] = np.diff(np.append(np.searchsorted(left, a_first), len(number)))
    ends, parts, order = np.cumsum(n_windows).tolist(), windows.text, number.tolist()
    told = ["".join([parts[w] for w in order[e - n : e]])[:-1] for n, e in zip(n_windows.tolist(), ends)]
    pairs, links = np.unique(windows.links, return_inverse=True)
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": _sums(windows.groups[number], n_windows),
        "n_links": _sums(windows.sizes[number], n_windows), "n_windows": n_windows, "windows": number, "sizes": windows.sizes,
        "links": links, "pairs": pairs, "linked": _documents(number, n_windows, windows.sizes, links, len(pairs)),
        "groups_sha256": [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in told],
    }


def _aligned(paths: tuple[str, str, str], block_bytes: int) -> Callable:
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = tokenizers(*paths)
        ids, texts, size, number = [], [], 0, TaskContext.get().partitionId() << 40

        def block() -> pa.RecordBatch:
            lists = align_block(texts, of)
            columns = [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64()))]
            columns.append(pa.array([lists["groups_sha256"]], pa.list_(pa.string())))
            columns += [pa.array([lists[c]], pa.list_(pa.int64())) for c in ("pairs", "linked")]
            columns += [pa.array([_pack(lists[c])], pa.binary()) for c in PACKED]
            return pa.RecordBatch.from_arrays(columns, names=["block", "doc_id", "groups_sha256", "pairs", "linked", *PACKED])

        for batch in batches:
            for i in range(batch.num_rows):
                text = batch["text"][i].as_py()
                ids.append(batch["doc_id"][i].as_py())
                texts.append(text)
                size += len(text.encode()) if text else 0
                if size >= block_bytes:
                    yield block()
                    ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield block()

    return aligned


OUT = pa.schema([*[(c, pa.int64()) for c in "doc_id n_a n_b n_groups n_links n_best count_sum".split()], ("groups_sha256", pa.string())])
OUT_SCHEMA = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in OUT)


def _with_counts(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one block, with the sums that need the counts of its pairs."""
    of = {c: _unpack(blocks[c][0].as_py()) for c in PACKED}
    listed = {c: blocks[c].combine_chunks()[0].values for c in ("doc_id", "groups_sha256")}
    place, n_pairs = counts["place"].to_numpy(), counts.num_rows
    n, best = (np.zeros(n_pairs, np.int64) for _ in range(2))
    n[place], best[place] = counts["n"].to_numpy(), counts["best"].to_numpy()
    # Sums of a window's links, and of a document's windows.
    by_window = [_sums(v[of["links"]], of["sizes"]) for v in (best, n)]
    n_best, count_sum = (_sums(v[of["windows"]], of["n_windows"]) for v in by_window)
    numbers = [pa.array(x) for x in (*(of[c] for c in ("n_a", "n_b", "n_groups", "n_links")), n_best, count_sum)]
    return pa.Table.from_arrays([listed["doc_id"], *numbers, listed["groups_sha256"]], schema=OUT)


def align(docs: DataFrame, vocabulary: str, ranks: str, pieces: str, block_bytes: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) of ``docs`` (doc_id, text).

    Documents have one row for each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Pairs are
    a, b, n (documents that hold the pair linked) and best (whether no pair of ``a`` has more). ``vocabulary`` and ``ranks``
    are the two files of tokenizer A, ``pieces`` is the model of B, at paths that every worker has.

    Defined results: a NULL or empty text, and one that a tokenizer doesn't give back to the byte, has no tokens, zeros and an
    empty text for its digest; a NULL id is kept; repeated rows are documents of their own, in the counts, too; pairs tied for
    the most are all best; long texts are aligned whole, each in a block of its own; an empty table gives no rows; other
    columns are left behind.
    """
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = staged(picked.mapInArrow(_aligned((vocabulary, ranks, pieces), block_bytes), BLOCK_SCHEMA), "aligned")
    each = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "linked")).alias("place", "of"))
    each = each.select("block", "place", F.col("of.pairs").alias("pair"), F.col("of.linked").alias("n"))
    counts = staged(each.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("pair", LINK)), "pairs")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = counts.join(most, "a").withColumn("best", (F.col("n") == F.col("most")).cast("long"))
    told = each.drop("n").join(counts.select("pair", "n", "best"), "pair")
    told = told.select(F.col("block").alias("of_block"), F.col("place").cast("long").alias("place"), "n", "best")
    documents = blocks.drop("pairs", "linked").groupBy("block").cogroup(told.groupBy("of_block")).applyInArrow(_with_counts, OUT_SCHEMA)
    shown = counts.select("a", F.col("pair").bitwiseAND((1 << LINK) - 1).alias("b"), "n", (F.col("best") == 1).alias("best"))
    return documents, shown
