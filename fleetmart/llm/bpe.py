"""BPE encoding and decoding with a lexicon of frequent words as a minimal acyclic transducer.

The frequent words of a corpus are counted in Spark, encoded once, and compiled into a transducer: a word's bytes are
the labels on its path, its ids are the outputs along it, pushed as near to the start as all words of a
prefix allow, and states with the same continuations are one state. The transducer is one small file (``LEXICON``
words at most) that executors fetch to their own disk and map into memory. Words that it lacks are merged exactly,
by the vocabulary's ranks.

The vocabulary file is that of a tokenizer with word ends: text is normalised (NFC, lower case), split into
contractions, runs of letters, single digits and runs of other signs, white space falls away, and a word's bytes are merged.
Ids are those of the tokenizers library. This Python's tables lack some of the newest code points; texts that hold
any of them are normalised and split by the library itself.

Defined results: a NULL text is empty and has no ids; special tokens standing in a text are their one id; repeated
rows are encoded each; an empty table gives no rows, and an empty corpus an empty lexicon; long texts and long
words are encoded whole; other columns are left behind.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import sys
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.base import shared_folder, staged, write_file

#: Frequent words in the transducer, at most.
LEXICON = 50_000
#: Words longer than this (in bytes) are merged, not looked up.
LONGEST = 64
#: Words after which a worker forgets those it has not met since it last did, and those it counts before it hands counts on.
REMEMBERED = 300_000
COUNTED = 300_000
#: Documents in one batch of results.
BATCH = 500
WORD_END = "</w>"
# Fixed value: how the vocabulary's words are cut out of a normalised text.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


#: Every code point below these is known.
_LATER = re.compile("[^\\x00-\\u0377]")


def _is_latin(text: str) -> bool:
    """Whether all code points are among the first 256, for which there is a faster pattern."""
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


@cache
def _latin_words() -> re.Pattern:
    """``WORDS`` for texts of the first 256 code points, with its classes written out."""
    of = lambda kind: "".join(f"\\x{c:02x}" for c in range(256) if regex.match(kind, chr(c)))
    letters, digits, blanks = of(r"\p{L}"), of(r"\p{N}"), of(r"\s")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{blanks}{letters}{digits}]+")


@cache
def _unknown_points() -> re.Pattern:
    """Code points that this Python's tables don't know."""
    ranges, start = [], None
    for c in range(0x378, sys.maxunicode + 2):
        free = c <= sys.maxunicode and unicodedata.category(chr(c)) == "Cn"
        if free and start is None:
            start = c
        elif not free and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile("[" + "".join(ranges) + "]")


@cache
def _byte_signs() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """A vocabulary file: words of a text, exact merges, and tokens of ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.ranks = {(self.ids[a], self.ids[b]): i for i, (a, b) in enumerate(pairs)}
        self.merged = [self.ids[a + b] for a, b in pairs]
        self.signs = dict(enumerate(_byte_signs()))
        self.byte_ids = [self.ids[s] for s in _byte_signs()]
        self.last_ids = [self.ids[s + WORD_END] for s in _byte_signs()]
        special = self.library.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in special.items()}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")" if special else "(?!)")
        size = max([*self.ids.values(), *special], default=-1) + 1
        self.tokens = [""] * size
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token

    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        latin = _is_latin(text)
        if not latin and _LATER.search(text) and _unknown_points().search(text):
            signs = {s: b for b, s in enumerate(_byte_signs())}
            cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(signs[s] for s in word).decode("utf-8") for word, _ in cut]
        text = unicodedata.normalize("NFC", text)
        if latin:  # and so still after composition
            return _latin_words().findall(text.lower())
        return WORDS.findall(text.replace("Σ", "σ").lower())  # the library knows no final sigma

    def parts(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """Special tokens (True) and the words between them (False), in order."""
        for i, part in enumerate(self.marks.split(text)) if self.special else [(0, text)]:
            if part:
                yield (True, [part]) if i % 2 else (False, self.words(part))

    def merge(self, word: str) -> tuple[int, ...]:
        """Ids of a word: the pair of least rank is merged, the first such pair first, until no pair has a rank.

        The library's merger does so for usual words; long ones are merged here, in less time than it would take.
        """
        data = word.encode("utf-8")
        if len(data) <= LONGEST:
            return tuple([t.id for t in self.library.model.tokenize(data.decode("latin-1").translate(self.signs))])
        ids = [self.byte_ids[b] for b in data[:-1]]
        ids.append(self.last_ids[data[-1]])
        return self._merge_long(ids)

    def _merge_long(self, ids: list[int]) -> tuple[int, ...]:
        """Merges with a queue of pairs, whose time doesn't grow with the square of the length."""
        parts: list[int | None] = list(ids)
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        queue: list[tuple] = []

        def offer(i: int) -> None:
            j = after[i]
            rank = self.ranks.get((parts[i], parts[j])) if i >= 0 and j >= 0 else None
            if rank is not None:
                heapq.heappush(queue, (rank, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while queue:
            rank, i, left, right = heapq.heappop(queue)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = self.merged[rank], None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return tuple(p for p in parts if p is not None)

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by blanks, as the library does for a vocabulary without a decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


class _State:
    __slots__ = ("arcs", "final", "rest")

    def __init__(self):
        self.arcs: dict[int, list] = {}  # label: [target, output]
        self.final, self.rest = False, ()


def _common(a: tuple, b: tuple) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def compile_lexicon(entries: dict[bytes, tuple[int, ...]]) -> bytes:
    """The minimal transducer of words and their ids, as the bytes of one file.

    Words are added in order. What the last word shares with the next stays open; the states behind are final in
    form, so each is looked up among the finished ones and replaced by its like. An output that a new word doesn't share
    is moved one state on.
    """
    finished: dict[tuple, int] = {}
    rows: list[tuple] = []

    def freeze(state: _State) -> int:
        key = (state.final, state.rest, tuple((c, t, o) for c, (t, o) in sorted(state.arcs.items())))
        if key not in finished:
            finished[key] = len(rows)
            rows.append(key)
        return finished[key]

    path, last = [_State()], b""
    for word in sorted(entries):
        output = entries[word]
        shared = _common(last, word)
        while len(path) - 1 > shared:
            state = path.pop()
            path[-1].arcs[last[len(path) - 1]][0] = freeze(state)
        for i in range(shared, len(word)):
            path[-1].arcs[word[i]] = [None, ()]
            path.append(_State())
        path[-1].final = True
        for i in range(shared):
            arc = path[i].arcs[word[i]]
            n = _common(arc[1], output)
            moved, arc[1], output = arc[1][n:], arc[1][:n], output[n:]
            if moved:
                state = path[i + 1]
                for onward in state.arcs.values():
                    onward[1] = moved + onward[1]
                if state.final:
                    state.rest = moved + state.rest
        if shared < len(word):
            path[shared].arcs[word[shared]][1] = output
        else:
            path[-1].rest = output
        last = word
    while len(path) > 1:
        state = path.pop()
        path[-1].arcs[last[len(path) - 1]][0] = freeze(state)
    root = freeze(path[0])

    first_arc, final, rest_start, labels, targets, output_start, pool = [0], [], [], [], [], [0], []
    rests: list[tuple] = []
    for is_final, rest, arcs in rows:
        for label, target, output in arcs:
            labels.append(label)
            targets.append(target)
            pool.extend(output)
            output_start.append(len(pool))
        first_arc.append(len(labels))
        final.append(int(is_final))
        rests.append(rest)
    for rest in rests:
        rest_start.append(len(pool))
        pool.extend(rest)
    rest_start.append(len(pool))
    numbers = [root, len(rows), len(labels), len(pool), *first_arc, *rest_start, *output_start, *targets, *pool]
    head = b"".join(n.to_bytes(4, sys.byteorder) for n in numbers)
    return head + bytes(final) + bytes(labels)


class Lexicon:
    """A compiled transducer over any buffer, such as a file mapped into memory."""

    def __init__(self, data):
        view = memoryview(data)
        root, states, arcs, pool = view[:16].cast("i")
        at = 16

        def numbers(n: int):
            nonlocal at
            part = view[at : at + 4 * n].cast("i")
            at += 4 * n
            return part

        self.root = root
        self.first_arc, self.rest_start, self.output_start = numbers(states + 1), numbers(states + 1), numbers(arcs + 1)
        self.targets, self.pool = numbers(arcs), numbers(pool)
        self.final, self.labels = view[at : at + states], data
        self.labels_at = at + states

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def get(self, word: bytes) -> tuple[int, ...] | None:
        """Ids of a word, or None if it isn't here."""
        state, out = self.root, []
        first, find, base, output = self.first_arc, self.labels.find, self.labels_at, self.output_start
        for i in range(len(word)):
            arc = find(word[i : i + 1], base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return None
            start, end = output[arc], output[arc + 1]
            if start != end:
                out += self.pool[start:end]
            state = self.targets[arc]
        if not self.final[state]:
            return None
        return (*out, *self.pool[self.rest_start[state] : self.rest_start[state + 1]])


class _Memory(dict):
    """Words that a worker has met, from the lexicon or merged: their ids as 32-bit numbers end to end, and the ids' text."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon, self.before = vocabulary, lexicon, {}

    def __missing__(self, word: str) -> tuple[bytes, str]:
        if len(self) >= REMEMBERED:  # what was met since the last time outlives this one, the rest goes
            self.before = dict(self)
            self.clear()
        found = self.before.get(word)
        if found is None:
            data = word.encode("utf-8")
            ids = self.lexicon.get(data) if len(data) <= LONGEST else None
            if ids is None:
                ids = self.vocabulary.merge(word)
            found = array("i", ids).tobytes(), self.vocabulary.decode(ids)
            if len(data) > LONGEST:
                return found
        self[word] = found
        return found


def encode_words(memory: _Memory, text: str) -> list[tuple[bytes, str]]:
    """Every word's ids and their text, in order."""
    out: list[tuple[bytes, str]] = []
    for special, words in memory.vocabulary.parts(text):
        if special:
            i = memory.vocabulary.special[words[0]]
            out.append((array("i", [i]).tobytes(), memory.vocabulary.decode([i])))
        else:
            out += map(memory.__getitem__, words)
    return out


def encode_text(memory: _Memory, text: str) -> list[int]:
    return array("i", b"".join([ids for ids, _ in encode_words(memory, text)])).tolist()


@cache
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@cache
def _memory(path: str, lexicon: str) -> _Memory:
    return _Memory(_vocabulary(path), Lexicon.mapped(lexicon))


def _count(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        counts: Counter[str] = Counter()

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )
            counts.clear()
            return out

        for part in batches:
            for text in part["text"]:
                for special, words in vocabulary.parts(text.as_py() or ""):
                    if not special:
                        counts.update(words)
                if len(counts) >= COUNTED:
                    yield batch()
        yield batch()

    return count


def frequent_words(docs: DataFrame, vocabulary: str, most: int = LEXICON) -> list[str]:
    """The words that occur most in all texts of ``docs``, ``most`` of them at the utmost, and none that occurs once.

    Words go in or stay out by levels of their count, a few thousand in all: so the driver gets the number of words
    of each level, and then no more words than asked for, whatever the size of the corpus.
    """
    counts = docs.select("text").mapInArrow(_count(vocabulary), "word string, n long")
    counts = counts.where(F.octet_length("word") <= LONGEST).groupBy("word").agg(F.sum("n").alias("n"))
    level = F.floor(F.log2("n") * 64).alias("level")
    counts = staged(counts.where("n > 1").select("word", level), "word-counts")
    lowest, room = None, most
    for row in counts.groupBy("level").count().orderBy(F.desc("level")).collect():
        room -= row["count"]
        if room < 0:
            break
        lowest = row["level"]
    return [] if lowest is None else [r["word"] for r in counts.where(F.col("level") >= lowest).collect()]


def publish_lexicon(docs: DataFrame, vocabulary: str, most: int = LEXICON) -> str:
    """Compile the frequent words of ``docs`` and give the file to all executors; returns its name."""
    spark, words = docs.sparkSession, _vocabulary(vocabulary)
    data = compile_lexicon({w.encode("utf-8"): words.merge(w) for w in frequent_words(docs, vocabulary, most)})
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    uri = f"{shared_folder(spark, 'lexicon')}/{name}"
    write_file(spark, uri, data)
    spark.sparkContext.addFile(uri)
    return name


SCHEMA = "doc_id long, ids array<int>, decoded string"


def _encode(vocabulary: str, lexicon: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(vocabulary, SparkFiles.get(lexicon))
        for part in batches:
            for start in range(0, part.num_rows, BATCH):
                some = part.slice(start, BATCH)
                found = [encode_words(memory, text.as_py() or "") for text in some["text"]]
                ids = [b"".join([i for i, _ in words]) for words in found]
                decoded = [" ".join([t for _, t in words]) for words in found]
                ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [some["doc_id"], lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"]
                )

    return encode


def encode_documents(docs: DataFrame, vocabulary: str, lexicon: str) -> DataFrame:
    """doc_id, ids and decoded (the text that the ids give) of every row of ``docs`` (doc_id, text).

    ``vocabulary`` is a file at a path that every worker has, ``lexicon`` a name from ``publish_lexicon``.
    """
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return picked.mapInArrow(_encode(vocabulary, lexicon), SCHEMA)
