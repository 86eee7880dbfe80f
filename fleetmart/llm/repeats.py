"""Bytes of repeated strings, found on Burrows-Wheeler transforms of the texts that may hold them.

Every byte string of ``LEAST`` bytes that starts at two places of a corpus is a repeat, and its bytes are removed. Whole texts
that occur several times are put together first. The strings (windows) of a text are then dealt out by content: a window's
anchor is the place in it whose next ``GRAM`` bytes have the least hash, the leftmost of several, so equal windows have equal
anchors at the same distance. Neighbouring windows with one anchor are one segment, and segments whose anchors' bytes
differ need never meet. What is shuffled for each segment is a few numbers; segments with equal bytes are counted together, so
a passage that a third of all documents hold is one row for each task. Where all segments of an anchor are equal, all their
windows repeat. Where they differ, as at the ends of passages and about changed words, one text of each meets the others of
its anchor in a task, which puts many such groups into one text and builds its transform.

There, intervals of suffixes that share a prefix are widened breadth first by backward extension: the intervals of
strings of length d, found for the first time, give those of length d + 1, and every right end found for the first time at
depth d ends a common prefix of d bytes. After ``LEAST`` rounds the work stops: the prefixes that are still without an end are
as long as asked for, whatever their length. Windows between two ends are equal; those met twice, or once in a segment that
occurs twice, repeat.

An anchor with more than ``CROWD`` different segments is not brought to one task: its segments are cut into shorter ones,
whose windows share ever more bytes, until a window is alone, and each level's groups are treated like the first's. So no group is
collected that grows with the corpus, and none is cut off.

Defined results: see ``repeated_bytes``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.base import staged
from fleetmart.llm.spread import join_spread
from fleetmart.llm.textbytes import slices

#: Bytes of the shortest repeat.
LEAST = 200
#: Bytes whose hash chooses and names an anchor.
GRAM = 64
#: Different segments of one anchor that may meet in one task.
CROWD = 2000
#: Windows in a segment of each level beyond the first.
LEVELS = (32, 8, 1)
#: Bytes of text whose anchors are looked for at once.
BLOCK = 1 << 18
#: Bytes of the texts that share a transform, if one group has not more.
TOGETHER = 1 << 18
_PLACE = np.uint64((1 << 23) - 1)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASES = (0xD1342543DE82EF95, 0x2545F4914F6CDD1D)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


@cache
def _powers(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)]))


class Hashes:
    """Hashes of any stretch of eight bytes or more, from running sums over eight bytes at each place."""

    def __init__(self, data: np.ndarray):
        n = max(len(data) - 7, 0)
        words = np.empty(n, np.uint64)
        raw = data.tobytes()
        for i in range(min(8, n)):
            each = np.frombuffer(raw, "<u8", count=(len(raw) - i) // 8, offset=i)
            words[i::8] = each[: len(words[i::8])]
        self.words = _mix(words + _M1)
        size = 1 << max(int(n).bit_length(), 10)
        self.back = [_powers(pow(b, -1, 1 << 64), size) for b in _BASES]
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.words * _powers(b, size)[:n])]) for b in _BASES]

    def of(self, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        total = self.sums[which]
        return _mix((total[ends - 7] - total[starts]) * self.back[which][starts] + (ends - starts).astype(np.uint64))

    def grams(self) -> np.ndarray:
        """Hash of the ``GRAM`` bytes from each place on."""
        total, k = self.sums[0], GRAM - 7
        n = len(total) - k
        return _mix((total[k:] - total[:n]) * self.back[0][:n] + np.uint64(GRAM))


def _least_over(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def _shaped(hashes: Hashes, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of each segment's bytes and of where its anchor and windows lie."""
    shape = ((at - low).astype(np.uint64) << np.uint64(32)) + (high - low).astype(np.uint64)
    return _mix(hashes.of(low, high + LEAST, 1) ^ _mix(shape + _M1))


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text number, first window, last window, anchor, anchor's hash, segment's hash) of all segments, by place."""
    width = LEAST - GRAM + 1
    if len(data) < LEAST:
        return tuple(np.empty(0, np.uint64 if i > 3 else np.int64) for i in range(6))
    hashes = Hashes(data)
    grams = hashes.grams()
    least = _least_over((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), width)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = np.arange(len(data) - LEAST + 1)
    starts = starts[starts + LEAST <= offsets[1:][owner[: len(starts)]]]
    anchor = (least[starts] & _PLACE).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    low, high, at = starts[first], starts[np.append(first[1:], len(starts)) - 1] if len(first) else starts[:0], anchor[first]
    return owner[low], low, high, at, grams[at], _shaped(hashes, at, low, high)


SEGMENT = "low long, high long, at long, h long, g long"
MORE = "more array<long>"


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of whole texts. Equal ones of one text are one row, with the places of all but the first in ``more``."""
    for batch in batches:
        for first, data, offsets in slices(batch["text"], BLOCK):
            if len(data) >= LEAST:
                yield from _rows(batch.slice(first, len(offsets) - 1), data, offsets)


def _rows(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> Iterator[pa.RecordBatch]:
    step = int(_PLACE) + 1 - LEAST
    for begin in range(0, max(len(data) - LEAST + 1, 1), step):  # more than one step for a single text of 8 MB or more only
        part = data[begin : begin + step + LEAST - 1]
        cut = offsets if begin == 0 and len(part) == len(data) else np.array([0, len(part)])
        text, low, high, at, h, g = segments(part, cut)
        order = np.lexsort((low, g, h, text))
        text, h, g = text[order], h[order], g[order]
        same = np.zeros(len(order), bool)
        same[1:] = (text[1:] == text[:-1]) & (h[1:] == h[:-1]) & (g[1:] == g[:-1])
        heads = np.flatnonzero(~same)
        base = begin - cut[text]
        low, high, at = (c[order] + base for c in (low, high, at))
        sizes = np.diff(np.append(heads, len(order)))
        more = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes - 1)), pa.int32()), pa.array(low[same], pa.int64()))
        columns = [batch[c].take(pa.array(text[heads])) for c in ("key", "copies")]
        columns += [pa.array(c[heads], pa.int64()) for c in (low, high, at)]
        columns += [pa.array(c[heads].view(np.int64)) for c in (h, g)]
        yield pa.RecordBatch.from_arrays([*columns, more], names=["key", "copies", "low", "high", "at", "h", "g", "more"])


def _cut_finer(width: int, level: int):
    """Segments of the bytes in ``part``, cut into pieces of ``width`` windows at most, by their distance from the anchor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (_, data, offsets), = slices(batch["part"], 1 << 62)
            given = {c: batch[c].to_numpy() for c in ("low", "high", "at", "h", "g", "n")}
            size, far = given["high"] - given["low"], given["at"] - given["low"]
            block = [far // width, (far - size) // width]  # of the first and of the last window
            count = block[0] - block[1] + 1
            row = np.repeat(np.arange(batch.num_rows), count)
            number = np.repeat(block[0], count) - (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
            anchor = offsets[:-1][row] + far[row]
            low = np.maximum(offsets[:-1][row], anchor - number * width - (width - 1))
            high = np.minimum(offsets[:-1][row] + size[row], anchor - number * width)
            hashes = Hashes(data)
            core = hashes.of(anchor - number * width, anchor - number * width - (width - 1) + LEAST)
            shape = _mix(number.astype(np.uint64) + np.uint64(level << 40))
            off = low - offsets[:-1][row]
            moved = given["low"][row] - offsets[:-1][row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(given["h"][row]), pa.array(given["g"][row]), pa.array(off), batch["key"].take(pa.array(row)),
                 pa.array(low + moved), pa.array(high + moved), pa.array(anchor + moved), pa.array(_mix(core ^ shape).view(np.int64)),
                 pa.array(_shaped(hashes, anchor, low, high).view(np.int64)), pa.array(given["n"][row])],
                names=["of_h", "of_g", "off", "key", "low", "high", "at", "h", "g", "n"],
            )

    return cut


def rotations(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all rotations, in the order of their first ``depth`` symbols at least (0 to 511)."""
    n = len(symbols)
    bits = (n - 1).bit_length()  # of a place or a rank
    used = np.bincount(symbols) > 0
    code, base, have = (np.cumsum(used) - 1)[symbols], max(int(used.sum()), 2), 1
    while base ** (have + 1) <= 1 << max(63 - bits, 0):
        have += 1
    key = code
    for i in range(1, have):
        key = key * base + np.roll(code, -i)
    places, rank = np.arange(n), np.empty(n, np.int64)
    while True:
        if 3 * bits <= 63:  # key and place fit into one number, and numbers are sorted faster than their places
            held = np.sort(key << bits | places)
            order = held & ((1 << bits) - 1)
            held >>= bits
        else:
            order = np.argsort(key)
            held = key[order]
        ranks = np.append(0, np.cumsum(held[1:] != held[:-1]))
        if have >= depth or ranks[-1] == n - 1:
            return order
        rank[order] = ranks
        key = rank << bits | np.roll(rank, -have)
        have *= 2


def bounded_prefixes(last: np.ndarray, least: int) -> np.ndarray:
    """Length of the common prefix of each sorted rotation with the one before it, where it is under ``least``; else -1.

    ``last`` holds the symbol before each sorted rotation. Intervals of all strings of one length are extended backwards
    together, by every symbol that stands before them; an interval goes on if its right end is new. Intervals are kept in
    order, so sorting the symbols of their places stably, which is cheap for 16 bits, brings the places reached in order.
    """
    n, last = len(last), last.astype(np.uint16)
    to = np.empty(n, np.int32)
    to[np.argsort(last, kind="stable")] = np.arange(n, dtype=np.int32)
    common = np.full(n + 1, -1, np.int32)
    common[0] = common[n] = 0
    low, high = np.array([0], np.int32), np.array([n], np.int32)
    for length in range(least):
        if not len(low):
            break
        sizes = high - low
        ends = np.cumsum(sizes, dtype=np.int32)
        places = np.arange(ends[-1], dtype=np.int32) + np.repeat(low - (ends - sizes), sizes)
        symbol = last[places]
        order = np.argsort(symbol, kind="stable")
        reached, symbol = to[places[order]], symbol[order]
        held = np.repeat(np.arange(len(low), dtype=np.int32), sizes)[order]
        breaks = np.flatnonzero((held[1:] != held[:-1]) | (symbol[1:] != symbol[:-1]))
        starts, stops = reached[np.append(0, breaks + 1)], reached[np.append(breaks, len(reached) - 1)] + 1
        new = common[stops] < 0
        common[stops[new]] = length
        low, high = starts[new], stops[new]
    return common[:n]


def repeated_windows(parts: list[bytes], times: np.ndarray, least: int = LEAST) -> list[np.ndarray]:
    """For each part, which of its windows of ``least`` bytes occur twice in all; part i occurs ``times[i]`` times."""
    symbols = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int64) + 1, 0) for p in parts])
    order = rotations(symbols, least)
    common = bounded_prefixes(symbols[order - 1], least)
    interval = np.empty(len(order), np.int64)
    interval[order] = np.cumsum(common >= 0) - 1
    sizes = np.array([len(p) for p in parts])
    begins = np.cumsum(sizes + 1) - sizes - 1
    counts = np.maximum(sizes - least + 1, 0)
    windows = np.arange(counts.sum()) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
    met = np.bincount(interval[windows], np.repeat(times, counts), minlength=len(order))
    return np.split(met[interval[windows]] >= 2, np.cumsum(counts)[:-1])


def _runs(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"first": int(a), "n": int(b - a)} for a, b in zip(edge[::2], edge[1::2])]


RUNS = pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())]))


def _transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows of each segment; rows come in the order of ``h``, and groups are not torn apart."""
    rows, size = [], 0

    def done() -> pa.RecordBatch:
        found = repeated_windows([r[2] for r in rows], np.array([r[3] for r in rows]))
        kept = [(h, g, runs) for (h, g, _, _), runs in zip(rows, map(_runs, found)) if runs]
        h, g, runs = zip(*kept) if kept else ((), (), ())
        columns = [pa.array(h, pa.int64()), pa.array(g, pa.int64()), pa.array(runs, RUNS)]
        return pa.RecordBatch.from_arrays(columns, names=["h", "g", "runs"])

    for batch in batches:
        for h, g, part, n in zip(*[batch[c].to_pylist() for c in ("h", "g", "part", "n")]):
            if size >= TOGETHER and rows[-1][0] != h:
                yield done()
                rows, size = [], 0
            rows.append((h, g, part, n))
            size += len(part)
    if rows:
        yield done()


def _with_parts(segments_: DataFrame, texts: DataFrame) -> DataFrame:
    """The segments with their bytes. ``texts`` lie in buckets by key, so only the segments' numbers are shuffled."""
    wanted = segments_.groupBy("key").agg(F.collect_list(F.struct("low", "high", "at", "h", "g", "n")).alias("s"))
    each = texts.join(wanted, "key").select("key", F.encode("text", "utf-8").alias("raw"), F.explode("s").alias("s"))
    part = F.substring(F.col("raw"), F.col("s.low").cast("int") + 1, (F.col("s.high") - F.col("s.low") + LEAST).cast("int"))
    return each.select("key", "s.*", part.alias("part"))


def _one_of_each(rows: DataFrame, times: Column) -> DataFrame:
    """One segment of each kind, and how often the kind occurs."""
    one = rows.groupBy("h", "g").agg(F.sum(times).alias("n"), F.min(F.struct("key", "low", "high", "at")).alias("one"))
    return one.select("one.*", "h", "g", "n")


ALL = "array(named_struct('first', 0L, 'n', high - low + 1))"  # all windows of a segment
RUNS_SQL = "array<struct<first:long,n:long>>"


def decide(kinds: DataFrame, texts: DataFrame, crowd: int, level: int = 0) -> DataFrame:
    """h, g, runs: the repeated windows of all kinds of segments (key, low, high, at, h, g, n) that have any."""
    groups = kinds.groupBy("h").agg(F.sum("n").alias("all"), F.count("*").alias("kinds")).where("all > 1")
    kinds = staged(kinds.join(groups, "h"), "segment-kinds")
    equal = kinds.where("kinds = 1").select("h", "g", F.expr(ALL).alias("runs"))
    crowded = F.lit(level < len(LEVELS)) & (F.col("kinds") > crowd)
    few = _with_parts(kinds.where((F.col("kinds") > 1) & ~crowded), texts).select("h", "g", "part", "n")
    met = few.repartition("h").sortWithinPartitions("h").mapInArrow(_transformed, f"h long, g long, runs {RUNS_SQL}")
    out = equal.unionByName(met)
    many = kinds.where(crowded)
    if level == len(LEVELS) or many.isEmpty():
        return staged(out, "repeated-windows")
    schema = f"of_h long, of_g long, off long, key binary, {SEGMENT}, n long"
    finer = staged(_with_parts(many, texts).mapInArrow(_cut_finer(LEVELS[level], level), schema), "finer-segments")
    found = decide(_one_of_each(finer, F.col("n")), texts, crowd, level + 1)
    met = join_spread(finer, found.join(_copies(finer), ["h", "g"]), ["h", "g"], "copies")
    moved = F.transform("runs", lambda r: F.struct((r["first"] + F.col("off")).alias("first"), r["n"].alias("n")))
    whole = met.groupBy("of_h", "of_g").agg(F.flatten(F.collect_list(moved)).alias("runs"))
    return staged(out.unionByName(whole.select(F.col("of_h").alias("h"), F.col("of_g").alias("g"), "runs")), "repeated-windows")



def _copies(rows: DataFrame) -> DataFrame:
    return rows.groupBy("h", "g").agg(F.count("*").alias("copies"))


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, digests = [], []
        for text, runs in zip(batch["text"], batch["runs"].to_pylist()):
            raw = (text.as_py() or "").encode()
            edges = np.zeros(len(raw) + 1, np.int32)
            for run in runs or ():
                edges[run["first"]] += 1
                edges[run["first"] + run["n"] + LEAST - 1] -= 1
            gone = np.cumsum(edges)[:-1] > 0
            found = _runs(gone)
            spans.append([{"start": s["first"], "end": s["first"] + s["n"]} for s in found])
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if found else raw
            digests.append(hashlib.sha256(kept).hexdigest())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch["key"], batch["copies"], pa.array(spans, kind), pa.array(digests, pa.string())],
            names=["key", "copies", "spans", "kept_sha256"],
        )


def repeated_bytes(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_bytes, spans (array of start and end, in UTF-8 bytes, end
    exclusive, none touching the next) of the repeated bytes, and the SHA-256 of what is left.

    Defined results: a NULL text is empty; a text shorter than ``LEAST`` bytes has no spans; a NULL id is kept; repeated
    rows are repeats of each other from ``LEAST`` bytes on; a string that overlaps its own copy is a repeat; very long texts
    are searched whole; an empty table gives no rows; other columns are left behind. ``kept`` gives the remaining bytes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.unhex(F.md5("text")))
    name = f"fleetmart_texts_{uuid.uuid4().hex}"
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = rows.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    try:
        texts.write.bucketBy(slots, "key").format("parquet").saveAsTable(name)
        told = _by_text(spark.table(name), crowd)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    narrow = rows.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"))
    return join_spread(narrow, told, ["key"], "copies").select("doc_id", "n_bytes", "spans", "kept_sha256")


def _by_text(texts: DataFrame, crowd: int) -> DataFrame:
    """key, copies, spans, kept_sha256 of each text."""
    long = texts.where(F.octet_length("text") >= LEAST).select("key", "copies", "text")
    found = staged(long.mapInArrow(_found, f"key binary, copies long, {SEGMENT}, {MORE}"), "segments")
    # A text that occurs twice is repeated as a whole: its segments count as often.
    times = F.col("copies") * (1 + F.size("more"))
    groups = found.groupBy("h").agg(F.sum(times).alias("all"), F.min("g").alias("a"), F.max("g").alias("b")).where("all > 1")
    met = found.join(groups.select("h", (F.col("a") != F.col("b")).alias("mixed")), "h")
    met = staged(met, "met-segments")
    mixed = met.where("mixed")
    runs = decide(_one_of_each(mixed, times), texts, crowd)
    places = F.concat(F.array("low"), F.col("more"))
    same = met.where("NOT mixed").select("key", places.alias("at"), F.expr(ALL).alias("runs"))
    differ = join_spread(mixed.drop("copies"), runs.join(_copies(mixed), ["h", "g"]), ["h", "g"], "copies")
    every = same.unionByName(differ.select("key", places.alias("at"), "runs"))
    moved = F.flatten(F.transform("at", lambda p: F.transform("runs", lambda r: F.struct((r["first"] + p).alias("first"), r["n"].alias("n")))))
    by_text = every.groupBy("key").agg(F.flatten(F.collect_list(moved)).alias("runs"))
    whole = texts.join(by_text, "key", "left")
    schema = "key binary, copies long, spans array<struct<start:long,end:long>>, kept_sha256 string"
    return staged(whole.mapInArrow(_cut_out, schema), "repeated-bytes")


def kept(text: Column, spans: Column) -> Column:
    """The bytes of a text outside its spans, in order."""
    raw = F.encode(F.coalesce(text, F.lit("")), "utf-8")
    piece = lambda start, end: F.substring(raw, start.cast("int") + 1, (end - start).cast("int"))
    state = F.struct(F.lit(b"").alias("out"), F.lit(0).cast("long").alias("at"))
    grown = lambda s, p: F.struct(F.concat(s["out"], piece(s["at"], p["start"])).alias("out"), p["end"].alias("at"))
    return F.aggregate(spans, state, grown, lambda s: F.concat(s["out"], piece(s["at"], F.octet_length(raw).cast("long"))))
