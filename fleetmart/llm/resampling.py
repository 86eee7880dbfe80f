"""Importance resampling towards a target: hashed word features, a gain for each bucket, exact draws without replacement.

A feature is a run of one or more words; its bucket is the CRC-32 of its bytes. The checksums of all features of a block
of texts are computed at once: a CRC is linear but for a constant that depends on the length, so it is the exclusive or of one
table entry for each byte, chosen by the byte and its distance from the end (``PLACES`` distances are tabulated), reduced over the
features' spans, and of the checksum of as many zero bytes. Longer spans are cut into blocks of ``PLACES`` bytes, whose sums
are folded: a state moves on by a whole block through four small tables.

Every document's weight is the sum of its features' gains; a Gumbel variable made from its id turns the order of weights
into draws. The ranks of the drawn come from a range partitioning by score, so no task sorts all documents.

Defined results: a NULL or wordless text has no feature, weight 0, a score, and no rank; a NULL id is hashed as an empty text
and comes before all others in a tie; repeated rows count each, and rows equal in score and id follow in any order; an empty
table gives no rows; an empty target gives all buckets a count of 0; other columns are left behind.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.base import staged
from fleetmart.llm.textbytes import slices

BUCKETS = 10_000
#: Words of the longest feature.
RUN = 1
SEED = 2024
#: Documents with fewer words are not drawn.
LEAST_WORDS = 20
#: Percent of the eligible documents that are drawn.
SHARE = 10
#: Distances from a span's end that have a table of their own, and so the length of a block.
PLACES = 64
#: Bytes of text whose features are hashed at once.
BLOCK = 1 << 19
# Fixed value: the polynomial of CRC-32, its lowest power first.
POLYNOMIAL = 0xEDB88320


@cache
def _one_byte() -> np.ndarray:
    """What a byte leaves behind in an empty register."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


def _zero_byte(state: np.ndarray) -> np.ndarray:
    return _one_byte()[state & 0xFF] ^ (state >> 8)


@cache
def places() -> np.ndarray:
    """Contribution of a byte by its distance from the end: entry ``256 * distance + byte``."""
    rows = [_one_byte()]
    for _ in range(PLACES - 1):
        rows.append(_zero_byte(rows[-1]))
    return np.concatenate(rows)


@cache
def _block_shift() -> np.ndarray:
    """What each byte of a register becomes after ``PLACES`` zero bytes; the four bytes' rows are added by exclusive or."""
    out = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for _ in range(PLACES):
        out = _zero_byte(out)
    return out


@cache
def _zeros(length: int) -> int:
    """The part of a checksum that depends on the length alone."""
    return zlib.crc32(bytes(length))


def _linear(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Linear parts of spans of one to ``PLACES`` bytes."""
    ends = np.cumsum(lengths)
    firsts = ends - lengths
    inside = np.arange(ends[-1]) - np.repeat(firsts, lengths)
    distance = np.repeat(lengths, lengths) - 1 - inside
    each = places()[(distance << 8) | data[np.repeat(starts, lengths) + inside]]
    return np.bitwise_xor.reduceat(each, firsts)


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every span of ``data``; no span is empty."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint32)
    short = lengths <= PLACES
    if short.any():
        out[short] = _linear(data, starts[short], lengths[short])
    for i in np.flatnonzero(~short):
        head = lengths[i] % PLACES or PLACES
        cuts = np.arange(starts[i] + head, ends[i] + 1, PLACES)
        begins = np.append(starts[i], cuts[:-1])
        state, shift = 0, _block_shift()
        for value in _linear(data, begins, cuts - begins).tolist():
            moved = shift[0, state & 255] ^ shift[1, state >> 8 & 255] ^ shift[2, state >> 16 & 255] ^ shift[3, state >> 24]
            state = int(moved) ^ value
        out[i] = state
    sizes, which = np.unique(lengths, return_inverse=True)
    return out ^ np.array([_zeros(int(n)) for n in sizes], np.uint32)[which]


# A-Z become a-z; words are made of digits, a-z and all characters beyond ASCII.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; ``data`` is in lower case."""
    inside = IN_WORD[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    filled = offsets[:-1] < offsets[1:]
    before[offsets[:-1][filled]] = False
    after[offsets[1:][filled] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def features(data: np.ndarray, offsets: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of every feature, and each text's number of words."""
    data = LOWER[data]
    starts, ends, owner = words(data, offsets)
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    if not len(starts):
        return np.empty(0, np.int64), owner, counts
    if run > 1:  # the same words with one blank between them, and one that no feature holds at the end
        lengths = ends - starts + 1
        at = np.cumsum(lengths) - lengths
        joined = np.full(int(lengths.sum()), 32, np.uint8)
        inside = np.arange(len(joined)) - np.repeat(at, lengths)
        letters = inside < np.repeat(lengths - 1, lengths)
        joined[letters] = data[(np.repeat(starts, lengths) + inside)[letters]]
        data, starts, ends = joined, at, at + lengths - 1
    found = [(starts, ends, owner)]
    for n in range(1, run):
        same = owner[n:] == owner[:-n]
        found.append((starts[:-n][same], ends[n:][same], owner[n:][same]))
    begins, stops, texts = (np.concatenate(c) for c in zip(*found))
    buckets = crc32_spans(data, begins, stops) % BUCKETS if len(begins) else np.empty(0, np.int64)
    return buckets.astype(np.int64), texts, counts


def _counted(run: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, data, offsets in slices(batch["text"], BLOCK):
                total += np.bincount(features(data, offsets, run)[0], minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    return counted


def bucket_counts(docs: DataFrame, run: int = RUN) -> np.ndarray:
    """Features of all texts in each bucket. One row for each bucket and task is shuffled, ``BUCKETS`` rows come back."""
    counted = docs.select("text").mapInArrow(_counted(run), "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in thousandths, from the two smoothed distributions."""
    all_corpus, all_target = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratio = (target + 1).astype(float) * all_corpus / ((corpus + 1).astype(float) * all_target)
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _weighed(shared, run: int):
    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for first, data, offsets in slices(batch["text"], BLOCK):
                buckets, texts, counts = features(data, offsets, run)
                total = np.concatenate([[0], np.cumsum(gain[buckets[np.argsort(texts, kind="stable")]])])
                per_text = np.bincount(texts, minlength=len(counts))
                ends = np.cumsum(per_text)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, len(counts)), pa.array(counts, pa.int64()), pa.array(per_text, pa.int64()),
                     pa.array(total[ends] - total[ends - per_text], pa.int64())],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return weighed


def scored(docs: DataFrame, gain: np.ndarray, run: int = RUN, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = picked.mapInArrow(_weighed(shared, run), "doc_id long, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(name, 256), F.lit(8)), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return out.withColumn("score", (F.col("weight") + gumbel).cast("long"))


def resample(docs: DataFrame, target: DataFrame, run: int = RUN, share: int = SHARE, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs`` (doc_id, text); the drawn ones have a rank.

    Drawn are the highest scores among the documents with ``LEAST_WORDS`` words or more, ``share`` percent of them.
    The scored rows, a few numbers each, are dealt out by score once and written; only the parts' sizes, one row a
    partition, are added up in one place.
    """
    rows = scored(docs, gains(bucket_counts(docs, run), bucket_counts(target, run)), run, seed)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    eligible = (F.col("n_words") >= LEAST_WORDS).alias("eligible")
    dealt = rows.select("*", eligible).repartitionByRange(F.col("eligible").desc(), *order)
    dealt = staged(dealt.withColumn("part", F.spark_partition_id()), "scored")
    sizes = dealt.where("eligible").groupBy("part").agg(F.count("*").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select(
        "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"),
        F.floor(F.lit(share) * F.sum("n").over(everything) / 100).alias("drawn"),
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    ranked = dealt.where("eligible").join(starts, "part").withColumn("rank", (F.col("before") + inside).cast("long"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= F.col("drawn"), F.col("rank")))
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = dealt.where("NOT eligible").select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, "rank").unionByName(rest)
