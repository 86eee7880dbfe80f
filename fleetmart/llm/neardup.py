"""Near-duplicate documents by one-permutation hashing, and links that are confirmed on full shingle sets.

A document's set is its distinct shingles of five words, as 64-bit hashes. One hash of each shingle gives all minima:
the hash range is cut into ``BINS`` bins, and each bin keeps its least hash. An empty bin takes the value of the first
filled bin in an order of its own, the same for all documents (optimal densification), so two documents agree in a
bin with a probability equal to the similarity of their sets. Bins are joined to ``BANDS`` bands of ``ROWS``, and
documents that agree in a band share its bucket. Shingles that share a bin move several densified bins together, so
small sets miss more: of simulated pairs of similarity 0.75, one contained in the other, 15 of 184,320 missed each other
in all bands where the larger set had 4 shingles, 3 of 191,153 at 8, and 1 of 258,069 at 64.

Copies with the same set are one class from the start. Classes of a bucket are linked by stars, not in pairs: some
of them, the centres, are compared with all others, on full sets; verified links are put together to components;
then the centres leave their buckets. Buckets in which all that is left lies in one component are done, as further
links could tell nothing new; in the others new centres follow, ever more, first at random, so
that the many members of a large group meet at once, then from the components that are rare in the bucket. The
rounds end when no bucket is open. So every two classes that share a bucket are in the end in one component or were
compared, and no bucket's pairs are emitted as a whole. Before a pair of a centre and another class becomes a row, two bounds
are asked that can't be wrong. Each class has ``BITS`` parities: whether an odd number of its shingles falls into a cell.
Two sets differ in at least as many shingles as they differ in parities, and similar ones differ in few. After the second
round the shingles that only one open class has are counted, too: they bound what two classes can have in
common. So within a large group of copies that were changed a little too much hardly any pair is made. The sets
lie in a table bucketed by class, so a round moves the sets of its pairs, and no others.

Defined results: see ``near_duplicates``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.base import staged
from fleetmart.llm.components import components

WORDS = 5
#: Similarity in hundredths from which two documents are linked.
LEAST = 75
BANDS = 44
ROWS = 5
BINS = BANDS * ROWS
SEED = 9
#: Cells whose parities bound the difference of two sets; they tell least about sets of far more shingles than this, which
#: are then compared in full.
BITS = 1024
#: Bands whose stars make the first round.
FIRST_BANDS = 8
#: Centres that one share of a bucket chooses. Spark cuts to so many before they are dealt out, as it is under
#: spark.sql.optimizer.windowGroupLimitThreshold (1000).
SHARE = 512
#: Bits of the map of wanted texts, whatever their number: the more are wanted, the more others pass it, too.
MAP_BITS = 1 << 23
#: Rows of one class are spread over so many keys when they meet their component.
SALTS = 8
#: Word hashes that a worker remembers.
CACHED_WORDS = 100_000
#: Texts whose sets a worker holds at once, whatever the size of the batches that Spark hands over.
HELD = 256
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class _Words(dict):
    """Hashes of words, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles. Words end at blanks, tabs and line ends; A-Z count as a-z."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.array([_words[w] for w in words], np.uint64)
    if len(hashes) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=len(hashes))], np.uint64)
    out = np.zeros(len(hashes) - WORDS + 1, np.uint64)
    for i in range(WORDS):
        out = _mix(out + _M1 + hashes[i : len(hashes) - WORDS + 1 + i])
    return np.unique(out)


@cache
def _bin_starts(bins: int) -> np.ndarray:
    return np.array([(i << 64) // bins for i in range(bins)], np.uint64)


@cache
def _orders(bins: int) -> np.ndarray:
    """For each bin (row) an order of all bins; its own comes first."""
    rng = np.random.default_rng(SEED)
    return np.array([[i, *rng.permutation([j for j in range(bins) if j != i])] for i in range(bins)])


def signature(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The least hash of every bin, empty bins densified. ``hashes`` are sorted and not empty."""
    at = np.searchsorted(hashes, _bin_starts(bins))
    filled = at < np.append(at[1:], len(hashes))
    empty, step = np.flatnonzero(~filled), 8
    done = 1
    while len(empty):  # most find a filled bin among the first few of their order
        tried = _orders(bins)[empty, done : done + step]
        hit = filled[tried]
        found = hit.any(axis=1)
        at[empty[found]] = at[tried[found, hit[found].argmax(axis=1)]]
        empty, done, step = empty[~found], done + step, step * 4
    return hashes[at]


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls into each cell, packed into numbers."""
    odd = np.bincount((hashes & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def buckets(least: np.ndarray) -> np.ndarray:
    """One key for each band of a signature; its last six bits name the band."""
    rows = least.reshape(BANDS, ROWS)
    key = np.zeros(BANDS, np.uint64)
    for i in range(ROWS):
        key = _mix(key + _M1 + rows[:, i])
    return ((key & ~np.uint64(63)) | np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _class_of(hashes: np.ndarray) -> int:
    """A hash of the whole set, as a signed number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).view(np.int64))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, ``HELD`` at a time at most."""
    for batch in batches:
        for first in range(0, batch.num_rows, HELD):
            yield batch.slice(first, HELD)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut(batches):
        classes, sizes, keys, packed = [], [], [], []
        for text in batch["text"]:
            hashes = shingles(text.as_py())
            least = signature(hashes) if len(hashes) else None
            sizes.append(len(hashes))
            classes.append(_class_of(hashes) if len(hashes) else None)
            keys.append(buckets(least) if len(hashes) else None)
            packed.append(parities(hashes) if len(hashes) else None)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["text_key"], pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()),
             pa.array(keys, pa.list_(pa.int64())), pa.array(packed, pa.list_(pa.int64()))],
            names=["doc_id", "text_key", "class", "n_shingles", "buckets", "bits"],
        )


def _full_sets(wanted):
    """Sets of the texts whose key's bit is set in the map of wanted ones."""

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            cells = batch["text_key"].to_numpy(zero_copy_only=False) & (MAP_BITS - 1)
            held = batch.filter(pa.array((wanted.value[cells >> 6] >> (cells & 63).astype(np.uint64)) & np.uint64(1) == 1))
            found = [shingles(t.as_py()).view(np.int64) for t in held["text"]]
            yield pa.RecordBatch.from_arrays(
                [held["doc_id"], held["text_key"], pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "shingles"],
            )

    return full_sets


def _with_text_key(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def shared_buckets(rows: DataFrame) -> DataFrame:
    """bucket, class, ABOUT of all classes that share a bucket with another class.

    Copies are put together before their buckets are spread out. The buckets with more than one class are found by
    partial aggregates, so no task holds a whole bucket.
    """
    about = rows.where("class IS NOT NULL").groupBy("class").agg(
        F.first("buckets").alias("buckets"), F.first("n_shingles").alias("n"), F.first("bits").alias("bits"))
    each = about.select(F.explode("buckets").alias("bucket"), "class")
    many = each.groupBy("bucket").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b")
    members = each.join(many, "bucket", "left_semi")
    return members.join(about.select("class", "n", F.col("n").alias("most"), "bits", F.lit(None).cast("array<long>").alias("among")), "class")


def sets_of(rows: DataFrame, docs: DataFrame, members: DataFrame) -> DataFrame:
    """class, shingles: the full set of every class in ``members``, made from one of its documents.

    Texts stay where they are: a map of fixed size tells each task which of its texts may be wanted, and only the sets
    of those meet the list of wanted documents.
    """
    wanted = members.select("class").distinct()
    one = rows.where("class IS NOT NULL").groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("one"))
    one = staged(one.join(wanted, "class", "left_semi").select("class", "one.*"), "wanted")
    cell = F.col("text_key").bitwiseAND(F.lit(MAP_BITS - 1))
    words = one.groupBy(F.shiftright(cell, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(text_key & 63 as int))")).alias("bits")).toPandas()
    table = np.zeros(MAP_BITS // 64, np.uint64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    found = _with_text_key(docs).mapInArrow(_full_sets(shared), "doc_id long, text_key long, shingles array<long>")
    found, one = found.alias("f"), one.alias("o")
    found = found.join(one, F.expr("f.doc_id <=> o.doc_id AND f.text_key = o.text_key"))
    return found.groupBy("class").agg(F.first("shingles").alias("shingles"))


#: What is known of a class: the size of its set, how much of it others may have, its parities, and from the third round
#: on its open buckets.
ABOUT = ["n", "most", "bits", "among"]


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """bucket, class, ABOUT, component of the buckets that hold more than one component."""
    labelled = members.join(labels, "class")
    many = labelled.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    many = many.where(F.col("a") != F.col("b")).select("bucket")
    return labelled.join(many, "bucket", "left_semi")


def _centres(held: DataFrame, count: int, at_random: bool) -> DataFrame:
    """The ``count`` classes of each bucket that are compared with the others next, some fewer where they are dealt
    unevenly: where there are many, shares of a bucket choose theirs apart, so few that each task sends no more on."""
    order = [F.xxhash64("class", "bucket")]
    if not at_random:
        sizes = held.groupBy("bucket", "component").agg(F.count("*").alias("size"))
        held = held.join(sizes, ["bucket", "component"])
        order = [F.col("size"), *order]
    share = F.pmod(F.xxhash64("class"), F.lit(max(1, count // SHARE)))
    ranked = held.withColumn("place", F.row_number().over(Window.partitionBy("bucket", share).orderBy(*order, "class")))
    return ranked.where(F.col("place") <= min(count, SHARE)).select("bucket", "class", *ABOUT, "component")


def _pairs(centres: DataFrame, held: DataFrame) -> DataFrame:
    """a, b, u, v: classes to compare, a centre and another member of its bucket, and their components. ``held`` is
    marked with the centres."""
    c, m = centres.alias("c"), held.alias("m")
    off = sum(F.bit_count(F.col("c.bits")[i].bitwiseXOR(F.col("m.bits")[i])) for i in range(BITS // 64))
    common = "least(c.most, m.most)"
    # Of n + m shingles, two linked sets have at most (100 - LEAST) / (100 + LEAST) that the other one lacks.
    fits = F.expr(f"100 * {common} >= {LEAST} * (c.n + m.n - {common})") & (off * (100 + LEAST) <= (F.col("c.n") + F.col("m.n")) * (100 - LEAST))
    pairs = c.join(m, F.expr("c.bucket = m.bucket AND c.component <> m.component")).where(fits)
    pairs = pairs.where("NOT m.centre OR c.class < m.class")  # two centres meet once
    # A pair that meets in several buckets is compared in the first of them.
    pairs = pairs.where(F.expr("c.among IS NULL OR c.bucket = array_min(array_intersect(c.among, m.among))"))
    order = F.expr("c.class < m.class")
    return pairs.select(
        F.least("c.class", "m.class").alias("a"), F.greatest("c.class", "m.class").alias("b"),
        F.when(order, F.col("c.component")).otherwise(F.col("m.component")).alias("u"),
        F.when(order, F.col("m.component")).otherwise(F.col("c.component")).alias("v"),
    ).distinct()


def _with_most(held: DataFrame, sets: DataFrame) -> DataFrame:
    """``held`` with ``most``, how many of a class's shingles stand in another class of ``held``, too, and ``among``,
    the buckets of a class (one for each band at most)."""
    each = sets.join(held.select("class").distinct(), "class", "left_semi").select("class", F.explode("shingles").alias("s"))
    own = each.groupBy("s").agg(F.count("*").alias("times"), F.first("class").alias("class")).where("times = 1")
    own = own.groupBy("class").agg(F.count("*").alias("own"))
    lying = held.groupBy("class").agg(F.collect_list("bucket").alias("among"))
    found = held.drop("among").join(lying, "class").join(own, "class", "left")
    return found.withColumn("most", F.col("n") - F.coalesce("own", F.lit(0))).drop("own")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v: components of the pairs whose sets are similar enough."""
    of = lambda name: sets.select(F.col("class").alias(name), F.col("shingles").alias(f"{name}_set"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    common = F.size(F.array_intersect("a_set", "b_set"))
    total = F.size("a_set") + F.size("b_set") - common
    return both.where(100 * common >= LEAST * total).select("u", "v")


def class_components(members: DataFrame, sets: DataFrame) -> DataFrame:
    """class, component for the classes in ``members`` (bucket, class, ABOUT), by rounds of stars."""
    labels = staged(members.select("class", F.col("class").alias("component")).distinct(), "labels")
    turn, compared = 0, None
    while True:
        held = staged(_open(members, labels), "open-buckets")
        if turn and held.isEmpty():
            return labels
        if turn == 2:
            held = staged(_with_most(held, sets), "open-buckets")
        # A first round over few bands, one over all, and then 8, 512... centres.
        now = held.where((F.col("bucket").bitwiseAND(63)) < FIRST_BANDS) if turn == 0 else held
        centres = staged(_centres(now, 1 if turn < 2 else 8 * 64 ** (turn - 2), turn < 2), "centres")
        chosen = centres.select("bucket", "class", F.lit(True).alias("centre"))
        marked = held.join(chosen, ["bucket", "class"], "left").withColumn("centre", F.coalesce("centre", F.lit(False)))
        pairs = _pairs(centres, marked)
        pairs = staged(pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti"), "pairs")
        compared = pairs.select("a", "b") if compared is None else compared.union(pairs.select("a", "b"))
        links = staged(_links(pairs, sets), "links")
        if not links.isEmpty():
            found = components(links)
            found = found.select(F.col("node").alias("component"), F.col("component").alias("joined"))
            joined = labels.join(found, "component", "left")
            labels = staged(joined.select("class", F.coalesce("joined", "component").alias("component")), "labels")
        members = marked.where("NOT centre").select("bucket", "class", *ABOUT)
        turn += 1


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, text_key, n_shingles, component_id, kept, group.

    ``component_id`` is the smallest doc_id that links reach, ``kept`` whether it is the row's own; ``group`` names the
    component apart from ids. Defined results: a NULL text, or one without words, is linked with nothing, and has
    NULL as its group and its own id as its component; fewer than five words are one shingle; a NULL id takes part,
    but is only the smallest where all are NULL; repeated rows have the same set, and so the same component; long
    texts are compared whole; an empty table gives no rows; other columns are left behind.
    """
    keyed = _with_text_key(docs)
    schema = "doc_id long, text_key long, class long, n_shingles long, buckets array<long>, bits array<long>"
    rows = staged(keyed.mapInArrow(_sketch, schema), "sketches")
    members = staged(shared_buckets(rows), "buckets")
    spark, name = docs.sparkSession, f"fleetmart_sets_{uuid.uuid4().hex}"
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = sets_of(rows, docs, members).repartition(slices, "class")
    try:
        sets.write.bucketBy(slices, "class").sortBy("class").format("parquet").saveAsTable(name)
        labels = class_components(members, spark.table(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")

    classes = rows.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    known = classes.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("copies").alias("size"))
    found = known.join(least.where(F.col("size") > 1), "component").select("class", F.col("component").alias("group"), "component_id")
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = rows.drop("buckets", "bits").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    out = spread.join(found, ["class", "salt"], "left")
    alone = F.col("group").isNull()
    out = out.withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select(
        "doc_id", "text_key", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), F.coalesce("group", "class").alias("group"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id stays, of rows
    with that id the one whose text has the least hash, and of equal rows one. Texts without words stay."""
    decided = near_duplicates(docs)
    first = decided.where("kept AND group IS NOT NULL").groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("one"))
    wordless = decided.where("group IS NULL").select("doc_id", "text_key").distinct()
    stay = first.select("one.*", F.lit(False).alias("all")).union(wordless.select("*", F.lit(True).alias("all")))
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"),
        F.monotonically_increasing_id().alias("place"),
    )
    kept = rows.join(stay, F.expr("id <=> doc_id AND key = text_key"))
    kept = kept.withColumn("place", F.when(F.col("all"), F.col("place")).otherwise(F.lit(0)))
    return kept.dropDuplicates(["id", "key", "place"]).select("row.*")
