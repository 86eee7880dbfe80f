import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from fleetmart.llm import QUERIES, neardup
from fleetmart.llm.components import components
from tests_llm_brute import groups

def brute(rows):
    return sorted(groups(rows), key=str)


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS class", "2 AS component_id", "3 AS bucket")
    out = neardup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted(map(tuple, out), key=str)


def varied(seed, groups=12, size=14, words=60):
    """Groups of texts that differ from a common one by ever more words, so that links form chains."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows = []
    for g in range(groups):
        base = rng.choices(vocabulary, k=words)
        for i in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                text[rng.randrange(words)] = rng.choice(vocabulary)
            rows.append((g * 100 + i, " ".join(text)))
            if i % 3 == 0:
                base = text
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    passage = " ".join(f"p{i}" for i in range(50))
    rows = varied(seed) + [(5000 + i, f"{passage} " + " ".join(f"q{i}x{j}" for j in range(20 + i))) for i in range(40)]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [
        (5, None), (4, ""), (3, " \t\n"), (2, "One two"), (1, "one  TWO"), (7, "one two three"), (8, "É a b c d"), (9, "é a b c d"),
        (10, long), (11, long + " end"), (None, long), (None, None), (None, "only here at last it is"), (12, "a b c d e f"),
        (12, "a b c d e f"), (12, "quite another text of this id"), (13, "a b c d e f"), (14, "a\x1cb c d e f"),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_one_of_each(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, None), (3, None), (4, "x y"), (None, "x y"), (None, "z")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, place string")
    out = neardup.one_of_each(docs)
    assert out.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert kept == sorted([(1, "a b c d e f"), (3, None), (3, None), (4, "x y"), (None, "z")], key=str)


def test_query(spark, given):
    rows = [(r.doc_id, r.text) for r in given.documents.collect()]
    out = QUERIES["op9_near_duplicates"](spark, given.folder).collect()
    assert sorted(map(tuple, out), key=str) == brute(rows)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    for size in (3, 20, 400):
        agree = []
        for _ in range(200):
            both = rng.integers(0, 2**64, size=size, dtype=np.uint64)
            a = np.unique(np.append(both, rng.integers(0, 2**64, size=size // 3, dtype=np.uint64)))
            agree.append((neardup.signature(a) == neardup.signature(np.unique(both))).mean())
        assert np.mean(agree) == pytest.approx(size / (size + size // 3), abs=0.03)


def differing(a, b):
    x, y = neardup.parities(a), neardup.parities(b)
    return int(np.bitwise_count((x ^ y).view(np.uint64)).sum())


@pytest.mark.parametrize("size", [1, 5, 146, 3000])
def test_parities_never_tell_too_much(size):
    """Sets differ in as many shingles as in parities at least; in about as many where sets are smaller than the cells."""
    rng = np.random.default_rng(size)
    for _ in range(200):
        both = rng.integers(0, 2**64, size=size, dtype=np.uint64)
        a, b = (np.unique(np.append(both[: rng.integers(0, size + 1)], rng.integers(0, 2**64, size=rng.integers(0, size + 1), dtype=np.uint64))) for _ in range(2))
        apart = len(np.setxor1d(a, b))
        assert differing(a, b) <= apart
        assert size > 200 or differing(a, b) >= 0.6 * apart


def test_few_pairs_in_a_large_group_below_the_threshold(spark, monkeypatch):
    """1,500 texts, each changed in eight places of 150 words: hardly any two are similar enough, and pairs grow with the texts."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(150)]
    made = []
    for i in range(1500):
        text = list(base)
        for place in rng.sample(range(150), 8):
            text[place] = f"x{i}y{place}"
        made.append((i, " ".join(text)))
    real, pairs = neardup.staged, []

    def counting(df, purpose):
        out = real(df, purpose)
        if purpose == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(neardup, "staged", counting)
    assert run(spark, made[:750]) == brute(made[:750])
    few = sum(pairs)
    pairs.clear()
    found = run(spark, made)
    assert sum(pairs) <= 3 * max(few, 750) and sum(pairs) < 15_000
    assert found == brute(made)


def test_buckets_meet_at_the_threshold():
    rng = np.random.default_rng(1)
    missed, far = 0, 0
    for _ in range(1500):
        both = rng.integers(0, 2**64, size=120, dtype=np.uint64)
        a, b = (np.unique(np.append(both, rng.integers(0, 2**64, size=20, dtype=np.uint64))) for _ in range(2))
        x, y = neardup.signature(a), neardup.signature(b)
        missed += not (neardup.buckets(x) == neardup.buckets(y)).any()
        far += 7 * differing(a, b) > len(a) + len(b)
    assert missed == 0 and far == 0


def test_short_sets_are_linked_whatever_their_bits(spark):
    """Three of four shingles: similarity 0.75, at the very limit of both the sets and the parities."""
    words = [f"w3249x{i}" for i in range(8)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:7])), (3, "some other text of a few words")]
    a, b = (neardup.shingles(t) for _, t in rows[:2])
    assert 7 * differing(a, b) <= len(a) + len(b)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in neardup.near_duplicates(docs).collect()} == {(1, 1), (2, 1), (3, 3)}


def test_no_task_sorts_a_bucket(spark):
    """Shared buckets come from aggregates, and tasks cut to the centres before they deal out."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    rows = spark.sql("SELECT id AS class, 3L AS n_shingles, array(id, 1000L, 2000L + id DIV 2) AS buckets, array(0L) AS bits FROM range(9)")
    shared = neardup.shared_buckets(rows)
    assert "Window" not in plan(shared)
    assert sorted((r.bucket, r["class"]) for r in shared.collect()) == sorted(
        [(1000, i) for i in range(9)] + [(2000 + i // 2, i) for i in range(8)])
    about = "3L AS n, 3L AS most, array(0L) AS bits, CAST(NULL AS array<long>) AS among, id AS component"
    held = spark.sql(f"SELECT id % 2 AS bucket, id AS class, {about} FROM range(2000)")
    for count in (1, 8, 512, 32768):
        centres = neardup._centres(held, count, count == 1)
        assert any("WindowGroupLimit" in line and "Partial" in line for line in plan(centres).splitlines())
        assert {r.bucket: r["count"] for r in centres.groupBy("bucket").count().collect()} == dict.fromkeys((0, 1), min(count, 1000))


def test_components(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 105), (105, 103), (7, 7), (200, 201), (201, 200)]
    out = {r.node: r.component for r in components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert out == {**{i: 0 for i in range(61)}, 100: 100, 103: 100, 105: 100, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_workers_hold_few_texts_at_once():
    """A large batch of Spark's leaves the workers in small ones, so neither side holds the sets of all its texts; the words
    remembered are bounded."""
    texts = [" ".join(f"t{i}w{j}" for j in range(200)) for i in range(1000)] + [None, ""]
    places = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([places, places, pa.array(texts, pa.string())], names=["doc_id", "text_key", "text"])
    wanted = SimpleNamespace(value=np.full(neardup.MAP_BITS // 64, 0xFFFFFFFFFFFFFFFF, np.uint64))
    for made in (neardup._sketch, neardup._full_sets(wanted)):
        found = list(made(iter([batch])))
        assert max(b.num_rows for b in found) <= neardup.HELD
        assert [i for b in found for i in b["doc_id"].to_pylist()] == list(range(len(texts)))
        assert len(neardup._words) <= neardup.CACHED_WORDS
    assert [s is None for b in neardup._sketch(iter([batch])) for s in b["class"].to_pylist()] == [False] * 1000 + [True] * 2
