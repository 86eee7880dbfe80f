import math

import duckdb
import numpy as np
import pytest

from fleetmart.llm import ORACLE, QUERIES, neighbours, topk, visits

VECTORS = "vec_id long, vector array<double>"


def brute(rows, queries, k, score, best_first):
    out = []
    for q, x in queries:
        own = [(score(x, y), i) for i, y in rows if i != q and len(y) == len(x)]
        own.sort(key=lambda s: (best_first * s[0], s[1]))
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(own[:k])]
    return sorted(out)


def distance(x, y):
    return float(np.sqrt(((np.array(x, float) - np.array(y, float)) ** 2).sum()))


def product(x, y):
    return int(np.dot(np.array(x, np.int64), np.array(y, np.int64)))


def test_chi_square():
    # Fixed values from a table of the distribution.
    assert neighbours.chi_square_bound(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert neighbours.chi_square_bound(0.99, 2) == pytest.approx(9.210, abs=1e-3)


def test_tree_gives_leaves_in_order():
    points = np.random.default_rng(1).normal(size=(1000, 8))
    leaves = list(neighbours.Tree(points).leaves(points[7]))
    assert [a for a, _ in leaves] == sorted(a for a, _ in leaves)
    assert sorted(np.concatenate([m for _, m in leaves])) == list(range(1000))
    for away, members in leaves:
        assert ((points[members] - points[7]) ** 2).sum(axis=1).min() >= away - 1e-9
    assert len(neighbours.Tree(np.zeros((500, 8))).members) == 1


def test_recall_on_given(spark, given):
    rows = [(r.vec_id, list(r.embedding)) for r in given.embeddings.collect()]
    queries = [r for r in rows if r[0] % 100 == 0]
    expected = brute(rows, queries, 10, distance, 1)
    got = sorted(map(tuple, QUERIES["op2_nearest_neighbours"](spark, given.folder).collect()))
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    hits = {g[0:3:2] for g in got} & {e[0:3:2] for e in expected}
    assert len(hits) >= 0.9 * len(expected)
    exact = dict(rows)
    assert all(math.isclose(s, distance(exact[q], exact[i]), rel_tol=1e-12) for q, _, i, s in got)


@pytest.mark.parametrize(("width", "block", "group"), [(2, 1 << 19, 1 << 22), (2, 300, 60), (40, 1 << 19, 1 << 22), (40, 8000, 800)])
def test_recall_on_clusters(spark, monkeypatch, width, block, group):
    monkeypatch.setattr(visits, "BLOCK_VALUES", block)
    monkeypatch.setattr(visits, "GROUP_VALUES", group)
    rng = np.random.default_rng(width)
    centres = rng.normal(size=(12, width)) * 3
    rows = [(i, (centres[i % 12] + rng.normal(size=width)).tolist()) for i in range(3000)]
    queries = rows[::60]
    expected = {e[0:3:2] for e in brute(rows, queries, 10, distance, 1)}
    frame = spark.createDataFrame(rows, VECTORS)
    got = neighbours.nearest(frame, frame.where("vec_id % 60 = 0")).collect()
    assert len(got) == 500 and len({(r.query_id, r.vec_id) for r in got} & expected) >= 450


def test_neighbours_of_ties_and_odd_rows(spark):
    same = [(i, [1.0, 2.0]) for i in range(300)]
    odd = [(400, [float("nan"), 1.0]), (500, [0.0, 0.0]), (600, None), (700, [None, 1.0]), (800, [1.0]), (None, [1.0, 2.0])]
    given = spark.createDataFrame(same + odd + same[:3], VECTORS).selectExpr("*", "1 AS score", "2 AS block")
    kept = given.where(given.vec_id.isNotNull() & neighbours.searchable(given.vector))
    out = neighbours.nearest(kept, kept.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    assert {r.query_id for r in out} == {0, 100, 200}
    assert [r.vec_id for r in out if r.query_id == 100] == [0, 0, 1, 1, 2, 2, 3, 4, 5, 6]
    assert [r.vec_id for r in out if r.query_id == 0] == [1, 1, 2, 2, 3, 4, 5, 6, 7, 8]
    assert neighbours.nearest(kept.limit(0), kept.limit(0)).count() == 0


def test_products_against_sql(spark, given):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{given.folder}/embeddings.parquet'")
    expected = con.execute(ORACLE["op5_top_products"]).fetchall()
    got = [tuple(r) for r in QUERIES["op5_top_products"](spark, given.folder).collect()]
    assert sorted(got) == sorted(expected) and got


@pytest.mark.parametrize(("spread", "block", "group"), [(0.0, 1 << 19, 1 << 22), (0.05, 1000, 200), (1.0, 1000, 1 << 22), (1.0, 9000, 100)])
def test_products_against_brute_force(spark, monkeypatch, spread, block, group):
    monkeypatch.setattr(visits, "BLOCK_VALUES", block)
    monkeypatch.setattr(visits, "GROUP_VALUES", group)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 16))
    lengths = np.exp(rng.normal(size=2000) * 1.5)
    rows = []
    for i in range(2000):
        unit = centres[i % 20] + spread * rng.normal(size=16)
        rows.append((i, np.floor(300 * lengths[i] * unit / np.linalg.norm(unit)).astype(int).tolist()))
    rows += [(3000 + i, r[1]) for i, r in enumerate(rows[:50])] + [(4000, [0] * 16), (4001, [1])]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = sorted(map(tuple, topk.top_products(frame, frame.where("vec_id % 50 = 0")).collect()))
    assert got == brute(rows, [r for r in rows if r[0] % 50 == 0], 5, product, -1)


def test_pruning_keeps_all_that_can_reach():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(4000, 6)) * rng.lognormal(size=(4000, 1))
    points = points[np.argsort(-np.linalg.norm(points, axis=1))]
    norms = np.linalg.norm(points, axis=1)
    for query in rng.normal(size=(30, 6)):
        for start, end in topk.norm_buckets(norms):
            scores = points[start:end] @ query
            for least in (scores.max() * 0.98, scores.max() * 0.5, 0.0, -1.0):
                kept = topk.candidates(query, float(np.linalg.norm(query)), points[start:end] / norms[start:end, None],
                                       norms[start:end], least)
                assert set(np.flatnonzero(scores >= least)) <= set(kept)


def test_integers_and_usable(spark):
    rows = [(1, [0.1, -0.1, 1.0]), (2, None), (3, [None]), (4, [float("inf")]), (5, [float("nan")]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, v array<float>")
    got = {r[0]: (r[1], r[2]) for r in df.select("vec_id", topk.usable(df.v), topk.integer_vector(df.v)).collect()}
    assert got[1] == (True, [25, -26, 256])
    assert [got[i][0] for i in range(2, 7)] == [False, False, False, False, True]
    assert topk.top_products(df.where("false").withColumnRenamed("v", "vector"), df.where("false").withColumnRenamed("v", "vector")).count() == 0


def test_short_vectors_are_not_visited(spark, monkeypatch):
    """Queries whose best are long leave all shorter classes alone; clashing columns, a hot length and zeros change nothing."""
    monkeypatch.setattr(visits, "BLOCK_VALUES", 400)
    rng = np.random.default_rng(11)
    rows = [(i, (rng.integers(1, 9, size=4) * 4 ** int(i % 6)).tolist()) for i in range(600)]
    rows += [(700 + i, [3, 4, 0, 0]) for i in range(300)] + [(1000, [0] * 4), (1020, [-5, -5, -5, -5])]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<long>").selectExpr(
        "*", "'x' AS cell", "1 AS length", "2 AS floor", "3 AS band", "4 AS cells", "5 AS score", "6 AS query_id", "7 AS block", "8 AS `group`"
    )
    asks = []
    plain = visits.visit
    monkeypatch.setattr(visits, "visit", lambda held, asked, *rest: asks.append(asked) or plain(held, asked, *rest))
    got = sorted(map(tuple, topk.top_products(frame, frame.where("vec_id % 20 = 0")).collect()))
    assert got == brute(rows, [r for r in rows if r[0] % 20 == 0], 5, product, -1)
    assert len(asks) == 2 and {r.vec_id for r in asks[1].collect()} == {1000, 1020}


def test_bands_are_put_together():
    assert visits.grouped_bands([3, 0, 4, 5, 1], 5) == [0, 0, 0, 1, 2]
    assert visits.grouped_bands([0] * 3, 1) == [0, 0, 0]


def test_cells_cover_all_and_far_ones_are_not_visited(spark, monkeypatch):
    """Clusters far apart: few cells are visited beside the own; copies of one vector and clashing columns change nothing."""
    monkeypatch.setattr(visits, "BLOCK_VALUES", 600)
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) + 1000 * (i % 8)).tolist()) for i in range(800)]
    rows += [(900 + i, [5000.0] * 6) for i in range(400)] + [(2000, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS cell", "2 AS floor", "3 AS band", "4 AS cells", "5 AS point", "6 AS score")
    cuts = neighbours.cut_cells(frame, 13)
    assert cuts.depth == 3
    held = neighbours.placed(frame, cuts).collect()
    assert sorted(r.vec_id for r in held) == sorted(r[0] for r in rows) and {r.cell for r in held} <= set(range(8))
    asks = []
    plain = visits.visit
    monkeypatch.setattr(visits, "visit", lambda held, asked, *rest: asks.append(asked) or plain(held, asked, *rest))
    got = neighbours.nearest(frame, frame.where("vec_id % 20 = 0")).collect()
    expected = brute(rows, [r for r in rows if r[0] % 20 == 0], 10, distance, 1)
    assert len(got) == len(expected)
    assert len({(r.query_id, r.vec_id) for r in got} & {e[0:3:2] for e in expected}) >= 0.95 * len(expected)
    assert len(asks) == 2
    visited = sum(len(r.cells) for r in asks[1].collect() if r.vec_id != 2000)
    assert visited < 0.3 * 7 * len([r for r in rows if r[0] % 20 == 0])
