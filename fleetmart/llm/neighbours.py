"""Approximate nearest neighbours: a kd-tree over few stable projections, and a chi-square test that ends the search.

Vectors are projected on ``DIMENSIONS`` Gaussian directions (2-stable: a projected squared distance, divided by
the true one, has a chi-square distribution of that many degrees). A kd-tree over the projections gives
neighbours in the order of their projected distance; each is verified by its true distance. With ``d`` the k-th best
true distance so far, a point nearer than ``d`` lies beyond projected distance ``r`` with a probability of at
most 1 - chi2(r*r / (d*d)); the search ends where that falls below 1 - ``CERTAINTY``. So each true neighbour is found
with that probability, and there is no other limit on what is verified.

The upper levels of the tree are shared by the whole table: their cuts come from ``SAMPLE`` vectors at most, chosen by hash, every
vector is put into its cell, and each cell's box is that of all its vectors. A query first searches its own cell, and with the
k-th best distance found there visits only the cells whose boxes pass the same test. A cell is cut into blocks by a hash, with a
tree each; the k best are merged per query. The projections depend on the width and the seed alone.

Defined results: vectors that are NULL, zero, or hold a NULL or non-finite component take no part; NULL ids
likewise; repeated rows are candidates each, but never for a query of the same id; a query whose id is repeated is
answered once, for its smallest vector; vectors of another width than the query's are no candidates; ties go to the
smaller id; empty tables give no rows; other columns are left behind.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm import visits
from fleetmart.llm.base import staged
from fleetmart.llm.topk import usable

#: Projections; even, so that the distribution has a closed form.
DIMENSIONS = 8
CERTAINTY = 0.99
SEED = 20
LEAF = 64
#: Vectors whose projections choose the cuts between cells, the most.
SAMPLE = 16_384
OUT = "query_id long, vec_id long, score double"


def searchable(vector: Column) -> Column:
    return usable(vector) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def chi_square(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees."""
    term, total = 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_bound(certainty: float, degrees: int) -> float:
    """The value at which the distribution function reaches ``certainty``."""
    low, high = 0.0, 1.0
    while chi_square(high, degrees) < certainty:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < certainty else (low, middle)
    return high


def projections(width: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width, DIMENSIONS))


class Tree:
    """A kd-tree over points: boxes of all nodes, and the points of each leaf."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        self.members: list[np.ndarray | None] = []
        self.grow(np.arange(len(points)))

    def grow(self, members: np.ndarray) -> int:
        node, own = len(self.low), self.points[members]
        self.low.append(own.min(axis=0))
        self.high.append(own.max(axis=0))
        self.children.append(None)
        self.members.append(members)
        extent = self.high[node] - self.low[node]
        if len(members) > LEAF and extent.max() > 0:  # equal points stay in one leaf
            axis, half = int(extent.argmax()), len(members) // 2
            order = members[np.argpartition(own[:, axis], half)]
            self.members[node] = None
            self.children[node] = (self.grow(order[:half]), self.grow(order[half:]))
        return node

    def distance(self, node: int, point: np.ndarray) -> float:
        """Squared distance of a point to a node's box."""
        off = np.maximum(0, np.maximum(self.low[node] - point, point - self.high[node]))
        return float(off @ off)

    def leaves(self, point: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """Leaves with their squared distances, nearest first, opened only as they are asked for."""
        queue = [(self.distance(0, point), 0)]
        while queue:
            away, node = heapq.heappop(queue)
            if self.children[node] is None:
                yield away, self.members[node]
            else:
                for child in self.children[node]:
                    heapq.heappush(queue, (self.distance(child, point), child))


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
                 certainty: float = CERTAINTY, ceilings=None):
    """The k nearest found in one block for each query: (query row, id, distance) arrays.

    ``ceilings``: a distance for each query beyond which none is wanted.
    """
    matrix, bound = projections(vectors.shape[1]), chi_square_bound(certainty, DIMENSIONS)
    projected, asked = vectors @ matrix, queries @ matrix
    tree = Tree(projected)
    out = []
    ceilings = np.full(len(queries), math.inf) if ceilings is None else ceilings
    for row, (own, query, point, ceiling) in enumerate(zip(query_ids, queries, asked, ceilings)):
        best_ids, best = np.empty(0, np.int64), np.empty(0)
        for away, members in tree.leaves(point):
            kth = min(ceiling, best[k - 1]) if len(best) >= k else ceiling
            if away > bound * kth * kth:
                break
            members = members[ids[members] != own]
            near = ((projected[members] - point) ** 2).sum(axis=1) <= bound * kth * kth
            members = members[near] if kth > 0 else members  # at distance 0 equal points still compete by id
            true = np.sqrt(((vectors[members] - query) ** 2).sum(axis=1))
            best_ids, best = np.concatenate([best_ids, ids[members]]), np.concatenate([best, true])
            first = np.lexsort((best_ids, best))[:k]
            best_ids, best = best_ids[first], best[first]
        out.append((np.full(len(best), row), best_ids, best))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 3


def _search(k: int, certainty: float):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")]
        for _, same in rows.groupby(rows["vector"].map(len)):
            block, group = same[~same["asks"]], same[same["asks"]]
            if len(block) and len(group):
                row, ids, scores = search_block(
                    block["vec_id"].to_numpy(), np.stack(block["vector"].to_list()).astype(np.float64),
                    group["vec_id"].to_numpy(), np.stack(group["vector"].to_list()).astype(np.float64), k, certainty,
                    group["floor"].fillna(math.inf).to_numpy(np.float64),
                )
                found.append(
                    pd.DataFrame({"query_id": group["vec_id"].to_numpy()[row], "vec_id": ids, "score": scores})
                )
        return pd.concat(found)

    return search


def projected(vectors: pa.Array) -> np.ndarray:
    """The projections of each of a list of vectors, whatever their widths."""
    ends = np.diff(vectors.offsets.to_numpy())
    out = np.empty((len(vectors), DIMENSIONS))
    for width in np.unique(ends):
        at = np.flatnonzero(ends == width)
        out[at] = vectors.take(pa.array(at)).flatten().to_numpy().reshape(len(at), width).astype(np.float64) @ projections(width)
    return out


class Cuts:
    """The upper levels of the kd-tree: an axis and a value for each node, children of node i at 2i + 1 and 2i + 2."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth, self.axis, self.value = depth, np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1)
        held = {0: points}
        for node in range(2**depth - 1):
            own = held.pop(node)
            if len(own):
                self.axis[node] = np.ptp(own, axis=0).argmax()
                self.value[node] = np.median(own[:, self.axis[node]])
            right = own[:, self.axis[node]] >= self.value[node]
            held[2 * node + 1], held[2 * node + 2] = own[~right], own[right]

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] >= self.value[node])
        return node - (2**self.depth - 1)


def placed(vectors: DataFrame, cuts: Cuts) -> DataFrame:
    """vec_id, vector, point (its projections), cell."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = projected(batch["vector"])
            listed = pa.FixedSizeListArray.from_arrays(points.reshape(-1), DIMENSIONS).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["vector"], listed, pa.array(cuts.cell(points), pa.int32())], names=["vec_id", "vector", "point", "cell"]
            )

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.select("vec_id", "vector").mapInArrow(place, f"vec_id long, vector {kind}, point array<double>, cell int")


def cut_cells(vectors: DataFrame, cells: int) -> Cuts:
    """Cuts into ``cells``, rounded down to a power of two, from a sample that depends on the vectors alone."""
    depth = min(cells, visits.CELLS).bit_length() - 1
    if depth == 0:
        return Cuts(np.empty((0, DIMENSIONS)), 0)
    sample = vectors.select("vec_id", "vector").orderBy(F.xxhash64("vec_id", "vector")).limit(SAMPLE)
    points = [r["point"] for r in placed(sample, Cuts(np.empty((0, DIMENSIONS)), 0)).select("point").collect()]
    return Cuts(np.array(points).reshape(-1, DIMENSIONS), depth)


def other_cells(boxes: dict[int, tuple[np.ndarray, np.ndarray]], bound: float):
    """A column function of (point, cell, k-th distance): the other cells that pass the stopping test."""
    names = np.array(sorted(boxes))
    low, high = np.array([boxes[c][0] for c in names]), np.array([boxes[c][1] for c in names])

    @F.pandas_udf("array<int>")
    def others(point: pd.Series, cell: pd.Series, kth: pd.Series) -> pd.Series:
        found = []
        for p, own, d in zip(point, cell, kth.fillna(math.inf)):
            off = np.maximum(0, np.maximum(low - p, p - high))
            found.append(names[((off**2).sum(axis=1) <= bound * d * d * (1 + 1e-9)) & (names != own)].astype(np.int32))
        return pd.Series(found, dtype=object)

    return others


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, certainty: float = CERTAINTY) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance) of the ``k`` nearest found for each row of
    ``queries`` among the rows of ``vectors`` of another id. Both have vec_id and vector."""
    n, width = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    cuts = cut_cells(vectors, n // visits.rows_of(visits.BLOCK_VALUES, width) + 1)
    held = placed(vectors, cuts)
    axes = [f(F.element_at("point", i + 1)).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(DIMENSIONS)]
    sizes, boxes = [0] * 2**cuts.depth, {}
    for r in held.groupBy("cell").agg(F.count("*").alias("n"), *axes).collect():
        sizes[r["cell"]], edges = r["n"], np.array(r[2:])
        boxes[r["cell"]] = (edges[:DIMENSIONS], edges[DIMENSIONS:])
    asked = placed(queries.groupBy("vec_id").agg(F.min("vector").alias("vector")), cuts)
    begun = asked.withColumns({"floor": F.lit(None).cast("double"), "band": F.col("cell"), "cells": F.array("cell")})
    found = staged(visits.visit(held, begun, sizes, width, _search(k, certainty), OUT), "neighbours")
    ordered = Window.partitionBy("query_id").orderBy("score", "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)

    if len(boxes) > 1:
        known = best(found).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        others = other_cells(boxes, chi_square_bound(certainty, DIMENSIONS))
        later = asked.join(known, "vec_id", "left").withColumn("cells", others("point", "cell", "floor"))
        later = staged(later.where(F.size("cells") > 0).withColumn("band", F.col("cell")), "asked")
        found = found.unionByName(visits.visit(held, later, sizes, width, _search(k, certainty), OUT))
    return best(found).select("query_id", "rank", "vec_id", "score")
