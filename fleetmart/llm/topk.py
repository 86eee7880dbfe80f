"""Exact top-k search by inner product over integer vectors, with buckets of similar length.

Vectors are sorted into buckets by length, each bucket at most a tenth shorter at its lower than at its upper
end. For a query and its k-th best score so far, a bucket's longest vector gives the least cosine that could still
help there. A bucket whose threshold is over one is passed by, and so are all shorter ones. Below that the
bucket chooses a test: at a high threshold ranges of the query's largest coordinates (a unit vector close to the
query must agree with it in each), at a low one the vectors' own lengths. What passes is verified by its product.

The same holds for the whole table, before anything is moved: its vectors fall into classes of similar length
(``visits.CELLS`` at most). Each query first meets the class of the longest, which gives it a k-th best score; it then goes
only to the classes whose longest vector can still reach that, and begins there with this score. The k best are merged per query.

Defined results: vectors that are NULL or hold a NULL or non-finite component take no part, as a query or as a
candidate; NULL ids likewise, as there is nothing to return; repeated rows count as candidates each, but never for a
query of the same id; a query whose id is repeated is answered once, for its smallest vector; vectors of another width than
the query's are no candidates; empty tables give no rows; other columns are left behind. Components beyond 2**27 in
size may overflow the products.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm import visits
from fleetmart.llm.base import staged

SHRINK = 0.9
#: Local cosine threshold from which coordinates are tested, and how many of them.
CLOSE = 0.6
FOCUS = 4
OUT = "query_id long, vec_id long, score long"


def integer_vector(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component, computed in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long"))


def usable(vector: Column) -> Column:
    """Whether there is a vector without NULL, NaN or infinite components."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, good), F.lit(False))


def norm_buckets(norms: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of ``norms``, which fall, in each of which the last is at least ``SHRINK`` of the first."""
    ranges, at = [], 0
    while at < len(norms):
        end = len(norms) if norms[at] == 0 else at + int(np.count_nonzero(norms[at:] >= SHRINK * norms[at]))
        ranges.append((at, end))
        at = end
    return ranges


def candidates(query: np.ndarray, norm: float, units: np.ndarray, norms: np.ndarray, least: float) -> np.ndarray:
    """Places in a bucket whose product with the query can reach ``least``; a superset of those that do.

    ``units`` are the bucket's vectors divided by their lengths ``norms``. All tests keep a small margin for rounding.
    """
    if norm == 0 or norms[0] == 0:
        return np.arange(len(norms)) if least <= 0 else np.empty(0, np.int64)
    threshold = least / (norm * norms[0]) - 1e-9
    if threshold > 1:
        return np.empty(0, np.int64)
    if threshold < CLOSE:
        if least <= 0:
            return np.arange(len(norms))
        return np.flatnonzero(norms >= least / norm * (1 - 1e-9))
    unit = query / norm
    focus = np.argsort(-np.abs(unit))[:FOCUS]
    low, high = coordinate_range(unit[focus], threshold)
    near = (units[:, focus] >= low - 1e-6) & (units[:, focus] <= high + 1e-6)
    return np.flatnonzero(near.all(axis=1))


def coordinate_range(coordinate: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest value that a unit vector at cosine ``threshold`` or more to another may have in a
    coordinate of the other: the angle to the axis differs by the threshold's angle at most."""
    angle, most = np.arccos(np.clip(coordinate, -1, 1)), np.arccos(min(1.0, threshold))
    return np.cos(np.minimum(np.pi, angle + most)), np.cos(np.maximum(0, angle - most))


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, floors=None):
    """The k best candidates of one block for each query: (query row, id, score) arrays.

    ``floors``: a score for each query below which none is wanted.
    """
    norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((ids, -norms))
    ids, vectors, norms = ids[order], vectors[order], norms[order]
    units = vectors / np.where(norms == 0, 1, norms)[:, None]
    buckets = norm_buckets(norms)
    out = []
    floors = np.full(len(queries), -np.inf) if floors is None else floors
    for row, (own, query, floor) in enumerate(zip(query_ids, queries, floors)):
        norm = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
        best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
        for start, end in buckets:
            least = max(floor, best[k - 1]) if len(best) >= k else floor
            if least > norm * norms[start] * (1 + 1e-9) + 1e-6:
                break  # and so for all shorter vectors
            at = start + candidates(query, norm, units[start:end], norms[start:end], least)
            at = at[ids[at] != own]
            scores = vectors[at] @ query
            keep = scores >= least
            best_ids, best = np.concatenate([best_ids, ids[at][keep]]), np.concatenate([best, scores[keep]])
            first = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[first], best[first]
        out.append((np.full(len(best), row), best_ids, best))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 3


def _search(k: int):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")]
        for _, same in rows.groupby(rows["vector"].map(len)):
            block, group = same[~same["asks"]], same[same["asks"]]
            if len(block) and len(group):
                row, ids, scores = search_block(
                    block["vec_id"].to_numpy(), np.stack(block["vector"].to_list()).astype(np.int64),
                    group["vec_id"].to_numpy(), np.stack(group["vector"].to_list()).astype(np.int64), k,
                    group["floor"].fillna(-np.inf).to_numpy(np.float64),
                )
                found.append(
                    pd.DataFrame({"query_id": group["vec_id"].to_numpy()[row], "vec_id": ids, "score": scores})
                )
        return pd.concat(found)

    return search


def length(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda n, x: n + x.cast("double") * x))


def length_classes(vectors: DataFrame) -> tuple[DataFrame, list[int], list[float], int]:
    """``vectors`` with their class of length as ``cell`` (0 holds the longest), the classes' rows and greatest lengths, and
    the vectors' width."""
    held = vectors.select("vec_id", "vector", length(F.col("vector")).alias("length"))
    n, width = held.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    classes = min(visits.CELLS, n // visits.rows_of(visits.BLOCK_VALUES, width) + 1)
    at = [1 - i / classes for i in range(1, classes)]
    cuts = held.agg(F.percentile_approx("length", at).alias("cuts")).first()["cuts"] if at else []
    shorter = [(F.col("length") < cut).cast("int") for cut in sorted(set(cuts or []), reverse=True)]
    held = held.withColumn("cell", sum(shorter, F.lit(0)))
    sizes, longest = [0] * (len(shorter) + 1), [0.0] * (len(shorter) + 1)
    for r in held.groupBy("cell").agg(F.count("*").alias("n"), F.max("length").alias("longest")).collect():
        sizes[r["cell"]], longest[r["cell"]] = r["n"], r["longest"]
    return held, sizes, longest, width


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` highest inner products of each row of ``queries`` with the
    rows of ``vectors`` of another id, ties to the smaller id. Both have vec_id and vector (array of integers)."""
    held, sizes, longest, width = length_classes(vectors)
    asked = queries.groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("length", length(F.col("vector")))
    begun = asked.withColumns({"floor": F.lit(None).cast("double"), "band": F.lit(0), "cells": F.array(F.lit(0))})
    first = staged(visits.visit(held.where("cell = 0"), begun, sizes, width, _search(k), OUT), "products")
    ordered = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)

    if len(sizes) > 1:
        known = best(first).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
        reach = F.col("length") * (1 + 1e-9)
        helps = [F.when(F.col("floor").isNull() | (reach * most + 1e-6 >= F.col("floor")), F.lit(c)) for c, most in enumerate(longest) if c]
        cells = F.array_compact(F.array(*helps))
        later = asked.join(known, "vec_id", "left").withColumn("cells", cells).where(F.size("cells") > 0)
        later = staged(later.withColumn("band", F.array_max("cells")), "asked")
        first = first.unionByName(visits.visit(held.where("cell > 0"), later, sizes, width, _search(k), OUT))
    return best(first).select("query_id", "rank", "vec_id", "score")
