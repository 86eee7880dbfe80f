"""Queries visit cells of vectors: each query goes to the cells that can still help it, and vectors only where one asks.

Cells are few (``CELLS``) and may hold any number of vectors; a cell is cut into blocks by a hash, so that a task holds
``BLOCK_VALUES`` components of vectors however many vectors are alike. Queries that ask for similar cells form a group of about
``GROUP_VALUES`` components, and a vector is copied once per group that asks for its cell.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells, the most: what is known of each of them, and of each pair of them, may go through the driver.
CELLS = 64
#: Components of the vectors of a block, and of the queries of a group: what one task holds.
BLOCK_VALUES = 1 << 19
GROUP_VALUES = 1 << 22


def rows_of(values: int, width: int) -> int:
    return max(1, values // max(1, width))


def by_place(values: Sequence[int], place: Column) -> Column:
    """The value that stands at a place of a short list."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), place.cast("int") + 1)


def grouped_bands(counts: Sequence[int], least: int) -> list[int]:
    """The group of each band: neighbours are put together until they hold ``least`` queries."""
    groups, group, held = [], 0, 0
    for count in counts:
        if held >= least:
            group, held = group + 1, 0
        groups.append(group)
        held += count
    return groups


def visit(held: DataFrame, asked: DataFrame, sizes: Sequence[int], width: int, search: Callable[[pd.DataFrame], pd.DataFrame],
          out: str) -> DataFrame:
    """Union of ``search`` over blocks of vectors and groups of queries.

    ``held``: vec_id, vector, cell; ``sizes``: vectors of each cell. ``asked``: vec_id, vector, floor, band (a number below
    ``CELLS``), cells (array of those to visit). ``search`` gets vec_id, vector, floor and asks (true for queries).
    """
    group_rows = rows_of(GROUP_VALUES, width)
    bands = {r["band"]: r for r in asked.groupBy("band").agg(
        F.count("*").alias("n"), F.array_distinct(F.flatten(F.collect_set("cells"))).alias("cells")).collect()}
    counts = [bands[b]["n"] if b in bands else 0 for b in range(CELLS)]
    group_of = grouped_bands(counts, group_rows)
    shares, wanted = [0] * CELLS, [set() for _ in range(CELLS)]
    for b, r in bands.items():
        shares[group_of[b]] += r["n"]
        wanted[group_of[b]].update(r["cells"])
    shares = [n // group_rows + 1 for n in shares]
    blocks = [n // rows_of(BLOCK_VALUES, width) + 1 for n in sizes]
    askers = [[g for g in range(CELLS) if c in wanted[g]] for c in range(len(sizes))]

    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    own = lambda n: F.pmod(F.xxhash64("vec_id", "vector"), n)
    groups = F.array(*[F.array(*map(F.lit, a)) if a else F.array().cast("array<int>") for a in askers])
    left = held.withColumn("group", F.explode(F.element_at(groups, F.col("cell").cast("int") + 1)))
    left = left.withColumn("share", upto(by_place(shares, F.col("group")))).withColumn("block", own(by_place(blocks, F.col("cell"))))
    right = asked.withColumn("group", by_place(group_of, F.col("band"))).withColumn("share", own(by_place(shares, F.col("group"))))
    right = right.withColumn("cell", F.explode("cells")).withColumn("block", upto(by_place(blocks, F.col("cell"))))
    keys = [F.col(c).cast("int").alias(c) for c in ("cell", "block", "group", "share")]
    rows = left.select(*keys, "vec_id", "vector", F.lit(None).cast("double").alias("floor"), F.lit(False).alias("asks")).unionByName(
        right.select(*keys, "vec_id", "vector", "floor", F.lit(True).alias("asks"))
    )
    return rows.groupBy("cell", "block", "group", "share").applyInPandas(search, out)
