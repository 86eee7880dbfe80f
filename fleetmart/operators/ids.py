"""Surrogate keys without a one-partition sort."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_DIGITS = 4  # hexadecimal digits: 65,536 buckets at most


def bucket_of(*keys: str) -> Column:
    """Bucket of a row, from its natural key alone, so any rerun puts it in the same place."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.left(F.md5(F.concat_ws("|", *parts)), F.lit(BUCKET_DIGITS))


def with_dense_ids(df: DataFrame, keys: list[str], id_col: str, after: Column | int = 0) -> DataFrame:
    """Number the rows ``after + 1 … after + n`` in the order (bucket, natural key).

    Rows are ranked inside their bucket in parallel; a bucket starts where the ones before it end.
    Only the per-bucket counts (65,536 rows at most) meet in one task and are broadcast. ``keys``
    must be unique, which also keeps the buckets even.
    """
    rows = df.withColumn("_bucket", bucket_of(*keys))
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    base = after if isinstance(after, Column) else F.lit(after)
    inside = W.partitionBy("_bucket").orderBy(*keys)
    ranked = rows.withColumn("_rank", F.row_number().over(inside))
    joined = ranked.join(F.broadcast(starts), "_bucket")
    numbered = joined.withColumn(id_col, (base + F.col("_start") + F.col("_rank")).cast("long"))
    return numbered.drop("_bucket", "_start", "_rank")


def with_new_ids(
    source: DataFrame, new_ids: DataFrame, key: str, reduce: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The source rows of the new keys, reduced to one per key, with their ids.

    The join comes first, so that rows already known are not reduced; a shuffled join has the rows
    in place by key for the reduction.
    """
    return reduce(source.join(new_ids, key))


def highest(df: DataFrame, id_col: str) -> Column:
    """Largest key in use as a scalar subquery; 0 for an empty table."""
    return df.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_top")).scalar()
