"""An equi-join whose left side may hold a third of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Left rows of one key from which the key is spread over as many shares as there are shuffle partitions.
HOT = 10_000


def join_spread(left: DataFrame, right: DataFrame, on: Sequence[str], copies: str, hot: int = HOT) -> DataFrame:
    """Inner join on keys that are unique on the right, where ``copies`` counts each key's rows on the left.

    Both sides carry a share beside the key: the right repeats its hot keys for every share and has the others once, under
    none; a left row looks under none and under the share that its other columns give it, and meets exactly one of the two.
    ``copies`` is not in the result.
    """
    shares = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in left.columns if c not in on]
    simple = [c for c in rest if left.schema[c].dataType.typeName() not in ("array", "map", "struct")]
    own = F.pmod(F.xxhash64(*simple), F.lit(shares)).cast("int")
    none = F.array(F.lit(-1))
    every = F.when(F.col(copies) >= hot, F.sequence(F.lit(0), F.lit(shares - 1))).otherwise(none)
    wide = right.withColumn("_share", F.explode(every)).drop(copies)
    return left.withColumn("_share", F.explode(F.array(F.lit(-1), own))).join(wide, [*on, "_share"]).drop("_share")
