"""Existence filters between tables, and staging of frames that several readers share.

Nothing is hinted here: Catalyst and adaptive execution choose each join by the sizes they see.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.columns import is_key_text, name_key
from fleetmart.session import shared_dir


def staged(df: DataFrame, purpose: str = "staged") -> DataFrame:
    """The frame, written to the shared folder and read again.

    For a frame with several readers: it is computed once, all of them see the same rows even if
    its source changes meanwhile, lost executors cost nothing, and later joins know its size.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def active_types(types: DataFrame, flag: str | None = None) -> DataFrame:
    """Type ids that are switched on (all of them when the table has no flag)."""
    on = types.where(F.col(flag)) if flag else types
    return on.select("ManagedEntityTypeRowId")


def of_types(entities: DataFrame, types: DataFrame) -> DataFrame:
    return entities.join(types.distinct(), "ManagedEntityTypeRowId", "left_semi")


def same_name(df: DataFrame, column: str, others: DataFrame, other_column: str) -> DataFrame:
    """Rows whose name occurs in another table, whatever the case and trailing blanks.

    Names are compared by their type if both sides have it (``schemas.with_key_texts``), by a key else.
    """
    df, others = _alike(df, column, others, other_column)
    names = others.select(name_key(others, other_column).alias("_name")).distinct()
    return df.join(names, name_key(df, column) == names["_name"], "left_semi")


def _alike(df: DataFrame, column: str, others: DataFrame, other_column: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with a plain name where only one of them has the type of names, as the two cannot be compared."""
    if is_key_text(df, column) == is_key_text(others, other_column):
        return df, others
    plain = lambda frame, c: frame.withColumn(c, F.col(c).cast("string"))
    return plain(df, column), plain(others, other_column)


def known_entities(*inventories: DataFrame) -> DataFrame:
    """Entity ids of all inventories, rows marked missing included."""
    ids = [t.select("ManagedEntityRowId") for t in inventories]
    union = ids[0]
    for more in ids[1:]:
        union = union.unionByName(more)
    return union.distinct()


def only_known(df: DataFrame, known: DataFrame, column: str = "ManagedEntityRowId") -> DataFrame:
    ids = known.select(F.col("ManagedEntityRowId").alias("_id")).distinct()
    return df.join(ids, df[column] == ids["_id"], "left_semi")


def exclude_names(df: DataFrame, column: str, excluded: DataFrame, name: str = "Name") -> DataFrame:
    """``NOT IN``: rows with a NULL name go too, unless the list is empty; a NULL in the list
    removes every row.

    Written as a plain anti join plus one row of facts about the list, because Spark's own
    null-aware anti join has to broadcast the list or fall back to a nested loop.
    """
    df, excluded = _alike(df, column, excluded, name)
    names = excluded.select(name_key(excluded, name).alias("_name"))
    facts = F.struct(
        F.count("*").alias("n"), F.count_if(F.col("_name").isNull()).alias("nulls")
    )
    about = names.agg(facts.alias("_facts")).scalar()
    hits = names.where("_name is not null").distinct()
    kept = df.join(hits, name_key(df, column) == hits["_name"], "left_anti")
    return kept.where((about["n"] == 0) | (kept[column].isNotNull() & (about["nulls"] == 0)))
