"""Schema extension: inventories grow a text column per property they lack."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.operators.joins import of_types


def missing_columns(
    dictionary: DataFrame, types: DataFrame, table: str, existing: Sequence[str]
) -> DataFrame:
    """(Tabelle, Neue Spalte): property names of the given types that are no columns yet.

    Names that differ only in case are one column, shown in their smallest spelling.
    """
    names = of_types(dictionary, types).where("PropertySystemName is not null")
    have = {c.lower() for c in existing}
    absent = names.where(~F.lower("PropertySystemName").isin(sorted(have)))
    spelled = absent.groupBy(F.lower("PropertySystemName").alias("_name")).agg(
        F.min("PropertySystemName").alias("Neue Spalte")
    )
    return spelled.select(F.lit(table).alias("Tabelle"), "Neue Spalte")


def extension_plan(missing: Iterable[DataFrame], what_if: bool = True) -> DataFrame:
    """Preview of the extension of all tables, in order."""
    frames = list(missing)
    rows = frames[0]
    for more in frames[1:]:
        rows = rows.unionByName(more)
    # Shown texts.
    kind = "NVARCHAR(256) NULL"
    action = "(WhatIf – keine Aenderung)" if what_if else "ALTER TABLE wird ausgefuehrt"
    shown = rows.select(
        "Tabelle",
        "Neue Spalte",
        F.lit(kind).alias("Datentyp"),
        F.lit(action).alias("Aktion"),
    )
    return shown.orderBy("Tabelle", "Neue Spalte")


@dataclass
class Extension:
    """Outcome of a schema extension."""

    df: DataFrame
    added: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)


def extend_schema(df: DataFrame, names: Sequence[str]) -> Extension:
    """Add nullable text columns; a name that cannot be added is noted and the rest go on."""
    have = {c.lower() for c in df.columns}
    added, failed = [], []
    for name in names:
        if not name.strip() or name.lower() in have:
            failed.append(name)
            continue
        added.append(name)
        have.add(name.lower())
    empty = F.lit(None).cast("string")
    wide = df.select("*", *[empty.alias(name) for name in added])
    return Extension(wide, added, failed)


@dataclass
class TableExtension:
    """Columns that a stored table got, and those it could not get."""

    added: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)


def extend_table(spark: SparkSession, table: str, names: Iterable[str]) -> TableExtension:
    """Add nullable text columns to a table of the catalog; one that cannot be added is noted and the rest go on.

    Only the catalog's schema changes: no file is written again, rows of older files have NULL in the new columns.
    """
    out = TableExtension()
    for name in names:
        quoted = name.replace("`", "``")
        try:
            if not name.strip():
                raise AnalysisException("a column needs a name")
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{quoted}` STRING)")
            out.added.append(name)
        except AnalysisException:
            out.failed.append(name)
    return out


def read_evolved(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of parquet files that were written before and after an extension, with the columns of all of them."""
    return spark.read.option("mergeSchema", "true").parquet(folder)


def column_names(missing: Iterable[DataFrame]) -> dict[str, list[str]]:
    """Names for :func:`extend_schema` by table; they become a schema, which the driver holds."""
    rows = extension_plan(missing).select("Tabelle", "Neue Spalte").collect()
    names: dict[str, list[str]] = {}
    for table, name in rows:
        names.setdefault(table, []).append(name)
    return names


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename a column if it exists; a second run changes nothing."""
    return df.withColumnRenamed(old, new)


def recast_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """Change a column's type; values that do not fit become NULL."""
    return df.withColumn(name, F.col(name).try_cast(kind))
