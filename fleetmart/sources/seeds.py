"""Seed rows, their two dialects, and full reloads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.schemas import struct_of
from fleetmart.sources.snapshots import Snapshots

# Parents before children; deletion would go the other way round.
LOAD_ORDER = [
    "SQLVersion",
    "Support",
    "ManagedSQLEntityType",
    "ManagedEntityCompType",
    "ManagedEntityDatabaseType",
    "ExcludeDB",
    "Customer",
    "CustomerDomain",
    "SQLServer",
    "Computer",
    "SQLDatabase",
]
RENAMED = {"Customer": {"Id": "CustomerId"}}


def _date_text(c: Column) -> Column:
    """ISO text from ``YYYYMMDD`` or ISO text, with or without a time."""
    return F.regexp_replace(F.trim(c), r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")


def _flag(c: Column) -> Column:
    text = F.lower(F.trim(c))
    return F.when(text.isin("1", "true"), True).when(text.isin("0", "false"), False)


def _flag_text(c: Column) -> Column:
    """Flags kept in text columns: 1/0 become true/false, other text stays."""
    return F.when(c == "1", "true").when(c == "0", "false").otherwise(c)


def normalise_seed(
    df: DataFrame,
    schema: T.StructType,
    renamed: Mapping[str, str] | None = None,
    flag_texts: Sequence[str] = (),
) -> DataFrame:
    """Seed text of either dialect in the table's own names and types.

    Columns the seed lacks are NULL. Dates may be compact or ISO, flags words or digits;
    ``flag_texts`` names text columns that hold flags.
    """
    for old, new in (renamed or {}).items():
        df = df.withColumnRenamed(old, new)

    def typed(field: T.StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType)
        text = df[field.name].cast("string")
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            return _date_text(text).cast(field.dataType)
        if isinstance(field.dataType, T.BooleanType):
            return _flag(text)
        if field.name in flag_texts:
            return _flag_text(text)
        return text.cast(field.dataType)

    return df.select(*[typed(f).alias(f.name) for f in schema.fields])


def seed_table(
    spark: SparkSession, table: str, columns: Sequence[str], rows: Sequence[tuple]
) -> DataFrame:
    """Inline rows, given as text in either dialect, as a table frame."""
    texts = [tuple(None if v is None else str(v) for v in row) for row in rows]
    ddl = ", ".join(f"`{c}` string" for c in columns)
    flags = ("DatabaseAutogrow", "LogAutogrow") if table == "SQLDatabase" else ()
    return normalise_seed(
        spark.createDataFrame(texts, ddl), struct_of(table), RENAMED.get(table), flags
    )


def with_random_guid(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.upper(F.uuid()))


def reload(store: Snapshots, tables: Mapping[str, DataFrame]) -> int:
    """Replace tables in full, parents first, and switch to all of them at once."""
    known = [t for t in LOAD_ORDER if t in tables]
    return store.write({t: tables[t] for t in [*known, *[t for t in tables if t not in known]]})


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(Tabelle, Zeilen) of every table, by name."""
    counts = [
        df.agg(F.count("*").alias("Zeilen")).select(F.lit(name).alias("Tabelle"), "Zeilen")
        for name, df in tables.items()
    ]
    union = counts[0]
    for more in counts[1:]:
        union = union.unionByName(more)
    return union.orderBy("Tabelle")
