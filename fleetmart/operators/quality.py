"""Constraints as audits: each returns its findings as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.schemas import (
    FOREIGN_KEYS,
    KEYS,
    NATURAL_KEYS,
    REQUIRED,
    conform,
    declared_widths,
)


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key, unless NULL, has no parent."""
    keys = parent.select(F.col(parent_key).alias("_parent")).distinct()
    filled = child.where(F.col(column).isNotNull())
    return filled.join(keys, filled[column] == keys["_parent"], "left_anti")


def nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_null) of every column that must be filled, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_null")


def widths(df: DataFrame, declared: Mapping[str, int]) -> DataFrame:
    """(column_name, declared, longest, n_too_long) of every text column, in one pass."""
    tests = []
    for name, width in declared.items():
        length = F.length(F.rtrim(F.col(name)))
        tests.append(F.max(length).alias(f"longest_{name}"))
        tests.append(F.count_if(length > width).alias(f"over_{name}"))
    found = df.agg(*tests)
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(width).alias("declared"),
            F.col(f"longest_{name}").alias("longest"),
            F.col(f"over_{name}").alias("n_too_long"),
        )
        for name, width in declared.items()
    ]
    return found.select(F.inline(F.array(*rows)))


ITEM = "table_name string, rule string, column_name string, value string, child long, parent long"


def _item(table: str, rule: str, column: str, value: Column, child: int = 1, parent: int = 0) -> Column:
    cells = [F.lit(table), F.lit(rule), F.lit(column), value.cast("string"), F.lit(child).cast("long"), F.lit(parent).cast("long")]
    names = [part.split()[0] for part in ITEM.split(", ")]
    return F.struct(*[c.alias(n) for c, n in zip(cells, names)])


def audit_items(df: DataFrame, table: str, given: Sequence[str]) -> DataFrame:
    """What one table brings into its audits, in one scan: each row's keys and foreign keys, and an item for each empty
    cell and each text that is too long. ``given`` names all audited tables."""
    items = []
    for rule, keys in (("key", KEYS), ("natural key", NATURAL_KEYS)):
        if columns := keys.get(table):
            value = F.col(columns[0]) if len(columns) == 1 else F.to_json(F.struct(*columns))
            items.append(_item(table, rule, ", ".join(columns), value))
    for column in REQUIRED.get(table, []):
        items.append(F.when(F.col(column).isNull(), _item(table, "required", column, F.lit(None))))
    for column, width in declared_widths(table).items():
        long = F.length(F.rtrim(F.col(column))) > width
        items.append(F.when(long, _item(table, "width", column, F.lit(None))))
    for child, column, parent, parent_key in FOREIGN_KEYS:
        if {child, parent} <= set(given):
            if table == child:
                items.append(F.when(F.col(column).isNotNull(), _item(child, "foreign key", column, F.col(column))))
            if table == parent:
                items.append(_item(child, "foreign key", column, F.col(parent_key), 0, 1))
    held = F.filter(F.array(*items), lambda i: i.isNotNull())
    return df.select(F.explode(held).alias("_item")).select("_item.*")


def audit_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rule, column_name, n_bad) of every declared rule that a given table breaks.

    ``n_bad`` counts keys that occur several times, rows without a parent, empty cells and texts
    that are too long. Columns a frame lacks count as NULL. A foreign key is checked if both of its
    tables are given.

    Every table is scanned once for all of its rules. Its items are counted by value in one aggregate that all tables
    and rules share; a value that most rows have, or a column that is mostly empty, is one row for each task.
    """
    items = [audit_items(conform(df, name), name, list(tables)) for name, df in tables.items()]
    counted = reduce(DataFrame.unionByName, items).groupBy("table_name", "rule", "column_name", "value").agg(
        F.sum("child").alias("n"), F.max("parent").alias("parent")
    )
    rule = F.col("rule")
    bad = (
        F.when(rule.isin("key", "natural key"), (F.col("n") > 1).cast("long"))
        .when(rule == "foreign key", F.when(F.col("parent") == 0, F.col("n")).otherwise(0))
        .otherwise(F.col("n"))
    )
    found = counted.groupBy("table_name", "rule", "column_name").agg(F.sum(bad).alias("n_bad"))
    return found.where("n_bad > 0")
