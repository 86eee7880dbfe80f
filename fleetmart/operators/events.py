"""Event histories: retention, upsert by natural key, load metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.columns import cutoff, differs, moment
from fleetmart.operators.ids import highest, with_dense_ids, with_new_ids
from fleetmart.operators.joins import staged

PURGED, UPDATED, INSERTED, UNCHANGED = "purged", "updated", "inserted", "unchanged"


def recent(df: DataFrame, ts_col: str, as_of: datetime, days: int) -> DataFrame:
    """Rows not older than the retention window; rows without a date are left out."""
    return df.where(F.col(ts_col) >= moment(cutoff(as_of, days)))


def purge(df: DataFrame, ts_col: str, as_of: datetime, days: int) -> DataFrame:
    """What a retention run keeps; rows without a date stay."""
    limit = moment(cutoff(as_of, days))
    return df.where(F.col(ts_col).isNull() | (F.col(ts_col) >= limit))


def latest_per_key(df: DataFrame, key: str, prefer: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``prefer``, then by the other columns."""
    rest = [c for c in df.columns if c not in prefer and c != key]
    top = df.groupBy(key).agg(F.max(F.struct(*prefer, *rest)).alias("_row"))
    return top.select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in df.columns])


def offers(inside: DataFrame, key: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per incoming key: ``_key`` and the values it offers."""
    narrow = inside.select(key, *dict.fromkeys([*order, *values]))
    return latest_per_key(narrow, key, order).select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in values]
    )


def upsert_delta(
    held: DataFrame, offered: DataFrame, key: str, compare: Sequence[str], update: Sequence[str], null_safe: bool
) -> DataFrame:
    """Keys that are new or whose compared values changed, with what they offer: _key, _new, _new_*.

    Where the held rows carry the day they are kept under, ``_days`` lists a changed key's days and ``_undated`` tells
    whether one of its rows has none.
    """
    by_day = "_day" in held.columns
    held = held.where(F.col(key).isNotNull())
    held = held.select(key, *compare, *(["_day"] if by_day else [])).distinct()
    is_new = held[key].isNull()
    changed = reduce(
        lambda a, b: a | b, [differs(F.col(c), F.col(f"_new_{c}"), null_safe) for c in compare]
    )
    work = offered.join(held, offered["_key"] == held[key], "left")
    news = [f"_new_{c}" for c in update]
    if not by_day:
        return work.where(is_new | changed).select("_key", is_new.alias("_new"), *news).distinct()
    per_key = work.groupBy("_key", *news).agg(
        F.bool_and(is_new).alias("_new"),
        F.bool_or(F.coalesce(changed, F.lit(False))).alias("_changed"),
        F.collect_set("_day").alias("_days"),
        F.bool_or(~is_new & F.col("_day").isNull()).alias("_undated"),
    )
    return per_key.where("_new or _changed").drop("_changed")


def with_actions(
    old: DataFrame,
    updates: DataFrame,
    key: str,
    ts_col: str,
    limit: Column,
    update: Sequence[str],
    stamp_col: str,
    now: Column,
) -> DataFrame:
    """Old rows with their ``_action``, those to be updated with their new values."""
    outdated = F.coalesce(F.col(ts_col) < limit, F.lit(False))
    joined = old.join(updates, old[key] == updates["_key"], "left")
    action = (
        F.when(outdated, PURGED).when(F.col("_key").isNotNull(), UPDATED).otherwise(UNCHANGED)
    )
    marked = joined.withColumn("_action", action)
    is_update = F.col("_action") == UPDATED
    for name in update:
        new_value = F.col(f"_new_{name}").cast(old.schema[name].dataType)
        marked = marked.withColumn(name, F.when(is_update, new_value).otherwise(F.col(name)))
    return marked.withColumn(stamp_col, F.when(is_update, now).otherwise(F.col(stamp_col)))


def plan_upsert(
    old: DataFrame,
    new: DataFrame,
    *,
    key: str,
    ts_col: str,
    as_of: datetime,
    days: int,
    compare: Sequence[str],
    update: Sequence[str],
    prefer: Sequence[str] = (),
    null_safe: bool = True,
    id_col: str = "ID",
    stamp_col: str = "Imported",
) -> DataFrame:
    """Every old and inserted row with its ``_action``.

    Old rows outside the retention window are purged. An incoming row inside it updates the old
    row of its key if one of ``compare`` changed, or is inserted. Of several incoming rows with
    one key the greatest by ``prefer`` counts; rows without a key are left out.

    Where the old rows carry the day they are kept under (``_day``), inserted ones get theirs. The
    delta and the inserts are written to the shared folder once, so every reader of the plan sees
    the same.
    """
    now = moment(as_of)
    limit = moment(cutoff(as_of, days))
    order = [*prefer] or [*compare]
    inside = recent(new, ts_col, as_of, days).where(F.col(key).isNotNull())
    if "_day" in old.columns:
        inside = inside.withColumn("_day", F.to_date(ts_col))

    # What changed, found on the compared columns alone, before any full row moves.
    values = list(dict.fromkeys([*compare, *update]))
    held = purge(old, ts_col, as_of, days)
    delta = staged(upsert_delta(held, offers(inside, key, order, values), key, compare, update, null_safe), "upsert-delta")
    updates = delta.where("not _new").select("_key", *[f"_new_{c}" for c in update])
    new_keys = delta.where("_new").select(F.col("_key").alias(key))

    marked = with_actions(old, updates, key, ts_col, limit, update, stamp_col, now)

    new_ids = with_dense_ids(new_keys, [key], id_col, highest(old, id_col))
    inserts = with_new_ids(inside, new_ids, key, lambda df: latest_per_key(df, key, order))
    inserts = inserts.withColumn(stamp_col, now)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in old.schema.fields]
    inserted = staged(inserts.select(*columns, F.lit(INSERTED).alias("_action")), "upsert-inserts")
    return marked.select(*old.columns, "_action").unionByName(inserted)


def upsert_events(old: DataFrame, new: DataFrame, **rules) -> DataFrame:
    """The history after retention and upsert; see :func:`plan_upsert` for the rules."""
    return plan_upsert(old, new, **rules).where(F.col("_action") != PURGED).drop("_action")


def import_metrics(planned: DataFrame) -> DataFrame:
    """Rows inserted or updated, and rows deleted, by one load."""
    loaded = F.count_if(F.col("_action").isin(INSERTED, UPDATED))
    return planned.agg(
        loaded.alias("imported"), F.count_if(F.col("_action") == PURGED).alias("deleted")
    )


# Rules of the two event histories.
ALERT_RULES: Mapping[str, object] = {
    "key": "AlertGuid",
    "ts_col": "RaisedDateTime",
    "compare": ["RepeatCount"],
    "update": ["RepeatCount"],
    "prefer": ["RepeatCount", "RaisedDateTime"],
}
ALERT_DAYS = 90
MAINTENANCE_RULES: Mapping[str, object] = {
    "key": "MaintenanceRowId",
    "ts_col": "StartDateTime",
    "compare": ["EndDateTime", "ScheduledEndDateTime"],
    "update": ["EndDateTime", "ScheduledEndDateTime", "Comment"],
    "prefer": ["EndDateTime", "ScheduledEndDateTime"],
}
MAINTENANCE_DAYS = 365
