"""Snapshot sync with soft delete, and its helpers."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.columns import moment
from fleetmart.operators.ids import highest, with_dense_ids, with_new_ids
from fleetmart.operators.joins import staged

KEEP, REVIVED = "keep", "revived"
NEWLY_MISSING, STILL_MISSING = "newly_missing", "still_missing"


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by ``order``, then by the other columns. NULL keys form one group.

    An aggregate instead of a window: each task reduces its copies before the shuffle, so a key
    that holds most rows moves one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranking = [c for c in order if c not in keys]
    row = F.struct(*ranking, *[c for c in rest if c not in ranking])
    first = df.groupBy(*keys).agg(F.min(row).alias("_row"))
    # Keys come from the grouping, so a reader of keys alone makes this a plain distinct.
    return first.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest by all columns in turn, whatever the input order."""
    return keep_first(df, [key], [c for c in df.columns if c != key])


def key_delta(
    target: DataFrame, source: DataFrame, *, key: str, match_on: str, missing_col: str
) -> DataFrame:
    """Keys that need work: (_key, _found, _new).

    Both sides are reduced to their distinct keys first, so no key is hot in the join, and only
    keys and one mark are shuffled. Keys whose rows stay as they are do not appear.
    """
    marked = F.col(missing_col).isNotNull()
    known = (
        target.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.bool_or(marked).alias("_marked"), F.bool_or(~marked).alias("_unmarked"))
    )
    seen = source.select(F.col(match_on).alias("_key")).where("_key is not null").distinct()
    both = known.join(seen.withColumn("_found", F.lit(True)), "_key", "full_outer").select(
        "_key",
        F.coalesce("_found", F.lit(False)).alias("_found"),
        F.col("_marked").isNull().alias("_new"),
        "_marked",
        "_unmarked",
    )
    work = "_new or (_found and _marked) or (not _found and _unmarked)"
    return both.where(work).select("_key", "_found", "_new")


def with_state(target: DataFrame, delta: DataFrame, key: str, missing_col: str) -> DataFrame:
    """Target rows with their ``_state``; a row without a key counts as not found."""
    changed = delta.where("not _new").select("_key", "_found")
    present = F.col(missing_col).isNull()
    joined = target.join(changed, target[key] == changed["_key"], "left")
    found = F.when(F.col(key).isNull(), False).otherwise(F.coalesce("_found", present))
    state = (
        F.when(found & present, KEEP)
        .when(found, REVIVED)
        .when(present, NEWLY_MISSING)
        .otherwise(STILL_MISSING)
    )
    return joined.withColumn("_state", state).drop("_key", "_found")


def classify(
    target: DataFrame, source: DataFrame, *, key: str, missing_col: str = "NotFoundSince"
) -> DataFrame:
    """Target rows with the state a sync would find them in."""
    delta = key_delta(target, source, key=key, match_on=key, missing_col=missing_col)
    return with_state(target, delta, key, missing_col)


def sync_snapshot(
    target: DataFrame,
    source: DataFrame,
    *,
    key: str,
    as_of: datetime,
    match_on: str | None = None,
    id_col: str = "ID",
    missing_col: str = "NotFoundSince",
    modified_col: str | None = None,
    defaults: Mapping[str, Column] | None = None,
    claim: Callable[[int, int], int] | None = None,
) -> DataFrame:
    """Bring an inventory in line with its source.

    Rows found again lose their missing mark, rows not found any more get ``as_of``, new rows are
    inserted with the given defaults and a fresh surrogate key; nothing is deleted. Source rows
    are reduced to one per ``key``; those without a key are left out, as they could never be found
    again. ``match_on`` names the source column compared with the target's key when it is another
    one than ``key``.

    Keys are compared before any full row moves, and what changed is written to the shared folder
    once. After a usual run that is little, and both tables are then joined where they are read.

    ``claim(count, used)`` gives the number after which fresh ids follow, as ``Snapshots.claim_ids`` does for a stored
    table; without it they follow the highest id in the target.
    """
    match_on = match_on or key
    source = source.where(F.col(key).isNotNull())
    delta = key_delta(target, source, key=key, match_on=match_on, missing_col=missing_col)
    delta = staged(delta, "sync-delta")
    now = moment(as_of)
    types = {f.name: f.dataType for f in target.schema.fields}
    state = F.col("_state")
    none = F.lit(None)
    mark = (
        F.when(state == REVIVED, none.cast(types[missing_col]))
        .when(state == NEWLY_MISSING, now.cast(types[missing_col]))
        .otherwise(F.col(missing_col))
    )
    kept = with_state(target, delta, key, missing_col).withColumn(missing_col, mark)
    if modified_col:
        touched = state.isin(REVIVED, NEWLY_MISSING)
        stamp = F.when(touched, now.cast(types[modified_col])).otherwise(F.col(modified_col))
        kept = kept.withColumn(modified_col, stamp)

    if match_on == key:
        new_keys = delta.where("_new").select(F.col("_key").alias(key))
    else:
        known = target.select(F.col(key).alias("_known")).distinct()
        pairs = source.select(key, match_on).distinct()
        unmatched = pairs.join(known, pairs[match_on] == known["_known"], "left_anti")
        new_keys = staged(unmatched.select(key).distinct(), "sync-keys")
    after = highest(target, id_col)
    if claim is not None:
        after = claim(new_keys.count(), target.agg(F.max(id_col)).first()[0] or 0)
    new_ids = with_dense_ids(new_keys, [key], id_col, after)
    inserts = with_new_ids(source, new_ids, key, lambda df: one_per_key(df, key))
    defaults = defaults or {}

    def inserted(name: str) -> Column:
        value = F.col(name) if name in inserts.columns else none
        if name in defaults:
            value = F.coalesce(value, defaults[name])
        return value.cast(types[name]).alias(name)

    return kept.select(*target.columns).unionByName(
        inserts.select(*[inserted(c) for c in target.columns])
    )


def update_from(
    target: DataFrame,
    values: DataFrame,
    *,
    on: str,
    values_key: str,
    set_cols: Mapping[str, str],
) -> DataFrame:
    """Overwrite target columns from ``values`` where the key matches, also with NULL.

    ``values`` holds one row per key.
    """
    hits = values.select(
        F.col(values_key).alias("_key"),
        *[F.col(v).alias(f"_new_{t}") for t, v in set_cols.items()],
    ).where("_key is not null")
    joined = target.join(hits, target[on] == hits["_key"], "left")
    for name in set_cols:
        new = F.when(F.col("_key").isNotNull(), F.col(f"_new_{name}")).otherwise(F.col(name))
        joined = joined.withColumn(name, new)
    return joined.select(*target.columns)
