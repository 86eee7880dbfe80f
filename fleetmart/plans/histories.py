"""Loads of the event histories that read and write the days they change, and no others."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fleetmart.functions.columns import cutoff, moment
from fleetmart.operators import events as E
from fleetmart.operators.events import INSERTED, PURGED, UNCHANGED, UPDATED
from fleetmart.operators.ids import with_dense_ids, with_new_ids
from fleetmart.operators.joins import staged
from fleetmart.plans.inventory import kept_rows
from fleetmart.sources.snapshots import DAY, Snapshots, among

# The rules of each history and the days it is kept.
RULES = {
    "AlertHistory": (E.ALERT_RULES, E.ALERT_DAYS),
    "MaintenanceHistory": (E.MAINTENANCE_RULES, E.MAINTENANCE_DAYS),
}


@dataclass
class Load:
    """Entries for the commit log, how many rows were imported and deleted, and the days looked into."""

    paths: dict[str, str]
    metrics: dict[str, int]
    opened: set[date | None] = field(default_factory=set)


def of_days(df: DataFrame, days: list) -> DataFrame:
    """Rows of the given days, None among them for rows without a date; read from their folders only."""
    return df.where(among(days))


def load_history(
    store: Snapshots,
    table: str,
    source: DataFrame,
    as_of: datetime,
    attempt: str,
    *,
    days: int | None = None,
    null_safe: bool = True,
) -> Load:
    """Purge a history and upsert incoming rows into it, by its rules; see ``events.plan_upsert``.

    The days a load must look into are found first: those that may hold one of its keys, by the key index, and
    the day the retention window begins in, unless all its events lie inside. Days before that are dropped by their facts
    alone. Keys and compared columns of the opened days give the delta, which is written once; the days it names are
    then read in full, merged and written in the one execution of that plan, which counts its rows on the way.
    """
    rules, usual = RULES[table]
    key, when, update = rules["key"], rules["ts_col"], rules["update"]
    days = usual if days is None else days
    begin, now = cutoff(as_of, days), moment(as_of)
    inside = E.recent(source, when, as_of, days).where(F.col(key).isNotNull())
    inside = inside.withColumn(DAY, F.to_date(when))
    values = list(dict.fromkeys([*rules["compare"], *update]))
    offered = staged(E.offers(inside, key, rules["prefer"], values), "offers")

    facts = store.facts(table)
    past = {d: f.rows for d, f in facts.items() if d is not None and f.last is not None and f.last < begin}
    edge = {d for d, f in facts.items() if f.first is not None and f.first < begin and d not in past}
    edge |= {d for d in store.days(table) if d not in facts and d is not None and d <= begin.date()}
    opened = (store.days_holding(table, offered.select("_key")) | edge) - past.keys()

    narrow = E.purge(store.read_days(table, opened), when, as_of, days)
    delta = E.upsert_delta(narrow, offered, key, rules["compare"], update, null_safe)
    delta = staged(delta, "upsert-delta")
    about = delta.agg(
        F.count_if("_new").alias("new"),
        F.array_distinct(F.flatten(F.collect_set(F.when(~F.col("_new"), F.col("_days"))))).alias("days"),
        F.coalesce(F.bool_or(~F.col("_new") & F.col("_undated")), F.lit(False)).alias("undated"),
    ).first()
    touched = set(about["days"]) | ({None} if about["undated"] else set()) | edge

    used = max((f.top_id or 0 for f in facts.values()), default=0)
    if any(d not in facts for d in store.days(table)):
        used = store.read_days(table).agg(F.max("ID")).first()[0] or 0
    after = store.claim_ids(table, about["new"], used)
    inserts, fresh = None, Counter()
    if about["new"]:
        keys = delta.where("_new").select(F.col("_key").alias(key))
        ids = with_dense_ids(keys, [key], "ID", after)
        rows = with_new_ids(inside, ids, key, lambda df: E.latest_per_key(df, key, rules["prefer"]))
        inserts = staged(rows.withColumns({"Imported": now, "_action": F.lit(INSERTED)}), "upsert-inserts")
        fresh = Counter({r[DAY]: r["count"] for r in inserts.groupBy(DAY).count().collect()})
    metrics = {"imported": 0, "deleted": sum(past.values())}
    gone = dict.fromkeys(past, False)
    if not touched and inserts is None:
        return Load(store.stage_days(table, narrow, attempt, gone), metrics, opened)

    # Days that get new rows keep their old ones.
    written = dict.fromkeys({*touched, *fresh}, True)
    old = store.read_days(table, written)
    updates = delta.where("not _new").select("_key", *[f"_new_{c}" for c in update])
    merged = E.with_actions(old, updates, key, when, moment(begin), update, "Imported", now).select(*old.columns, "_action")
    if inserts is not None:
        cells = [F.col(f.name).cast(f.dataType).alias(f.name) for f in old.schema.fields]
        merged = merged.unionByName(inserts.select(*cells, "_action"))
    seen = Observation()
    merged = merged.observe(
        seen,
        F.count_if(F.col("_action").isin(INSERTED, UPDATED)).alias("imported"),
        F.count_if(F.col("_action") == PURGED).alias("deleted"),
    )
    sizes = {d: fresh[d] + (facts[d].rows if d in facts else 0) for d in written}
    rows = merged.where(F.col("_action") != PURGED).drop("_action")
    paths = store.stage_days(table, rows, attempt, gone | written, sizes)
    metrics = {name: metrics[name] + seen.get[name] for name in metrics}
    return Load(paths, metrics, opened)


def stage_load(
    store: Snapshots, table: str, plan: Callable[[DataFrame], DataFrame], attempt: str
) -> Load:
    """Write the days that a planned upsert of one's own changes.

    The plan is first counted by day and action, which reads keys, dates and compared columns. The
    counts, a row for each day and action, tell the metrics, the days to write again and the days
    without rows from now on; all other days keep their files.
    """
    planned = plan(store.read_days(table))
    counts: dict = defaultdict(dict)
    for row in planned.groupBy(DAY, "_action").count().collect():
        counts[row[DAY]][row["_action"]] = row["count"]
    touched = {
        day: any(action != PURGED for action in found)
        for day, found in counts.items()
        if set(found) != {UNCHANGED}
    }
    rows = of_days(kept_rows(planned), [day for day, kept in touched.items() if kept])
    paths = store.stage_days(table, rows, attempt, touched)

    def total(*actions: str) -> int:
        return sum(found.get(action, 0) for found in counts.values() for action in actions)

    return Load(paths, {"imported": total(INSERTED, UPDATED), "deleted": total(PURGED)})
