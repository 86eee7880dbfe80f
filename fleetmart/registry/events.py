"""Queries for the two event histories, in batch and as streams."""

from fleetmart.operators import events as E
from fleetmart.operators.joins import known_entities
from fleetmart.plans import inventory as I
from fleetmart.registry import standins as S
from fleetmart.registry.base import Tables, query, shown
from fleetmart.session import shared_dir
from fleetmart.sources.snapshots import Snapshots
from fleetmart.streaming import upserts

UNDATED = """
SELECT event_id, CASE WHEN event_type <> 'signup' THEN ts END AS ts, event_type FROM {events}"""


@query(
    "retention_purge",
    f"""SELECT event_id, event_type FROM ({UNDATED}) e
        WHERE ts IS NULL OR ts >= TIMESTAMP_NTZ '2024-01-08 00:00:00'""",
)
def retention_purge(t: Tables):
    return E.purge(t.sql(UNDATED), "ts", S.EVENTS_AS_OF, 24).select("event_id", "event_type")


def text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


ALERT_PLAN = f"""
WITH old AS ({S.ALERT_HISTORY}),
src AS (SELECT upper(AlertGuid) AS AlertGuid, ManagedEntityRowId, Category, RaisedDateTime,
               CASE Severity WHEN 0 THEN 'Information' WHEN 1 THEN 'Warning' WHEN 2 THEN 'Error'
                    ELSE CAST(Severity AS VARCHAR) END AS Severity,
               CASE Priority WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High'
                    ELSE CAST(Priority AS VARCHAR) END AS Priority, RepeatCount
        FROM ({S.ALERT_DETAILS}) d
        WHERE RaisedDateTime >= TIMESTAMP_NTZ '2024-01-08 00:00:00'
          AND ManagedEntityRowId IN ({S.KNOWN_SERVERS} UNION {S.KNOWN_COMPUTERS})),
kept AS (SELECT * FROM old WHERE RaisedDateTime >= TIMESTAMP_NTZ '2024-01-08 00:00:00'),
f AS (SELECT * FROM src WHERE AlertGuid NOT IN (SELECT AlertGuid FROM kept)),
result AS (
SELECT k.ID, k.AlertGuid, k.ManagedEntityRowId, k.Category, {text("k.RaisedDateTime")} AS RaisedDateTime,
       k.Severity, k.Priority, coalesce(s.RepeatCount, k.RepeatCount) AS RepeatCount,
       CASE WHEN s.RepeatCount <> k.RepeatCount THEN '2024-02-01 00:00:00'
            ELSE '2024-01-21 00:00:00' END AS Imported
FROM kept k LEFT JOIN src s ON s.AlertGuid = k.AlertGuid
UNION ALL
SELECT CAST((SELECT max(ID) FROM old) + row_number() OVER (ORDER BY left(md5(AlertGuid), 4), AlertGuid)
            AS BIGINT), AlertGuid, ManagedEntityRowId, Category, {text("RaisedDateTime")}, Severity,
       Priority, RepeatCount, '2024-02-01 00:00:00' FROM f)"""
ALERT_COLUMNS = [
    "AlertGuid",
    "ManagedEntityRowId",
    "Category",
    "RaisedDateTime",
    "Severity",
    "Priority",
    "RepeatCount",
    "Imported",
]
SHOWN_ALERTS = ", ".join(ALERT_COLUMNS)


def known(t: Tables):
    return known_entities(t.sql(S.KNOWN_SERVERS), t.sql(S.KNOWN_COMPUTERS))


def planned_alerts(t: Tables):
    source = I.alert_source(t.sql(S.ALERT_DETAILS), known(t))
    return I.plan_alerts(t.sql(S.ALERT_HISTORY), source, S.EVENTS_AS_OF, 24)


def alert_rows(df, *more):
    return shown(df.select(*more, *ALERT_COLUMNS), "RaisedDateTime", "Imported")


@query("alert_import", f"{ALERT_PLAN} SELECT ID, {SHOWN_ALERTS} FROM result")
def alert_import(t: Tables):
    return alert_rows(I.kept_rows(planned_alerts(t)), "ID")


@query(
    "import_metrics",
    f"""{ALERT_PLAN} SELECT (SELECT count(*) FROM result WHERE Imported = '2024-02-01 00:00:00') AS imported,
                            (SELECT count(*) FROM old) - (SELECT count(*) FROM kept) AS deleted""",
)
def import_metrics(t: Tables):
    return E.import_metrics(planned_alerts(t))


LIMIT = "TIMESTAMP_NTZ '2000-12-31 10:30:00'"
MAINTENANCE_PLAN = f"""
WITH old AS ({S.MAINTENANCE_HISTORY}),
src AS (SELECT w.*, n.ManagedEntityDefaultName FROM ({S.WINDOWS}) w
        JOIN ({S.NAMED_ENTITIES}) n ON n.ManagedEntityRowId = w.ManagedEntityRowId
        WHERE StartDateTime >= {LIMIT}
          AND w.ManagedEntityRowId IN (SELECT c_custkey FROM {{customer}} WHERE c_acctbal > 2000)),
kept AS (SELECT * FROM old WHERE StartDateTime >= {LIMIT}),
j AS (SELECT k.*, s.EndDateTime AS e, s.ScheduledEndDateTime AS p, s.Comments AS c,
             s.MaintenanceModeRowId IS NOT NULL
             AND (k.EndDateTime IS DISTINCT FROM s.EndDateTime
                  OR k.ScheduledEndDateTime IS DISTINCT FROM s.ScheduledEndDateTime) AS hit
      FROM kept k LEFT JOIN src s ON s.MaintenanceModeRowId = k.MaintenanceRowId),
result AS (
SELECT ID, MaintenanceRowId, ManagedEntityRowId, DisplayName, {text("StartDateTime")} AS StartDateTime,
       {text("CASE WHEN hit THEN e ELSE EndDateTime END")} AS EndDateTime,
       {text("CASE WHEN hit THEN p ELSE ScheduledEndDateTime END")} AS ScheduledEndDateTime, UserId,
       CASE WHEN hit THEN c ELSE Comment END AS Comment,
       CASE WHEN hit THEN '2001-12-31 10:30:00' ELSE '2001-05-01 00:00:00' END AS Imported
FROM j
UNION ALL
SELECT CAST((SELECT max(ID) FROM old) + row_number() OVER (
           ORDER BY left(md5(CAST(MaintenanceModeRowId AS VARCHAR)), 4), MaintenanceModeRowId) AS BIGINT),
       MaintenanceModeRowId, ManagedEntityRowId, ManagedEntityDefaultName, {text("StartDateTime")},
       {text("EndDateTime")}, {text("ScheduledEndDateTime")}, UserId, Comments, '2001-12-31 10:30:00'
FROM src WHERE MaintenanceModeRowId NOT IN (SELECT MaintenanceRowId FROM kept))"""
MAINTENANCE_COLUMNS = [
    "MaintenanceRowId",
    "ManagedEntityRowId",
    "DisplayName",
    "StartDateTime",
    "EndDateTime",
    "ScheduledEndDateTime",
    "UserId",
    "Comment",
    "Imported",
]
SHOWN_WINDOWS = ", ".join(MAINTENANCE_COLUMNS)
WINDOW_TIMES = ["StartDateTime", "EndDateTime", "ScheduledEndDateTime", "Imported"]


def window_rows(df, *more):
    return shown(df.select(*more, *MAINTENANCE_COLUMNS), *WINDOW_TIMES)


def planned_windows(t: Tables, **options):
    source = I.maintenance_source(
        t.sql(S.WINDOWS), t.sql(S.NAMED_ENTITIES), t.sql(S.KNOWN_COMPUTERS)
    )
    return I.plan_maintenance(t.sql(S.MAINTENANCE_HISTORY), source, S.ORDERS_AS_OF, **options)


@query("maintenance_import", f"{MAINTENANCE_PLAN} SELECT ID, {SHOWN_WINDOWS} FROM result")
def maintenance_import(t: Tables):
    return window_rows(I.kept_rows(planned_windows(t)), "ID")


# The original rule: a date that was NULL, or becomes so, is no change.
LITERAL_PLAN = MAINTENANCE_PLAN.replace("IS DISTINCT FROM", "<>").replace("AS hit", "IS TRUE AS hit", 1)


@query("maintenance_import_literal", f"{LITERAL_PLAN} SELECT ID, {SHOWN_WINDOWS} FROM result")
def maintenance_import_literal(t: Tables):
    return window_rows(I.kept_rows(planned_windows(t, null_safe=False)), "ID")


#: Files of a replayed micro-batch.
BATCH_FILES = 16


def replayed(t: Tables, text: str, order: str, root: str):
    """A result as a stream of about three micro-batches, from files written in ``order``; each batch has files for many
    tasks, as no task reads less than a file's row group."""
    feed = f"{root}/feed"
    rows = t.sql(text)
    rows.repartitionByRange(3 * BATCH_FILES, order).write.parquet(feed)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", BATCH_FILES).parquet(feed)


@query("stream_alert_upsert", f"{ALERT_PLAN} SELECT {SHOWN_ALERTS} FROM result")
def stream_alert_upsert(t: Tables):
    root = shared_dir(t.spark, "alerts")
    store = Snapshots(t.spark, f"{root}/state")
    store.write({"AlertHistory": t.sql(S.ALERT_HISTORY)})
    details = replayed(t, S.ALERT_DETAILS, "RaisedDateTime", root)
    run = upserts.stream_alerts(details, store, known(t), S.EVENTS_AS_OF, f"{root}/progress", 24)
    run.awaitTermination()
    return alert_rows(store.read("AlertHistory"))


@query("stream_maintenance_upsert", f"{MAINTENANCE_PLAN} SELECT {SHOWN_WINDOWS} FROM result")
def stream_maintenance_upsert(t: Tables):
    root = shared_dir(t.spark, "windows")
    store = Snapshots(t.spark, f"{root}/state")
    store.write({"MaintenanceHistory": t.sql(S.MAINTENANCE_HISTORY)})
    windows = replayed(t, S.WINDOWS, "StartDateTime", root)
    run = upserts.stream_maintenance(
        windows,
        store,
        t.sql(S.NAMED_ENTITIES),
        t.sql(S.KNOWN_COMPUTERS),
        S.ORDERS_AS_OF,
        f"{root}/progress",
    )
    run.awaitTermination()
    return window_rows(store.read("MaintenanceHistory"))
