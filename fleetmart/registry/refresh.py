"""The whole refresh on the given tables."""

from functools import reduce

from pyspark.sql import functions as F

from fleetmart.plans.refresh import TypeTables, refresh
from fleetmart.registry import standins as S
from fleetmart.registry.base import Tables, query, second
from fleetmart.registry.events import ALERT_PLAN
from fleetmart.registry.properties import (
    COMPUTER_CELLS,
    COMPUTER_NAMED,
    DATABASE_CELLS,
    DATABASE_NAMED,
    SERVER_CELLS,
    SERVER_NAMED,
)
from fleetmart.registry.schema import ADDED
from fleetmart.registry.sync import (
    COMPUTER_COLUMNS,
    DATABASE_COLUMNS,
    DATABASE_SOURCE,
    SERVER_COLUMNS,
    SERVER_SOURCE,
    merged,
)
from fleetmart.schemas import conform
from fleetmart.session import shared_dir
from fleetmart.sources.readers import Warehouse
from fleetmart.sources.snapshots import Snapshots

# One id space for all entities: computers and databases are moved behind the servers.
COMPUTER, DATABASE, SYSTEM = 10**12, 2 * 10**12, 3 * 10**12
SEGMENTS = [c for c in ADDED if c.startswith("Segment")]

SYSTEMS = f"""
SELECT {SYSTEM} + s_suppkey AS ManagedEntityRowId,
       {COMPUTER} + s_suppkey AS TopLevelHostManagedEntityRowId, 62 AS ManagedEntityTypeRowId,
       concat('System ', s_name) AS ManagedEntityDefaultName
FROM {{supplier}}"""
DETAILS = f"""
SELECT AlertGuid, {COMPUTER} + ManagedEntityRowId AS ManagedEntityRowId, Category,
       MonitoringObjectDisplayName, AlertName, AlertDescription, RaisedDateTime, Severity, Priority,
       RepeatCount
FROM ({S.ALERT_DETAILS}) d"""


def moved(df, offset: int, *columns: str):
    for c in columns or ("ManagedEntityRowId",):
        df = df.withColumn(c, F.col(c) + offset)
    return df


def together(frames, source: str):
    return reduce(lambda a, b: a.unionByName(b), [conform(df, source) for df in frames])


def warehouse(t: Tables) -> Warehouse:
    host = "TopLevelHostManagedEntityRowId"
    entities = [
        t.sql(S.SERVER_ENTITIES),
        moved(t.sql(S.COMPUTER_ENTITIES), COMPUTER, "ManagedEntityRowId", host),
        moved(t.sql(S.DATABASE_ENTITIES), DATABASE),
        t.sql(SYSTEMS),
    ]
    properties = [
        t.sql(S.SERVER_HISTORY),
        moved(t.sql(S.COMPUTER_HISTORY), COMPUTER),
        moved(t.sql(S.DATABASE_HISTORY), DATABASE),
    ]
    names = [t.sql(d) for d in (S.SERVER_DICTIONARY, S.COMPUTER_DICTIONARY, S.DATABASE_DICTIONARY)]
    return Warehouse(
        entities=together(entities, "ManagedEntity"),
        properties=together(properties, "ManagedEntityProperty"),
        dictionary=together(names, "ManagedEntityTypeProperty"),
        alerts=t.sql(DETAILS),
        windows=moved(t.sql(S.WINDOWS), COMPUTER),
    )


def old_state(t: Tables) -> dict:
    host = "TopLevelHostManagedEntityRowId"
    return {
        "SQLServer": conform(t.sql(S.SERVER_TARGET), "SQLServer"),
        "Computer": conform(
            moved(t.sql(S.COMPUTER_TARGET), COMPUTER, "ManagedEntityRowId", host), "Computer"
        ),
        "SQLDatabase": conform(moved(t.sql(S.DATABASE_TARGET), DATABASE), "SQLDatabase"),
        "AlertHistory": moved(t.sql(S.ALERT_HISTORY), COMPUTER),
        "MaintenanceHistory": moved(t.sql(S.MAINTENANCE_HISTORY), COMPUTER),
    }


def refreshed(t: Tables) -> Snapshots:
    store = Snapshots(t.spark, shared_dir(t.spark, "refresh"))
    store.write(old_state(t))
    types = TypeTables(
        servers=t.sql(S.SERVER_TYPES),
        computers=t.sql(S.COMPUTER_TYPES),
        databases=t.sql(S.DATABASE_TYPES),
        excluded=t.sql(S.EXCLUDED),
    )
    # The events lie years behind the orders, so the alert window is chosen to cut among them.
    refresh(store, warehouse(t), types, S.EVENTS_AS_OF, alert_days=24, maintenance_days=8431)
    return store


INVENTORY_CELLS = {
    "SQLServer": SERVER_CELLS,
    "Computer": [*COMPUTER_CELLS, *SEGMENTS, "WindowsOS"],
    "SQLDatabase": DATABASE_CELLS,
}


def summary(store: Snapshots):
    """Per table: rows, rows marked missing, filled property cells, rows touched by the run."""
    rows = []
    for table, cells in INVENTORY_CELLS.items():
        filled = reduce(lambda a, b: a + b, [F.count(c) for c in cells])
        missing = F.count("NotFoundSince")
        touched = F.count("Modified")
        rows.append((table, [F.count("*"), missing, filled, touched]))
    for table in ("AlertHistory", "MaintenanceHistory"):
        fresh = F.count_if(F.col("Imported") == F.lit("2024-02-01").cast("timestamp_ntz"))
        rows.append((table, [F.count("*"), F.lit(0), F.count("*"), fresh]))
    names = ["n_rows", "n_missing", "n_filled", "n_touched"]
    frames = [
        store.read(table)
        .agg(*[c.cast("long").alias(n) for n, c in zip(names, counts)])
        .withColumn("Tabelle", F.lit(table))
        for table, counts in rows
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


def inventory_sql(table, target, source, columns, named, cells, extra="", touched="") -> str:
    """Counts of one inventory after its sync and property refresh."""
    picks = ", ".join(
        f"max(CASE WHEN lower(name) = '{c.lower()}' THEN 1 ELSE 0 END) = 1 AS v_{c}" for c in cells
    )
    news = ", ".join(
        f"arg_max(value, created || guid || value) FILTER (WHERE lower(name) = '{c.lower()}') AS w_{c}"
        for c in cells
    )
    old = ", ".join(f'"{c}"' if c not in SEGMENTS else f"NULL AS {c}" for c in cells)
    none = ", ".join(f'NULL AS "{c}"' for c in cells)
    filled = " + ".join(
        f"""count(*) FILTER (WHERE a."{c}" IS NOT NULL OR coalesce(v_{c}, FALSE))""" for c in cells
    )
    changed = " OR ".join(
        f"""(v_{c} AND (a."{c}" IS NULL OR lower(a."{c}") <> lower(w_{c})))""" for c in cells
    )
    return f"""
SELECT '{table}' AS Tabelle, count(*) AS n_rows,
       count(*) FILTER (WHERE state IN ('newly_missing', 'still_missing')) AS n_missing,
       {filled}{extra} AS n_filled,
       count(*) FILTER (WHERE {touched}{changed}) AS n_touched
FROM (WITH {merged(target, source, columns)}
      SELECT ManagedEntityRowId, state, {old} FROM k
      UNION ALL SELECT ManagedEntityRowId, 'new', {none} FROM f) a
LEFT JOIN (SELECT ManagedEntityRowId AS entity, {picks}, {news} FROM ({named}) n
           GROUP BY ManagedEntityRowId) p ON entity = a.ManagedEntityRowId"""


HOSTING = f"""
SELECT c.ManagedEntityRowId, c.TopLevelHostManagedEntityRowId, c.Path, c.FullName, c.DisplayName,
       c.Name AS Maschine, c.ManagedEntityTypeRowId, c.ManagedEntityDefaultName, c.DWCreatedDateTime
FROM ({S.COMPUTER_ENTITIES}) c
JOIN ({S.COMPUTER_TYPES}) y ON y.ManagedEntityTypeRowId = c.ManagedEntityTypeRowId
WHERE c.Name IN (SELECT lower(Maschine) FROM ({S.SERVER_TARGET}) x
                 UNION SELECT lower(Maschine) FROM ({SERVER_SOURCE}) z)"""
LISTED_COMPUTERS = f"""
SELECT ManagedEntityRowId FROM ({S.COMPUTER_TARGET}) a UNION SELECT ManagedEntityRowId FROM ({HOSTING}) b"""
# An operating system exists where a supplier has the computer's number.
SYSTEM_CELLS = f""" + (SELECT count(*) FROM ({LISTED_COMPUTERS}) l LEFT JOIN {{customer}} ON c_custkey = l.ManagedEntityRowId
          WHERE l.ManagedEntityRowId IN (SELECT s_suppkey FROM {{supplier}})
             OR (c_acctbal > 5000 AND l.ManagedEntityRowId IN (SELECT ManagedEntityRowId FROM ({S.COMPUTER_TARGET}) c)))"""

KNOWN = f"({S.KNOWN_SERVERS} UNION {S.KNOWN_COMPUTERS})"
assert KNOWN in ALERT_PLAN
ALERTS = ALERT_PLAN.replace(KNOWN, f"({LISTED_COMPUTERS})")

WINDOW_LIMIT = "DATE '2001-01-01'"
MAINTENANCE = f"""
SELECT 'MaintenanceHistory' AS Tabelle, count(*) AS n_rows, 0 AS n_missing, count(*) AS n_filled,
       count(*) FILTER (WHERE touched) AS n_touched
FROM (SELECT h.MaintenanceRowId, l.ManagedEntityRowId IS NOT NULL
             AND h.EndDateTime IS DISTINCT FROM w.EndDateTime AS touched
      FROM ({S.MAINTENANCE_HISTORY}) h JOIN ({S.WINDOWS}) w ON w.MaintenanceModeRowId = h.MaintenanceRowId
      LEFT JOIN ({LISTED_COMPUTERS}) l ON l.ManagedEntityRowId = w.ManagedEntityRowId
      WHERE h.StartDateTime >= {WINDOW_LIMIT}
      UNION ALL
      SELECT MaintenanceModeRowId, TRUE FROM ({S.WINDOWS}) w
      JOIN ({LISTED_COMPUTERS}) l ON l.ManagedEntityRowId = w.ManagedEntityRowId
      WHERE StartDateTime >= {WINDOW_LIMIT}
        AND MaintenanceModeRowId NOT IN (SELECT MaintenanceRowId FROM ({S.MAINTENANCE_HISTORY}) o)) x"""

SERVERS = inventory_sql(
    "SQLServer", S.SERVER_TARGET, SERVER_SOURCE, SERVER_COLUMNS, SERVER_NAMED, SERVER_CELLS
)
COMPUTERS = inventory_sql(
    "Computer",
    S.COMPUTER_TARGET,
    HOSTING,
    COMPUTER_COLUMNS,
    COMPUTER_NAMED,
    [*COMPUTER_CELLS, *SEGMENTS],
    SYSTEM_CELLS,
)
DATABASES = inventory_sql(
    "SQLDatabase",
    S.DATABASE_TARGET,
    DATABASE_SOURCE,
    DATABASE_COLUMNS,
    DATABASE_NAMED,
    DATABASE_CELLS,
    touched="state IN ('revived', 'newly_missing') OR ",
)
SUMMARY = f"""
SELECT * FROM ({SERVERS}) a UNION ALL SELECT * FROM ({COMPUTERS}) b
UNION ALL SELECT * FROM ({DATABASES}) c
UNION ALL SELECT * FROM ({ALERTS}
    SELECT 'AlertHistory' AS Tabelle, count(*) AS n_rows, 0 AS n_missing, count(*) AS n_filled,
           count(*) FILTER (WHERE Imported = '2024-02-01 00:00:00') AS n_touched FROM result) d
UNION ALL SELECT * FROM ({MAINTENANCE}) e"""


@query("refresh_all", SUMMARY)
def refresh_all(t: Tables):
    return summary(refreshed(t))


# The same run, row by row: what each inventory and history holds afterwards.
OFFSETS = {"SQLServer": 0, "Computer": COMPUTER, "SQLDatabase": DATABASE}


def told(cells) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cells) + ")"


def inventory_rows(table, target, source, columns, named, cells, more=(), touched="") -> str:
    """Every row of one inventory after its sync and property refresh, its cells as one text."""
    picks = ", ".join(
        f"arg_max(value, created || guid || value) FILTER (WHERE lower(name) = '{c.lower()}') AS w_{c}" for c in cells
    )
    old = ", ".join(f'"{c}"' if c not in SEGMENTS else f'NULL AS "{c}"' for c in cells)
    none = ", ".join(f'NULL AS "{c}"' for c in cells)
    change = {c: f"""(w_{c} IS NOT NULL AND (a."{c}" IS NULL OR rtrim(lower(a."{c}")) <> rtrim(lower(w_{c}))))""" for c in cells}
    values = [f"""CASE WHEN {change[c]} THEN lower(w_{c}) ELSE a."{c}" END""" for c in cells]
    state = "CASE WHEN state IN ('newly_missing', 'still_missing') THEN 'missing' ELSE 'live' END"
    stamped = f"CASE WHEN {touched}{' OR '.join(change.values())} THEN 'touched' ELSE 'as it was' END"
    return f"""
SELECT '{table}' AS Tabelle, CAST(a.ManagedEntityRowId + {OFFSETS[table]} AS VARCHAR) AS Schluessel,
       {told([*values, *more, state, stamped])} AS Inhalt
FROM (WITH {merged(target, source, columns)}
      SELECT ManagedEntityRowId, state, {old} FROM k
      UNION ALL SELECT ManagedEntityRowId, 'new', {none} FROM f) a
LEFT JOIN (SELECT ManagedEntityRowId AS entity, {picks} FROM ({named}) n GROUP BY ManagedEntityRowId) p
  ON entity = a.ManagedEntityRowId"""


SYSTEM_NAME = f"""coalesce((SELECT max('System ' || s_name) FROM {{supplier}} WHERE s_suppkey = a.ManagedEntityRowId),
              (SELECT max(WindowsOS) FROM ({S.COMPUTER_TARGET}) o WHERE o.ManagedEntityRowId = a.ManagedEntityRowId))"""
ALERT_CELLS = ["ManagedEntityRowId", "Category", "RaisedDateTime", "Severity", "Priority", "RepeatCount", "Imported"]
WINDOW_CELLS = ["StartDateTime", "EndDateTime", "ScheduledEndDateTime", "UserId", "Comment", "Imported"]


def time_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


WINDOW_ROWS = f"""
SELECT 'MaintenanceHistory' AS Tabelle, CAST(id AS VARCHAR) AS Schluessel, {told(WINDOW_CELLS)} AS Inhalt
FROM (SELECT id, {time_text("started")} AS StartDateTime,
             {time_text("CASE WHEN touched THEN new_end ELSE old_end END")} AS EndDateTime,
             {time_text("scheduled")} AS ScheduledEndDateTime, UserId,
             CASE WHEN touched THEN comments END AS Comment,
             CASE WHEN touched THEN '2024-02-01 00:00:00' ELSE '2001-05-01 00:00:00' END AS Imported
      FROM (SELECT h.MaintenanceRowId AS id, h.StartDateTime AS started, w.EndDateTime AS new_end, h.EndDateTime AS old_end,
                   h.ScheduledEndDateTime AS scheduled, h.UserId, w.Comments AS comments,
                   l.ManagedEntityRowId IS NOT NULL AND h.EndDateTime IS DISTINCT FROM w.EndDateTime AS touched
            FROM ({S.MAINTENANCE_HISTORY}) h JOIN ({S.WINDOWS}) w ON w.MaintenanceModeRowId = h.MaintenanceRowId
            LEFT JOIN ({LISTED_COMPUTERS}) l ON l.ManagedEntityRowId = w.ManagedEntityRowId
            WHERE h.StartDateTime >= {WINDOW_LIMIT}
            UNION ALL
            SELECT MaintenanceModeRowId, StartDateTime, EndDateTime, NULL, ScheduledEndDateTime, UserId, Comments, TRUE
            FROM ({S.WINDOWS}) w JOIN ({LISTED_COMPUTERS}) l ON l.ManagedEntityRowId = w.ManagedEntityRowId
            WHERE StartDateTime >= {WINDOW_LIMIT}
              AND MaintenanceModeRowId NOT IN (SELECT MaintenanceRowId FROM ({S.MAINTENANCE_HISTORY}) o)) x) y"""
ALERT_ROWS = f"""
{ALERTS} SELECT 'AlertHistory' AS Tabelle, AlertGuid AS Schluessel, {told(ALERT_CELLS)} AS Inhalt FROM result"""
ALL_ROWS = " UNION ALL ".join(
    f"SELECT * FROM ({rows}) t{i}"
    for i, rows in enumerate([
        inventory_rows("SQLServer", S.SERVER_TARGET, SERVER_SOURCE, SERVER_COLUMNS, SERVER_NAMED, SERVER_CELLS),
        inventory_rows("Computer", S.COMPUTER_TARGET, HOSTING, COMPUTER_COLUMNS, COMPUTER_NAMED, [*COMPUTER_CELLS, *SEGMENTS], [SYSTEM_NAME]),
        inventory_rows("SQLDatabase", S.DATABASE_TARGET, DATABASE_SOURCE, DATABASE_COLUMNS, DATABASE_NAMED, DATABASE_CELLS,
                       touched="state IN ('revived', 'newly_missing') OR "),
        ALERT_ROWS,
        WINDOW_ROWS,
    ])
)


@query("refresh_pipeline", ALL_ROWS)
def refresh_pipeline(t: Tables):
    """Every row of the five tables that a refresh leaves behind."""
    store = refreshed(t)
    text = lambda cells: F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in cells])
    frames = []
    for table, cells in INVENTORY_CELLS.items():
        state = F.when(F.col("NotFoundSince").isNotNull(), "missing").otherwise("live")
        stamped = F.when(F.col("Modified").isNotNull(), "touched").otherwise("as it was")
        frames.append((table, F.col("ManagedEntityRowId"), [*map(F.col, cells), state, stamped]))
    entity = F.col("ManagedEntityRowId") - F.lit(COMPUTER)
    times = ("RaisedDateTime", "StartDateTime", "EndDateTime", "ScheduledEndDateTime", "Imported")
    cell = lambda c: second(c) if c in times else entity if c == "ManagedEntityRowId" else F.col(c)
    frames.append(("AlertHistory", F.col("AlertGuid"), [cell(c) for c in ALERT_CELLS]))
    frames.append(("MaintenanceHistory", F.col("MaintenanceRowId"), [cell(c) for c in WINDOW_CELLS]))
    shown = [
        store.read(table).select(F.lit(table).alias("Tabelle"), key.cast("string").alias("Schluessel"), text(cells).alias("Inhalt"))
        for table, key, cells in frames
    ]
    return reduce(lambda a, b: a.unionByName(b), shown)
