"""Queries for snapshot sync, updates from joins, and duplicates."""

from pyspark.sql import functions as F

from fleetmart.functions.columns import moment
from fleetmart.operators.sync import classify, keep_first, sync_snapshot
from fleetmart.plans import inventory as I
from fleetmart.registry import standins as S
from fleetmart.registry.base import Tables, query, shown

AS_OF = "TIMESTAMP_NTZ '2001-12-31 10:30:00'"
AS_OF_TEXT = "'2001-12-31 10:30:00'"


def text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def merged(target: str, source: str, columns: list[str], match: str = "ManagedEntityRowId") -> str:
    """Common table expressions of a sync: ``k`` the old rows with their state, ``f`` the new ones
    with their id. ``columns`` are the source's columns beside the key."""
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return f"""
t AS ({target}),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ManagedEntityRowId ORDER BY {order})
                     AS rn FROM ({source}) x) y WHERE rn = 1),
k AS (SELECT t.*, CASE WHEN m.seen IS NOT NULL AND t.NotFoundSince IS NULL THEN 'keep'
                       WHEN m.seen IS NOT NULL THEN 'revived'
                       WHEN t.NotFoundSince IS NULL THEN 'newly_missing'
                       ELSE 'still_missing' END AS state
      FROM t LEFT JOIN (SELECT DISTINCT {match} AS seen FROM s) m ON m.seen = t.ManagedEntityRowId),
f AS (SELECT s.*, CAST((SELECT max(ID) FROM t) + row_number() OVER (
                 ORDER BY left(md5(CAST(s.ManagedEntityRowId AS VARCHAR)), 4), s.ManagedEntityRowId)
                 AS BIGINT) AS new_id
      FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.ManagedEntityRowId = s.{match}))"""


def mark(kind: str = text("NotFoundSince"), now: str = AS_OF_TEXT) -> str:
    return f"""CASE state WHEN 'revived' THEN NULL WHEN 'newly_missing' THEN {now}
                          ELSE {kind} END AS NotFoundSince"""


TARGET = """
SELECT c_custkey + 1 AS ID, c_custkey AS ManagedEntityRowId, c_name AS DisplayName,
       CASE WHEN c_acctbal < 1000 THEN first_order END AS NotFoundSince,
       CAST(NULL AS TIMESTAMP_NTZ) AS Modified, first_order AS Inserted
FROM {customer} JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM {orders}
                      GROUP BY o_custkey) f ON o_custkey = c_custkey
WHERE first_order < DATE '1996-01-01'"""
SOURCE = """
SELECT c_custkey AS ManagedEntityRowId, concat(c_name, ' ', o_orderpriority) AS DisplayName
FROM {customer} JOIN {orders} ON o_custkey = c_custkey
WHERE o_orderstatus = 'O' AND o_orderdate >= DATE '1999-01-01'"""
MERGED = merged(TARGET, SOURCE, ["DisplayName"])
ALL_ROWS = f"""
SELECT ID, ManagedEntityRowId, DisplayName, {mark()},
       CASE WHEN state IN ('revived', 'newly_missing') THEN {AS_OF_TEXT} END AS Modified,
       {text("Inserted")} AS Inserted, state
FROM k
UNION ALL
SELECT new_id, ManagedEntityRowId, DisplayName, NULL, NULL, {AS_OF_TEXT}, 'new' FROM f"""
COLUMNS = "ID, ManagedEntityRowId, DisplayName, NotFoundSince, Modified, Inserted"


def synced(target, source):
    return sync_snapshot(
        target,
        source,
        key="ManagedEntityRowId",
        as_of=S.ORDERS_AS_OF,
        modified_col="Modified",
        defaults={"Inserted": moment(S.ORDERS_AS_OF)},
    )


def readable(df):
    return shown(df, "NotFoundSince", "Modified", "Inserted")


@query("sync_merge", f"WITH {MERGED} SELECT {COLUMNS} FROM ({ALL_ROWS}) a")
def sync_merge(t: Tables):
    return readable(synced(t.sql(TARGET), t.sql(SOURCE)))


@query("sync_insert", f"WITH {MERGED} SELECT {COLUMNS} FROM ({ALL_ROWS}) a WHERE state = 'new'")
def sync_insert(t: Tables):
    target = t.sql(TARGET)
    rows = synced(target, t.sql(SOURCE))
    return readable(rows.join(target.select("ManagedEntityRowId"), "ManagedEntityRowId", "left_anti"))


def with_state(t: Tables, state: str):
    rows = classify(t.sql(TARGET), t.sql(SOURCE), key="ManagedEntityRowId")
    return rows.where(F.col("_state") == state).select("ID", "ManagedEntityRowId", "DisplayName")


@query(
    "sync_soft_delete",
    f"WITH {MERGED} SELECT ID, ManagedEntityRowId, DisplayName FROM k WHERE state = 'newly_missing'",
)
def sync_soft_delete(t: Tables):
    return with_state(t, "newly_missing")


@query(
    "sync_revive",
    f"WITH {MERGED} SELECT ID, ManagedEntityRowId, DisplayName FROM k WHERE state = 'revived'",
)
def sync_revive(t: Tables):
    return with_state(t, "revived")


@query("sync_idempotent", f"WITH {MERGED} SELECT {COLUMNS} FROM ({ALL_ROWS}) a")
def sync_idempotent(t: Tables):
    """The result of a second run on the result of the first."""
    source = t.sql(SOURCE)
    return readable(synced(synced(t.sql(TARGET), source), source))


# Servers.
FACTS = f"""
SELECT ManagedEntityRowId, count(*) AS Changes, max(DWCreatedDateTime) FILTER (WHERE ToDateTime IS NULL)
       AS created FROM ({S.SERVER_HISTORY}) h GROUP BY ManagedEntityRowId
HAVING count(*) FILTER (WHERE ToDateTime IS NULL) > 0"""
SERVER_SOURCE = f"""
SELECT e.ManagedEntityRowId, e.TopLevelHostManagedEntityRowId, e.ManagedEntityDefaultName, e.FullName,
       replace(substr(e.FullName, strpos(e.FullName, ':') + 1), ';', '.') AS Path,
       regexp_replace(replace(e.Name, ';', '.'), '\\.[^.]*$', '') AS Maschine,
       regexp_extract(replace(e.FullName, ';', '.'), ':[^.]*\\.(.*)\\.[^.]*$', 1) AS Domain,
       strftime(f.created, '%Y-%m-%d %H:%M:00') AS DWCreatedDateTime, f.Changes
FROM ({S.SERVER_ENTITIES}) e
JOIN ({S.SERVER_TYPES}) y ON y.ManagedEntityTypeRowId = e.ManagedEntityTypeRowId AND y.Aktiv
JOIN ({FACTS}) f ON f.ManagedEntityRowId = e.ManagedEntityRowId"""
SERVER_COLUMNS = [
    "TopLevelHostManagedEntityRowId",
    "ManagedEntityDefaultName",
    "FullName",
    "Path",
    "Maschine",
    "Domain",
    "DWCreatedDateTime",
    "Changes",
]


def server_rows(match: str) -> str:
    return f"""WITH {merged(S.SERVER_TARGET, SERVER_SOURCE, SERVER_COLUMNS, match)}
SELECT ID, ManagedEntityRowId, TopLevelHostManagedEntityRowId, ManagedEntityDefaultName,
       {text("DWCreatedDateTime")} AS DWCreatedDateTime, CAST(Changes AS INTEGER) AS Changes,
       Maschine, Path, Domain, FullName, {text("Inserted")} AS Inserted, IsSCOM, {mark()}
FROM k
UNION ALL
SELECT new_id, ManagedEntityRowId, TopLevelHostManagedEntityRowId, ManagedEntityDefaultName,
       DWCreatedDateTime, CAST(Changes AS INTEGER), Maschine, Path, Domain, FullName, {AS_OF_TEXT},
       TRUE, NULL
FROM f"""


def server_frames(t: Tables):
    source = I.server_source(
        t.sql(S.SERVER_ENTITIES), t.sql(S.SERVER_HISTORY), t.sql(S.SERVER_TYPES)
    )
    return t.sql(S.SERVER_TARGET), source


def listed_servers(df):
    dropped = df.drop("Account", "Edition", "InstanceName", "Version", "Modified")
    return shown(dropped, "DWCreatedDateTime", "Inserted", "NotFoundSince")


@query("sync_servers", server_rows("ManagedEntityRowId"))
def sync_servers(t: Tables):
    return listed_servers(I.sync_servers(*server_frames(t), S.ORDERS_AS_OF))


@query("sync_servers_by_host", server_rows("TopLevelHostManagedEntityRowId"))
def sync_servers_by_host(t: Tables):
    return listed_servers(I.sync_servers(*server_frames(t), S.ORDERS_AS_OF, match_host=True))


# Computers.
COMPUTER_SOURCE = f"""
SELECT c.ManagedEntityRowId, c.TopLevelHostManagedEntityRowId, c.Path, c.FullName, c.DisplayName,
       c.Name AS Maschine, c.ManagedEntityTypeRowId, c.ManagedEntityDefaultName, c.DWCreatedDateTime
FROM ({S.COMPUTER_ENTITIES}) c
JOIN ({S.COMPUTER_TYPES}) y ON y.ManagedEntityTypeRowId = c.ManagedEntityTypeRowId
WHERE c.Name IN (SELECT lower(Maschine) FROM ({S.SERVER_TARGET}) x)"""
COMPUTER_COLUMNS = [
    "TopLevelHostManagedEntityRowId",
    "Path",
    "FullName",
    "DisplayName",
    "Maschine",
    "ManagedEntityTypeRowId",
    "ManagedEntityDefaultName",
    "DWCreatedDateTime",
]
# The old inventory lists some computers twice; the merge leaves that to the clean-up after it.
TWICE = f"""
SELECT * FROM ({S.COMPUTER_TARGET}) a
UNION ALL
SELECT ID + 10000000 AS ID, ManagedEntityRowId, TopLevelHostManagedEntityRowId,
       ManagedEntityTypeRowId, ManagedEntityDefaultName, Path, FullName, DisplayName, Maschine,
       DNSName, DomainDnsName, IPAddress, LogicalProcessors, OrganizationalUnit, Modified, Inserted,
       IsSCOM, DWCreatedDateTime, NotFoundSince, 'copy' AS WindowsOS
FROM ({S.COMPUTER_TARGET}) b WHERE NotFoundSince IS NULL"""


@query(
    "sync_computers",
    f"""WITH {merged(TWICE, COMPUTER_SOURCE, COMPUTER_COLUMNS)},
a AS (SELECT ID, ManagedEntityRowId, TopLevelHostManagedEntityRowId, Path, FullName, DisplayName,
             Maschine, ManagedEntityTypeRowId, CAST(Inserted AS VARCHAR) AS Inserted, IsSCOM,
             {mark("CAST(NotFoundSince AS VARCHAR)", "'2001-12-31'")}
      FROM k
      UNION ALL
      SELECT new_id, ManagedEntityRowId, TopLevelHostManagedEntityRowId, Path, FullName, DisplayName,
             Maschine, ManagedEntityTypeRowId, '2001-12-31', FALSE, NULL FROM f)
SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY ManagedEntityRowId ORDER BY ID)
                          AS rn FROM a) b WHERE rn = 1""",
)
def sync_computers(t: Tables):
    source = I.computer_source(
        t.sql(S.COMPUTER_ENTITIES), t.sql(S.COMPUTER_TYPES), t.sql(S.SERVER_TARGET)
    )
    rows = I.sync_computers(t.sql(TWICE), source, S.ORDERS_AS_OF).select(
        "ID",
        "ManagedEntityRowId",
        "TopLevelHostManagedEntityRowId",
        "Path",
        "FullName",
        "DisplayName",
        "Maschine",
        "ManagedEntityTypeRowId",
        "Inserted",
        "IsSCOM",
        "NotFoundSince",
    )
    return shown(rows, "Inserted", "NotFoundSince")


# Databases.
DATABASE_SOURCE = f"""
SELECT e.ManagedEntityRowId, e.TopLevelHostManagedEntityRowId, replace(e.Path, ';', ':') AS Path,
       e.ManagedEntityTypeRowId, e.DisplayName
FROM ({S.DATABASE_ENTITIES}) e
JOIN ({S.DATABASE_TYPES}) y ON y.ManagedEntityTypeRowId = e.ManagedEntityTypeRowId AND y.Aktive
WHERE lower(e.DisplayName) NOT IN (SELECT Name FROM ({S.EXCLUDED}) x)
  AND e.ManagedEntityRowId IN (SELECT ManagedEntityRowId FROM ({S.DATABASE_HISTORY}) h
                               WHERE ToDateTime IS NULL)"""
DATABASE_COLUMNS = ["TopLevelHostManagedEntityRowId", "Path", "ManagedEntityTypeRowId", "DisplayName"]


@query(
    "sync_databases",
    f"""WITH {merged(S.DATABASE_TARGET, DATABASE_SOURCE, DATABASE_COLUMNS)}
SELECT ID, ManagedEntityRowId, TopLevelHostManagedEntityRowId, Path, DisplayName,
       CAST(ManagedEntityTypeRowId AS BIGINT) AS ManagedEntityTypeRowId, {mark()},
       CASE WHEN state IN ('revived', 'newly_missing') THEN {AS_OF_TEXT} END AS Modified,
       {text("Inserted")} AS Inserted
FROM k
UNION ALL
SELECT new_id, ManagedEntityRowId, TopLevelHostManagedEntityRowId, Path, DisplayName,
       CAST(ManagedEntityTypeRowId AS BIGINT), NULL, NULL, {AS_OF_TEXT} FROM f""",
)
def sync_databases(t: Tables):
    source = I.database_source(
        t.sql(S.DATABASE_ENTITIES),
        t.sql(S.DATABASE_HISTORY),
        t.sql(S.DATABASE_TYPES),
        t.sql(S.EXCLUDED),
    )
    rows = I.sync_databases(t.sql(S.DATABASE_TARGET), source, S.ORDERS_AS_OF)
    return readable(rows.drop("Collation", "Owner", "RecoveryModel"))


# Updates from joins.
SYSTEMS = """
SELECT s_suppkey AS ManagedEntityRowId, CAST(s_nationkey AS BIGINT) AS TopLevelHostManagedEntityRowId,
       CASE WHEN s_acctbal > 0 THEN 62 ELSE 61 END AS ManagedEntityTypeRowId,
       CASE WHEN s_acctbal < 9000 THEN s_name END AS ManagedEntityDefaultName
FROM {supplier}"""
HOSTED = """
SELECT c_custkey AS ID, c_custkey AS ManagedEntityRowId,
       CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS BIGINT) END
           AS TopLevelHostManagedEntityRowId, c_mktsegment AS WindowsOS
FROM {customer}"""


@query(
    "os_update",
    f"""SELECT ID, h.ManagedEntityRowId, h.TopLevelHostManagedEntityRowId,
               CASE WHEN n.host IS NOT NULL THEN n.os ELSE WindowsOS END AS WindowsOS
        FROM ({HOSTED}) h LEFT JOIN (
            SELECT TopLevelHostManagedEntityRowId AS host, ManagedEntityDefaultName AS os,
                   row_number() OVER (PARTITION BY TopLevelHostManagedEntityRowId
                                      ORDER BY ManagedEntityRowId DESC) AS rn
            FROM ({SYSTEMS}) s WHERE ManagedEntityTypeRowId = 62) n
          ON n.host = h.TopLevelHostManagedEntityRowId AND n.rn = 1""",
)
def os_update(t: Tables):
    return I.update_os(t.sql(HOSTED), t.sql(SYSTEMS))


SERVER_PATHS = """
SELECT s_suppkey + 1 AS ID, s_suppkey AS ManagedEntityRowId,
       CASE WHEN s_acctbal < 5000 THEN s_name END AS Path
FROM {supplier} WHERE s_acctbal > 0"""


@query(
    "path_repair",
    f"""SELECT d.ManagedEntityRowId, d.TopLevelHostManagedEntityRowId,
               CASE WHEN s.ID IS NOT NULL THEN s.Path ELSE d.Path END AS Path
        FROM ({S.DATABASE_ENTITIES}) d LEFT JOIN ({SERVER_PATHS}) s
          ON s.ManagedEntityRowId = d.TopLevelHostManagedEntityRowId""",
)
def path_repair(t: Tables):
    databases = t.sql(S.DATABASE_ENTITIES).select(
        "ManagedEntityRowId", "TopLevelHostManagedEntityRowId", "Path"
    )
    return I.repair_paths(databases, t.sql(SERVER_PATHS))


LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


@query(
    "dedup_keep_first",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {text("l_shipdate")} AS l_shipdate
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                           ORDER BY {", ".join(LINE_ORDER)}) AS rn
              FROM {{lineitem}}) x WHERE rn = 1""",
)
def dedup_keep_first(t: Tables):
    first = keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    wanted = first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return shown(wanted, "l_shipdate")
