"""Queries for seeds, reloads, schema extension and audits."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart import schemas
from fleetmart.operators import evolve, quality
from fleetmart.operators.joins import active_types
from fleetmart.registry import standins as S
from fleetmart.registry.base import TABLES, Tables, query, shown
from fleetmart.session import shared_dir
from fleetmart.sources import files, seeds
from fleetmart.sources.snapshots import Snapshots

# Seeds: the given rows written out as text in both dialects.
SEED_VALUES = f"""
SELECT CAST(ManagedEntityTypeRowId AS STRING) AS ManagedEntityTypeRowId, '1' AS ManagementPackRowId,
       ManagedEntityTypeSystemName,
       CASE WHEN Aktive THEN '1' ELSE 'false' END AS Aktive
FROM ({S.DATABASE_TYPES}) x"""


@query(
    "seed_values",
    f"""SELECT CAST(ManagedEntityTypeRowId AS INTEGER) AS ManagedEntityTypeRowId,
               36 AS guid_length, 1 AS ManagementPackRowId, ManagedEntityTypeSystemName,
               CAST(NULL AS VARCHAR) AS ManagedEntityTypeDefaultName, Aktive
        FROM ({S.DATABASE_TYPES}) x""",
)
def seed_values(t: Tables):
    table = seeds.struct_of("ManagedEntityDatabaseType")
    rows = seeds.with_random_guid(t.sql(SEED_VALUES), "ManagedEntityTypeGuid")
    return seeds.normalise_seed(rows, table).select(
        "ManagedEntityTypeRowId",
        F.length("ManagedEntityTypeGuid").alias("guid_length"),
        "ManagementPackRowId",
        "ManagedEntityTypeSystemName",
        "ManagedEntityTypeDefaultName",
        "Aktive",
    )


COMPACT = """
SELECT CAST(o_orderkey AS STRING) AS ManagedEntityRowId,
       replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '') AS Inserted,
       CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS DatabaseAutogrow,
       CAST(o_custkey AS STRING) AS Id
FROM {orders}"""
ISO = """
SELECT o_orderkey AS ManagedEntityRowId, CAST(CAST(o_orderdate AS DATE) AS STRING) AS Inserted,
       CASE WHEN o_orderstatus = 'O' THEN '1' ELSE '0' END AS DatabaseAutogrow,
       o_custkey AS TopLevelHostManagedEntityRowId
FROM {orders}"""


@query(
    "seed_dialects",
    """SELECT o_orderkey AS ManagedEntityRowId, o_custkey AS TopLevelHostManagedEntityRowId,
              CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS DatabaseAutogrow,
              strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS Inserted, 2 AS dialects
       FROM {orders}""",
)
def seed_dialects(t: Tables):
    """Each row once, with the number of dialects that gave exactly it."""
    table = T.StructType.fromDDL(
        """ManagedEntityRowId long, TopLevelHostManagedEntityRowId long, DatabaseAutogrow string,
           Inserted timestamp_ntz"""
    )
    renamed, flags = {"Id": "TopLevelHostManagedEntityRowId"}, ["DatabaseAutogrow"]
    compact = seeds.normalise_seed(t.sql(COMPACT), table, renamed, flags)
    iso = seeds.normalise_seed(t.sql(ISO), table, flag_texts=flags)
    both = compact.unionByName(iso).groupBy(*table.names).agg(F.count("*").alias("dialects"))
    return shown(both, "Inserted")


@query(
    "reload_rowcounts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS Tabelle, count(*) AS Zeilen FROM {{{name}}}" for name in sorted(TABLES)
    )
    + " ORDER BY Tabelle",
)
def reload_rowcounts(t: Tables):
    """Row counts after two full reloads."""
    store = Snapshots(t.spark, shared_dir(t.spark, "reload"))
    tables = {name: getattr(t, name) for name in TABLES}
    for _ in range(2):
        seeds.reload(store, tables)
    return seeds.row_counts({name: store.read(name) for name in TABLES})


# Schema extension: what the three dictionaries name and the inventories lack.
DICTIONARIES = {
    "SQLServer": (S.SERVER_DICTIONARY, S.SERVER_TYPES, "Aktiv", ["ID", "Version", "EDITION"]),
    "Computer": (S.COMPUTER_DICTIONARY, S.COMPUTER_TYPES, None, ["ID", "DNSName", "IPAddress"]),
    "SQLDatabase": (S.DATABASE_DICTIONARY, S.DATABASE_TYPES, "Aktive", ["ID", "Owner"]),
}


def missing_sql() -> str:
    parts = []
    for table, (dictionary, types, flag, columns) in DICTIONARIES.items():
        have = ", ".join(f"'{c.lower()}'" for c in columns)
        on = f" WHERE {flag}" if flag else ""
        parts.append(
            f"""SELECT DISTINCT '{table}' AS "Tabelle", PropertySystemName AS "Neue Spalte"
                FROM ({dictionary}) d
                WHERE lower(PropertySystemName) NOT IN ({have}) AND ManagedEntityTypeRowId IN (
                    SELECT ManagedEntityTypeRowId FROM ({types}) y{on})"""
        )
    return " UNION ALL ".join(parts)


def missing(t: Tables):
    return [
        evolve.missing_columns(
            t.sql(dictionary), active_types(t.sql(types), flag), table, columns
        )
        for table, (dictionary, types, flag, columns) in DICTIONARIES.items()
    ]


@query("missing_columns", missing_sql())
def missing_columns(t: Tables):
    servers, computers, databases = missing(t)
    return servers.unionByName(computers).unionByName(databases)


@query(
    "whatif_preview",
    f"""SELECT *, 'NVARCHAR(256) NULL' AS "Datentyp", '(WhatIf – keine Aenderung)' AS "Aktion"
        FROM ({missing_sql()}) m ORDER BY "Tabelle", "Neue Spalte" """,
)
def whatif_preview(t: Tables):
    return evolve.extension_plan(missing(t))


ADDED = [
    "LogicalProcessors",
    "NotFoundSince",
    "OrganizationalUnit",
    "SegmentAUTOMOBILE",
    "SegmentBUILDING",
    "SegmentFURNITURE",
    "SegmentHOUSEHOLD",
    "SegmentMACHINERY",
]


@query(
    "extend_schema",
    f"""SELECT c_custkey, {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ADDED)},
               {len(ADDED)} AS added, 1 AS failed FROM {{customer}}""",
)
def extend_schema(t: Tables):
    """Customers with the columns computers lack; a name offered twice fails and the rest go on."""
    names = evolve.column_names(missing(t))["Computer"]
    outcome = evolve.extend_schema(t.customer.select("c_custkey"), [*names, names[0].upper()])
    return outcome.df.select(
        "*",
        F.lit(len(outcome.added)).alias("added"),
        F.lit(len(outcome.failed)).alias("failed"),
    )


@query(
    "rename_column",
    """SELECT c_custkey AS CustomerId, c_name AS Name,
              TRY_CAST(c_mktsegment AS INTEGER) AS c_mktsegment FROM {customer}""",
)
def rename_column(t: Tables):
    """Renamed twice, the second time without effect; a text column becomes a number."""
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    for _ in range(2):
        rows = evolve.rename_column(rows, "c_custkey", "CustomerId")
        rows = evolve.rename_column(rows, "c_name", "Name")
    return evolve.recast_column(rows, "c_mktsegment", "int")


# A stored table that gets the columns its dictionary names, and some that it cannot get.
STORED = ["ManagedEntityRowId", "DisplayName", "IPAddress"]
OWN = "SELECT ManagedEntityRowId, DisplayName, IPAddress FROM ({}) c".format(S.COMPUTER_TARGET)
LATER = "SELECT c_custkey AS ManagedEntityRowId, c_name AS DisplayName, c_mktsegment AS SegmentFURNITURE FROM {customer} WHERE c_mktsegment = 'FURNITURE'"
BARRED = ["ipaddress", "", "Two Words", "SegmentFURNITURE"]


def added_columns() -> str:
    dictionary = f"SELECT DISTINCT PropertySystemName AS p FROM ({S.COMPUTER_DICTIONARY}) d"
    typed = f"ManagedEntityTypeRowId IN (SELECT ManagedEntityTypeRowId FROM ({S.COMPUTER_TYPES}) y)"
    return f"(SELECT count(*) FROM ({dictionary} WHERE {typed}) n WHERE lower(p) NOT IN ('managedentityrowid', 'displayname', 'ipaddress'))"


@query(
    "extend_table",
    f"""SELECT ManagedEntityRowId, DisplayName, IPAddress, CAST(NULL AS VARCHAR) AS SegmentFURNITURE,
               {added_columns()} + 1 AS n_added, 3 AS n_failed, 0 AS n_rewritten FROM ({OWN}) o
        UNION ALL
        SELECT ManagedEntityRowId, DisplayName, NULL, SegmentFURNITURE, {added_columns()} + 1, 3, 0 FROM ({LATER}) l""",
)
def extend_table(t: Tables):
    """Rows written before and after a stored table got new columns, how many it got and did not, and files written again."""
    name = f"fleetmart_extended_{uuid.uuid4().hex}"
    folder = shared_dir(t.spark, "extended")
    t.sql(OWN).write.option("path", folder).format("parquet").saveAsTable(name)
    try:
        before = files.children(t.spark, folder)
        plan = evolve.missing_columns(t.sql(S.COMPUTER_DICTIONARY), active_types(t.sql(S.COMPUTER_TYPES)), "Computer", STORED)
        wanted = evolve.column_names([plan])["Computer"]
        done = evolve.extend_table(t.spark, name, [*wanted, *BARRED])
        later = t.sql(LATER)
        columns = t.spark.table(name).columns
        cells = [F.col(c) if c in later.columns else F.lit(None).cast("string").alias(c) for c in columns]
        later.select(*cells).write.insertInto(name)
        after = files.children(t.spark, folder)
        schema = t.spark.table(name).schema
    finally:
        t.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the folder stays for the readers of the result
    rows = t.spark.read.schema(schema).parquet(folder)
    counts = [len(done.added), len(done.failed), len(set(before) - set(after))]
    names = ["n_added", "n_failed", "n_rewritten"]
    return rows.select(*STORED, "SegmentFURNITURE", *[F.lit(n).cast("long").alias(c) for n, c in zip(counts, names)])


@query(
    "audit_duplicates",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM {lineitem}
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def audit_duplicates(t: Tables):
    return quality.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "audit_orphans",
    """SELECT o_orderkey, o_custkey FROM {orders}
       WHERE o_custkey NOT IN (SELECT c_custkey FROM {customer} WHERE c_acctbal > 2000)""",
)
def audit_orphans(t: Tables):
    parents = t.customer.where("c_acctbal > 2000")
    return quality.orphans(t.orders, "o_custkey", parents, "c_custkey").select(
        "o_orderkey", "o_custkey"
    )


@query(
    "audit_nulls",
    f"""SELECT 'TopLevelHostManagedEntityRowId' AS column_name,
               count(*) FILTER (WHERE TopLevelHostManagedEntityRowId IS NULL) AS n_null
        FROM ({S.DATABASE_ENTITIES}) d
        UNION ALL SELECT 'DisplayName', count(*) FILTER (WHERE DisplayName IS NULL)
        FROM ({S.DATABASE_ENTITIES}) d
        UNION ALL SELECT 'Path', count(*) FILTER (WHERE Path IS NULL) FROM ({S.DATABASE_ENTITIES}) d""",
)
def audit_nulls(t: Tables):
    columns = ["TopLevelHostManagedEntityRowId", "DisplayName", "Path"]
    return quality.nulls(t.sql(S.DATABASE_ENTITIES), columns)


WIDTHS = {"p_name": 9, "p_brand": 7, "p_type": 255}


@query(
    "audit_widths",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {w} AS declared, CAST(max(length({c})) AS INTEGER) AS longest,
                   count(*) FILTER (WHERE length({c}) > {w}) AS n_too_long FROM {{part}}"""
        for c, w in WIDTHS.items()
    ),
)
def audit_widths(t: Tables):
    return quality.widths(t.part, WIDTHS)


# The reporting tables with faults: a customer left out, empty and long texts, repeated keys.
FAULTY = {
    "Customer": f"SELECT * FROM ({S.CUSTOMERS}) x WHERE Name <> 'ASIA'",
    "CustomerDomain": f"""SELECT DomainId, CustomerId,
        CASE WHEN length(DomainDnsName) < 17 THEN DomainDnsName END AS DomainDnsName
        FROM ({S.DOMAINS}) x""",
    "ExcludeDB": "SELECT repeat(o_orderpriority, 6) AS Name FROM {orders}",
    "SQLVersion": S.RELEASES,
    "SQLServer": S.SERVER_TARGET,
    "Computer": f"""SELECT ManagedEntityRowId AS ID, Inserted, repeat(DisplayName, 20) AS DisplayName,
        CASE WHEN WindowsOS IS NULL THEN IsSCOM END AS IsSCOM FROM ({S.COMPUTER_TARGET}) x""",
    "SQLDatabase": f"SELECT TopLevelHostManagedEntityRowId AS ID, Inserted FROM ({S.DATABASE_TARGET}) x",
    "AlertHistory": f"""SELECT ID, substr(AlertGuid, 1, 3) AS AlertGuid, ManagedEntityRowId, Imported
        FROM ({S.ALERT_HISTORY}) x""",
    "MaintenanceHistory": f"""SELECT ID, MaintenanceRowId, ManagedEntityRowId,
        CASE WHEN UserId <> '1-URGENT' THEN Imported END AS Imported FROM ({S.MAINTENANCE_HISTORY}) x""",
}
TOO_LONG = [("ExcludeDB", "Name", 50), ("Computer", "DisplayName", 256)]


def _counted(table: str, rule: str, column: str, bad: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, count(*) AS n_bad
               FROM ({bad}) b"""


def _audit_sql() -> str:
    parts = []
    for rule, keys in (("key", schemas.KEYS), ("natural key", schemas.NATURAL_KEYS)):
        for table in FAULTY:
            for key in keys.get(table, []):
                repeated = f"SELECT {key} FROM ({FAULTY[table]}) f GROUP BY {key} HAVING count(*) > 1"
                parts.append(_counted(table, rule, key, repeated))
    for table, text in FAULTY.items():
        for column in schemas.REQUIRED[table]:
            empty = f"SELECT 1 FROM ({text}) f WHERE {column} IS NULL"
            parts.append(_counted(table, "required", column, empty))
    for table, column, width in TOO_LONG:
        long = f"SELECT 1 FROM ({FAULTY[table]}) f WHERE length(rtrim({column})) > {width}"
        parts.append(_counted(table, "width", column, long))
    orphans = f"""SELECT 1 FROM ({FAULTY["CustomerDomain"]}) d
                  WHERE CustomerId NOT IN (SELECT CustomerId FROM ({FAULTY["Customer"]}) c)"""
    parts.append(_counted("CustomerDomain", "foreign key", "CustomerId", orphans))
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) a WHERE n_bad > 0"


@query("audit_tables", _audit_sql())
def audit_tables(t: Tables):
    return quality.audit_tables({name: t.sql(text) for name, text in FAULTY.items()})
