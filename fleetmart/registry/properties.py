"""Queries for property XML and property lists."""

from pyspark.sql import functions as F

from fleetmart.functions.columns import VALUE_WIDTH
from fleetmart.operators import properties as P
from fleetmart.plans import views
from fleetmart.registry import standins as S
from fleetmart.registry.base import Tables, query, shown

# What the XML holds, built from the columns directly.
COMPUTER_ITEMS = """
SELECT o_custkey AS ManagedEntityRowId, o_orderdate AS created, upper(md5(o_orderpriority)) AS guid,
       CASE WHEN o_totalprice < 20000 THEN '' ELSE concat('Val ', o_orderstatus) END AS value
FROM {orders} WHERE o_orderstatus <> 'F' AND o_totalprice <= 450000
UNION ALL
SELECT o_custkey, o_orderdate, upper(md5(c_mktsegment)), substr(repeat(c_name, 6), 1, 100)
FROM {orders} JOIN {customer} ON c_custkey = o_custkey
WHERE o_orderstatus <> 'F' AND o_totalprice <= 450000"""
COMPUTER_NAMED = f"""
SELECT i.*, d.PropertySystemName AS name FROM ({COMPUTER_ITEMS}) i
JOIN (SELECT DISTINCT upper(trim(PropertyGuid, '{{}}')) AS g, PropertySystemName
      FROM ({S.COMPUTER_DICTIONARY}) x) d ON d.g = i.guid"""

SERVER_NAMED = """
SELECT l_suppkey AS ManagedEntityRowId, l_shipdate AS created,
       upper(md5(concat('flag', l_returnflag))) AS guid, concat('Line ', l_linenumber) AS value,
       CASE l_returnflag WHEN 'A' THEN 'Edition' WHEN 'N' THEN 'InstanceName' ELSE 'account' END AS name
FROM {lineitem} WHERE l_shipdate >= DATE '2001-06-01'
UNION ALL
SELECT l_suppkey, l_shipdate, upper(md5(concat('line', l_linestatus))),
       concat(10 + l_linenumber, '.0.', l_linestatus), 'Version'
FROM {lineitem} WHERE l_shipdate >= DATE '2001-06-01'"""

DATABASE_NAMED = """
SELECT l_orderkey AS ManagedEntityRowId, l_shipdate AS created,
       upper(md5(concat('db', l_returnflag))) AS guid, concat('DB ', l_linestatus, l_linenumber) AS value,
       CASE l_returnflag WHEN 'A' THEN 'Owner' WHEN 'N' THEN 'Collation' ELSE 'RecoveryModel' END AS name
FROM {lineitem} WHERE l_linestatus <> 'F'"""


@query(
    "property_shred",
    f"SELECT ManagedEntityRowId, guid AS PropertyGuid, value AS PropertyValue FROM ({COMPUTER_ITEMS}) i",
)
def property_shred(t: Tables):
    return P.shred(P.current_only(t.sql(S.COMPUTER_HISTORY)), VALUE_WIDTH).drop("DWCreatedDateTime")


# Properties with markup inside, other roots, a namespace, literal sections and references, nested properties.
MIXED_HISTORY = """
SELECT o_orderkey AS ManagedEntityRowId, o_orderdate AS DWCreatedDateTime, CAST(NULL AS TIMESTAMP_NTZ) AS ToDateTime,
       CASE substr(o_orderpriority, 1, 1)
         WHEN '1' THEN concat('<Root><Property Guid="{a-1}">Val <b k="1&gt;0">', c_name, '<i/></b> end</Property><Property Guid="a-2"/></Root>')
         WHEN '2' THEN concat('<Other><Property Guid="b">', c_name, '</Property></Other>')
         WHEN '3' THEN concat('<Root xmlns="urn:x"><Property Guid="c">', c_name, '</Property></Root>')
         WHEN '4' THEN concat('<?xml version="1.0"?><!-- <Other> --><Root><Property Guid="d"><![CDATA[<x> &amp; ]]>&lt;', c_name,
                              '&gt;&#233;<!-- no --></Property><property Guid="e">low</property></Root>')
         ELSE concat('<Root><Group><Property Guid="f">in</Property></Group><Property Guid="g">', o_orderstatus,
                     '<Property Guid="h">', c_name, '</Property>!</Property></Root>')
       END AS PropertyXML
FROM {orders} JOIN {customer} ON c_custkey = o_custkey"""


@query(
    "property_shred_mixed",
    """SELECT o_orderkey AS ManagedEntityRowId, guid AS PropertyGuid, value AS PropertyValue FROM (
         SELECT o_orderkey, 'A-1' AS guid, concat('Val ', c_name, ' end') AS value, '1' AS kind FROM {orders} JOIN {customer} ON c_custkey = o_custkey
         UNION ALL SELECT o_orderkey, 'A-2', '', '1' FROM {orders}
         UNION ALL SELECT o_orderkey, 'D', concat('<x> &amp; <', c_name, '>é'), '4' FROM {orders} JOIN {customer} ON c_custkey = o_custkey
         UNION ALL SELECT o_orderkey, 'G', concat(o_orderstatus, c_name, '!'), '5' FROM {orders} JOIN {customer} ON c_custkey = o_custkey) x
       JOIN (SELECT o_orderkey AS k, substr(o_orderpriority, 1, 1) AS p FROM {orders}) o ON k = o_orderkey AND p = kind""",
)
def property_shred_mixed(t: Tables):
    return P.shred(P.current_only(t.sql(MIXED_HISTORY)), VALUE_WIDTH).drop("DWCreatedDateTime")


@query(
    "property_names",
    f"""SELECT name AS PropertySystemName, count(*) AS n, count(DISTINCT ManagedEntityRowId) AS entities
        FROM ({COMPUTER_NAMED}) i GROUP BY name""",
)
def property_names(t: Tables):
    items = P.shred(P.current_only(t.sql(S.COMPUTER_HISTORY)), VALUE_WIDTH)
    named = P.named(items, t.sql(S.COMPUTER_DICTIONARY))
    return named.groupBy("PropertySystemName").agg(
        F.count("*").alias("n"), F.countDistinct("ManagedEntityRowId").alias("entities")
    )


@query(
    "show_properties",
    f"""SELECT ManagedEntityRowId, guid AS PropertyGuid, name AS PropertySystemName,
               value AS PropertyValue FROM ({COMPUTER_NAMED}) i
        ORDER BY PropertySystemName, ManagedEntityRowId""",
)
def show_properties(t: Tables):
    return P.show_properties(t.sql(S.COMPUTER_HISTORY), t.sql(S.COMPUTER_DICTIONARY))


def written(target: str, named: str, columns: list[str], keep: list[str], lower: bool = True) -> str:
    """The write-back in SQL: newest value per column, stored if NULL or different."""
    picks, cells, tests = [], [], []
    for c in columns:
        picks.append(
            f"""arg_max(value, created || guid || value) FILTER (WHERE lower(name) = '{c.lower()}') AS v_{c}"""
        )
        old = f't."{c}"'
        test = f"(v_{c} IS NOT NULL AND ({old} IS NULL OR rtrim(lower({old})) <> rtrim(lower(v_{c}))))"
        new = f"lower(v_{c})" if lower else f"v_{c}"
        cells.append(f'CASE WHEN {test} THEN {new} ELSE {old} END AS "{c}"')
        tests.append(test)
    return f"""
SELECT {", ".join(keep)}, {", ".join(cells)},
       CASE WHEN {" OR ".join(tests)} THEN '2001-12-31' END AS Modified
FROM ({target}) t LEFT JOIN (
    SELECT ManagedEntityRowId AS entity, {", ".join(picks)}
    FROM ({named}) n GROUP BY ManagedEntityRowId) w ON w.entity = t.ManagedEntityRowId"""


def refreshed(t: Tables, target: str, history: str, dictionary: str, columns: list[str], **options):
    rows = P.refresh_properties(
        t.sql(target), t.sql(history), t.sql(dictionary), S.ORDERS_AS_OF, columns=columns, **options
    )
    modified = F.col("Modified").cast("date").cast("string").alias("Modified")
    return rows.select("ID", "ManagedEntityRowId", *columns, modified)


COMPUTER_CELLS = ["DNSName", "IPAddress", "LogicalProcessors", "OrganizationalUnit"]
SERVER_CELLS = ["Edition", "InstanceName", "Account", "Version"]
DATABASE_CELLS = ["Owner", "Collation", "RecoveryModel"]
IDS = ["ID", "ManagedEntityRowId"]


@query(
    "property_writeback",
    written(S.COMPUTER_TARGET, COMPUTER_NAMED, COMPUTER_CELLS, IDS, lower=False),
)
def property_writeback(t: Tables):
    """The operator on named properties, values kept in their own case."""
    items = P.named(
        P.shred(P.current_only(t.sql(S.COMPUTER_HISTORY)), VALUE_WIDTH), t.sql(S.COMPUTER_DICTIONARY)
    )
    rows = P.write_back(
        t.sql(S.COMPUTER_TARGET), items, S.ORDERS_AS_OF, columns=COMPUTER_CELLS, lowercase=False
    )
    return shown(rows.select(*IDS, *COMPUTER_CELLS, "Modified"), "Modified")


@query(
    "property_refresh_computers",
    written(S.COMPUTER_TARGET, COMPUTER_NAMED, COMPUTER_CELLS, IDS),
)
def property_refresh_computers(t: Tables):
    return refreshed(
        t, S.COMPUTER_TARGET, S.COMPUTER_HISTORY, S.COMPUTER_DICTIONARY, COMPUTER_CELLS
    )


@query("property_refresh_servers", written(S.SERVER_TARGET, SERVER_NAMED, SERVER_CELLS, IDS))
def property_refresh_servers(t: Tables):
    return refreshed(t, S.SERVER_TARGET, S.SERVER_HISTORY, S.SERVER_DICTIONARY, SERVER_CELLS)


@query(
    "property_refresh_databases",
    written(S.DATABASE_TARGET, DATABASE_NAMED, DATABASE_CELLS, IDS),
)
def property_refresh_databases(t: Tables):
    return refreshed(
        t, S.DATABASE_TARGET, S.DATABASE_HISTORY, S.DATABASE_DICTIONARY, DATABASE_CELLS
    )


# Rows with every listed property; most are derived from the given columns, some stay empty.
SERVER_ROWS = f"""
SELECT s.*, Name AS Raw, '  ' AS AuditLevel, '' AS Cluster,
       CASE WHEN NotFoundSince IS NULL THEN DATE '2001-01-01' + CAST(ManagedEntityRowId AS INT) END
           AS EndOfMainstream
FROM ({S.SERVER_TARGET}) s
JOIN (SELECT s_suppkey, s_name AS Name FROM {{supplier}}) n ON s_suppkey = ManagedEntityRowId"""
FILLED_SERVER = {
    "Maschine": "Maschine",
    "Domain": "Domain",
    "InstanceName": "InstanceName",
    "Edition": "Edition",
    "Account": "Account",
    "AuditLevel": "AuditLevel",
    "Cluster": "Cluster",
    "EndOfMainstream": "CAST(EndOfMainstream AS VARCHAR)",
}
FILLED_COMPUTER = {
    "Maschine": "Maschine",
    "DNSName": "DNSName",
    "DomainDnsName": "DomainDnsName",
    "IPAddress": "IPAddress",
    "OrganizationalUnit": "OrganizationalUnit",
    "WindowsOS": "WindowsOS",
}


def listed(rows: str, filled: dict[str, str]) -> str:
    parts = [
        f"SELECT ManagedEntityRowId, '{name}' AS Property, {value} AS Wert FROM ({rows}) r"
        for name, value in filled.items()
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) p WHERE rtrim(Wert) <> ''"


def padded(df, columns):
    """The frame with the listed columns it lacks as empty text."""
    empty = F.lit(None).cast("string")
    return df.select("*", *[empty.alias(c) for c in columns if c not in df.columns])


@query("property_list", listed(SERVER_ROWS, FILLED_SERVER))
def property_list(t: Tables):
    return views.server_properties(padded(t.sql(SERVER_ROWS), views.SERVER_PROPERTIES))


@query("computer_property_list", listed(S.COMPUTER_TARGET, FILLED_COMPUTER))
def computer_property_list(t: Tables):
    return views.computer_properties(padded(t.sql(S.COMPUTER_TARGET), views.COMPUTER_PROPERTIES))
