"""Queries for scans, projections and scalar functions."""

from pyspark.sql import functions as F

from fleetmart.functions import columns as X
from fleetmart.operators.ids import with_dense_ids
from fleetmart.registry import standins as S
from fleetmart.registry.base import Tables, query, second
from fleetmart.sources.readers import type_catalogue

FULL_NAMES = """
SELECT c_custkey,
       CASE c_mktsegment
            WHEN 'MACHINERY' THEN c_name
            WHEN 'BUILDING' THEN concat('T:', c_name, '.I', CAST(c_custkey AS STRING))
            ELSE concat('T:', c_name, ';', lower(n_name), '.', lower(r_name), '.I',
                        CAST(c_custkey AS STRING)) END AS FullName
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey JOIN {region} ON r_regionkey = n_regionkey"""


@query("scan_entities", "SELECT * FROM {supplier}")
def scan_entities(t: Tables):
    return t.supplier


TYPES = """
SELECT DISTINCT p_size AS ManagedEntityTypeRowId, md5(CAST(p_size AS STRING)) AS ManagedEntityTypeGuid,
       1 AS ManagementPackRowId, concat('Type.', CAST(p_size AS STRING)) AS ManagedEntityTypeSystemName,
       concat('Size ', CAST(p_size AS STRING)) AS ManagedEntityTypeDefaultName,
       CAST(NULL AS STRING) AS ManagedEntityTypeDefaultDescription, 7 AS Other
FROM {part}"""


@query(
    "type_catalogue",
    f"""SELECT ManagedEntityTypeRowId, ManagedEntityTypeGuid, ManagementPackRowId,
        ManagedEntityTypeSystemName, ManagedEntityTypeDefaultName,
        ManagedEntityTypeDefaultDescription FROM ({TYPES}) x""",
)
def types(t: Tables):
    return type_catalogue(t.sql(TYPES))


@query(
    "cut_domain",
    f"""SELECT c_custkey, regexp_replace(substr(tail, strpos(tail, '.') + 1), '\\.[^.]*$', '') AS Domain
        FROM (SELECT c_custkey, CASE WHEN FullName LIKE '%:%'
                     THEN substr(replace(FullName, ';', '.'), strpos(FullName, ':') + 1) END AS tail
              FROM ({FULL_NAMES}) x) y""",
)
def cut_domain(t: Tables):
    return t.sql(FULL_NAMES).select("c_custkey", X.domain_of(F.col("FullName"), X.NAME_WIDTH).alias("Domain"))


@query(
    "cut_machine",
    f"""SELECT c_custkey, regexp_replace(dotted, '\\.[^.]*$', '') AS Maschine,
               split_part(dotted, '.', 1) AS first_part
        FROM (SELECT c_custkey, replace(FullName, ';', '.') AS dotted FROM ({FULL_NAMES}) x) y""",
)
def cut_machine(t: Tables):
    name = F.col("FullName")
    return t.sql(FULL_NAMES).select(
        "c_custkey",
        X.machine_of(name, width=X.NAME_WIDTH).alias("Maschine"),
        X.machine_of(name, first_dot=True, width=X.NAME_WIDTH).alias("first_part"),
    )


@query(
    "entity_path",
    f"""SELECT c_custkey, replace(substr(FullName, strpos(FullName, ':') + 1, 255), ';', '.') AS Path
        FROM ({FULL_NAMES}) x""",
)
def path_of_entity(t: Tables):
    return t.sql(FULL_NAMES).select("c_custkey", X.entity_path(F.col("FullName"), X.NAME_WIDTH).alias("Path"))


@query(
    "replace_last",
    f"""SELECT c_custkey, regexp_replace(FullName, '\\.([^.]*)$', '_\\1') AS replaced
        FROM ({FULL_NAMES}) x""",
)
def replaced_last(t: Tables):
    replaced = X.replace_last(F.col("FullName"), ".", "_")
    return t.sql(FULL_NAMES).select("c_custkey", replaced.alias("replaced"))


LONG_PATHS = f"SELECT c_custkey, concat(FullName, ';', repeat(FullName, 8)) AS Path FROM ({FULL_NAMES}) x"


@query(
    "build_path",
    f"""SELECT c_custkey, substr(regexp_replace(substr(Path, 1, 256), '\\.([^.]*)$', ';\\1'), 1, 250)
               AS tempPath FROM ({LONG_PATHS}) y""",
)
def built_path(t: Tables):
    return t.sql(LONG_PATHS).select("c_custkey", X.build_path(F.col("Path")).alias("tempPath"))


@query(
    "db_path",
    f"SELECT ManagedEntityRowId, replace(Path, ';', ':') AS Path FROM ({S.DATABASE_ENTITIES}) x",
)
def db_path(t: Tables):
    path = X.database_path(F.col("Path")).alias("Path")
    return t.sql(S.DATABASE_ENTITIES).select("ManagedEntityRowId", path)


@query("minute_trunc", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:00') AS minute FROM {events}")
def minute_trunc(t: Tables):
    return t.events.select("event_id", second(X.minute_of(F.col("ts"))).alias("minute"))


MISSING = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '23' HOUR END
       AS NotFoundSince FROM {orders}"""


@query(
    "missing_days",
    f"""SELECT o_orderkey, CAST(date_diff('day', CAST(NotFoundSince AS DATE), DATE '2001-12-31') AS INTEGER)
               AS NotFoundSinceDays FROM ({MISSING}) x""",
)
def days_missing(t: Tables):
    days = X.missing_days(F.col("NotFoundSince"), S.ORDERS_AS_OF)
    return t.sql(MISSING).select("o_orderkey", days.alias("NotFoundSinceDays"))




@query(
    "severity_map",
    """SELECT p_partkey, CASE p_size // 12 WHEN 0 THEN 'Information' WHEN 1 THEN 'Warning'
              WHEN 2 THEN 'Error' ELSE CAST(p_size // 12 AS VARCHAR) END AS Severity FROM {part}""",
)
def severity_map(t: Tables):
    code = F.floor(F.col("p_size") / 12)
    return t.part.select("p_partkey", X.severity_label(code).alias("Severity"))


@query(
    "priority_map",
    """SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Low' WHEN '2' THEN 'Medium'
              WHEN '3' THEN 'High' ELSE CAST(CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS VARCHAR) END
              AS Priority FROM {orders}""",
)
def priority_map(t: Tables):
    code = F.left("o_orderpriority", F.lit(1)).cast("int") - 1
    return t.orders.select("o_orderkey", X.priority_label(code).alias("Priority"))


@query(
    "surrogate_ids",
    """SELECT c_custkey, c_name, CAST(500 + row_number() OVER (
              ORDER BY left(md5(CAST(c_custkey AS VARCHAR)), 4), c_custkey) AS BIGINT) AS ID
       FROM {customer}""",
)
def surrogate_ids(t: Tables):
    return with_dense_ids(t.customer.select("c_custkey", "c_name"), ["c_custkey"], "ID", 500)
