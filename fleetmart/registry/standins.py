"""The given tables in the role of warehouse tables, as SQL both engines read.

Servers are suppliers, computers customers, databases orders; a region is a customer, a nation a
customer's domain. Every text covers its whole tables.
"""

from datetime import datetime

ORDERS_AS_OF = datetime(2001, 12, 31, 10, 30)
EVENTS_AS_OF = datetime(2024, 2, 1)

DOMAINS = """
SELECT n_nationkey AS DomainId,
       CASE WHEN r_name = 'AMERICA' THEN NULL ELSE n_regionkey END AS CustomerId,
       concat(lower(n_name), '.', lower(r_name)) AS DomainDnsName
FROM {nation} JOIN {region} ON r_regionkey = n_regionkey"""

CUSTOMERS = """
SELECT r_regionkey AS CustomerId, r_name AS Name,
       CASE WHEN r_name <> 'MIDDLE EAST' THEN concat(r_name, ' AG') END AS NameLong
FROM {region}"""

SERVER_TYPES = """
SELECT 100 + r_regionkey AS ManagedEntityTypeRowId, r_name AS ManagedEntityTypeSystemName,
       r_name <> 'ASIA' AS Aktiv
FROM {region}"""

SERVER_ENTITIES = """
SELECT s_suppkey AS ManagedEntityRowId,
       CASE WHEN s_acctbal >= 0 THEN s_suppkey ELSE CAST(s_nationkey AS BIGINT) END
           AS TopLevelHostManagedEntityRowId,
       100 + n_regionkey AS ManagedEntityTypeRowId,
       concat('T.Engine:', n_name, '-', CAST(CAST(floor(s_acctbal / 500) AS INT) AS STRING), ';',
              lower(n_name), '.', lower(r_name), '.I', CAST(s_suppkey AS STRING)) AS FullName,
       concat(n_name, '-', CAST(CAST(floor(s_acctbal / 500) AS INT) AS STRING), ';db') AS Name,
       s_name AS DisplayName, s_name AS ManagedEntityDefaultName
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey JOIN {region} ON r_regionkey = n_regionkey"""

SERVER_HISTORY = """
SELECT l_suppkey AS ManagedEntityRowId,
       concat('<Root><Property Guid="', md5(concat('flag', l_returnflag)), '">Line ',
              CAST(l_linenumber AS STRING), '</Property><Property Guid="{',
              upper(md5(concat('line', l_linestatus))), '}">',
              CAST(10 + l_linenumber AS STRING), '.0.', l_linestatus,
              '</Property></Root>') AS PropertyXML,
       l_shipdate AS DWCreatedDateTime,
       CASE WHEN l_shipdate < DATE '2001-06-01' THEN l_shipdate END AS ToDateTime
FROM {lineitem}"""

SERVER_DICTIONARY = """
SELECT DISTINCT 100 AS ManagedEntityTypeRowId, md5(concat('flag', l_returnflag)) AS PropertyGuid,
       CASE l_returnflag WHEN 'A' THEN 'Edition' WHEN 'N' THEN 'InstanceName' ELSE 'account' END
           AS PropertySystemName
FROM {lineitem}
UNION ALL
SELECT DISTINCT 100, md5(concat('line', l_linestatus)), 'Version' FROM {lineitem}"""

SERVER_TARGET = """
SELECT s_suppkey + 1 AS ID, s_suppkey AS ManagedEntityRowId,
       CAST(s_nationkey AS BIGINT) AS TopLevelHostManagedEntityRowId,
       s_name AS ManagedEntityDefaultName,
       CAST(NULL AS TIMESTAMP_NTZ) AS DWCreatedDateTime, CAST(NULL AS INT) AS Changes,
       concat(n_name, '-', CAST(CAST(floor(s_acctbal / 500) AS INT) AS STRING)) AS Maschine,
       CAST(NULL AS STRING) AS Path, 'line 1' AS Account,
       CAST(concat(lower(n_name), '.', lower(r_name)) AS STRING) AS Domain,
       CASE WHEN s_acctbal > 2000 THEN 'line 7' END AS Edition, CAST(NULL AS STRING) AS FullName,
       s_name AS InstanceName, CAST(NULL AS STRING) AS Version,
       CAST(NULL AS TIMESTAMP_NTZ) AS Modified, CAST(DATE '1999-01-01' AS TIMESTAMP_NTZ) AS Inserted,
       TRUE AS IsSCOM,
       CASE WHEN s_acctbal > 8000 THEN CAST(DATE '2001-05-01' AS TIMESTAMP_NTZ) END AS NotFoundSince
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey JOIN {region} ON r_regionkey = n_regionkey
WHERE s_acctbal > 500"""

COMPUTER_TYPES = """
SELECT 200 + r_regionkey AS ManagedEntityTypeRowId, r_name AS ManagedEntityTypeSystemName
FROM {region} WHERE r_name <> 'EUROPE'"""

COMPUTER_ENTITIES = """
SELECT c_custkey AS ManagedEntityRowId, c_custkey AS TopLevelHostManagedEntityRowId,
       200 + n_regionkey AS ManagedEntityTypeRowId,
       concat('T.Computer:', c_name) AS FullName, c_mktsegment AS Path,
       concat(lower(n_name), '-', CAST(CAST(floor(c_acctbal / 500) AS INT) AS STRING)) AS Name,
       c_name AS DisplayName, c_name AS ManagedEntityDefaultName,
       CAST(DATE '2001-01-01' AS TIMESTAMP_NTZ) AS DWCreatedDateTime
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey"""

COMPUTER_HISTORY = """
SELECT o_custkey AS ManagedEntityRowId,
       CASE WHEN o_totalprice > 450000 THEN '<Root><Property'
            ELSE concat('<Root><Property Guid="', md5(o_orderpriority), '">',
                        CASE WHEN o_totalprice < 20000 THEN '' ELSE concat('Val ', o_orderstatus) END,
                        '</Property><Property Guid="{', upper(md5(c_mktsegment)), '}">',
                        repeat(c_name, 6), '</Property></Root>') END AS PropertyXML,
       o_orderdate AS DWCreatedDateTime,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS ToDateTime
FROM {orders} JOIN {customer} ON c_custkey = o_custkey"""

COMPUTER_DICTIONARY = """
SELECT DISTINCT 200 AS ManagedEntityTypeRowId, concat('{', md5(o_orderpriority), '}') AS PropertyGuid,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'DNSName' WHEN '2' THEN 'ipaddress'
            WHEN '3' THEN 'LogicalProcessors' WHEN '4' THEN 'OrganizationalUnit'
            ELSE 'NotFoundSince' END AS PropertySystemName
FROM {orders}
UNION ALL
SELECT DISTINCT 200, md5(c_mktsegment), concat('Segment', c_mktsegment) FROM {customer}"""

COMPUTER_TARGET = """
SELECT c_custkey + 1 AS ID, c_custkey AS ManagedEntityRowId,
       c_custkey AS TopLevelHostManagedEntityRowId,
       CAST(200 + n_regionkey AS BIGINT) AS ManagedEntityTypeRowId,
       c_name AS ManagedEntityDefaultName, c_mktsegment AS Path, CAST(NULL AS STRING) AS FullName,
       c_name AS DisplayName,
       concat(lower(n_name), '-', CAST(CAST(floor(c_acctbal / 500) AS INT) AS STRING)) AS Maschine,
       CASE WHEN c_acctbal > 1000 THEN 'VAL O' END AS DNSName,
       concat(lower(n_name), '.', lower(r_name)) AS DomainDnsName,
       CASE WHEN c_acctbal > 3000 THEN 'other' END AS IPAddress,
       CAST(NULL AS STRING) AS LogicalProcessors, 'val p' AS OrganizationalUnit,
       CAST(NULL AS DATE) AS Modified, DATE '1999-01-01' AS Inserted, FALSE AS IsSCOM,
       CAST(NULL AS DATE) AS DWCreatedDateTime,
       CASE WHEN c_acctbal > 8000 THEN DATE '2001-05-01' END AS NotFoundSince,
       CASE WHEN c_acctbal > 5000 THEN 'old system' END AS WindowsOS
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey JOIN {region} ON r_regionkey = n_regionkey
WHERE c_mktsegment <> 'FURNITURE'"""

DATABASE_TYPES = """
SELECT DISTINCT 300 + CAST(substr(o_orderpriority, 1, 1) AS INT) AS ManagedEntityTypeRowId,
       o_orderpriority AS ManagedEntityTypeSystemName, o_orderpriority <> '2-HIGH' AS Aktive
FROM {orders}"""

DATABASE_ENTITIES = """
SELECT o_orderkey AS ManagedEntityRowId, host AS TopLevelHostManagedEntityRowId,
       300 + CAST(substr(o_orderpriority, 1, 1) AS INT) AS ManagedEntityTypeRowId,
       concat('16.0;M', CAST(o_custkey AS STRING), ';', o_orderstatus) AS Path,
       CASE WHEN o_totalprice < 5000 THEN NULL
            ELSE concat(o_orderstatus, '-', o_orderpriority) END AS DisplayName
FROM {orders} LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS host FROM {lineitem} GROUP BY l_orderkey) h
  ON l_orderkey = o_orderkey"""

DATABASE_HISTORY = """
SELECT l_orderkey AS ManagedEntityRowId,
       concat('<Root><Property Guid="', md5(concat('db', l_returnflag)), '">DB ', l_linestatus,
              CAST(l_linenumber AS STRING), '</Property></Root>') AS PropertyXML,
       l_shipdate AS DWCreatedDateTime,
       CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS ToDateTime
FROM {lineitem}"""

DATABASE_DICTIONARY = """
SELECT DISTINCT 301 AS ManagedEntityTypeRowId, md5(concat('db', l_returnflag)) AS PropertyGuid,
       CASE l_returnflag WHEN 'A' THEN 'Owner' WHEN 'N' THEN 'Collation' ELSE 'RecoveryModel' END
           AS PropertySystemName
FROM {lineitem}"""

DATABASE_TARGET = """
SELECT o_orderkey + 1 AS ID, o_orderkey AS ManagedEntityRowId,
       host AS TopLevelHostManagedEntityRowId,
       concat('16.0:M', CAST(o_custkey AS STRING), ':', o_orderstatus) AS Path,
       concat(o_orderstatus, '-', o_orderpriority) AS DisplayName,
       CAST(300 + CAST(substr(o_orderpriority, 1, 1) AS INT) AS BIGINT) AS ManagedEntityTypeRowId,
       CASE WHEN o_totalprice > 100000 THEN 'db o1' END AS Collation,
       'db o2' AS Owner, CAST(NULL AS STRING) AS RecoveryModel,
       CASE WHEN o_totalprice > 300000 THEN CAST(DATE '2001-05-01' AS TIMESTAMP_NTZ) END
           AS NotFoundSince,
       CAST(NULL AS TIMESTAMP_NTZ) AS Modified, o_orderdate AS Inserted
FROM {orders} LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS host FROM {lineitem} GROUP BY l_orderkey) h
  ON l_orderkey = o_orderkey
WHERE o_orderdate < DATE '2000-01-01'"""

EXCLUDED = """
SELECT DISTINCT lower(concat(o_orderstatus, '-', o_orderpriority)) AS Name
FROM {orders} WHERE o_orderstatus = 'P' AND o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')"""

RELEASES = """
SELECT substr(p_brand, 1, 7) AS productversion, CAST(2000 + min(p_size) AS STRING) AS sqlversion
FROM {part} GROUP BY substr(p_brand, 1, 7)
UNION ALL
SELECT p_brand, concat(CAST(2000 + max(p_size) AS STRING), 'R2')
FROM {part} WHERE p_type = 'PROMO' AND p_retailprice > 950 GROUP BY p_brand
UNION ALL
SELECT p_brand, CAST(2000 + max(p_size) AS STRING)
FROM {part} WHERE p_type = 'LARGE' AND p_name LIKE '%gear' GROUP BY p_brand"""

SUPPORT = """
SELECT DISTINCT 2000 + p_size AS VersionNr, DATE '1995-01-01' + p_size AS ReleaseDate,
       DATE '2000-01-01' + 10 * p_size AS EndOfMainstream,
       DATE '2005-01-01' + 10 * p_size AS EndofExtended
FROM {part}"""

# Alerts: what one user did on one day. The old state saw only the mornings of the first days.
ALERT_COLUMNS = """
SELECT md5(concat(CAST(user_id AS STRING), '|', CAST(CAST(ts AS DATE) AS STRING), '|', event_type))
           AS AlertGuid,
       user_id AS ManagedEntityRowId, event_type AS Category,
       concat('user ', CAST(user_id AS STRING)) AS MonitoringObjectDisplayName,
       event_type AS AlertName, CAST(NULL AS STRING) AS AlertDescription,
       min(ts) AS RaisedDateTime,
       CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'error' THEN 2 ELSE 7 END
           AS Severity,
       CAST(floor(max(value) / 20) AS INT) AS Priority, CAST(count(*) AS INT) AS RepeatCount,
       min(event_id) AS first_event
FROM {events} """
ALERT_GROUP = " GROUP BY user_id, CAST(ts AS DATE), event_type"

ALERT_DETAILS = ALERT_COLUMNS + ALERT_GROUP

ALERT_HISTORY = (
    """
SELECT first_event + 1 AS ID, upper(AlertGuid) AS AlertGuid, ManagedEntityRowId, Category,
       MonitoringObjectDisplayName AS DisplayName, AlertName AS Alertname, AlertDescription,
       RaisedDateTime, 'old' AS Severity, 'old' AS Priority, RepeatCount,
       CAST(DATE '2024-01-21' AS TIMESTAMP_NTZ) AS Imported
FROM ("""
    + ALERT_COLUMNS
    + " WHERE ts < DATE '2024-01-21' AND extract(hour FROM ts) < 12"
    + ALERT_GROUP
    + ") x"
)

KNOWN_SERVERS = "SELECT s_suppkey AS ManagedEntityRowId FROM {supplier} WHERE s_acctbal > 5000"
KNOWN_COMPUTERS = "SELECT c_custkey AS ManagedEntityRowId FROM {customer} WHERE c_acctbal > 2000"

# Maintenance windows: an order is open until its last line ships.
WINDOWS = """
SELECT o_orderkey AS MaintenanceModeRowId, o_custkey AS ManagedEntityRowId,
       o_orderdate AS StartDateTime,
       CASE WHEN last_ship >= o_orderdate THEN last_ship END AS EndDateTime,
       o_orderdate + INTERVAL '60' DAY AS ScheduledEndDateTime,
       o_orderpriority AS UserId, o_orderstatus AS Comments
FROM {orders} LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM {lineitem}
                         GROUP BY l_orderkey) s ON l_orderkey = o_orderkey"""

MAINTENANCE_HISTORY = """
SELECT o_orderkey + 1 AS ID, o_orderkey AS MaintenanceRowId, o_custkey AS ManagedEntityRowId,
       c_name AS DisplayName, o_orderdate AS StartDateTime,
       CASE WHEN last_ship >= o_orderdate THEN last_ship END AS EndDateTime,
       o_orderdate + INTERVAL '60' DAY AS ScheduledEndDateTime, o_orderpriority AS UserId,
       CAST(NULL AS STRING) AS Comment, CAST(DATE '2001-05-01' AS TIMESTAMP_NTZ) AS Imported
FROM {orders} JOIN {customer} ON c_custkey = o_custkey
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM {lineitem}
           WHERE l_shipdate < DATE '2001-05-01' GROUP BY l_orderkey) s ON l_orderkey = o_orderkey
WHERE o_orderdate < DATE '2001-05-01'"""

NAMED_ENTITIES = """
SELECT c_custkey AS ManagedEntityRowId, c_name AS ManagedEntityDefaultName
FROM {customer} WHERE c_mktsegment <> 'MACHINERY'"""
