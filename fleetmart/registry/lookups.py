"""Queries for joins and lookups."""

from pyspark.sql import functions as F

from fleetmart.functions import columns as X
from fleetmart.operators import joins as J
from fleetmart.operators import lookups as L
from fleetmart.plans import views
from fleetmart.plans.derived import with_domain_counts
from fleetmart.plans.inventory import change_counts
from fleetmart.registry import standins as S
from fleetmart.registry.base import Tables, query
from fleetmart.schemas import check_key_texts, with_key_texts

# Servers whose domain is complete, a part contained in several, blank, or unknown.
SERVERS = """
SELECT s_suppkey AS ManagedEntityRowId,
       CASE WHEN s_acctbal < 1000 THEN n_name
            WHEN s_acctbal < 1500 THEN ''
            WHEN s_acctbal > 7500 THEN 'nowhere.local'
            ELSE concat(lower(n_name), '.', lower(r_name)) END AS Domain,
       CASE WHEN s_acctbal > 8000 THEN DATE '2001-05-01' END AS NotFoundSince
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey JOIN {region} ON r_regionkey = n_regionkey"""

DIMENSION = f"""
SELECT DomainId, DomainDnsName, c.Name AS CustomerShortName, c.NameLong AS CustomerName
FROM ({S.DOMAINS}) d LEFT JOIN ({S.CUSTOMERS}) c ON c.CustomerId = d.CustomerId"""

NAMED_SERVERS = f"""
SELECT s.*, b.DomainId AS hit, CASE WHEN b.DomainId IS NOT NULL THEN coalesce(b.CustomerShortName, '???') END AS Short,
       CASE WHEN b.DomainId IS NOT NULL THEN coalesce(b.CustomerName, '???') END AS Long
FROM ({SERVERS}) s LEFT JOIN (
    SELECT x.Domain AS wanted, d.*, row_number() OVER (
               PARTITION BY x.Domain ORDER BY length(d.DomainDnsName) DESC, d.DomainId) AS rn
    FROM (SELECT DISTINCT Domain FROM ({SERVERS}) a WHERE Domain <> '') x
    JOIN ({DIMENSION}) d ON contains(lower(d.DomainDnsName), lower(x.Domain))) b
  ON b.wanted = s.Domain AND b.rn = 1"""


def named_servers(t: Tables):
    dimension = L.domain_dimension(t.sql(S.DOMAINS), t.sql(S.CUSTOMERS))
    take = {"SQLMandantNameShort": "CustomerShortName", "SQLMandantName": "CustomerName"}
    return L.with_customer(t.sql(SERVERS), "Domain", dimension, take)


@query(
    "lookup_contains",
    f"SELECT ManagedEntityRowId, Domain, Long AS SQLMandantName FROM ({NAMED_SERVERS}) n",
)
def lookup_contains(t: Tables):
    return named_servers(t).select("ManagedEntityRowId", "Domain", "SQLMandantName")


# Looked-up texts with wildcards, without a literal, and empty.
PATTERNS = """
SELECT s_suppkey AS ManagedEntityRowId,
       CASE WHEN s_acctbal < 500 THEN '' WHEN s_acctbal < 1000 THEN '%'
            WHEN s_acctbal < 1500 THEN repeat('_', 18) WHEN s_acctbal < 2000 THEN repeat('_', 40)
            WHEN s_acctbal < 5000 THEN replace(lower(n_name), 'a', '_')
            WHEN s_acctbal < 8000 THEN concat(substr(n_name, 1, 2), '%.', substr(lower(r_name), 1, 3))
            ELSE n_name END AS Domain
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey JOIN {region} ON r_regionkey = n_regionkey"""


@query(
    "lookup_like",
    f"""SELECT s.ManagedEntityRowId, s.Domain,
               CASE WHEN b.DomainId IS NOT NULL THEN coalesce(b.CustomerName, '???') END AS SQLMandantName
        FROM ({PATTERNS}) s LEFT JOIN (
            SELECT x.Domain AS wanted, d.*, row_number() OVER (
                       PARTITION BY x.Domain ORDER BY length(d.DomainDnsName) DESC, d.DomainId) AS rn
            FROM (SELECT DISTINCT Domain FROM ({PATTERNS}) a) x
            JOIN ({DIMENSION}) d
              ON lower(d.DomainDnsName) LIKE concat('%', lower(x.Domain), '%')) b
          ON b.wanted = s.Domain AND b.rn = 1""",
)
def lookup_like(t: Tables):
    dimension = L.domain_dimension(t.sql(S.DOMAINS), t.sql(S.CUSTOMERS))
    take = {"SQLMandantName": "CustomerName"}
    return L.with_customer(t.sql(PATTERNS), "Domain", dimension, take, like=True)


@query(
    "enrich_chain",
    f"""SELECT ManagedEntityRowId, Short AS SQLMandantNameShort, Long AS SQLMandantName
        FROM ({NAMED_SERVERS}) n""",
)
def enrich_chain(t: Tables):
    return named_servers(t).select("ManagedEntityRowId", "SQLMandantNameShort", "SQLMandantName")


@query(
    "dist_mandant",
    f"""SELECT coalesce(Long, '(unbekannt)') AS Mandant, count(*) AS Anzahl
        FROM ({NAMED_SERVERS}) n WHERE NotFoundSince IS NULL GROUP BY Long""",
)
def dist_mandant(t: Tables):
    return views.customers_of_servers(named_servers(t))


BEST_RELEASE = f"""
SELECT p_partkey, p_brand, p_size, (SELECT arg_max(sqlversion, length(productversion))
     FROM (SELECT productversion, min(sqlversion) AS sqlversion FROM ({S.RELEASES}) r GROUP BY 1) v
     WHERE starts_with(p_brand, productversion)) AS VersionNr
FROM {{part}}"""


@query("lookup_prefix", f"SELECT p_partkey, p_brand, VersionNr FROM ({BEST_RELEASE}) b")
def lookup_prefix(t: Tables):
    parts = t.part.select("p_partkey", "p_brand")
    return L.with_release(parts, "p_brand", t.sql(S.RELEASES))


@query(
    "support_lookup",
    f"""SELECT p_partkey, b.VersionNr, CAST(EndOfMainstream AS VARCHAR) AS EndOfMainstream,
               CAST(EndofExtended AS VARCHAR) AS EndofExtended
        FROM ({BEST_RELEASE}) b LEFT JOIN ({S.SUPPORT}) s
          ON s.VersionNr = TRY_CAST(b.VersionNr AS INTEGER)""",
)
def support_lookup(t: Tables):
    parts = t.part.select("p_partkey", "p_brand")
    dated = L.with_support(parts, "p_brand", t.sql(S.RELEASES), t.sql(S.SUPPORT))
    return dated.drop("p_brand")


PARTS = """
SELECT p_brand AS Version, CASE WHEN p_size > 3 THEN p_type END AS Edition,
       CASE WHEN p_retailprice > 1000 THEN DATE '2001-05-01' END AS NotFoundSince
FROM {part}"""


@query(
    "dist_version",
    f"""SELECT VersionNr, count(*) AS Anzahl
        FROM ({BEST_RELEASE}) b JOIN {{part}} p ON p.p_partkey = b.p_partkey
        WHERE p_retailprice <= 1000 AND VersionNr IS NOT NULL GROUP BY VersionNr""",
)
def dist_version(t: Tables):
    return views.releases(L.with_release(t.sql(PARTS), "Version", t.sql(S.RELEASES)))


@query(
    "dist_edition",
    f"""SELECT Edition, count(*) AS Anzahl FROM ({PARTS}) p
        WHERE NotFoundSince IS NULL AND Edition IS NOT NULL GROUP BY Edition""",
)
def dist_edition(t: Tables):
    return views.editions(t.sql(PARTS))


@query(
    "lookup_key",
    """SELECT c_custkey, (SELECT n_name FROM {nation} WHERE n_nationkey = c_nationkey
                                             AND n_regionkey <> 2) AS DatabaseType
       FROM {customer}""",
)
def lookup_key(t: Tables):
    types = t.nation.where("n_regionkey <> 2")
    named = L.key_lookup(
        t.customer.select("c_custkey", "c_nationkey"),
        "c_nationkey",
        types,
        "n_nationkey",
        {"DatabaseType": "n_name"},
    )
    return named.drop("c_nationkey")


@query(
    "current_version",
    f"""SELECT ManagedEntityRowId, DisplayName FROM ({S.DATABASE_ENTITIES}) e
        WHERE EXISTS (SELECT 1 FROM ({S.DATABASE_HISTORY}) h
                      WHERE h.ManagedEntityRowId = e.ManagedEntityRowId AND ToDateTime IS NULL)""",
)
def current_version(t: Tables):
    current = t.sql(S.DATABASE_HISTORY).where("ToDateTime IS NULL").select("ManagedEntityRowId")
    live = t.sql(S.DATABASE_ENTITIES).join(current, "ManagedEntityRowId", "left_semi")
    return live.select("ManagedEntityRowId", "DisplayName")


@query(
    "active_types",
    f"""SELECT ManagedEntityRowId, e.ManagedEntityTypeRowId FROM ({S.SERVER_ENTITIES}) e
        JOIN ({S.SERVER_TYPES}) y ON y.ManagedEntityTypeRowId = e.ManagedEntityTypeRowId
        WHERE Aktiv""",
)
def types_on(t: Tables):
    on = J.active_types(t.sql(S.SERVER_TYPES), "Aktiv")
    rows = J.of_types(t.sql(S.SERVER_ENTITIES), on)
    return rows.select("ManagedEntityRowId", "ManagedEntityTypeRowId")


@query(
    "host_semi",
    f"""SELECT ManagedEntityRowId, Name FROM ({S.COMPUTER_ENTITIES}) c
        WHERE lower(Name) IN (SELECT lower(Maschine) FROM ({S.SERVER_TARGET}) s)""",
)
def host_semi(t: Tables):
    hosts = J.same_name(t.sql(S.COMPUTER_ENTITIES), "Name", t.sql(S.SERVER_TARGET), "Maschine")
    return hosts.select("ManagedEntityRowId", "Name")


@query("known_entities", f"{S.KNOWN_SERVERS} UNION {S.KNOWN_COMPUTERS}")
def known(t: Tables):
    return J.known_entities(t.sql(S.KNOWN_SERVERS), t.sql(S.KNOWN_COMPUTERS))


@query(
    "exclude_names",
    f"""SELECT ManagedEntityRowId, DisplayName FROM ({S.DATABASE_ENTITIES}) d
        WHERE lower(DisplayName) NOT IN (SELECT Name FROM ({S.EXCLUDED}) x)""",
)
def excluded(t: Tables):
    kept = J.exclude_names(t.sql(S.DATABASE_ENTITIES), "DisplayName", t.sql(S.EXCLUDED))
    return kept.select("ManagedEntityRowId", "DisplayName")


# The same by the type of the columns; a third of the computers and of the databases share one name.
HOT_COMPUTERS = f"""
SELECT ManagedEntityRowId, CASE WHEN DisplayName < 'Customer#000000500' THEN concat(upper(Name), '  ') ELSE Name END AS Name
FROM ({S.COMPUTER_ENTITIES}) c"""


@query(
    "host_semi_collated",
    f"""SELECT ManagedEntityRowId, Name FROM ({HOT_COMPUTERS}) c
        WHERE rtrim(lower(Name)) IN (SELECT lower(Maschine) FROM ({S.SERVER_TARGET}) s)""",
)
def host_semi_collated(t: Tables):
    entities = check_key_texts(with_key_texts(t.sql(HOT_COMPUTERS), "ManagedEntity"), "ManagedEntity")
    servers = check_key_texts(with_key_texts(t.sql(S.SERVER_TARGET), "SQLServer"), "SQLServer")
    return J.same_name(entities, "Name", servers, "Maschine").select("ManagedEntityRowId", F.col("Name").cast("string").alias("Name"))


@query(
    "exclude_names_collated",
    f"""SELECT ManagedEntityRowId, DisplayName FROM ({S.DATABASE_ENTITIES}) d
        WHERE lower(DisplayName) NOT IN (SELECT Name FROM ({S.EXCLUDED}) x)""",
)
def exclude_names_collated(t: Tables):
    databases = with_key_texts(t.sql(S.DATABASE_ENTITIES), "ManagedEntity")
    kept = J.exclude_names(databases, "DisplayName", with_key_texts(t.sql(S.EXCLUDED), "ExcludeDB"))
    return kept.select("ManagedEntityRowId", F.col("DisplayName").cast("string").alias("DisplayName"))


# Texts of sets alone: beside each other, apart, with a range, a negated one, an empty one.
SETS = """
SELECT s_suppkey AS ManagedEntityRowId,
       CASE WHEN s_acctbal < 1000 THEN '[nx][ay]' WHEN s_acctbal < 2500 THEN '[0-2]%[.]' WHEN s_acctbal < 4000 THEN '_[5-9][a-z.]'
            WHEN s_acctbal < 5500 THEN '[^a-z0-9_]' WHEN s_acctbal < 7000 THEN '[z][z]' WHEN s_acctbal < 8500 THEN '%[3]%'
            ELSE '[A-M][s][^b]' END AS Domain
FROM {supplier}"""
SET_PATTERN = "replace(replace(lower(x.Domain), '%', '.*'), '[^a-z0-9_]', '[^a-z0-9~]')"


@query(
    "lookup_like_sets",
    f"""SELECT s.ManagedEntityRowId, s.Domain,
               CASE WHEN b.DomainId IS NOT NULL THEN coalesce(b.CustomerName, '???') END AS SQLMandantName
        FROM ({SETS}) s LEFT JOIN (
            SELECT x.Domain AS wanted, d.*, row_number() OVER (
                       PARTITION BY x.Domain ORDER BY length(d.DomainDnsName) DESC, d.DomainId) AS rn
            FROM (SELECT DISTINCT Domain FROM ({SETS}) a) x
            JOIN ({DIMENSION}) d
              ON regexp_matches(lower(d.DomainDnsName), replace(replace({SET_PATTERN}, '_', '.'), '~', '_'))) b
          ON b.wanted = s.Domain AND b.rn = 1""",
)
def lookup_like_sets(t: Tables):
    dimension = L.domain_dimension(t.sql(S.DOMAINS), t.sql(S.CUSTOMERS))
    return L.with_customer(t.sql(SETS), "Domain", dimension, {"SQLMandantName": "CustomerName"}, like=True)


@query(
    "change_count",
    """SELECT o_orderkey, (SELECT count(*) FROM {lineitem} WHERE l_orderkey = o_orderkey) AS Changes
       FROM {orders}""",
)
def change_count(t: Tables):
    counts = change_counts(t.sql(S.DATABASE_HISTORY)).select("ManagedEntityRowId", "Changes")
    orders = t.orders.select("o_orderkey")
    joined = orders.join(counts, orders["o_orderkey"] == counts["ManagedEntityRowId"], "left")
    return joined.select("o_orderkey", F.coalesce("Changes", F.lit(0)).alias("Changes"))


@query(
    "domain_count",
    f"""SELECT c.CustomerId, c.Name, CAST(count(d.DomainId) AS INTEGER) AS Domains
        FROM ({S.CUSTOMERS}) c LEFT JOIN ({S.DOMAINS}) d ON d.CustomerId = c.CustomerId
        GROUP BY c.CustomerId, c.Name""",
)
def domain_count(t: Tables):
    counted = with_domain_counts(t.sql(S.CUSTOMERS), t.sql(S.DOMAINS))
    return counted.select("CustomerId", "Name", "Domains")


CHANGES = """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL '60' DAY END AS old_end,
       CASE WHEN last_ship >= o_orderdate THEN last_ship END AS new_end
FROM {orders} LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM {lineitem}
                         GROUP BY l_orderkey) s ON l_orderkey = o_orderkey"""


@query(
    "changed_rows",
    f"""SELECT o_orderkey, old_end IS DISTINCT FROM new_end AS null_safe,
               coalesce(old_end <> new_end, FALSE) AS literal FROM ({CHANGES}) c""",
)
def changed_rows(t: Tables):
    old, new = F.col("old_end"), F.col("new_end")
    return t.sql(CHANGES).select(
        "o_orderkey",
        X.differs(old, new).alias("null_safe"),
        X.differs(old, new, null_safe=False).alias("literal"),
    )
