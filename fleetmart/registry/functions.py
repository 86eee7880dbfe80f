"""Queries through the SQL functions: all fourteen per row of a table, and the list functions beside each row."""

from fleetmart.operators import lookups as L
from fleetmart.plans.sqlfunctions import register_functions
from fleetmart.plans.views import COMPUTER_PROPERTIES, SERVER_PROPERTIES
from fleetmart.registry import standins as S
from fleetmart.registry.base import Tables, query
from fleetmart.registry.lookups import BEST_RELEASE, NAMED_SERVERS, SERVERS
from fleetmart.registry.properties import FILLED_COMPUTER, FILLED_SERVER, SERVER_ROWS, listed, padded

# A part's number names a server beside it, its size a database type, the server's region a customer.
ROWS = f"""
SELECT p_partkey, p_brand AS ver, Domain AS domain, FullName AS fullname, Name AS name, CAST(n_regionkey AS INT) AS customer,
       CAST(300 + p_size AS INT) AS type_id
FROM {{part}} LEFT JOIN ({SERVERS}) s ON s.ManagedEntityRowId = p_size
LEFT JOIN (SELECT ManagedEntityRowId AS entity, FullName, Name FROM ({S.SERVER_ENTITIES}) e0) e ON entity = p_size
LEFT JOIN (SELECT s_suppkey, n_regionkey FROM {{supplier}} JOIN {{nation}} ON n_nationkey = s_nationkey) n ON s_suppkey = p_size"""


def registered(t: Tables) -> None:
    register_functions(t.spark, {
        "Customer": t.sql(S.CUSTOMERS),
        "CustomerDomain": L.domain_dimension(t.sql(S.DOMAINS), t.sql(S.CUSTOMERS)),
        "SQLVersion": t.sql(S.RELEASES),
        "Support": t.sql(S.SUPPORT),
        "ManagedEntityDatabaseType": t.sql(S.DATABASE_TYPES),
        "SQLServer": padded(t.sql(SERVER_ROWS), SERVER_PROPERTIES),
        "Computer": padded(t.sql(S.COMPUTER_TARGET), COMPUTER_PROPERTIES),
    })


CALLS = {
    "GetCustomerName": "domain", "GetCustomerNameShort": "domain", "GetCustomerNameLong": "customer",
    "GetCustomerNameLong4Domain": "customer", "GetCustomerNameShort4Domain": "customer", "fn_CustDomainCount": "customer",
    "GetDatabaseType": "type_id", "GetSQLVersion": "ver", "GetEndOfMainstream": "ver", "GetEndofExtended": "ver",
    "CutDomain": "fullname", "CutMaschine": "name", "ReplaceLastOccurrence": "fullname, '.', ';'", "BuildPath": "fullname",
}


@query(
    "sql_functions",
    f"""SELECT r.p_partkey, ns.Long AS GetCustomerName, ns.Short AS GetCustomerNameShort, c.NameLong AS GetCustomerNameLong,
               c.NameLong AS GetCustomerNameLong4Domain, c.Name AS GetCustomerNameShort4Domain,
               CAST((SELECT count(*) FROM ({S.DOMAINS}) d WHERE d.CustomerId = r.customer) AS INTEGER) AS fn_CustDomainCount,
               y.ManagedEntityTypeSystemName AS GetDatabaseType, b.VersionNr AS GetSQLVersion,
               CAST(u.EndOfMainstream AS VARCHAR) AS GetEndOfMainstream, CAST(u.EndofExtended AS VARCHAR) AS GetEndofExtended,
               regexp_replace(regexp_replace(replace(r.fullname, ';', '.'), '^[^:]*:[^.]*\\.', ''), '\\.[^.]*$', '') AS CutDomain,
               regexp_replace(replace(r.name, ';', '.'), '\\.[^.]*$', '') AS CutMaschine,
               regexp_replace(r.fullname, '\\.([^.]*)$', ';\\1') AS ReplaceLastOccurrence,
               regexp_replace(r.fullname, '\\.([^.]*)$', ';\\1') AS BuildPath
        FROM ({ROWS}) r LEFT JOIN ({NAMED_SERVERS}) ns ON ns.ManagedEntityRowId = (r.type_id - 300)
        LEFT JOIN ({S.CUSTOMERS}) c ON c.CustomerId = r.customer
        LEFT JOIN ({S.DATABASE_TYPES}) y ON y.ManagedEntityTypeRowId = r.type_id
        LEFT JOIN ({BEST_RELEASE}) b ON b.p_partkey = r.p_partkey
        LEFT JOIN ({S.SUPPORT}) u ON u.VersionNr = TRY_CAST(b.VersionNr AS INTEGER)""",
)
def sql_functions(t: Tables):
    registered(t)
    t.sql(ROWS).createOrReplaceTempView("function_rows")
    calls = ", ".join(f"{name}({argument}) AS {name}" for name, argument in CALLS.items())
    return t.spark.sql(f"SELECT p_partkey, {calls} FROM function_rows")


@query(
    "sql_property_list",
    f"""SELECT s_suppkey, p.Property, p.Wert FROM {{supplier}} JOIN ({listed(SERVER_ROWS, FILLED_SERVER)}) p
        ON p.ManagedEntityRowId = s_suppkey""",
)
def sql_property_list(t: Tables):
    """The list function of servers beside each row of a table."""
    registered(t)
    t.supplier.createOrReplaceTempView("function_servers")
    return t.spark.sql("SELECT s_suppkey, p.Property, p.Wert FROM function_servers, LATERAL SQLPropList(s_suppkey) AS p")


NAMED_MACHINES = f"""
SELECT m.machine, p.Property, p.Wert
FROM (SELECT DISTINCT upper(Maschine) AS machine FROM ({S.COMPUTER_TARGET}) c) m
JOIN (SELECT lower(Maschine) AS name, ManagedEntityRowId AS id FROM ({S.COMPUTER_TARGET}) d) n ON name = lower(machine)
JOIN ({listed(S.COMPUTER_TARGET, FILLED_COMPUTER)}) p ON p.ManagedEntityRowId = id"""


@query("sql_computer_property_list", NAMED_MACHINES)
def sql_computer_property_list(t: Tables):
    """The list function of computers beside each machine name, in another case than stored."""
    registered(t)
    t.sql(f"SELECT DISTINCT upper(Maschine) AS machine FROM ({S.COMPUTER_TARGET}) c").createOrReplaceTempView("function_machines")
    return t.spark.sql("SELECT machine, p.Property, p.Wert FROM function_machines, LATERAL ComputerPropList(machine) AS p")
