"""Queries for the list views."""

from fleetmart.plans import derived as D
from fleetmart.plans import views
from fleetmart.registry import standins as S
from fleetmart.registry.base import Tables, query, shown
from fleetmart.registry.lookups import BEST_RELEASE, DIMENSION
from fleetmart.registry.properties import padded

DAYS = "CAST(date_diff('day', CAST(NotFoundSince AS DATE), DATE '2001-12-31') AS INTEGER)"


def lookups(t: Tables) -> D.Lookups:
    return D.Lookups(
        customers=t.sql(S.CUSTOMERS),
        domains=t.sql(S.DOMAINS),
        versions=t.sql(S.RELEASES),
        support=t.sql(S.SUPPORT),
        database_types=t.sql(S.DATABASE_TYPES),
    )


@query(
    "computer_grid",
    f"""SELECT ManagedEntityRowId, coalesce(d.CustomerName, '???') AS SQLCustomer,
               c.DomainDnsName, Maschine, CAST(NULL AS VARCHAR) AS NetbiosComputerName, DNSName,
               IPAddress, CAST(NULL AS VARCHAR) AS PhysicalProcessors, LogicalProcessors,
               CAST(NULL AS VARCHAR) AS VirtualMachineName,
               CAST(NULL AS VARCHAR) AS SQLMonitoringType, WindowsOS,
               CAST(NotFoundSince AS VARCHAR) AS NotFoundSince, {DAYS} AS NotFoundSinceDays
        FROM ({S.COMPUTER_TARGET}) c LEFT JOIN ({DIMENSION}) d ON d.DomainDnsName = c.DomainDnsName""",
)
def computer_grid(t: Tables):
    computers = padded(t.sql(S.COMPUTER_TARGET), views.COMPUTER_GRID[4:11])
    full = D.with_computer_columns(computers, lookups(t), S.ORDERS_AS_OF)
    return shown(views.computer_grid(full), "NotFoundSince")


EMPTY = ["DatabaseAutogrow", "LogAutogrow", "Updateability", "UserAccess"]
EMPTY_SQL = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in EMPTY)


def text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


@query(
    "databases_view",
    f"""SELECT ManagedEntityRowId, TopLevelHostManagedEntityRowId, '' AS symbol,
               DisplayName AS DatabaseName, Owner, RecoveryModel, "Collation", {EMPTY_SQL},
               {text("NotFoundSince")} AS NotFoundSince, {DAYS} AS NotFoundSinceDays,
               CAST(Modified AS VARCHAR) AS Modified, {text("Inserted")} AS Inserted,
               substr(DisplayName, 3) AS DatabaseType
        FROM ({S.DATABASE_TARGET}) d""",
)
def databases_view(t: Tables):
    databases = padded(t.sql(S.DATABASE_TARGET), EMPTY)
    full = D.with_database_columns(databases, lookups(t), S.ORDERS_AS_OF)
    return shown(views.databases(full), "NotFoundSince", "Modified", "Inserted")


# Servers with a version, so that every derived column has something to show.
VERSIONED = f"""
SELECT s.*, p_brand AS Version, concat('T.', p_name) AS Path
FROM (SELECT ManagedEntityRowId, Domain, Edition, InstanceName, Account AS PrincipalName, NotFoundSince
      FROM ({S.SERVER_TARGET}) a) s
JOIN {{part}} ON p_partkey = ManagedEntityRowId"""


@query(
    "databases_list",
    f"""SELECT d.ManagedEntityRowId AS ID, d.ManagedEntityRowId, '' AS symbol,
               d.TopLevelHostManagedEntityRowId, d.DisplayName AS DatabaseName, s.PrincipalName,
               s.InstanceName, Owner, RecoveryModel, "Collation", {EMPTY_SQL},
               {text("d.NotFoundSince")} AS NotFoundSince, {DAYS.replace("Not", "d.Not")} AS NotFoundSinceDays,
               CASE WHEN m.DomainId IS NOT NULL THEN coalesce(m.CustomerName, '???') END AS SQLMandantName,
               CASE WHEN m.DomainId IS NOT NULL THEN coalesce(m.CustomerShortName, '???') END
                   AS SQLMandantNameShort, s.Domain, s.Edition, b.VersionNr
        FROM ({S.DATABASE_TARGET}) d
        LEFT JOIN ({VERSIONED}) s ON s.ManagedEntityRowId = d.TopLevelHostManagedEntityRowId
        LEFT JOIN ({DIMENSION}) m ON m.DomainDnsName = s.Domain
        LEFT JOIN ({BEST_RELEASE}) b ON b.p_partkey = s.ManagedEntityRowId""",
)
def databases_list(t: Tables):
    known = lookups(t)
    databases = padded(t.sql(S.DATABASE_TARGET), EMPTY)
    full = D.with_database_columns(databases, known, S.ORDERS_AS_OF)
    servers = D.with_server_columns(t.sql(VERSIONED), known, S.ORDERS_AS_OF)
    return shown(views.databases_list(full, servers), "NotFoundSince")


@query(
    "server_columns",
    f"""SELECT s.ManagedEntityRowId,
               CASE WHEN m.DomainId IS NOT NULL THEN coalesce(m.CustomerName, '???') END AS SQLMandantName,
               b.VersionNr, CAST(u.EndOfMainstream AS VARCHAR) AS EndOfMainstream,
               CAST(u.EndofExtended AS VARCHAR) AS EndofExtended, {DAYS} AS NotFoundSinceDay,
               concat('T;', substr(Path, 3)) AS tempPath
        FROM ({VERSIONED}) s LEFT JOIN ({DIMENSION}) m ON m.DomainDnsName = s.Domain
        LEFT JOIN ({BEST_RELEASE}) b ON b.p_partkey = s.ManagedEntityRowId
        LEFT JOIN ({S.SUPPORT}) u ON u.VersionNr = TRY_CAST(b.VersionNr AS INTEGER)""",
)
def server_columns(t: Tables):
    full = D.with_server_columns(t.sql(VERSIONED), lookups(t), S.ORDERS_AS_OF)
    return full.select(
        "ManagedEntityRowId",
        "SQLMandantName",
        "VersionNr",
        "EndOfMainstream",
        "EndofExtended",
        "NotFoundSinceDay",
        "tempPath",
    )


@query(
    "alerts_view",
    f"""SELECT ID AS AlertGuid, ManagedEntityRowId, Category, DisplayName, Alertname,
               AlertDescription, {text("RaisedDateTime")} AS RaisedDateTime, Severity,
               Priority AS priority, RepeatCount FROM ({S.ALERT_HISTORY}) h""",
)
def alerts_view(t: Tables):
    return shown(views.alerts(t.sql(S.ALERT_HISTORY)), "RaisedDateTime")


@query(
    "maintenance_view",
    f"""SELECT ID, ManagedEntityRowId, DisplayName, {text("StartDateTime")} AS StartDateTime,
               {text("EndDateTime")} AS EndDateTime,
               {text("ScheduledEndDateTime")} AS ScheduledEndDateTime, UserId, Comment AS comment
        FROM ({S.MAINTENANCE_HISTORY}) h""",
)
def maintenance_view(t: Tables):
    rows = views.maintenance(t.sql(S.MAINTENANCE_HISTORY))
    return shown(rows, "StartDateTime", "EndDateTime", "ScheduledEndDateTime")
