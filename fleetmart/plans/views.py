"""Reporting views over the tables with their derived columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.columns import label
from fleetmart.operators.properties import property_list


def live(df: DataFrame) -> DataFrame:
    return df.where(F.col("NotFoundSince").isNull())


def distribution(df: DataFrame, column: str, name: str, keep_unknown: bool = False) -> DataFrame:
    """Live rows per value of a column; the label is put on after grouping."""
    rows = live(df)
    if not keep_unknown:
        rows = rows.where(F.col(column).isNotNull())
    counts = rows.groupBy(F.col(column).alias("_value")).agg(F.count("*").alias("Anzahl"))
    return counts.select(label(F.col("_value")).alias(name), "Anzahl")


def editions(servers: DataFrame) -> DataFrame:
    return distribution(servers, "Edition", "Edition")


def customers_of_servers(servers: DataFrame) -> DataFrame:
    return distribution(servers, "SQLMandantName", "Mandant", keep_unknown=True)


def releases(servers: DataFrame) -> DataFrame:
    return distribution(servers, "VersionNr", "VersionNr")


# Columns of the list views.
COMPUTER_GRID = [
    "ManagedEntityRowId",
    "SQLCustomer",
    "DomainDnsName",
    "Maschine",
    "NetbiosComputerName",
    "DNSName",
    "IPAddress",
    "PhysicalProcessors",
    "LogicalProcessors",
    "VirtualMachineName",
    "SQLMonitoringType",
    "WindowsOS",
    "NotFoundSince",
    "NotFoundSinceDays",
]
DATABASE_SETTINGS = [
    "Owner",
    "RecoveryModel",
    "Collation",
    "DatabaseAutogrow",
    "LogAutogrow",
    "Updateability",
    "UserAccess",
    "NotFoundSince",
    "NotFoundSinceDays",
]


def computer_grid(computers: DataFrame) -> DataFrame:
    return computers.select(*COMPUTER_GRID)


def _symbol() -> Column:
    return F.lit("").alias("symbol")


def databases(dbs: DataFrame) -> DataFrame:
    return dbs.select(
        "ManagedEntityRowId",
        "TopLevelHostManagedEntityRowId",
        _symbol(),
        F.col("DisplayName").alias("DatabaseName"),
        *DATABASE_SETTINGS,
        "Modified",
        "Inserted",
        "DatabaseType",
    )


def databases_list(dbs: DataFrame, servers: DataFrame) -> DataFrame:
    """All databases with facts about their server; one row per pair if a server is listed twice."""
    facts = [
        "PrincipalName",
        "InstanceName",
        "SQLMandantName",
        "SQLMandantNameShort",
        "Domain",
        "Edition",
        "VersionNr",
    ]
    hosts = servers.select(F.col("ManagedEntityRowId").alias("_host"), *facts)
    own = dbs.select(
        F.col("ManagedEntityRowId").alias("ID"),
        "ManagedEntityRowId",
        _symbol(),
        "TopLevelHostManagedEntityRowId",
        F.col("DisplayName").alias("DatabaseName"),
        *DATABASE_SETTINGS,
    )
    on = own["TopLevelHostManagedEntityRowId"] == hosts["_host"]
    return own.join(hosts, on, "left").drop("_host")


def alerts(history: DataFrame) -> DataFrame:
    """Alert list; readers expect the surrogate key under the name ``AlertGuid``."""
    return history.select(
        F.col("ID").alias("AlertGuid"),
        "ManagedEntityRowId",
        "Category",
        "DisplayName",
        "Alertname",
        "AlertDescription",
        "RaisedDateTime",
        "Severity",
        F.col("Priority").alias("priority"),
        "RepeatCount",
    )


def maintenance(history: DataFrame) -> DataFrame:
    return history.select(
        "ID",
        "ManagedEntityRowId",
        "DisplayName",
        "StartDateTime",
        "EndDateTime",
        "ScheduledEndDateTime",
        "UserId",
        F.col("Comment").alias("comment"),
    )


# Properties shown for one server and for one computer.
SERVER_PROPERTIES = [
    "Maschine",
    "Domain",
    "InstanceName",
    "PrincipalName",
    "DisplayName",
    "Version",
    "VersionNr",
    "Edition",
    "ServicePackVersion",
    "AuthenticationMode",
    "AuditLevel",
    "Account",
    "AgentName",
    "AgentClusterName",
    "Cluster",
    "TcpPorts",
    "ConnectionString",
    "InstallPath",
    "ToolsPath",
    "MasterDatabaseLocation",
    "MasterDatabaseLogLocation",
    "ErrorLogLocation",
    "ServiceName",
    "ServiceClusterName",
    "Language",
    "InstanceID",
    "Type",
    "EnableErrorReporting",
    "FullTextSearchServiceName",
    "FullTextSearchServiceClusterName",
    "ReplicationDistributionDatabase",
    "ReplicationWorkingDirectory",
    "EndOfMainstream",
    "EndofExtended",
]
COMPUTER_PROPERTIES = [
    "Maschine",
    "NetbiosComputerName",
    "DNSName",
    "DomainDnsName",
    "PrincipalName",
    "NetworkName",
    "IPAddress",
    "PhysicalProcessors",
    "LogicalProcessors",
    "VirtualMachineName",
    "Virtual_Server_Type",
    "SQLMonitoringType",
    "SQLMandant",
    "SQLCustomer",
    "OrganizationalUnit",
    "WindowsOS",
]


def server_properties(servers: DataFrame, entity: int | None = None) -> DataFrame:
    """Filled properties of one server, or of all with their ids."""
    if entity is None:
        return property_list(servers, ["ManagedEntityRowId"], SERVER_PROPERTIES)
    one = servers.where(F.col("ManagedEntityRowId") == entity)
    return property_list(one, ["ManagedEntityRowId"], SERVER_PROPERTIES).drop("ManagedEntityRowId")


def computer_properties(computers: DataFrame, machine: str | None = None) -> DataFrame:
    """Filled properties of one machine, or of all with their ids."""
    if machine is None:
        return property_list(computers, ["ManagedEntityRowId"], COMPUTER_PROPERTIES)
    name = F.lower(F.rtrim("Maschine"))
    one = computers.where(name == machine.rstrip().lower())
    shown = property_list(one, ["ManagedEntityRowId"], COMPUTER_PROPERTIES)
    return shown.drop("ManagedEntityRowId")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """The eight views under their usual names, for SQL users.

    ``tables`` holds SQLServer, Computer and SQLDatabase with derived columns, and the histories.
    """
    servers, dbs = tables["SQLServer"], tables["SQLDatabase"]
    views = {
        "vEdition": editions(servers),
        "vSQLMandant": customers_of_servers(servers),
        "vVersionen": releases(servers),
        "vComputerGrid": computer_grid(tables["Computer"]),
        "vDatabases": databases(dbs),
        "vDatabasesList": databases_list(dbs, servers),
        "vAlertsOperationsManagerDW": alerts(tables["AlertHistory"]),
        "vMaintenanceHistory": maintenance(tables["MaintenanceHistory"]),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
