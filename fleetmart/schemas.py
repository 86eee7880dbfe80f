"""Column layouts of the warehouse sources and of the reporting tables.

Names, types and widths are fixed values: users' queries refer to them. Only stored columns are
listed; derived ones are added by ``plans.derived``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.functions.columns import KEY_TEXT, is_key_text

# Columns read from the warehouse.
SOURCES = {
    "ManagedEntity": """
        ManagedEntityRowId long, TopLevelHostManagedEntityRowId long, ManagementGroupRowId int,
        ManagedEntityGuid string, ManagedEntityTypeRowId int, FullName string, Path string,
        Name string, DisplayName string, ManagedEntityDefaultName string,
        DWCreatedDateTime timestamp_ntz""",
    "ManagedEntityProperty": """
        ManagedEntityRowId long, PropertyXML string, DWCreatedDateTime timestamp_ntz,
        ToDateTime timestamp_ntz""",
    "ManagedEntityType": """
        ManagedEntityTypeRowId int, ManagedEntityTypeGuid string, ManagementPackRowId int,
        ManagedEntityTypeSystemName string, ManagedEntityTypeDefaultName string,
        ManagedEntityTypeDefaultDescription string""",
    "ManagedEntityTypeProperty": """
        ManagedEntityTypeRowId int, PropertyGuid string, PropertySystemName string""",
    "AlertDetail": """
        AlertGuid string, ManagedEntityRowId long, Category string,
        MonitoringObjectDisplayName string, AlertName string, AlertDescription string,
        RaisedDateTime timestamp_ntz, Severity int, Priority int, RepeatCount int""",
    "MaintenanceModeHistory": """
        MaintenanceModeRowId long, ManagedEntityRowId long, StartDateTime timestamp_ntz,
        EndDateTime timestamp_ntz, ScheduledEndDateTime timestamp_ntz, UserId string,
        Comments string""",
}

# Stored columns of the reporting tables.
TABLES = {
    "Computer": """
        ID long, ManagedEntityRowId long, TopLevelHostManagedEntityRowId long,
        ManagedEntityTypeRowId long, ManagedEntityDefaultName string, Path string,
        FullName string, DisplayName string, Maschine string, DNSName string,
        DomainDnsName string, IPAddress string, LogicalProcessors string,
        NetbiosComputerName string, NetworkName string, OrganizationalUnit string,
        PhysicalProcessors string, PrincipalName string, SQLMandant string,
        SQLMonitoringType string, Virtual_Server_Type string, VirtualMachineName string,
        Modified date, Inserted date, IsSCOM boolean, DWCreatedDateTime date,
        NotFoundSince date, WindowsOS string""",
    "Customer": """
        CustomerId int, Name string, NameLong string, Address string, Zip string, City string,
        Notes string, Computers int, Installations int""",
    "CustomerDomain": """
        DomainId int, CustomerId int, DomainDnsName string, JumpServer1 string,
        JumpServer2 string, JumpServer3 string, JumpServer4 string, Notes string""",
    "ExcludeDB": "Name string",
    "ManagedEntityCompType": """
        ManagedEntityTypeRowId int, ManagedEntityTypeSystemName string""",
    "ManagedEntityDatabaseType": """
        ManagedEntityTypeRowId int, ManagedEntityTypeGuid string, ManagementPackRowId int,
        ManagedEntityTypeSystemName string, ManagedEntityTypeDefaultName string,
        ManagedEntityTypeDefaultDescription string, Aktive boolean""",
    "ManagedSQLEntityType": """
        ManagedEntityTypeRowId int, ManagedEntityTypeSystemName string, Description string,
        ManagedEntityTypeSQLId int, Aktiv boolean""",
    "SQLDatabase": """
        ID long, ManagedEntityRowId long, TopLevelHostManagedEntityRowId long, Path string,
        DisplayName string, ManagedEntityTypeRowId long, Collation string,
        DatabaseAutogrow string, DatabaseName string, LogAutogrow string, Owner string,
        RecoveryModel string, Updateability string, UserAccess string,
        NotFoundSince timestamp_ntz, Modified timestamp_ntz, Inserted timestamp_ntz""",
    "SQLServer": """
        ID long, ManagedEntityRowId long, TopLevelHostManagedEntityRowId long,
        ManagedEntityDefaultName string, DWCreatedDateTime timestamp_ntz, Changes int,
        Maschine string, Path string, Account string, AgentClusterName string,
        AgentName string, AuditLevel string, AuthenticationMode string, Cluster string,
        ConnectionString string, DisplayName string, Domain string, Edition string,
        EnableErrorReporting string, ErrorLogLocation string, FullName string,
        FullTextSearchServiceClusterName string, FullTextSearchServiceName string,
        InstallPath string, InstanceID string, InstanceName string, Language string,
        MasterDatabaseLocation string, MasterDatabaseLogLocation string,
        PrincipalName string, ReplicationDistributionDatabase string,
        ReplicationWorkingDirectory string, ServiceClusterName string, ServiceName string,
        ServicePackVersion string, TcpPorts string, ToolsPath string, Type string,
        Version string, Modified timestamp_ntz, Inserted timestamp_ntz, IsSCOM boolean,
        NotFoundSince timestamp_ntz""",
    "SQLVersion": "productversion string, sqlversion string",
    "Support": "VersionNr int, ReleaseDate date, EndOfMainstream date, EndofExtended date",
    "AlertHistory": """
        ID long, AlertGuid string, ManagedEntityRowId long, Category string,
        DisplayName string, Alertname string, AlertDescription string,
        RaisedDateTime timestamp_ntz, Severity string, Priority string, RepeatCount int,
        Imported timestamp_ntz""",
    "MaintenanceHistory": """
        ID long, MaintenanceRowId long, ManagedEntityRowId long, DisplayName string,
        StartDateTime timestamp_ntz, EndDateTime timestamp_ntz,
        ScheduledEndDateTime timestamp_ntz, UserId string, Comment string,
        Imported timestamp_ntz""",
}

# Primary and unique keys.
KEYS = {
    "Computer": ["ID"],
    "Customer": ["CustomerId"],
    "CustomerDomain": ["DomainId"],
    "ExcludeDB": ["Name"],
    "ManagedEntityDatabaseType": ["ManagedEntityTypeRowId"],
    "ManagedSQLEntityType": ["ManagedEntityTypeRowId"],
    "SQLDatabase": ["ID"],
    "SQLServer": ["ID"],
    "SQLVersion": ["productversion"],
    "AlertHistory": ["ID"],
    "MaintenanceHistory": ["ID"],
}
NATURAL_KEYS = {"AlertHistory": ["AlertGuid"], "MaintenanceHistory": ["MaintenanceRowId"]}

# Fixed values: (table, column, parent table, parent column).
FOREIGN_KEYS = [("CustomerDomain", "CustomerId", "Customer", "CustomerId")]

# Columns that may not be NULL.
REQUIRED = {
    "Computer": ["ID", "Inserted", "IsSCOM"],
    "Customer": ["CustomerId", "Name"],
    "CustomerDomain": ["DomainId", "DomainDnsName"],
    "ExcludeDB": ["Name"],
    "ManagedEntityCompType": ["ManagedEntityTypeRowId", "ManagedEntityTypeSystemName"],
    "ManagedEntityDatabaseType": [
        "ManagedEntityTypeRowId",
        "ManagedEntityTypeGuid",
        "ManagementPackRowId",
        "ManagedEntityTypeSystemName",
        "ManagedEntityTypeDefaultName",
        "Aktive",
    ],
    "ManagedSQLEntityType": ["ManagedEntityTypeRowId", "ManagedEntityTypeSystemName", "Aktiv"],
    "SQLDatabase": ["ID", "Inserted"],
    "SQLServer": ["ID", "ManagedEntityRowId", "Inserted", "IsSCOM"],
    "SQLVersion": ["productversion", "sqlversion"],
    "Support": ["VersionNr", "ReleaseDate", "EndOfMainstream", "EndofExtended"],
    "AlertHistory": ["ID", "AlertGuid", "ManagedEntityRowId", "Imported"],
    "MaintenanceHistory": ["ID", "MaintenanceRowId", "ManagedEntityRowId", "Imported"],
}

# Declared widths that differ from the table's usual text width.
TEXT_WIDTH = {"Computer": 256, "SQLServer": 256, "SQLDatabase": 255}
WIDTHS = {
    "Customer": {"Name": 50, "NameLong": 120, "Address": 120, "Zip": 50, "City": 120, "Notes": 1024},
    "CustomerDomain": {
        "DomainDnsName": 256,
        "JumpServer1": 256,
        "JumpServer2": 256,
        "JumpServer3": 256,
        "JumpServer4": 256,
        "Notes": 1024,
    },
    "ExcludeDB": {"Name": 50},
    "ManagedEntityCompType": {"ManagedEntityTypeSystemName": 255},
    "ManagedEntityDatabaseType": {
        "ManagedEntityTypeSystemName": 256,
        "ManagedEntityTypeDefaultName": 256,
    },
    "ManagedSQLEntityType": {"ManagedEntityTypeSystemName": 255, "Description": 255},
    "SQLVersion": {"productversion": 15, "sqlversion": 15},
    "AlertHistory": {
        "AlertGuid": 50,
        "Category": 256,
        "DisplayName": 256,
        "Alertname": 256,
        "Severity": 50,
        "Priority": 50,
    },
    "MaintenanceHistory": {"DisplayName": 256, "UserId": 256},
}

# Columns computed from others, never stored.
DERIVED = {
    "Computer": ["SQLCustomer", "NotFoundSinceDays"],
    "Customer": ["Domains"],
    "CustomerDomain": ["CustomerName", "CustomerShortName"],
    "SQLDatabase": ["DatabaseType", "NotFoundSinceDays", "tempPath"],
    "SQLServer": [
        "SQLMandantNameShort",
        "SQLMandantName",
        "VersionNr",
        "NotFoundSinceDay",
        "EndOfMainstream",
        "EndofExtended",
        "tempPath",
    ],
}

# Columns the property write-back must not touch: keys and bookkeeping.
PROTECTED = [
    "ID",
    "ManagedEntityRowId",
    "TopLevelHostManagedEntityRowId",
    "ManagedEntityTypeRowId",
    "DWCreatedDateTime",
    "Changes",
    "Modified",
    "Inserted",
    "IsSCOM",
    "NotFoundSince",
]


#: Column that tells the day an event history keeps a row under.
EVENT_TIMES = {"AlertHistory": "RaisedDateTime", "MaintenanceHistory": "StartDateTime"}


def struct_of(name: str) -> T.StructType:
    """Schema of a reporting table or warehouse source."""
    ddl = TABLES[name] if name in TABLES else SOURCES[name]
    return T.StructType.fromDDL(ddl)


# Columns whose names are compared without case and trailing blanks.
NAME_COLUMNS = {
    "ManagedEntity": ["Name", "DisplayName"],
    "SQLServer": ["Maschine"],
    "Computer": ["Maschine"],
    "ExcludeDB": ["Name"],
}


def with_key_texts(df: DataFrame, table: str) -> DataFrame:
    """The frame with its names in the type that compares as names do: joins, groups and filters then need no key."""
    names = [c for c in NAME_COLUMNS.get(table, []) if c in df.columns]
    return df.withColumns({c: F.col(c).cast(KEY_TEXT) for c in names}) if names else df


def check_key_texts(df: DataFrame, table: str) -> DataFrame:
    """The frame, if all its names have their type; read this way, no join can forget the key."""
    wrong = [c for c in NAME_COLUMNS.get(table, []) if c in df.columns and not is_key_text(df, c)]
    if wrong:
        raise TypeError(f"{table}: {', '.join(wrong)} must be {KEY_TEXT}")
    return df


def conform(df: DataFrame, table: str) -> DataFrame:
    """The frame in a table's columns and types; columns it lacks are NULL."""
    fields = struct_of(table).fields
    cells = [F.col(f.name) if f.name in df.columns else F.lit(None) for f in fields]
    return df.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cells, fields)])


def declared_widths(table: str) -> dict[str, int]:
    """Declared width of every text column of a reporting table."""
    if table in TEXT_WIDTH:
        texts = (f.name for f in struct_of(table).fields if f.dataType == T.StringType())
        return {name: TEXT_WIDTH[table] for name in texts}
    return WIDTHS.get(table, {})
