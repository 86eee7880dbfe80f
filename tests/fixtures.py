"""A small invented estate: two customers, their servers, computers, databases and events."""

from datetime import datetime

from fleetmart.plans.derived import Lookups
from fleetmart.plans.refresh import TypeTables
from fleetmart.schemas import conform
from fleetmart.sources.readers import Warehouse
from fleetmart.sources.seeds import seed_table

NOW = datetime(2030, 5, 10, 8, 30)


def lookups(spark) -> Lookups:
    return Lookups(
        customers=seed_table(
            spark,
            "Customer",
            ["Id", "Name", "NameLong"],
            [(1, "Oak", "Oak Mills Ltd"), (2, "Elm", "Elm Foods Ltd"), (3, "Fir", None)],
        ),
        domains=seed_table(
            spark,
            "CustomerDomain",
            ["DomainId", "CustomerId", "DomainDnsName"],
            [
                (1, 1, "oak.test"),
                (2, 2, "elm.test"),
                (3, 3, "fir.test"),
                (4, None, "spare.test"),
                (5, 2, "shop.elm.test"),
            ],
        ),
        versions=seed_table(
            spark,
            "SQLVersion",
            ["productversion", "sqlversion"],
            [("21.", "3001"), ("21.5", "3001R2"), ("22.", "3002")],
        ),
        support=seed_table(
            spark,
            "Support",
            ["VersionNr", "ReleaseDate", "EndOfMainstream", "EndofExtended"],
            [(3001, "30010203", "30060203", "30110203"), (3002, "3002-02-03", "3007-02-03", "3012-02-03")],
        ),
        database_types=database_types(spark),
    )


def database_types(spark):
    return seed_table(
        spark,
        "ManagedEntityDatabaseType",
        ["ManagedEntityTypeRowId", "ManagedEntityTypeSystemName", "Aktive"],
        [(30, "Db.New", 1), (31, "Db.Old", 0)],
    )


def types(spark) -> TypeTables:
    return TypeTables(
        servers=seed_table(
            spark,
            "ManagedSQLEntityType",
            ["ManagedEntityTypeRowId", "ManagedEntityTypeSystemName", "Aktiv"],
            [(10, "Engine.New", "true"), (11, "Engine.Old", "false")],
        ),
        computers=seed_table(
            spark, "ManagedEntityCompType", ["ManagedEntityTypeRowId"], [(20,)]
        ),
        databases=database_types(spark),
        excluded=seed_table(spark, "ExcludeDB", ["Name"], [("sysdb",)]),
    )


def xml(*pairs) -> str:
    return "<Root>" + "".join(f'<Property Guid="{g}">{v}</Property>' for g, v in pairs) + "</Root>"


ENTITY = """ManagedEntityRowId long, TopLevelHostManagedEntityRowId long, ManagedEntityTypeRowId int,
FullName string, Path string, Name string, DisplayName string, ManagedEntityDefaultName string,
DWCreatedDateTime timestamp_ntz"""
T1, T2 = datetime(2030, 1, 1, 10, 20, 59), datetime(2030, 2, 1)


def warehouse(spark) -> Warehouse:
    entities = [
        (1, 101, 10, "E:h1.oak.test.MAIN", "p", "h1.MAIN", "h1", "H1", T1),
        (2, 102, 10, "E:h2;elm.test.MAIN", "p", "h2;MAIN", "h2", "H2", T1),
        (3, 103, 11, "E:h3.elm.test.MAIN", "p", "h3.MAIN", "h3", "H3", T1),
        (4, 104, 10, "E:h4.elm.test.MAIN", "p", "h4.MAIN", "h4", "H4", T1),
        (101, 101, 20, "C:h1.oak.test", "p", "H1", "h1", "H1 computer", T1),
        (102, 102, 20, "C:h2.elm.test", "p", "h2 ", "h2", "H2 computer", T1),
        (105, 105, 20, "C:h5.elm.test", "p", "h5", "h5", "H5 computer", T1),
        (201, 1, 30, "D:x", "21.0;h1;sales", "sales", "sales", "sales", T1),
        (202, 1, 30, "D:x", "21.0;h1;sys", "sys", "SysDb", "sys", T1),
        (203, 2, 31, "D:x", "21.0;h2;old", "old", "old", "old", T1),
        (204, 2, 30, "D:x", "21.0;h2;none", "none", None, "none", T1),
        (301, 101, 62, "O:1", "p", "os", "os", "System A", T1),
        (302, 101, 62, "O:2", "p", "os", "os", "System B", T1),
    ]
    properties = [
        (1, xml(("{aaaa-1}", "21.0.7"), ("AAAA-2", "Big Edition")), T1, T2),
        (1, xml(("{aaaa-1}", "21.5.7"), ("AAAA-2", "Big's Edition")), T2, None),
        (1, xml(("AAAA-9", "ignored")), T1, None),
        (2, xml(("aaaa-1", "22.1"), ("aaaa-3", "x" * 150)), T1, None),
        (2, "<Root><Property", T1, None),
        (4, xml(("aaaa-1", "22.1")), T1, T2),
        (101, xml(("bbbb-1", "10.0.0.1"), ("bbbb-2", "")), T1, None),
        (201, xml(("cccc-1", "SA"), ("cccc-2", "9999")), T1, None),
        (202, xml(("cccc-1", "SA")), T1, None),
        (204, "<Root/>", T1, None),
    ]
    dictionary = [
        (10, "AAAA-1", "Version"),
        (11, "AAAA-1", "Version"),
        (10, "AAAA-2", "edition"),
        (10, "AAAA-3", "Shelf"),
        (10, "AAAA-4", None),
        (20, "BBBB-1", "IPAddress"),
        (20, "BBBB-2", "DNSName"),
        (30, "CCCC-1", "Owner"),
        (30, "CCCC-2", "ManagedEntityRowId"),
        (31, "CCCC-3", "Inactive"),
    ]
    alerts = [
        ("{a-1}", 1, "c", "h1", "disk", "d", datetime(2030, 5, 1), 2, 1, 3),
        ("a-2", 101, "c", "h1", "cpu", "d", datetime(2030, 5, 2), 0, 7, 1),
        ("a-3", 999, "c", "h9", "cpu", "d", datetime(2030, 5, 2), 0, 0, 1),
        ("a-4", 1, "c", "h1", "old", "d", datetime(2029, 5, 2), 0, 0, 1),
    ]
    windows = [
        (1, 101, datetime(2030, 5, 1), None, datetime(2030, 5, 3), "u", "first"),
        (2, 1, datetime(2030, 5, 1), None, datetime(2030, 5, 3), "u", "server"),
        (3, 102, datetime(2028, 5, 1), None, datetime(2028, 5, 3), "u", "late"),
    ]
    make = spark.createDataFrame
    return Warehouse(
        entities=conform(make(entities, ENTITY), "ManagedEntity"),
        properties=make(
            properties,
            "ManagedEntityRowId long, PropertyXML string, DWCreatedDateTime timestamp_ntz, "
            "ToDateTime timestamp_ntz",
        ),
        dictionary=make(
            dictionary,
            "ManagedEntityTypeRowId int, PropertyGuid string, PropertySystemName string",
        ),
        alerts=make(
            alerts,
            "AlertGuid string, ManagedEntityRowId long, Category string, "
            "MonitoringObjectDisplayName string, AlertName string, AlertDescription string, "
            "RaisedDateTime timestamp_ntz, Severity int, Priority int, RepeatCount int",
        ),
        windows=make(
            windows,
            "MaintenanceModeRowId long, ManagedEntityRowId long, StartDateTime timestamp_ntz, "
            "EndDateTime timestamp_ntz, ScheduledEndDateTime timestamp_ntz, UserId string, "
            "Comments string",
        ),
    )


SERVER = """ID long, ManagedEntityRowId long, Domain string, Maschine string, Version string,
Edition string, NotFoundSince timestamp_ntz"""


def servers(spark):
    gone = datetime(2030, 5, 8, 23, 59)
    rows = [
        (1, 1, "oak.test", "h1", "21.0.7", "Big", None),
        (2, 2, "elm.test", "h2", "21.5.1", "Big", None),
        (3, 3, "nowhere", "h3", "22.1", None, None),
        (4, 4, "fir.test", "h4", "2", "Small", None),
        (5, 5, "oak.test", "h5", "22.1", "Small", gone),
    ]
    return conform(spark.createDataFrame(rows, SERVER), "SQLServer")
