import fixtures
import pytest
from pyspark.sql import functions as F

from fleetmart.functions import columns as X
from fleetmart.plans import derived as D
from fleetmart.plans.sqlfunctions import register_functions
from fleetmart.schemas import conform


@pytest.fixture(scope="module")
def sql(spark):
    known = fixtures.lookups(spark)
    computers = spark.createDataFrame(
        [(1, "h1", "10.0.0.1", "oak.test")],
        "ManagedEntityRowId long, Maschine string, IPAddress string, DomainDnsName string",
    )
    register_functions(
        spark,
        {
            "Customer": known.customers,
            "CustomerDomain": known.domain_names(),
            "SQLVersion": known.versions,
            "Support": known.support,
            "ManagedEntityDatabaseType": known.database_types,
            "SQLServer": D.with_server_columns(fixtures.servers(spark), known, fixtures.NOW),
            "Computer": D.with_computer_columns(conform(computers, "Computer"), known, fixtures.NOW),
        },
    )
    return lambda text: [tuple(r) for r in spark.sql(text).collect()]


@pytest.mark.parametrize(
    "call, value",
    [
        ("GetCustomerName('OAK.test')", "Oak Mills Ltd"),
        ("GetCustomerName('test')", "Elm Foods Ltd"),
        ("GetCustomerName('fir')", "???"),
        ("GetCustomerName('none')", None),
        ("GetCustomerName('')", None),
        ("GetCustomerNameShort('fir')", "Fir"),
        ("GetCustomerNameLong(2)", "Elm Foods Ltd"),
        ("GetCustomerNameLong4Domain(9)", None),
        ("GetCustomerNameShort4Domain(2)", "Elm"),
        ("fn_CustDomainCount(2)", 2),
        ("fn_CustDomainCount(9)", 0),
        ("GetDatabaseType(30)", "Db.New"),
        ("GetSQLVersion('21.5.1')", "3001R2"),
        ("GetSQLVersion('21.5.1  ')", "3001R2"),
        ("GetEndOfMainstream('21.0')", "3006-02-03"),
        ("GetEndofExtended('22.1')", "3012-02-03"),
        ("GetEndofExtended('21.5')", None),
    ],
)
def test_single_lookups(sql, call, value):
    assert sql(f"SELECT {call}") == [(value,)]


def test_text_functions_equal_the_columns(spark, sql):
    values = ["T:srv.domain.corp.MAIN", "T:a;b;c", "plain.x ", "none", "", None, "T:one.I"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    df.createOrReplaceTempView("texts")
    v = F.col("v")
    expected = df.select(X.domain_of(v), X.machine_of(v), X.build_path(v), X.replace_last(v, ";", "-"), X.replace_last(v, " ", "-"))
    found = sql(
        "SELECT CutDomain(v), CutMaschine(v), BuildPath(v), ReplaceLastOccurrence(v, ';', '-'), "
        "ReplaceLastOccurrence(v, ' ', '-') FROM texts"
    )
    assert found == [tuple(r) for r in expected.collect()]


def test_list_functions(sql):
    assert ("VersionNr", "3001") in sql("SELECT * FROM SQLPropList(1)")
    assert sql("SELECT * FROM SQLPropList(99)") == []
    assert sorted(sql("SELECT * FROM ComputerPropList('H1')")) == [
        ("DomainDnsName", "oak.test"),
        ("IPAddress", "10.0.0.1"),
        ("Maschine", "h1"),
        ("SQLCustomer", "Oak Mills Ltd"),
    ]


def test_functions_beside_rows_are_joins(spark, sql):
    """Key lookups and list functions decorrelate into equality joins."""
    spark.range(5).selectExpr("id", "cast(id as int) as k", "concat('H', id) as name").createOrReplaceTempView("beside")
    texts = [
        "SELECT id, GetCustomerNameLong(k), GetCustomerNameLong4Domain(k), GetCustomerNameShort4Domain(k), fn_CustDomainCount(k), GetDatabaseType(k) FROM beside",
        "SELECT id, p.* FROM beside, LATERAL SQLPropList(id) AS p",
        "SELECT id, p.* FROM beside, LATERAL ComputerPropList(name) AS p",
    ]
    for text in texts:
        plan = spark.sql(text)._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sql("SELECT id, fn_CustDomainCount(k) FROM beside ORDER BY id") == [(0, 0), (1, 1), (2, 2), (3, 1), (4, 0)]
    assert (1, "IPAddress", "10.0.0.1") in sql(texts[2])
    assert (1, "VersionNr", "3001") in sql(texts[1]) and (0, "VersionNr", "3001") not in sql(texts[1])
