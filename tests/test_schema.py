from datetime import datetime

import fixtures

from fleetmart import schemas
from fleetmart.operators import evolve, quality
from fleetmart.plans.refresh import new_columns
from fleetmart.sources import seeds
from fleetmart.sources.readers import Warehouse, read_parquet, type_catalogue
from fleetmart.sources.snapshots import Snapshots


def test_missing_columns(spark, rows):
    w, types = fixtures.warehouse(spark), fixtures.types(spark)
    targets = {t: spark.createDataFrame([], schemas.struct_of(t)) for t in ("SQLServer", "Computer", "SQLDatabase")}
    missing = new_columns(w.dictionary, types, targets)
    plan = evolve.extension_plan(missing.values())
    assert [tuple(r) for r in plan.collect()] == [
        ("SQLServer", "Shelf", "NVARCHAR(256) NULL", "(WhatIf – keine Aenderung)")
    ]
    done = evolve.extension_plan(missing.values(), what_if=False).first()
    assert done["Aktion"] == "ALTER TABLE wird ausgefuehrt"
    assert evolve.column_names(missing.values()) == {"SQLServer": ["Shelf"]}


def test_any_number_and_length_of_columns(spark):
    names = [f"c{i}" for i in range(6000)] + ["x" * 300]
    df = spark.createDataFrame([("T", n) for n in names], "Tabelle string, `Neue Spalte` string")
    assert sorted(evolve.column_names([df])["T"]) == sorted(names)
    assert evolve.extend_schema(spark.range(1), ["x" * 300]).failed == []


def test_extend_goes_on_after_a_failure(spark):
    df = spark.createDataFrame([(1,)], "ID long")
    outcome = evolve.extend_schema(df, ["a", "id", " ", "A", "b c"])
    assert (outcome.added, outcome.failed) == (["a", "b c"], ["id", " ", "A"])
    assert outcome.df.columns == ["ID", "a", "b c"]
    assert tuple(outcome.df.first()) == (1, None, None)


def test_rename_and_recast(spark, rows):
    df = spark.createDataFrame([("1", "7"), ("2", "x")], "Id string, n string")
    once = evolve.rename_column(df, "Id", "CustomerId")
    twice = evolve.rename_column(once, "Id", "CustomerId")
    assert twice.columns == ["CustomerId", "n"]
    assert rows(evolve.recast_column(twice, "n", "int")) == [("1", 7), ("2", None)]


def test_audits(spark, rows):
    df = spark.createDataFrame([(1, "abc"), (1, None), (None, "a  "), (2, "abcd")], "k long, v string")
    assert rows(quality.duplicates(df, ["k"])) == [(1, 2)]
    parents = spark.createDataFrame([(1,)], "p long")
    assert rows(quality.orphans(df, "k", parents, "p")) == [(2, "abcd")]
    assert rows(quality.nulls(df, ["k", "v"])) == [("k", 1), ("v", 1)]
    assert rows(quality.widths(df, {"v": 3})) == [("v", 3, 4, 1)]


def test_layouts_fit_together():
    for table in schemas.TABLES:
        columns = set(schemas.struct_of(table).names)
        assert set(schemas.KEYS.get(table, [])) <= columns
        assert set(schemas.NATURAL_KEYS.get(table, [])) <= columns
        assert set(schemas.REQUIRED[table]) <= columns
        assert set(schemas.declared_widths(table)) <= columns
        assert not set(schemas.DERIVED.get(table, [])) & columns
    assert len(schemas.struct_of("SQLServer").names) == 43


SEED = ["ManagedEntityRowId", "DisplayName", "DatabaseAutogrow", "Inserted"]


def test_dialects_load_to_equal_rows(spark, rows):
    a = seeds.seed_table(spark, "SQLDatabase", SEED, [(1, "x", "true", "20300102"), (2, "y", "false", None)])
    b = seeds.seed_table(spark, "SQLDatabase", SEED, [(1, "x", 1, "2030-01-02"), (2, "y", 0, None)])
    assert rows(a) == rows(b)
    row = a.where("ManagedEntityRowId = 1").first()
    assert (row.Inserted, row.DatabaseAutogrow, row.ID) == (datetime(2030, 1, 2), "true", None)
    guids = seeds.with_random_guid(a, "g").select("g").collect()
    assert len({r.g for r in guids}) == 2


def test_reload_is_idempotent(spark, rows, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    known = fixtures.lookups(spark)
    tables = {"CustomerDomain": known.domains, "Customer": known.customers}
    for _ in range(2):
        seeds.reload(store, tables)
    counts = seeds.row_counts({t: store.read(t) for t in tables})
    assert [tuple(r) for r in counts.collect()] == [("Customer", 3), ("CustomerDomain", 5)]
    first = store.log().where("commit = 1").orderBy("path").first()["table"]
    assert first == "Customer"


def test_snapshots(spark, rows, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    assert store.read("ExcludeDB").isEmpty() and store.last_commit() == 0
    one = seeds.seed_table(spark, "ExcludeDB", ["Name"], [("a",)])
    store.write({"ExcludeDB": one}, tag="first")
    # A version is made from the one before it.
    store.write({"ExcludeDB": store.read("ExcludeDB").union(one)})
    assert store.read("ExcludeDB").count() == 2
    assert store.read("ExcludeDB", commit=1).count() == 1
    assert store.has_tag("first") and not store.has_tag("second")
    store.stage("ExcludeDB", one.limit(0), "v00000003")  # not committed, so not seen
    assert store.read("ExcludeDB").count() == 2


def test_warehouse_from_parquet(spark, tmp_path):
    w = fixtures.warehouse(spark)
    frames = {
        "ManagedEntity": w.entities,
        "ManagedEntityProperty": w.properties,
        "ManagedEntityTypeProperty": w.dictionary,
        "AlertDetail": w.alerts,
        "MaintenanceModeHistory": w.windows,
    }
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}")
    found = Warehouse.from_parquet(spark, str(tmp_path))
    assert found.entities.count() == w.entities.count()
    assert found.alerts.schema["Severity"].dataType.simpleString() == "int"
    assert read_parquet(spark, f"{tmp_path}/ManagedEntity", "ManagedEntity").columns == w.entities.columns


def test_type_catalogue(spark):
    wide = schemas.conform(spark.range(1), "ManagedEntityType").withColumn("more", fixtures_lit())
    assert type_catalogue(wide).columns == schemas.struct_of("ManagedEntityType").names


def fixtures_lit():
    from pyspark.sql import functions as F

    return F.lit(1)


def test_audits_scan_each_table_once(spark, tmp_path, rows):
    from fleetmart.operators import quality

    domains = spark.createDataFrame(
        [(1, 1, "a"), (1, None, "b"), (2, 9, None), (3, 9, "c"), (None, 1, "d"), (None, 1, "e" * 300)],
        "DomainId int, CustomerId int, DomainDnsName string",
    )
    customers = spark.createDataFrame([(1, "x"), (2, None), (2, "y" * 300)], "CustomerId int, Name string")
    tables = {}
    for name, df in {"CustomerDomain": domains, "Customer": customers}.items():
        df.write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    found = quality.audit_tables(tables)
    shown = [(r.table_name, r.rule, r.column_name, r.n_bad) for r in found.collect()]
    assert set(shown) >= {
        ("CustomerDomain", "key", "DomainId", 2),
        ("CustomerDomain", "foreign key", "CustomerId", 2),
        ("CustomerDomain", "width", "DomainDnsName", 1),
        ("Customer", "key", "CustomerId", 1),
        ("Customer", "required", "Name", 1),
    }
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    alone = quality.audit_tables({"CustomerDomain": tables["CustomerDomain"]})
    assert "foreign key" not in {r.rule for r in alone.collect()}


def test_extend_table(spark, tmp_path, rows):
    from fleetmart.operators import evolve

    folder = f"{tmp_path}/t"
    spark.range(2).selectExpr("id", "'x' AS a").write.option("path", folder).format("parquet").saveAsTable("extended")
    try:
        done = evolve.extend_table(spark, "extended", ["b", "A", "", "c d", "b", "e`f"])
        assert (done.added, done.failed) == (["b", "c d", "e`f"], ["A", "", "b"])
        spark.sql("INSERT INTO extended VALUES (5, 'y', 'new', NULL, 'z')")
        assert rows(spark.table("extended")) == [(0, "x", None, None, None), (1, "x", None, None, None), (5, "y", "new", None, "z")]
        assert rows(evolve.read_evolved(spark, folder), "id", "b") == [(0, None), (1, None), (5, "new")]
    finally:
        spark.sql("DROP TABLE extended")
