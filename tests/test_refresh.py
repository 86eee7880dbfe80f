import re
from dataclasses import replace
from datetime import date, datetime, timedelta

import fixtures
import pytest
from pyspark.sql import functions as F

from fleetmart.plans import derived as D
from fleetmart.plans import inventory as I
from fleetmart.plans import refresh as R
from fleetmart.plans import views
from fleetmart.plans.histories import of_days, stage_load
from fleetmart.sources.snapshots import Snapshots
from fleetmart.streaming import upserts

NOW = fixtures.NOW


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    store = Snapshots(spark, str(tmp_path_factory.mktemp("mart")))
    report = R.refresh(store, fixtures.warehouse(spark), fixtures.types(spark), NOW)
    return store, report


def test_first_run(done, rows):
    store, report = done
    servers = store.read("SQLServer")
    assert rows(servers, "ManagedEntityRowId", "Maschine", "Domain", "Path", "Changes", "IsSCOM") == [
        (1, "h1", "oak.test", "h1.oak.test.MAIN", 3, True),
        (2, "h2", "elm.test", "h2.elm.test.MAIN", 2, True),
    ]
    assert rows(servers, "ManagedEntityRowId", "Version", "edition", "Shelf", "DWCreatedDateTime") == [
        (1, "21.5.7", "big's edition", None, datetime(2030, 2, 1)),
        (2, "22.1", None, "x" * 100, datetime(2030, 1, 1, 10, 20)),
    ]
    assert rows(
        store.read("Computer"), "ManagedEntityRowId", "IPAddress", "DNSName", "WindowsOS", "IsSCOM"
    ) == [(101, "10.0.0.1", "", "System B", False), (102, None, None, None, False)]
    databases = store.read("SQLDatabase")
    assert rows(databases, "ManagedEntityRowId", "Path", "DisplayName", "Owner") == [
        (201, "21.0:h1:sales", "sales", "sa"),
    ]
    assert rows(store.read("AlertHistory"), "AlertGuid", "Severity", "Priority") == [
        ("A-1", "Error", "Medium"),
        ("A-2", "Information", "7"),
    ]
    assert rows(store.read("MaintenanceHistory"), "MaintenanceRowId", "DisplayName") == [
        (1, "H1 computer")
    ]
    assert report.added == {"SQLServer": ["Shelf"], "Computer": [], "SQLDatabase": []}
    assert report.metrics["AlertHistory"] == {"imported": 2, "deleted": 0}


def test_second_run_changes_nothing(spark, done, rows):
    store, first = done
    report = R.refresh(store, fixtures.warehouse(spark), fixtures.types(spark), NOW)
    assert report.metrics["AlertHistory"] == {"imported": 0, "deleted": 0}
    for table in (*R.INVENTORIES, "AlertHistory", "MaintenanceHistory"):
        before, after = store.read(table, first.commit), store.read(table)
        assert sorted(before.columns) == sorted(after.columns)
        assert rows(before, *sorted(before.columns)) == rows(after, *sorted(before.columns))


def test_vanished_entity_and_retention(spark, done, rows):
    store, _ = done
    later = NOW + timedelta(days=120)
    w = fixtures.warehouse(spark)
    w.entities = w.entities.where("ManagedEntityRowId <> 2")
    before = store.last_commit()
    report = R.refresh(store, w, fixtures.types(spark), later)
    gone = store.read("SQLServer").where("NotFoundSince is not null")
    assert rows(gone, "ManagedEntityRowId", "NotFoundSince") == [(2, later)]
    assert report.metrics["AlertHistory"] == {"imported": 0, "deleted": 2}
    assert store.read("AlertHistory").isEmpty()
    assert store.read("AlertHistory", before).count() == 2


def test_failed_run_leaves_the_old_state(spark, done, monkeypatch, rows):
    store, _ = done
    before, commit = rows(store.read("SQLServer")), store.last_commit()

    def fail(*_args, **_options):
        raise RuntimeError("lost")

    monkeypatch.setattr(R.I, "maintenance_source", fail)
    with pytest.raises(RuntimeError):
        R.refresh(store, fixtures.warehouse(spark), fixtures.types(spark), NOW + timedelta(days=1))
    assert store.last_commit() == commit
    assert rows(store.read("SQLServer")) == before


def test_path_repair(spark, done, rows):
    store, _ = done
    R.repair_paths(store)
    assert rows(store.read("SQLDatabase"), "ManagedEntityRowId", "Path") == [
        (201, "h1.oak.test.MAIN"),
    ]


def test_views(spark, done, rows):
    store, first = done
    known = fixtures.lookups(spark)
    tables = {
        "SQLServer": D.with_server_columns(store.read("SQLServer", 1), known, NOW),
        "Computer": D.with_computer_columns(store.read("Computer", 1), known, NOW),
        "SQLDatabase": D.with_database_columns(store.read("SQLDatabase", 1), known, NOW),
        "AlertHistory": store.read("AlertHistory", 1),
        "MaintenanceHistory": store.read("MaintenanceHistory", 1),
    }
    views.register_views(tables)
    assert rows(spark.table("vSQLMandant")) == [("Elm Foods Ltd", 1), ("Oak Mills Ltd", 1)]
    listed = spark.table("vDatabasesList")
    assert rows(listed, "ID", "DatabaseName", "Domain", "VersionNr", "SQLMandantNameShort") == [
        (201, "sales", "oak.test", "3001R2", "Oak"),
    ]
    assert rows(spark.table("vDatabases"), "DatabaseType", "symbol") == [("Db.New", "")]
    assert rows(spark.table("vAlertsOperationsManagerDW"), "AlertGuid") == [(1,), (2,)]
    assert spark.table("vMaintenanceHistory").count() == 1
    assert spark.table("vComputerGrid").count() == 2
    assert spark.table("vEdition").count() == 1
    shown = views.computer_properties(tables["Computer"], "H1 ")
    assert ("IPAddress", "10.0.0.1") in rows(shown)


def test_stream_equals_batch(spark, tmp_path, rows):
    """Counts that rise from file to file, and the same file delivered again."""
    store = Snapshots(spark, f"{tmp_path}/state")
    known = spark.createDataFrame([(1,)], "ManagedEntityRowId long")
    base = fixtures.warehouse(spark).alerts.where("AlertGuid = '{a-1}'")
    for count in (1, 4, 9):
        one = base.selectExpr("* except (RepeatCount)", f"{count} as RepeatCount").coalesce(1)
        one.write.mode("append").parquet(f"{tmp_path}/feed")
    for _ in range(2):
        stream = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1)
        run = upserts.stream_alerts(
            stream.parquet(f"{tmp_path}/feed"), store, known, NOW, f"{tmp_path}/progress"
        )
        run.awaitTermination()
    assert rows(store.read("AlertHistory"), "ID", "AlertGuid", "RepeatCount") == [(1, "A-1", 9)]
    assert store.last_commit() == 3


def test_batch_delivered_twice_counts_once(spark, tmp_path):
    store = Snapshots(spark, f"{tmp_path}/state")
    base = fixtures.warehouse(spark).alerts
    base.coalesce(1).write.parquet(f"{tmp_path}/feed")
    known = spark.createDataFrame([(1,), (101,)], "ManagedEntityRowId long")
    store.commit({"Marker": "-"}, tag=f"{tmp_path}/progress#0")  # batch 0 is done
    stream = spark.readStream.schema(base.schema).parquet(f"{tmp_path}/feed")
    upserts.stream_alerts(stream, store, known, NOW, f"{tmp_path}/progress").awaitTermination()
    assert store.read("AlertHistory").isEmpty()


def test_a_load_writes_the_days_it_changes(spark, tmp_path, rows):
    """Other days keep their files, purged days go, rows without a date have a part of their own."""
    store = Snapshots(spark, f"{tmp_path}/state")
    old = spark.sql(
        """SELECT id AS ID, concat('A-', id) AS AlertGuid, 1L AS ManagedEntityRowId, 'c' AS Category,
                  'd' AS DisplayName, 'n' AS Alertname, CAST(NULL AS STRING) AS AlertDescription,
                  CASE WHEN id < 40 THEN timestamp_ntz'2030-01-01 08:00:00' + make_dt_interval(CAST(id % 4 AS INT)) END
                      AS RaisedDateTime,
                  'old' AS Severity, 'old' AS Priority, 1 AS RepeatCount,
                  timestamp_ntz'2030-01-05' AS Imported
           FROM range(1, 50)"""
    )
    store.write({"AlertHistory": old})
    before = store.paths()
    assert len(before) == 5
    assert rows(store.read("AlertHistory")) == rows(old)
    source = old.where("ID IN (5, 45)").withColumn("RepeatCount", F.lit(9)).unionByName(
        old.where("ID = 3").withColumns(
            {"AlertGuid": F.lit("B-1"), "RaisedDateTime": F.expr("timestamp_ntz'2030-02-01'")}
        )
    ).drop("ID", "Imported")
    as_of = datetime(2030, 3, 1)

    def plan(history):
        return I.plan_alerts(history, source, as_of, days=58)  # from 2 January on

    load = stage_load(store, "AlertHistory", plan, "v00000002")
    assert load.metrics == {"imported": 2, "deleted": 9}
    store.commit(load.paths)
    after = store.paths()
    day = "AlertHistory/_day="
    assert f"{day}2030-01-01" in before and f"{day}2030-01-01" not in after
    assert {d for d in after if after[d] != before.get(d)} == {f"{day}2030-01-02", f"{day}2030-02-01"}
    history = store.read("AlertHistory")
    assert history.where("AlertGuid = 'A-5'").first().RepeatCount == 9
    assert history.agg(F.count("*"), F.countDistinct("ID"), F.max("ID")).first() == (41, 41, 50)
    pruned = of_days(store.read_days("AlertHistory"), [date(2030, 1, 3), None])
    assert re.search(r"PartitionFilters: \[[^\]]*_day", pruned._jdf.queryExecution().toString())
    assert pruned.count() == 20
    store.write({"AlertHistory": old.where("ID = 45")})
    assert rows(store.read("AlertHistory")) == rows(old.where("ID = 45"))


def test_a_failed_run_goes_on_where_it_failed(spark, tmp_path, monkeypatch, rows):
    """The seventh step fails; the rerun does none of the six before it and ends like a run that never failed."""
    stores = [Snapshots(spark, f"{tmp_path}/{name}") for name in ("failed", "whole")]
    made = []

    def noting(name):
        real = getattr(I, name)

        def noted(*args, **options):
            made.append(name)
            return real(*args, **options)

        return noted

    def fail(*_args, **_options):
        raise RuntimeError("lost")

    sources = ["server_source", "computer_source", "update_os", "database_source", "alert_source"]
    for name in sources:
        monkeypatch.setattr(R.I, name, noting(name))
    with monkeypatch.context() as broken:
        broken.setattr(R.I, "sync_databases", fail)
        with pytest.raises(RuntimeError):
            R.refresh(stores[0], fixtures.warehouse(spark), fixtures.types(spark), NOW)
    assert stores[0].last_commit() == 0
    made.clear()
    # A new object, as a new driver would have.
    stores[0] = Snapshots(spark, stores[0].root)
    report = R.refresh(stores[0], fixtures.warehouse(spark), fixtures.types(spark), NOW)
    assert made == ["database_source", "alert_source"]
    assert report.added["SQLServer"] == ["Shelf"] and report.metrics["AlertHistory"]["imported"] == 2
    R.refresh(stores[1], fixtures.warehouse(spark), fixtures.types(spark), NOW)
    for table in (*R.INVENTORIES, "AlertHistory", "MaintenanceHistory"):
        one, other = (s.read(table) for s in stores)
        assert rows(one, *sorted(one.columns)) == rows(other, *sorted(one.columns))
    # The journal of a committed run does not stand for a later one.
    made.clear()
    R.refresh(stores[0], fixtures.warehouse(spark), fixtures.types(spark), NOW)
    assert made == sources


def test_the_warehouse_is_read_once(spark, tmp_path):
    """Entities are read once for all steps, the history of properties to count its versions and to take it apart."""
    plain = fixtures.warehouse(spark)
    seen = {name: spark.sparkContext.accumulator(0) for name in ("entities", "properties")}

    def noting(name):
        df, rows_read = getattr(plain, name), seen[name]

        def passed(batches):
            for batch in batches:
                rows_read.add(batch.num_rows)
                yield batch

        return df.mapInArrow(passed, df.schema)

    R.refresh(Snapshots(spark, str(tmp_path)), replace(plain, **{n: noting(n) for n in seen}), fixtures.types(spark), NOW)
    assert seen["entities"].value == plain.entities.count()
    assert seen["properties"].value == 2 * plain.properties.count()
