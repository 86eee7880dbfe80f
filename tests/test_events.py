from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fleetmart.operators import events as E
from fleetmart.registry.events import BATCH_FILES, replayed

NOW = datetime(2030, 6, 1)
OLD = datetime(2030, 5, 1)
HISTORY = "ID long, k string, t timestamp_ntz, n int, end timestamp_ntz, note string, Imported timestamp_ntz"
DETAIL = "k string, t timestamp_ntz, n int, end timestamp_ntz, note string"
IN, OUT = datetime(2030, 5, 20), datetime(2030, 1, 1)
E1, E2 = datetime(2030, 5, 21), datetime(2030, 5, 22)


def history(spark):
    rows = [
        (1, "same", IN, 1, E1, "a", OLD),
        (2, "more", IN, 1, E1, "a", OLD),
        (3, "late", OUT, 1, E1, "a", OLD),
        (4, "undated", None, 1, E1, "a", OLD),
        (5, "open", IN, 1, None, "a", OLD),
        (9, "alone", IN, None, E1, "a", OLD),
    ]
    return spark.createDataFrame(rows, HISTORY)


def details(spark):
    rows = [
        ("same", IN, 1, E1, "b"),
        ("more", IN, 5, E1, "b"),
        ("more", IN, 4, E2, "c"),
        ("late", IN, 2, E1, "b"),
        ("open", IN, 1, E2, "b"),
        ("new", IN, 1, E1, "b"),
        ("new", IN, 2, E1, "z"),
        ("toolate", OUT, 1, E1, "b"),
        ("nodate", None, 1, E1, "b"),
    ]
    return spark.createDataFrame(rows, DETAIL)


def plan(spark, **options):
    rules = dict(
        key="k", ts_col="t", as_of=NOW, days=90, compare=["n"], update=["n"], prefer=["n"]
    )
    return E.plan_upsert(history(spark), details(spark), **{**rules, **options})


def test_actions(spark, side):
    done = {(r.k, r.ID): (r._action, r.n, r.note, r.Imported) for r in plan(spark).collect()}
    fresh = {k: v for k, v in done.items() if v[0] == E.INSERTED}
    assert {k[0]: v[1:] for k, v in fresh.items()} == {
        "late": (2, "b", NOW),  # its old row was purged in the same run
        "new": (2, "z", NOW),  # the greater count wins
    }
    assert sorted(k[1] for k in fresh) == [10, 11]
    assert done["same", 1] == (E.UNCHANGED, 1, "a", OLD)
    assert done["more", 2] == (E.UPDATED, 5, "a", NOW)
    assert done["late", 3][0] == E.PURGED
    assert done["undated", 4][0] == E.UNCHANGED
    assert done["alone", 9] == (E.UNCHANGED, None, "a", OLD)
    assert len(done) == 8


@pytest.mark.parametrize("null_safe, closed", [(True, True), (False, False)])
def test_open_windows_close(spark, null_safe, closed):
    planned = plan(
        spark, compare=["end"], update=["end", "note"], prefer=["end"], null_safe=null_safe
    )
    row = planned.where("k = 'open'").first()
    assert (row.end == E2 and row.note == "b") is closed


def test_upsert_and_metrics(spark):
    planned = plan(spark)
    assert E.import_metrics(planned).first().asDict() == {"imported": 3, "deleted": 1}
    rules = dict(
        key="k", ts_col="t", as_of=NOW, days=90, compare=["n"], update=["n"], prefer=["n"]
    )
    once = E.upsert_events(history(spark), details(spark), **rules)
    twice = E.upsert_events(once, details(spark), **rules)
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()
    assert once.count() == 7


def test_purge_and_recent(spark):
    kept = {r.k for r in E.purge(history(spark), "t", NOW, 90).collect()}
    assert kept == {"same", "more", "undated", "open", "alone"}
    assert "nodate" not in {r.k for r in E.recent(details(spark), "t", NOW, 90).collect()}


def test_hot_key(spark, side):
    """A third of the incoming rows repeat one key."""
    incoming = spark.range(9000).selectExpr(
        "case when id < 3000 then 'hot' else cast(id as string) end as k",
        "timestamp_ntz'2030-05-20' as t", "cast(id as int) as n",
        "cast(null as timestamp_ntz) as end", "'x' as note",
    )
    rules = dict(
        key="k", ts_col="t", as_of=NOW, days=90, compare=["n"], update=["n"], prefer=["n"]
    )
    done = E.upsert_events(history(spark), incoming, **rules)
    assert done.where("k = 'hot'").first().n == 2999
    assert done.agg(F.count("*"), F.countDistinct("ID")).first() == (6006, 6006)


def test_replayed_batches_have_files_for_many_tasks(spark, tmp_path):
    given = SimpleNamespace(spark=spark, sql=lambda _text: spark.range(2000).selectExpr("id", "id % 500 AS at"))
    feed = replayed(given, "", "at", str(tmp_path))
    assert feed.isStreaming and feed.columns == ["id", "at"]
    assert len(list((tmp_path / "feed").glob("*.parquet"))) > 2.5 * BATCH_FILES >= 20
    assert spark.read.parquet(f"{tmp_path}/feed").agg(F.count("*"), F.sum("id")).first() == (2000, 1999000)
