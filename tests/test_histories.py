"""Loads through the key index: days opened, one execution, ids that never come back, packs, expiry."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetmart.operators import events as E
from fleetmart.plans.histories import load_history
from fleetmart.schemas import conform
from fleetmart.sources import files, snapshots
from fleetmart.sources.expiry import expire
from fleetmart.sources.keyindex import DAY, sketch_bits, sketch_word
from fleetmart.sources.snapshots import Snapshots

NOW = datetime(2030, 3, 1)
START = datetime(2030, 1, 1, 8)


def alerts(spark, rows):
    """(guid, days after START or None, count)."""
    made = [(g, None if d is None else START + timedelta(days=d), n) for g, d, n in rows]
    frame = spark.createDataFrame(made, "AlertGuid string, RaisedDateTime timestamp_ntz, RepeatCount int")
    return conform(frame, "AlertHistory").drop("ID", "Imported")


def filled(spark, root, days=30, per_day=4):
    store = Snapshots(spark, root)
    old = alerts(spark, [(f"G-{d}-{i}", d, 1) for d in range(days) for i in range(per_day)] + [("G-none", None, 1)])
    order = F.row_number().over(Window.orderBy(F.col("RaisedDateTime").asc_nulls_first(), "AlertGuid"))
    store.write({"AlertHistory": old.select(order.cast("long").alias("ID"), "*", F.lit(START).alias("Imported"))})
    return store


def load(store, source, as_of=NOW, days=90):
    number = store.last_commit() + 1
    done = load_history(store, "AlertHistory", source, as_of, f"v{number:08d}", days=days)
    store.commit(done.paths, "load", number)
    return done


def test_only_days_that_may_hold_a_key_are_opened(spark, tmp_path, rows):
    store = filled(spark, f"{tmp_path}/s")
    before = store.paths()
    source = alerts(spark, [("G-3-1", 3, 9), ("G-7-2", 7, 1), ("G-none", 5, 4), ("new", 40, 1), ("new", 40, 2), (None, 3, 1)])
    # G-none comes with a date now, G-7-2 as it was.
    done = load(store, source)
    assert done.opened == {date(2030, 1, 4), date(2030, 1, 8), None}
    assert done.metrics == {"imported": 3, "deleted": 0}
    after = store.paths()
    changed = {p.split("=")[1] for p in after if after[p] != before.get(p)}
    assert changed == {"2030-01-04", "2030-02-10", snapshots.NO_DAY}
    history = store.read("AlertHistory")
    assert rows(history.where("RepeatCount > 1"), "AlertGuid", "RepeatCount", "ID") == [("G-3-1", 9, 15), ("G-none", 4, 1), ("new", 2, 122)]
    assert history.count() == 122


@pytest.mark.parametrize("seed", [1, 2])
def test_same_rows_as_the_whole_plan(spark, tmp_path, rows, seed):
    """Random loads, with keys that come again on other days, against the plan over the whole history."""
    rng = random.Random(seed)
    store = filled(spark, f"{tmp_path}/s", days=25)
    whole = store.read("AlertHistory")
    for step in range(2):
        keys = [f"G-{rng.randrange(30)}-{rng.randrange(5)}" for _ in range(25)]
        source = alerts(spark, [(k, rng.choice([None, *range(40)]), rng.randrange(3)) for k in keys])
        as_of = NOW + timedelta(days=5 * step, hours=9)
        planned = E.plan_upsert(whole, source, as_of=as_of, days=60, **E.ALERT_RULES)
        metrics = E.import_metrics(planned).first().asDict()
        done = load(store, source, as_of, 60)
        assert done.metrics == metrics
        columns = [c for c in whole.columns if c != "ID"]
        whole = spark.createDataFrame(planned.where("_action <> 'purged'").drop("_action").collect(), whole.schema)
        assert rows(store.read("AlertHistory"), *columns) == rows(whole, *columns)


def test_no_day_is_missed(spark, tmp_path):
    """Every day that holds a key is named, whatever else is; days out of the keys' range are not."""
    store = filled(spark, f"{tmp_path}/s", days=40, per_day=30)
    held = store.read_days("AlertHistory").select("AlertGuid", DAY).collect()
    rng = random.Random(4)
    for size in (1, 7, 200):
        picked = rng.sample(held, size)
        keys = spark.createDataFrame([(r.AlertGuid,) for r in picked] + [("unknown",)], "k string")
        assert store.days_holding("AlertHistory", keys) >= {r[DAY] for r in picked}
    assert store.days_holding("AlertHistory", spark.createDataFrame([("a",), ("zzz",)], "k string")) == set()
    assert store.days_holding("AlertHistory", spark.createDataFrame([], "k string")) == set()


def test_sketches_merge(spark):
    """Bits of any two parts, put together by bit_or, are those of the whole."""
    df = spark.range(2000).select("id", sketch_word(F.col("id"), "bigint").alias("w"), sketch_bits(F.col("id"), "bigint").alias("b"))
    parts = df.groupBy("w", (F.col("id") % 3).alias("p")).agg(F.bit_or("b").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    whole = df.groupBy("w").agg(F.bit_or("b").alias("b"))
    assert parts.exceptAll(whole).isEmpty() and whole.exceptAll(parts).isEmpty()
    assert df.where(F.bit_count("b") == 0).isEmpty()


def test_a_load_runs_its_source_and_merge_once(spark, tmp_path):
    """Rows are counted as they pass: the incoming ones twice (their keys, then the new rows), merged ones once."""
    store = filled(spark, f"{tmp_path}/s")
    passed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    source = alerts(spark, [("G-3-1", 3, 9), ("new", 3, 1)])
    merged = []
    real = snapshots.Snapshots.stage_days

    def noting(self, table, df, *args):
        merged.append(df)
        return real(self, table, df.mapInArrow(counted, df.schema), *args)

    snapshots.Snapshots.stage_days = noting
    try:
        done = load(store, source)
    finally:
        snapshots.Snapshots.stage_days = real
    assert passed.value == 5 and len(merged) == 1  # four old rows of the day and a new one
    assert done.metrics == {"imported": 2, "deleted": 0}


def test_ids_do_not_come_back(spark, tmp_path, rows, monkeypatch):
    store = filled(spark, f"{tmp_path}/s", days=3)
    assert load(store, alerts(spark, [("late", 50, 1)])).metrics["imported"] == 1
    assert store.read("AlertHistory").agg(F.max("ID")).first()[0] == 14
    # All but the undated row is purged; the highest ids are gone from the table.
    assert load(store, alerts(spark, []), NOW + timedelta(days=400)).metrics == {"imported": 0, "deleted": 13}
    later = NOW + timedelta(days=400)

    def fail(*_args, **_options):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(snapshots.Snapshots, "stage_days", fail)
        with pytest.raises(RuntimeError):
            load(store, alerts(spark, [("x", 450, 1), ("y", 450, 1)]), later)
    store = Snapshots(spark, store.root)
    load(store, alerts(spark, [("x", 450, 1), ("y", 450, 1)]), later)
    # The failed run's two ids are a gap.
    assert [r[0] for r in rows(store.read("AlertHistory"), "ID")] == [1, 17, 18]


def test_ids_of_a_table_written_whole(spark, tmp_path):
    store = filled(spark, f"{tmp_path}/s", days=2)
    load(store, alerts(spark, []), NOW + timedelta(days=400))
    assert store.claim_ids("AlertHistory", 1, 0) == 9


def test_packs(spark, tmp_path, rows, monkeypatch):
    """Many days share files, a few do not; small ones are put together, full packs stay."""
    monkeypatch.setattr(snapshots, "PACK_ROWS", 40)
    store = filled(spark, f"{tmp_path}/s", days=30)
    all_rows = rows(store.read("AlertHistory"))
    packs = set(store.paths().values())
    assert 3 <= len(packs) <= 4 and all(f"/{snapshots.PACK}=" in p for p in packs)
    load(store, alerts(spark, [(f"G-{d}-0", d, 7) for d in (0, 11, 12)]))
    assert sum(f"/{DAY}=" in p for p in store.paths().values()) == 3
    assert store.read("AlertHistory").count() == len(all_rows)
    kept = rows(store.read("AlertHistory"))
    assert store.pack("AlertHistory") == 0  # three loose days and no small pack
    monkeypatch.setattr(snapshots, "PACK_ROWS", 1000)
    number = store.pack("AlertHistory")
    assert number == 3 and len(set(store.paths().values())) == 1
    assert rows(store.read("AlertHistory")) == kept
    assert rows(store.read("AlertHistory", commit=1)) == all_rows
    assert len(store.facts("AlertHistory")) == 31
    one = store.read_days("AlertHistory", [date(2030, 1, 3), None])
    assert one.count() == 5


def test_expiry(spark, tmp_path, rows):
    store = filled(spark, f"{tmp_path}/s")
    for n in (2, 3, 4):
        load(store, alerts(spark, [("G-3-1", 3, n), (f"new-{n}", 40 + n, 1)]))
    name = spark.createDataFrame([("a",)], "Name string")
    store.write({"ExcludeDB": name}, tag="feed#1")
    store.stage("ExcludeDB", name, "v99")  # of a run that failed
    last = store.last_commit()
    before = {c: rows(store.read("AlertHistory", commit=c)) for c in (last - 1, last)}
    done = expire(store, keep=2)
    assert 0 < done.files_after < done.files_before
    for s in (store, Snapshots(spark, store.root)):
        assert {c: rows(s.read("AlertHistory", commit=c)) for c in before} == before
        assert s.last_commit() == last and s.has_tag("feed#1") and s.read("ExcludeDB").count() == 1
        assert s.log().count() == len(s.entries())
    assert not files.exists(spark, f"{store.root}/ExcludeDB/v99")
    assert expire(store, keep=2).deleted == 0
    # Loads go on, and ids with them.
    done = load(store, alerts(spark, [("G-5-1", 5, 8), ("after", 60, 1)]))
    assert done.metrics == {"imported": 2, "deleted": 0} and date(2030, 1, 6) in done.opened
    assert store.read("AlertHistory").where("AlertGuid = 'after'").first().ID == 125


def test_expired_work(spark):
    from fleetmart.operators.joins import staged

    kept = staged(spark.range(3), "kept")
    assert files.expire_work(spark, timedelta(hours=1)) == 0
    assert kept.count() == 3
    assert files.expire_work(spark, timedelta(seconds=-60)) > 0
