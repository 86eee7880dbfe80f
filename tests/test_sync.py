from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetmart.functions.columns import moment
from fleetmart.operators import ids
from fleetmart.operators.sync import keep_first, one_per_key, sync_snapshot, update_from
from fleetmart.plans import inventory as I

OLD, NOW = datetime(2030, 1, 1), datetime(2030, 2, 1, 12)
TARGET = "ID long, k long, name string, NotFoundSince timestamp_ntz, Modified timestamp_ntz, Inserted timestamp_ntz"


def target_of(spark, rows):
    full = [(i, k, f"t{k}", since, None, OLD) for i, (k, since) in enumerate(rows, 1)]
    return spark.createDataFrame(full, TARGET)


def source_of(spark, keys):
    return spark.createDataFrame([(k, f"s{k}") for k in keys], "k long, name string")


def run(target, source, **options):
    return sync_snapshot(
        target, source, key="k", as_of=NOW, modified_col="Modified",
        defaults={"Inserted": moment(NOW)}, **options,
    )


def expected(target, source):
    """The state table, row by row."""
    keys = {k for k in source}
    out = []
    for i, (k, since) in enumerate(target, 1):
        if k in keys:
            out.append((i, k, None, NOW if since else None))
        else:
            out.append((i, k, since or NOW, None if since else NOW))
    return out


states = st.lists(
    st.tuples(st.integers(0, 8), st.sampled_from([None, OLD])), max_size=8, unique_by=lambda r: r[0]
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=states, source=st.lists(st.integers(0, 10), max_size=10))
def test_state_table(spark, target, source):
    synced = run(target_of(spark, target), source_of(spark, source)).collect()
    kept = [(r.ID, r.k, r.NotFoundSince, r.Modified) for r in synced if r.Inserted == OLD]
    assert sorted(kept, key=str) == sorted(expected(target, source), key=str)
    fresh = [r for r in synced if r.Inserted == NOW]
    assert {r.k for r in fresh} == set(source) - {k for k, _ in target}
    first = len(target) + 1
    assert sorted(r.ID for r in fresh) == list(range(first, first + len(fresh)))


def test_second_run_changes_nothing(spark, rows, side):
    target = target_of(spark, [(1, None), (2, OLD), (3, None), (4, OLD)])
    source = source_of(spark, [1, 2, 5, 5, 6])
    once = run(target, source)
    assert rows(run(once, source)) == rows(once)


def test_null_and_repeated_target_keys(spark, side):
    target = target_of(spark, [(None, None), (7, None), (7, None)])
    synced = {(r.ID, r.k, r.NotFoundSince) for r in run(target, source_of(spark, [7])).collect()}
    assert synced == {(1, None, NOW), (2, 7, None), (3, 7, None)}


def test_hot_key(spark, side):
    """A third of the rows on both sides share a key."""
    target = spark.range(3000).selectExpr(
        "id + 1 as ID", "case when id < 1000 then -1 else id end as k", "'t' as name",
        "cast(null as timestamp_ntz) as NotFoundSince", "cast(null as timestamp_ntz) as Modified",
        "timestamp_ntz'2030-01-01' as Inserted",
    )
    source = spark.range(3000).selectExpr(
        "case when id < 1000 then -1 else id + 500 end as k", "cast(id as string) as name"
    )
    synced = run(target, source)
    counts = synced.agg(
        F.count("*"), F.count("NotFoundSince"), F.countDistinct("ID"), F.max("ID")
    ).first()
    # 500 old keys vanish (1000 … 1499), 500 new ones come (3000 … 3499).
    assert tuple(counts) == (3500, 500, 3500, 3500)


def test_keep_first(spark, rows):
    df = spark.createDataFrame(
        [(3, 1, "c"), (1, 1, "a"), (2, None, "n"), (4, None, "m"), (5, 2, None)],
        "ID long, k long, v string",
    )
    assert rows(keep_first(df, ["k"], ["ID"])) == [(1, 1, "a"), (2, None, "n"), (5, 2, None)]
    assert rows(keep_first(df.select("k"), ["k"], ["k"])) == [(1,), (2,), (None,)]


def test_one_per_key_ignores_input_order(spark, rows):
    data = [(1, "b", 2), (1, "a", 9), (1, "a", 3)]
    kind = "k long, a string, b int"
    for order in (data, data[::-1]):
        assert rows(one_per_key(spark.createDataFrame(order, kind), "k")) == [(1, "a", 3)]


def test_keys_alone_need_no_rows(spark):
    """Reading only the keys of the reduced source must not carry its other columns."""
    df = spark.range(10).selectExpr("id as k", "cast(id as string) as wide")
    plan = one_per_key(df, "k").select("k")._jdf.queryExecution().optimizedPlan().toString()
    assert "min(" not in plan and "wide" not in plan


def test_dense_ids(spark):
    df = spark.range(5000).selectExpr("id as k")
    numbered = ids.with_dense_ids(df, ["k"], "ID", after=100)
    low, high, distinct = numbered.agg(F.min("ID"), F.max("ID"), F.countDistinct("ID")).first()
    assert (low, high, distinct) == (101, 5100, 5000)
    again = ids.with_dense_ids(df.repartition(7), ["k"], "ID", after=100)
    assert again.join(numbered, ["k", "ID"]).count() == 5000
    assert ids.with_dense_ids(df.where("k < 0"), ["k"], "ID").isEmpty()


def test_update_from_overwrites_with_null(spark, rows):
    target = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, None, "c")], "ID long, k long, v string")
    values = spark.createDataFrame([(1, "x"), (2, None), (None, "y")], "key long, w string")
    updated = update_from(target, values, on="k", values_key="key", set_cols={"v": "w"})
    assert rows(updated) == [(1, 1, "x"), (2, 2, None), (3, None, "c")]


def test_matching_on_the_host(spark, rows, side):
    """An entity whose host has another id is listed again and its old row marked missing."""
    target = spark.createDataFrame(
        [(1, 11, None), (2, 12, None)], "ID long, ManagedEntityRowId long, NotFoundSince timestamp_ntz"
    )
    source = spark.createDataFrame(
        [(11, 11), (12, 99)], "ManagedEntityRowId long, TopLevelHostManagedEntityRowId long"
    )
    by_entity = I.sync_servers(target, source, NOW)
    assert rows(by_entity) == [(1, 11, None), (2, 12, None)]
    by_host = I.sync_servers(target, source, NOW, match_host=True)
    assert rows(by_host) == [(1, 11, None), (2, 12, NOW), (3, 12, None)]


def test_os_of_a_host(spark, rows):
    computers = spark.createDataFrame(
        [(1, 10, "old"), (2, None, "old"), (3, 30, "old")],
        "ID long, TopLevelHostManagedEntityRowId long, WindowsOS string",
    )
    entities = spark.createDataFrame(
        [(5, 10, 62, "A"), (6, 10, 62, "B"), (7, None, 62, "C"), (8, 30, 61, "D")],
        "ManagedEntityRowId long, TopLevelHostManagedEntityRowId long, ManagedEntityTypeRowId int, "
        "ManagedEntityDefaultName string",
    )
    assert rows(I.update_os(computers, entities)) == [(1, 10, "B"), (2, None, "old"), (3, 30, "old")]
