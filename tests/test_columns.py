from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetmart.functions import columns as X


def apply(spark, value, make, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(make(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "text, domain",
    [
        ("Vendor.Engine:srv.domain.corp.MAIN", "domain.corp"),
        ("T:srv;domain;corp;MAIN", "domain.corp"),
        ("T:srv.I1", "I1"),
        ("no colon.at.all", None),
        ("T:srv.domain.corp.MAIN   ", "domain.corp"),
        ("T:a:b.c.d", "c"),
        ("T:plain", "plain"),
        (None, None),
    ],
)
def test_domain(spark, text, domain):
    assert apply(spark, text, X.domain_of) == domain


@pytest.mark.parametrize(
    "text, machine, first",
    [
        ("srv.domain.corp", "srv.domain", "srv"),
        ("srv;main", "srv", "srv"),
        ("srv", "srv", "srv"),
        ("srv.x  ", "srv", "srv"),
        ("", "", ""),
    ],
)
def test_machine(spark, text, machine, first):
    assert apply(spark, text, X.machine_of) == machine
    assert apply(spark, text, lambda c: X.machine_of(c, first_dot=True)) == first


@pytest.mark.parametrize(
    "text, out", [("a.b.c", "a.b;c"), ("abc", "abc"), ("", ""), (None, None), ("a.", "a;")]
)
def test_replace_last(spark, text, out):
    assert apply(spark, text, lambda c: X.replace_last(c, ".", ";")) == out


def test_replace_last_of_trailing_blanks(spark):
    """Trailing blanks don't count: neither as a place to cut nor in what is cut."""
    assert apply(spark, "abc ", lambda c: X.replace_last(c, " ", ";")) == "abc "
    assert apply(spark, "a b ", lambda c: X.replace_last(c, " ", ";")) == "a;b"


def test_replace_last_takes_single_characters():
    with pytest.raises(ValueError):
        X.replace_last(F.lit("x"), "ab", "c")


def test_paths(spark):
    assert apply(spark, "T:a;b.c", X.entity_path) == "a.b.c"
    assert apply(spark, "a;b", X.entity_path) == "a.b"
    assert apply(spark, "16.0;m;db", X.database_path) == "16.0:m:db"
    assert apply(spark, "a." * 200, X.build_path) == ("a." * 125)
    assert len(apply(spark, "T:" + "x" * 400, lambda c: X.entity_path(c, 255))) == 255
    assert len(apply(spark, "T:" + "x" * 400, X.entity_path)) == 400


def test_codes(spark):
    codes = [apply(spark, c, X.severity_label, "int") for c in (0, 1, 2, 7, None)]
    assert codes == ["Information", "Warning", "Error", "7", None]
    codes = [apply(spark, c, X.priority_label, "int") for c in (0, 1, 2, -1)]
    assert codes == ["Low", "Medium", "High", "-1"]


def test_days_count_midnights(spark):
    def days(value):
        later = datetime(2030, 1, 2, 0, 1)
        return apply(spark, value, lambda c: X.missing_days(c, later), "timestamp_ntz")

    assert days(datetime(2030, 1, 1, 23, 59)) == 1
    assert days(None) is None


def test_minute_and_guid(spark):
    value = datetime(2030, 1, 1, 5, 6, 59, 999)
    assert apply(spark, value, X.minute_of, "timestamp_ntz") == datetime(2030, 1, 1, 5, 6)
    assert apply(spark, "{ab-1}", X.guid_key) == "AB-1"


def test_minute_does_not_depend_on_the_session_zone(spark):
    value = datetime(2030, 3, 31, 2, 30, 10)  # does not exist on the clocks of some zones
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert apply(spark, value, X.minute_of, "timestamp_ntz") == datetime(2030, 3, 31, 2, 30)
        assert spark.range(1).select(X.moment(value)).first()[0] == value
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_blank_and_label(spark):
    assert [apply(spark, v, X.not_blank) for v in ("x", "", "  ", None)] == [True, False, False, False]
    assert apply(spark, None, X.label) == "(unbekannt)"


def test_change_test(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (None, None)], "a int, b int")
    safe = [r[0] for r in df.select(X.differs(F.col("a"), F.col("b"))).collect()]
    plain = [r[0] for r in df.select(X.differs(F.col("a"), F.col("b"), False)).collect()]
    assert safe == [False, True, True, False]
    assert plain == [False, True, False, False]
