from datetime import date, datetime

import fixtures
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetmart.operators import properties as P

T1, T2 = datetime(2030, 1, 1), datetime(2030, 1, 2)
NOW = datetime(2030, 3, 4, 5, 6)
HISTORY = "ManagedEntityRowId long, PropertyXML string, DWCreatedDateTime timestamp_ntz, ToDateTime timestamp_ntz"


def history(spark, *texts):
    return spark.createDataFrame([(i, x, T1, None) for i, x in enumerate(texts, 1)], HISTORY)


def shredded(spark, *texts):
    found = P.shred(history(spark, *texts), 100).collect()
    return sorted((r.ManagedEntityRowId, r.PropertyGuid, r.PropertyValue) for r in found)


def test_shred(spark):
    texts = [
        fixtures.xml(("{ab-1}", "x"), ("AB-2", "")),
        "<Root/>",
        "<Root><Property",
        None,
        '<Root><Property Guid="q"/></Root>',
        fixtures.xml(("w", "  two  ")),
        fixtures.xml(("l", "y" * 300)),
        fixtures.xml(("e", "a &amp; b &lt;c&gt;")),
    ]
    assert shredded(spark, *texts) == [
        (1, "AB-1", "x"),
        (1, "AB-2", ""),
        (5, "Q", ""),
        (6, "W", "  two  "),
        (7, "L", "y" * 100),
        (8, "E", "a & b <c>"),
    ]


def test_shred_by_path(spark):
    """Only properties right below the root, whole element texts, references decoded once."""
    texts = [
        '<Root><Property Guid="a">x<b>y</b>z</Property><Property Guid="b">p &lt;q&gt; &amp;amp; r</Property><Property Guid="c"/></Root>',
        '<Other><Property Guid="a">x</Property></Other>',
        '<n:Root xmlns:n="u"><n:Property Guid="a">x</n:Property></n:Root>',
        '<Root xmlns="u"><Property Guid="a">x</Property></Root>',
        '<Root><G><Property Guid="a">x</Property></G><Property Guid="b">u<Property Guid="c">v</Property>w</Property></Root>',
        '<?xml version="1.0"?><!-- <Other> --> <Root k="1">t<Property Guid="a"> s <!-- no --><i k="&lt;>">m<j/></i> &#xe9;</Property>'
        '<property Guid="b">low</property></Root>',
        '<Root><Property Guid="a"><![CDATA[<raw>&amp;]]>&amp;<![CDATA[ ]] > ]]></Property></Root>',
        '<root><Property Guid="a">x</Property></root>',
        '<Root><Property Guid="a"><b></Property></Root>',
        '<RootX><Property Guid="a">x</Property></RootX>',
        '<Root><Property Guid="a">' + "<b>é</b>" * 200 + "</Property></Root>",
    ]
    assert shredded(spark, *texts) == [
        (1, "A", "xyz"), (1, "B", "p <q> &amp; r"), (1, "C", ""), (5, "B", "uvw"), (6, "A", " s m é"), (7, "A", "<raw>&amp;& ]] > "),
        (11, "A", "é" * 100),
    ]


words = st.text(st.characters(min_codepoint=32, max_codepoint=382, exclude_characters='<>&"\x7f'), max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(words.map(str.strip), min_size=1, max_size=5))
def test_round_trip(spark, values):
    pairs = [(f"g{i}", v) for i, v in enumerate(values)]
    assert shredded(spark, fixtures.xml(*pairs)) == [(1, g.upper(), v) for g, v in pairs]


def test_current_properties_by_name(spark, rows):
    w = fixtures.warehouse(spark)
    shown = P.show_properties(w.properties, w.dictionary, 1)
    assert [tuple(r) for r in shown.collect()] == [
        (1, "AAAA-1", "Version", "21.5.7"),
        (1, "AAAA-2", "edition", "Big's Edition"),
    ]
    assert P.show_properties(w.properties, w.dictionary).count() == 9


TARGET = "ID long, ManagedEntityRowId long, A string, B string, Modified timestamp_ntz"


def test_write_back(spark, rows):
    target = spark.createDataFrame(
        [
            (1, 1, None, "same ", None),
            (2, 2, "old", "keep", None),
            (3, 3, "VALUE", None, None),
            (4, None, "x", "y", None),
        ],
        TARGET,
    )
    items = spark.createDataFrame(
        [
            (1, "a", T1, "g", "It's NEW"),
            (1, "B", T1, "g", "SAME"),
            (2, "A", T1, "g1", "first"),
            (2, "A", T2, "g0", "Later"),
            (3, "A", T1, "g", "value"),
            (3, "B", T1, "g", ""),
            (3, "ID", T1, "g", "77"),
            (9, "A", T1, "g", "nobody"),
        ],
        "ManagedEntityRowId long, PropertySystemName string, DWCreatedDateTime timestamp_ntz, "
        "PropertyGuid string, PropertyValue string",
    )
    day = datetime(2030, 3, 4)
    assert rows(P.write_back(target, items, NOW)) == [
        (1, 1, "it's new", "same ", day),
        (2, 2, "later", "keep", day),
        (3, 3, "VALUE", "", day),
        (4, None, "x", "y", None),
    ]
    cased = P.write_back(target, items, NOW, lowercase=False, columns=["A"])
    assert rows(cased, "A") == [("It's NEW",), ("Later",), ("VALUE",), ("x",)]


def test_modified_keeps_its_type(spark):
    target = spark.createDataFrame(
        [(1, 1, None, None)], "ID long, ManagedEntityRowId long, A string, Modified date"
    )
    items = spark.createDataFrame(
        [(1, "A", T1, "g", "v")],
        "ManagedEntityRowId long, PropertySystemName string, DWCreatedDateTime timestamp_ntz, "
        "PropertyGuid string, PropertyValue string",
    )
    assert P.write_back(target, items, NOW).first().Modified == date(2030, 3, 4)


def test_hot_entity(spark, side):
    """One entity holds most current versions; the newest wins."""
    versions = spark.range(6000).selectExpr(
        "case when id < 4000 then 1 else id end as ManagedEntityRowId",
        """concat('<Root><Property Guid="g">v', id, '</Property></Root>') as PropertyXML""",
        "timestamp_ntz'2030-01-01' + make_dt_interval(0, 0, 0, id) as DWCreatedDateTime",
        "cast(null as timestamp_ntz) as ToDateTime",
    )
    dictionary = spark.createDataFrame(
        [(1, "G", "A")], "ManagedEntityTypeRowId int, PropertyGuid string, PropertySystemName string"
    )
    target = spark.createDataFrame([(1, 1, None, None, None), (2, 4500, None, None, None)], TARGET)
    done = P.refresh_properties(target, versions, dictionary, NOW)
    assert {(r.ID, r.A) for r in done.collect()} == {(1, "v3999"), (2, "v4500")}


def test_property_list_counts_filled_cells(spark):
    df = spark.createDataFrame(
        [(1, "x", None, "  "), (2, "", "y", "z")], "ManagedEntityRowId long, a string, b string, c string"
    )
    pairs = P.property_list(df, ["ManagedEntityRowId"], ["a", "b", "c"])
    assert {tuple(r) for r in pairs.collect()} == {(1, "a", "x"), (2, "b", "y"), (2, "c", "z")}
    assert pairs.where(F.col("Property") == "a").count() == 1


def test_plain_texts_need_no_parser(spark, monkeypatch):
    """Texts of properties alone are found by patterns, all others by the parser, with the same rows."""
    value = lambda v: f'<Root><Property Guid="{{a-1}}">{v}</Property><Property Guid=" b ">w</Property></Root>'
    plain = ["<Root></Root>", value("x"), value(""), value("  two \"q\" 'r' "), value("]] = ; ~ é"), value("y" * 300)]
    other = [
        value("   "), value("a&amp;b"), value("a>b"), value("]]>"), value("a\nb"), value(" "), value(" z"), value("𝒳"), value("Ж"), value("\x01"),
        value("x") + "\n", " " + value("x"), value("x").replace("<Root>", "<Root >"), value("x")[:-1], value("x").replace(" b ", ""),
        value("x").replace('" b "', "' b '"), value("<i>x</i>"), value("x").replace(" b ", "b&lt;"), "<Root/>", None, "",
        value("x").replace("</Property><", "</Property> <"), value("x").replace(" b ", "  "), value("x") + "<Root></Root>",
    ]
    texts = [*plain, *other, "<Root>" + '<Property Guid="g">v</Property>' * 20000 + "</Root>"]
    found = history(spark, *texts).select("ManagedEntityRowId", F.col("PropertyXML").rlike(P._PLAIN).alias("plain"))
    assert [i for i, p in sorted(map(tuple, found.collect())) if p] == [*range(1, len(plain) + 1), len(texts)]
    quick = shredded(spark, *texts)
    monkeypatch.setattr(P, "_PLAIN", "(?!)")
    assert quick == shredded(spark, *texts)
