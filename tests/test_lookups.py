import fixtures
import pytest
from pyspark.sql import functions as F

from fleetmart import schemas
from fleetmart.operators import joins as J
from fleetmart.operators import lookups as L
from fleetmart.plans import derived as D
from fleetmart.plans import views

TAKE = {"long": "CustomerName", "short": "CustomerShortName"}


def domain_lookup(spark, values, **options):
    known = fixtures.lookups(spark)
    df = spark.createDataFrame([(v,) for v in values], "Domain string")
    found = L.with_customer(df, "Domain", known.domain_names(), TAKE, **options)
    return {r.Domain: (r.long, r.short) for r in found.collect()}


def test_containment(spark, side):
    found = domain_lookup(
        spark, ["OAK.test ", "elm.test", "test", "fir", "spare", "", None, "other", "o_k", "%"]
    )
    assert found == {
        "OAK.test ": ("Oak Mills Ltd", "Oak"),
        "elm.test": ("Elm Foods Ltd", "Elm"),  # contained in two, the longer is the same customer
        "test": ("Elm Foods Ltd", "Elm"),  # the longest of all
        "fir": ("???", "Fir"),
        "spare": ("???", "???"),
        "": (None, None),
        None: (None, None),
        "other": (None, None),
        "o_k": (None, None),
        "%": (None, None),
    }


def test_containment_with_wildcards(spark):
    values = ["o_k", "%", "o[a-c]k", "f%r.t", "o[a", "", "oak", "x_y", "_%_", "_" * 300, "[o]"]
    found = domain_lookup(spark, values, like=True)
    elm, oak = ("Elm Foods Ltd", "Elm"), ("Oak Mills Ltd", "Oak")
    assert found == {
        "o_k": oak,
        "%": elm,
        "o[a-c]k": oak,
        "f%r.t": ("???", "Fir"),
        "o[a": (None, None),
        "": elm,
        "oak": oak,
        "x_y": (None, None),
        "_%_": elm,
        "[o]": elm,
        "_" * 300: (None, None),
    }


def test_wildcards_beside_a_domain_without_name(spark):
    listed = fixtures.lookups(spark).domain_names()
    nameless = listed.limit(1).withColumns({"DomainId": F.lit(0), "DomainDnsName": F.lit(None).cast("string")})
    df = spark.createDataFrame([("%",), ("",), ("__",)], "Domain string")
    found = L.with_customer(df, "Domain", listed.unionByName(nameless), TAKE, like=True)
    assert {r.Domain: (r.long, r.short) for r in found.collect()} == dict.fromkeys(["%", "", "__"], ("Elm Foods Ltd", "Elm"))


def test_hot_domain(spark, side):
    """Most rows share a domain; the result is the same whether or not the lookup is broadcast."""
    df = spark.range(3000).selectExpr(
        "id", "case when id < 2000 then 'oak.test' else concat('d', id, '.test') end as Domain"
    )
    known = fixtures.lookups(spark)
    found = L.with_customer(df, "Domain", known.domain_names(), TAKE)
    assert found.count() == 3000
    assert found.where("short = 'Oak'").count() == 2000


def test_staged_is_computed_once(spark):
    df = J.staged(spark.range(5).selectExpr("id", "rand() AS x"))
    assert sorted(df.collect()) == sorted(df.collect())
    assert "parquet" in df._jdf.queryExecution().executedPlan().toString().lower()


def test_prefixes_of_listed_lengths_only(spark):
    """Many versions of one first letter; an empty listed prefix is the default of all but NULL."""
    listed = [("1", "one"), ("12", "twelve"), ("", "any"), (None, "no")]
    versions = spark.createDataFrame(listed, "productversion string, sqlversion string")
    df = spark.range(20000).selectExpr("concat('1', lpad(id, 30, '3')) AS v")
    odd = spark.createDataFrame([("12.5",), ("x",), ("",), (None,)], "v string")
    found = L.with_release(df.union(odd), "v", versions)
    counts = {r[0]: r[1] for r in found.groupBy("VersionNr").count().collect()}
    assert counts == {"one": 20000, "twelve": 1, "any": 2, None: 1}


def test_release_and_support(spark, side):
    known = fixtures.lookups(spark)
    df = spark.createDataFrame([("21.0",), ("21.5.9",), ("22.",), ("2",), (None,)], "Version string")
    found = L.with_support(df, "Version", known.versions, known.support)
    assert {tuple(r) for r in found.collect()} == {
        ("21.0", "3001", "3006-02-03", "3011-02-03"),
        ("21.5.9", "3001R2", None, None),  # no number, so no dates and no failure
        ("22.", "3002", "3007-02-03", "3012-02-03"),
        ("2", None, None, None),
        (None, None, None, None),
    }


def test_key_lookup_has_one_winner(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (None, "x")], "key int, v string")
    found = L.key_lookup(df, "k", dim, "key", {"name": "v"})
    assert {tuple(r) for r in found.collect()} == {(1, "a"), (2, None), (None, None)}


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "Name string")


def test_exclude_names_follows_not_in(spark, side):
    df = names(spark, ["Keep", "MASTER ", None])
    left = {r[0] for r in J.exclude_names(df, "Name", names(spark, ["master"])).collect()}
    assert left == {"Keep"}
    left = {r[0] for r in J.exclude_names(df, "Name", names(spark, [])).collect()}
    assert left == {"Keep", "MASTER ", None}
    assert J.exclude_names(df, "Name", names(spark, ["master", None])).isEmpty()


def test_same_name(spark):
    found = J.same_name(names(spark, ["H1", "h2 ", "h3"]), "Name", names(spark, ["h1", "H2", "h1"]), "Name")
    assert sorted(r[0] for r in found.collect()) == ["H1", "h2 "]


def test_known_entities_and_counts(spark, rows):
    a = spark.createDataFrame([(1,), (2,)], "ManagedEntityRowId long")
    b = spark.createDataFrame([(2,), (3,)], "ManagedEntityRowId long")
    assert rows(J.known_entities(a, b)) == [(1,), (2,), (3,)]
    known = fixtures.lookups(spark)
    counted = D.with_domain_counts(known.customers, known.domains)
    assert rows(counted, "Name", "Domains") == [("Elm", 2), ("Fir", 1), ("Oak", 1)]


def full_servers(spark):
    return D.with_server_columns(fixtures.servers(spark), fixtures.lookups(spark), fixtures.NOW)


def test_distributions(spark, rows):
    servers = full_servers(spark)
    assert rows(views.editions(servers)) == [("Big", 2), ("Small", 1)]
    assert rows(views.customers_of_servers(servers)) == [
        ("(unbekannt)", 1),
        ("???", 1),
        ("Elm Foods Ltd", 1),
        ("Oak Mills Ltd", 1),
    ]
    assert rows(views.releases(servers)) == [("3001", 1), ("3001R2", 1), ("3002", 1)]


def test_server_properties(spark, rows):
    servers = full_servers(spark)
    assert rows(views.server_properties(servers, 1)) == [
        ("Domain", "oak.test"),
        ("Edition", "Big"),
        ("EndOfMainstream", "3006-02-03"),
        ("EndofExtended", "3011-02-03"),
        ("Maschine", "h1"),
        ("Version", "21.0.7"),
        ("VersionNr", "3001"),
    ]
    days = {r.ID: r.NotFoundSinceDay for r in servers.collect()}
    assert days == {1: None, 2: None, 3: None, 4: None, 5: 2}


@pytest.mark.parametrize(
    "text, hits",
    [("[ab][cd]", "ac ad"), ("[^a-z.]", "bär"), ("[z][z]", ""), ("[x]_[x]", "x.x"), ("%[9]", "d9"), ("[a-c]%[.]", "b.c"), ("[ä-ü]", "bär")],
)
def test_sets_alone(spark, text, hits):
    """Texts of sets meet the domains that hold one of their pairs or characters, and no others."""
    names = ["acme", "bad", "d9", "x.x", "b.c", "bär", "", "oak"]
    listed = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "DomainId int, DomainDnsName string")
    keyed = listed.selectExpr("*", "lower(DomainDnsName) AS _text")
    wild = spark.createDataFrame([(text, "")], "_domain string, _pattern string")
    grams = L._set_grams(wild, keyed)
    met = L._pieces(keyed, grams, "_anchor").select("DomainDnsName").distinct()
    assert met.count() < len(names) - 1
    take = {"hit": "DomainDnsName"}
    df = spark.createDataFrame([(text,)], "Domain string")
    found = L.with_customer(df, "Domain", listed, take, like=True).first().hit
    longest = max(hits.split(), key=lambda h: len(next(n for n in names if h in n)), default=None)
    assert found == (None if longest is None else next(n for n in names if longest in n))


def test_names_by_their_type(spark, side, rows):
    """Columns with the type of names give what keys give, with a hot name; a side without it is compared by key."""
    left = spark.range(3000).selectExpr("id", "case when id < 1000 then concat('HOT', repeat(' ', int(id % 3))) when id = 1001 then null else concat('n', id) end AS Name")
    right = spark.createDataFrame([("hot ",), ("N2000",), ("absent",)], "Maschine string")
    typed, names = schemas.with_key_texts(left, "ManagedEntity"), schemas.with_key_texts(right, "SQLServer")
    plain = rows(J.same_name(left, "Name", right, "Maschine"))
    for one, other in ((typed, names), (typed, right), (left, names)):
        assert rows(J.same_name(one, "Name", other, "Maschine")) == plain
    assert len(plain) == 1001
    listed = right.withColumnRenamed("Maschine", "Name")
    kept = rows(J.exclude_names(left, "Name", listed))
    assert rows(J.exclude_names(typed, "Name", schemas.with_key_texts(listed, "ExcludeDB"))) == kept
    assert len(kept) == 3000 - 1001 - 1
    assert schemas.check_key_texts(typed, "ManagedEntity") is typed
    with pytest.raises(TypeError, match="Name"):
        schemas.check_key_texts(left, "ManagedEntity")
