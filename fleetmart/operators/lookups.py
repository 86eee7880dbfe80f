"""Lookups by key, by prefix and by containment, each as an equi-join with a stated winner."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.columns import NO_CUSTOMER, ci_key, label, truncate

LIKE_MARKS = r"[%_\[]"
UNCLOSED = r"\[[^\]]*$"  # an open bracket without its partner matches nothing
OPEN = r"^[%_]*$"  # no literal at all


def key_lookup(
    df: DataFrame, column: str, dim: DataFrame, dim_key: str, take: Mapping[str, str]
) -> DataFrame:
    """Add ``take`` (new name → dimension column) by key; NULL without a match.

    Should a key occur twice in the dimension, its smallest row wins.
    """
    cols = list(dict.fromkeys(take.values()))
    one = dim.groupBy(F.col(dim_key).alias("_key")).agg(F.min(F.struct(*cols)).alias("_row"))
    hits = one.select("_key", *[F.col("_row")[src].alias(new) for new, src in take.items()])
    return df.join(hits, df[column] == hits["_key"], "left").drop("_key")


def with_release(
    df: DataFrame,
    version: str,
    versions: DataFrame,
    out: str = "VersionNr",
    prefix: str = "productversion",
    release: str = "sqlversion",
) -> DataFrame:
    """Release of a version text by its longest listed prefix.

    Each *distinct* version offers its prefixes of the lengths that occur in the list, and these
    meet the list in an equi-join, so nothing is compared pairwise and the list may have any size.
    An empty listed prefix fits every version: it joins nothing and is the default instead.
    """
    keyed = df.withColumn("_version", ci_key(F.col(version)))
    distinct = keyed.select("_version").where("_version is not null").distinct()
    listed = versions.groupBy(ci_key(F.col(prefix)).alias("_prefix")).agg(
        F.min(release).alias("_release")
    )
    lengths = listed.agg(F.collect_set(F.length("_prefix")).alias("_lengths")).scalar()
    fitting = F.array_intersect(F.sequence(F.lit(1), F.length("_version")), lengths)
    filled = distinct.where("_version <> ''")
    prefixes = filled.select("_version", F.explode(fitting).alias("_len")).select(
        "_version", "_len", F.left("_version", F.col("_len")).alias("_prefix")
    )
    best = (
        prefixes.join(listed, "_prefix")
        .groupBy("_version")
        .agg(F.max_by("_release", "_len").alias("_best"))
    )
    default = listed.where("_prefix = ''").agg(F.min("_release").alias("_default")).scalar()
    found = keyed.join(best, "_version", "left")
    known = F.when(F.col("_version").isNotNull(), F.coalesce("_best", default))
    return found.withColumn(out, known).drop("_version", "_best")


def with_support(
    df: DataFrame, version: str, versions: DataFrame, support: DataFrame
) -> DataFrame:
    """Release and both support dates (ISO text) of a version, in one pass over the releases.

    A release that is no number has no dates. If a release is listed twice the later one counts.
    """
    dates = F.max(F.struct("ReleaseDate", "EndOfMainstream", "EndofExtended"))
    listed = support.groupBy(F.col("VersionNr").alias("_nr")).agg(dates.alias("_row"))
    dated = (
        versions.select("productversion", "sqlversion")
        .withColumn("_try", truncate(F.col("sqlversion"), 10).try_cast("int"))
        .join(listed, F.col("_try") == F.col("_nr"), "left")
        .select(
            "productversion",
            F.struct(
                F.col("sqlversion").alias("VersionNr"),
                F.col("_row.EndOfMainstream").cast("string").alias("EndOfMainstream"),
                F.col("_row.EndofExtended").cast("string").alias("EndofExtended"),
            ).alias("_support"),
        )
    )
    found = with_release(df, version, dated, out="_support", release="_support")
    names = ["VersionNr", "EndOfMainstream", "EndofExtended"]
    added = found.select("*", *[F.col("_support")[n].alias(n) for n in names])
    return added.drop("_support")


def domain_dimension(domains: DataFrame, customers: DataFrame) -> DataFrame:
    """Domains with the long and short name of their customer."""
    return key_lookup(
        domains,
        "CustomerId",
        customers,
        "CustomerId",
        {"CustomerName": "NameLong", "CustomerShortName": "Name"},
    )


def _winner() -> Column:
    """The longest domain, then the lowest id."""
    rank = F.struct((-F.length("DomainDnsName")).alias("size"), "DomainId")
    return F.min(rank)["DomainId"].alias("_hit")


def with_customer(
    df: DataFrame,
    domain: str,
    dimension: DataFrame,
    take: Mapping[str, str],
    like: bool = False,
    width: int | None = None,
) -> DataFrame:
    """Customer of a domain: the listed domains that *contain* it, the longest first.

    ``take`` maps new columns to dimension columns. No match gives NULL; a match without a name
    gives ``???``. Instead of comparing all pairs, each listed domain offers its substrings of the
    lengths that are looked for, with nothing but its id, and the distinct domains meet these in an
    equi-join; the names follow for the winners only.

    By default the text is taken literally and an empty one matches nothing. With ``like`` the
    marks ``%``, ``_`` and ``[…]`` inside it act as wildcards and an empty text matches all. The
    whole text is looked up, or its first ``width`` characters.
    """
    keyed = df.withColumn("_domain", ci_key(truncate(F.col(domain), width)))
    distinct = keyed.select("_domain").where("_domain is not null").distinct()
    listed = dimension.select(
        "DomainId", "DomainDnsName", ci_key(F.col("DomainDnsName")).alias("_text")
    ).distinct()
    plain = distinct.where("_domain <> ''")
    if like:
        plain = plain.where(~F.rlike("_domain", F.lit(LIKE_MARKS)))
    best = _contained(plain, listed)
    if like:
        best = best.unionByName(_matched(distinct, listed)).unionByName(_open(distinct, listed))
    named = key_lookup(best, "_hit", dimension, "DomainId", take)
    hits = named.select("_domain", *[label(F.col(new), NO_CUSTOMER).alias(new) for new in take])
    return keyed.join(hits, "_domain", "left").drop("_domain")


def _contained(distinct: DataFrame, listed: DataFrame) -> DataFrame:
    return _pieces(listed, distinct, "_domain").groupBy("_domain").agg(_winner())


def _pieces(listed: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """Listed domains beside each of their substrings that occurs in a column of ``wanted``."""
    lengths = wanted.agg(F.collect_set(F.length(name)).alias("_lengths")).scalar()
    sized = listed.where("_text <> ''").select("*", F.explode(lengths).alias("_len"))
    fitting = sized.where(F.length("_text") >= F.col("_len"))
    last = F.length("_text") - F.col("_len") + 1
    starts = fitting.select("*", F.explode(F.sequence(F.lit(1), last)).alias("_from"))
    piece = F.substring(F.col("_text"), F.col("_from"), F.col("_len"))
    pieces = starts.withColumn(name, piece).drop("_from", "_len").distinct()
    return pieces.join(wanted.select(name).distinct(), name, "left_semi")


def _open(distinct: DataFrame, listed: DataFrame) -> DataFrame:
    """Texts of ``%`` and ``_`` alone ask for a least length only, so the longest domain of the
    whole list wins or nothing does: one row beside each of them, no join."""
    first = listed.where("DomainDnsName IS NOT NULL").groupBy().agg(
        F.min(F.struct((-F.length("DomainDnsName")).alias("size"), "DomainId", "_text")).alias("_top")
    )
    top = first.select("_top").scalar()
    asked = distinct.where(F.rlike("_domain", F.lit(OPEN)))
    least = F.length(F.replace("_domain", F.lit("%"), F.lit("")))
    return asked.where(F.length(top["_text"]) >= least).select("_domain", top["DomainId"].alias("_hit"))


def _matched(distinct: DataFrame, listed: DataFrame) -> DataFrame:
    """Domains with wildcards: joined on their longest literal piece, then tested in full.

    A text that holds sets and not one literal character is joined on the one or two characters its sets may stand for
    (``_set_grams``), so no text meets the whole list.
    """
    marked = distinct.where(F.rlike("_domain", F.lit(LIKE_MARKS)))
    marked = marked.where(~F.rlike("_domain", F.lit(UNCLOSED)) & ~F.rlike("_domain", F.lit(OPEN)))
    pieces = F.split("_domain", r"%|_|\[[^\]]*\]?")
    sized = F.transform(pieces, lambda p: F.struct(F.length(p).alias("n"), p.alias("p")))
    longest = F.array_max(sized)
    pattern = _pattern(F.col("_domain"))
    literal = marked.select("_domain", longest["p"].alias("_anchor"), pattern.alias("_pattern"))
    wild = literal.where("_anchor <> ''").unionByName(_set_grams(literal.where("_anchor = ''"), listed))
    anchors = _pieces(listed, wild, "_anchor")
    tested = wild.join(anchors, "_anchor").where(F.rlike("_text", F.col("_pattern")))
    return tested.groupBy("_domain").agg(_winner())


def _pattern(text: Column) -> Column:
    """The wildcards as a regular expression; everything else is quoted."""
    quoted = F.regexp_replace(text, r"([\\^$.|?*+(){}])", r"\\$1")
    quoted = F.regexp_replace(quoted, r"\[\\\^", "[^")  # a set that begins so is a negated one
    outside = r"(?![^\[]*\])"
    return F.regexp_replace(F.regexp_replace(quoted, "%" + outside, ".*"), "_" + outside, ".")


def _set_grams(texts: DataFrame, listed: DataFrame) -> DataFrame:
    """Texts without a literal, beside each pair of characters that two neighbouring sets of theirs may stand for, or each
    character of their first set if no two are neighbours.

    Sets are spelled out over the characters that occur in the list at all, which is one small array.
    """
    letters = listed.select(F.explode(F.split("_text", "")).alias("_letter")).where("_letter <> ''")
    alphabet = letters.agg(F.collect_set("_letter").alias("_letters")).scalar()
    a_set = r"(\[[^\]]*\])"
    part = lambda i: F.regexp_extract("_domain", a_set + a_set, i)
    first = F.when(part(1) != "", part(1)).otherwise(F.regexp_extract("_domain", a_set, 1))
    spelled = texts.withColumns({"_first": _pattern(first), "_second": _pattern(part(2)), "_letters": alphabet})
    members = lambda name: F.filter("_letters", lambda c: F.rlike(c, F.concat(F.lit("^"), F.col(name), F.lit("$"))))
    ones = spelled.withColumn("_one", F.explode(members("_first")))
    seconds = F.when(F.col("_second") == "", F.array(F.lit(""))).otherwise(members("_second"))
    return ones.select("_domain", "_one", "_pattern", F.explode(seconds).alias("_two")).select(
        "_domain", F.concat("_one", "_two").alias("_anchor"), "_pattern"
    )
