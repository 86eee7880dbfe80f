"""Property XML: shredding, naming, and writing values back into inventory columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.columns import VALUE_WIDTH, ci_key, day, guid_key, not_blank, truncate
from fleetmart.schemas import PROTECTED

XML_SCHEMA = "Property array<struct<_Guid:string,_VALUE:string>>"
XML_OPTIONS = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}
_TAG = r"""<(?:[^"'<>]|"[^"]*"|'[^']*')*>"""
#: What may stand before the root element, and a root that is named as asked for and in no namespace.
_ROOT = r"""(?s)^\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<Root(?=[\s/>])(?![^>]*\sxmlns\s*=)"""
#: Markup beyond plain properties: other elements, comments, literal sections, a property inside a property.
_MARKUP = r"""(?s)<(?!/?Property[\s/>]|/?Root[\s/>]|\?xml)|<Property(?:\s[^>]*)?(?<!/)>[^<]*<Property"""
#: Characters of Latin-1 that mean nothing to a parser, one by one, as a set of single characters is the fastest to test.
_LETTERS = "".join(f"\\x{c:02X}" for c in (*range(0x21, 0x7F), *range(0xA1, 0x100)) if chr(c) not in "\"&<>")
#: Nothing but a root and properties with a guid, without blanks between them; guids and values may be found by patterns there.
_PLAIN = (
    rf"""^<Root>(?:<Property Guid="\x20*[{_LETTERS}][{_LETTERS}\x20]*">(?:\x20*[{_LETTERS}\x22][{_LETTERS}\x20\x22]*)?</Property>)*+</Root>\z"""
)
_OTHER_CASE = r"""(</?)(?!Property[\s/>])((?i:property))(?=[\s/>])"""


def current_only(history: DataFrame) -> DataFrame:
    """Current versions of a versioned table."""
    return history.where(F.col("ToDateTime").isNull())


def shred(history: DataFrame, width: int | None) -> DataFrame:
    """One row per property of every given version: (entity, created, guid, value).

    Properties are the ``Property`` elements directly below a ``Root`` element, both in no namespace and in this
    spelling; other texts give no rows, nor does a text that is no XML. A value is all text of its element, that of
    elements inside it, too, without markup and comments; an empty element gives an empty value. Values are cut to
    ``width`` characters, or whole where that is None; no caller can forget to say which.
    """
    xml = F.col("PropertyXML")
    usual = _with_mark(F.from_xml(xml, XML_SCHEMA, XML_OPTIONS)["Property"], False)
    raw = _with_mark(_raw_properties(xml), True)
    # One expression, so that each pattern goes over a text once; a text without such a root gives NULL, and no rows.
    rooted = F.when(xml.rlike(_ROOT), F.when(xml.rlike(_MARKUP), raw).otherwise(usual))
    parsed = F.when(xml.rlike(_PLAIN), _plain_properties(xml)).otherwise(rooted)
    items = history.select("ManagedEntityRowId", "DWCreatedDateTime", F.explode(parsed).alias("_p"))
    value = F.coalesce(F.when(F.col("_p._raw"), _text_of(F.col("_p._VALUE"))).otherwise(F.col("_p._VALUE")), F.lit(""))
    return items.select(
        "ManagedEntityRowId",
        "DWCreatedDateTime",
        guid_key(F.col("_p._Guid")).alias("PropertyGuid"),
        truncate(value, width).alias("PropertyValue"),
    )


def _property(guid: Column, value: Column, raw: bool) -> Column:
    """A property; ``_raw`` tells that its value still holds markup."""
    return F.struct(guid.alias("_Guid"), value.alias("_VALUE"), F.lit(raw).alias("_raw"))


def _with_mark(found: Column, raw: bool) -> Column:
    return F.transform(found, lambda p: _property(p["_Guid"], p["_VALUE"], raw))


def _plain_properties(xml: Column) -> Column:
    """Properties of a text as ``_PLAIN`` describes it, without a parser: it takes several times as long."""
    guids = F.regexp_extract_all(xml, F.lit(r'<Property Guid="([^"]*)">'), F.lit(1))
    values = F.regexp_extract_all(xml, F.lit(r'">([^<]*)</Property>'), F.lit(1))
    return F.zip_with(guids, values, lambda g, v: _property(g, v, False))


def _raw_properties(xml: Column) -> Column:
    """Properties with the raw content of their elements, references not yet decoded.

    The parser gives an element either its attributes or its content as text, so it goes over the text twice. It would
    decode references in the content, where they could no longer be told from markup, so they are guarded first; literal
    sections become plain text with references before that.
    """
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    end = F.lit("]]>")
    opened = lambda part: F.concat(
        escaped(F.substring_index(part, "]]>", 1)), F.substring(part, F.instr(part, "]]>") + 3, F.length(part))
    )
    parts = F.transform(F.split(xml, r"<!\[CDATA\["), lambda part, i: F.when((i == 0) | ~F.contains(part, end), part).otherwise(opened(part)))
    guarded = F.replace(F.array_join(parts, ""), F.lit("&"), F.lit("&amp;"))
    guarded = F.regexp_replace(guarded, _OTHER_CASE, "$1_$2")
    guids = F.from_xml(guarded, "Property array<struct<_Guid:string>>", XML_OPTIONS)["Property"]
    contents = F.from_xml(guarded, "Property array<string>", XML_OPTIONS)["Property"]
    return F.zip_with(guids, contents, lambda g, c: F.struct(g["_Guid"].alias("_Guid"), c.alias("_VALUE")))


def _text_of(content: Column) -> Column:
    """Raw content without its markup; the parser decodes the references that are left."""
    bare = F.regexp_replace(content, _TAG, "")
    return F.from_xml(F.concat(F.lit("<r><v>"), bare, F.lit("</v></r>")), "v string", XML_OPTIONS)["v"]


def named(
    shredded: DataFrame, dictionary: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Shredded properties with their names, of the given columns only if there are any; a guid
    listed for several types counts once."""
    names = dictionary.select(
        guid_key(F.col("PropertyGuid")).alias("PropertyGuid"), "PropertySystemName"
    )
    if columns is not None:
        wanted = [c.lower() for c in columns]
        names = names.where(ci_key(F.col("PropertySystemName")).isin(wanted))
    return shredded.join(names.distinct(), "PropertyGuid")


def show_properties(
    history: DataFrame,
    dictionary: DataFrame,
    entity: int | None = None,
    width: int | None = VALUE_WIDTH,
) -> DataFrame:
    """Current properties by name, of one entity or of all; ``width=None`` shows whole values."""
    rows = current_only(history)
    if entity is not None:
        rows = rows.where(F.col("ManagedEntityRowId") == entity)
    shown = named(shred(rows, width), dictionary).select(
        "ManagedEntityRowId", "PropertyGuid", "PropertySystemName", "PropertyValue"
    )
    return shown.orderBy("PropertySystemName", "ManagedEntityRowId")


def writable_columns(target: DataFrame, protected: Sequence[str] = PROTECTED) -> list[str]:
    """Text columns a property may be written to."""
    barred = {p.lower() for p in protected}
    texts = [n for n, t in target.dtypes if t == "string"]
    return [n for n in texts if n.lower() not in barred]


def values_by_column(properties: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per entity with a column per property name.

    Names are compared without case. Among several values the newest version wins, then the
    greatest guid and value. The winner of each entity and name is found first, reduced in each
    task, whatever the number of columns; an entity's winners then make one map, from which the
    columns are picked.
    """
    ranked = F.struct("DWCreatedDateTime", "PropertyGuid", "PropertyValue")
    keyed = properties.withColumn("_name", ci_key(F.col("PropertySystemName")))
    wanted = keyed.where(F.col("_name").isin([c.lower() for c in columns]))
    best = wanted.groupBy("ManagedEntityRowId", "_name").agg(F.max(ranked).alias("_best"))
    entry = F.struct("_name", F.col("_best.PropertyValue"))
    held = best.groupBy("ManagedEntityRowId").agg(
        F.map_from_entries(F.collect_list(entry)).alias("_values")
    )
    picks = [F.col("_values")[c.lower()].alias(c) for c in columns]
    return held.select("ManagedEntityRowId", *picks)


def write_back(
    target: DataFrame,
    properties: DataFrame,
    as_of: datetime,
    *,
    columns: Sequence[str] | None = None,
    modified_col: str = "Modified",
    lowercase: bool = True,
) -> DataFrame:
    """Copy named property values into the columns of the same name.

    A cell is written when it is NULL or differs from the value (case and trailing blanks aside);
    the value is stored in lower case and the row's ``Modified`` becomes the plain date.
    """
    columns = list(columns) if columns is not None else writable_columns(target)
    if not columns:
        return target
    wide = values_by_column(properties, columns)
    offered = wide.select(
        F.col("ManagedEntityRowId").alias("_entity"),
        *[F.col(c).alias(f"_new_{c}") for c in columns],
    )
    joined = target.join(offered, target["ManagedEntityRowId"] == offered["_entity"], "left")
    writes, any_write = {}, F.lit(False)
    for c in columns:
        old, new = F.col(c), F.col(f"_new_{c}")
        differs = old.isNull() | (ci_key(old) != ci_key(new))
        write = new.isNotNull() & differs
        any_write = any_write | write
        writes[c] = F.when(write, F.lower(new) if lowercase else new).otherwise(old)
    stamp = day(as_of.date()).cast(target.schema[modified_col].dataType)
    writes[modified_col] = F.when(any_write, stamp).otherwise(F.col(modified_col))
    return joined.select(*[writes[c].alias(c) if c in writes else F.col(c) for c in target.columns])


def refresh_properties(
    target: DataFrame,
    history: DataFrame,
    dictionary: DataFrame,
    as_of: datetime,
    *,
    columns: Sequence[str] | None = None,
    width: int | None = VALUE_WIDTH,
    **options,
) -> DataFrame:
    """Write the current properties of all entities of an inventory back in one job.

    The history is reduced to the target's entities before the XML is taken apart.
    """
    columns = list(columns) if columns is not None else writable_columns(target)
    rows = current_only(history)
    ids = target.select("ManagedEntityRowId").distinct()
    rows = rows.join(ids, "ManagedEntityRowId", "left_semi")
    properties = named(shred(rows, width), dictionary, columns)
    return write_back(target, properties, as_of, columns=columns, **options)


def property_list(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Filled columns of each row as (Property, Wert) pairs; blank ones are left out."""
    texts = df.select(
        *[F.col(i).alias(f"_id{n}") for n, i in enumerate(ids)],
        *[F.col(c).cast("string").alias(c) for c in columns],
    )
    keys = [f"_id{n}" for n in range(len(ids))]
    pairs = texts.unpivot(keys, list(columns), "Property", "Wert").where(not_blank(F.col("Wert")))
    named_ids = [F.col(k).alias(i) for k, i in zip(keys, ids)]
    return pairs.select(*named_ids, "Property", "Wert")
