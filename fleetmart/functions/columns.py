"""Column expressions; all stay inside whole-stage code generation."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "(unbekannt)"  # fixed value: label of a missing group
NO_CUSTOMER = "???"  # fixed value: domain known, customer name missing
# Widths of the original columns, for callers that want its cuts.
NAME_WIDTH, DOMAIN_WIDTH, VALUE_WIDTH = 255, 100, 100


def moment(as_of: datetime) -> Column:
    """A zone-free literal; ``F.lit`` on a datetime would depend on the session's zone."""
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def day(value: date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def cutoff(as_of: datetime, days: int) -> datetime:
    """Start of a retention window that ends at ``as_of``."""
    return as_of - timedelta(days=days)


def truncate(c: Column, width: int | None) -> Column:
    """The first ``width`` characters; the whole text without a width."""
    return c if width is None else F.substring(c, 1, width)


def ci_key(c: Column) -> Column:
    """Comparison key that ignores case and trailing blanks."""
    return F.lower(F.rtrim(c))


#: Type of a text that compares without case and trailing blanks, wherever it is compared.
KEY_TEXT = "string collate UTF8_LCASE_RTRIM"


def name_key(df: DataFrame, column: str) -> Column:
    """What a name is compared by: the column itself where its type compares as names do, else its key."""
    return df[column] if is_key_text(df, column) else ci_key(df[column])


def is_key_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.simpleString().lower() == KEY_TEXT.lower()


def guid_key(c: Column) -> Column:
    """Upper-case GUID text without braces."""
    return F.upper(F.translate(F.trim(c.cast("string")), "{}", ""))


def not_blank(c: Column) -> Column:
    """True unless NULL, empty or blanks only."""
    return F.coalesce(F.rtrim(c) != "", F.lit(False))


def label(c: Column, text: str = UNKNOWN) -> Column:
    return F.coalesce(c, F.lit(text))


def _dotted(c: Column) -> Column:
    return F.replace(c, F.lit(";"), F.lit("."))


def _before_last(c: Column, mark: str) -> Column:
    tail = F.substring_index(c, mark, -1)
    return F.when(
        F.contains(c, F.lit(mark)), F.left(c, F.length(c) - F.length(tail) - F.lit(1))
    ).otherwise(c)


def _after_first(c: Column, mark: str) -> Column:
    return F.right(c, F.length(c) - F.instr(c, mark))


def domain_of(full_name: Column, width: int | None = None) -> Column:
    """Domain part of an entity's full name ``type:host.domain.instance``; NULL without a colon.

    Like the two below it reads the whole text, or its first ``width`` characters if asked.
    """
    text = _dotted(F.rtrim(truncate(full_name, width)))
    tail = F.when(F.contains(text, F.lit(":")), _after_first(text, ":"))
    return _before_last(_after_first(tail, "."), ".")


def machine_of(name: Column, first_dot: bool = False, width: int | None = None) -> Column:
    """Machine name: what stands before the last dot, or before the first if asked."""
    text = _dotted(F.rtrim(truncate(name, width)))
    return F.substring_index(text, ".", 1) if first_dot else _before_last(text, ".")


def entity_path(full_name: Column, width: int | None = None) -> Column:
    """Text after the first colon, semicolons shown as dots; at most ``width`` characters of it."""
    return _dotted(truncate(_after_first(full_name, ":"), width))


def replace_last(c: Column, find: str, repl: str) -> Column:
    """Replace the last occurrence of one character; unchanged when it does not occur."""
    if len(find) != 1 or len(repl) != 1:
        raise ValueError("find and repl are single characters")
    text = F.rtrim(c)
    changed = F.concat(_before_last(text, find), F.lit(repl), F.substring_index(text, find, -1))
    return F.when(F.contains(text, F.lit(find)), changed).otherwise(c)


def build_path(path: Column) -> Column:
    """Path with its last dot shown as a semicolon, at most 250 characters."""
    return truncate(replace_last(truncate(path, 256), ".", ";"), 250)


def database_path(path: Column) -> Column:
    return F.replace(path, F.lit(";"), F.lit(":"))


def minute_of(ts: Column) -> Column:
    """Timestamp cut to the minute, through text so that no session zone takes part."""
    return F.left(ts.cast("string"), F.lit(16)).cast("timestamp_ntz")


def missing_days(since: Column, as_of: datetime) -> Column:
    """Midnights between ``since`` and ``as_of``; NULL for rows that are present."""
    return F.datediff(day(as_of.date()), since)


def code_label(code: Column, names: list[str]) -> Column:
    """Names for the codes 0, 1, 2 …; any other code as text."""
    shown = code.cast("string")
    for position, name in reversed(list(enumerate(names))):
        shown = F.when(code == position, F.lit(name)).otherwise(shown)
    return shown


def severity_label(code: Column) -> Column:
    return code_label(code, ["Information", "Warning", "Error"])


def priority_label(code: Column) -> Column:
    return code_label(code, ["Low", "Medium", "High"])


def differs(old: Column, new: Column, null_safe: bool = True) -> Column:
    """Changed-value test; without ``null_safe`` a NULL on either side counts as unchanged."""
    if null_safe:
        return ~old.eqNullSafe(new)
    return F.coalesce(old != new, F.lit(False))
