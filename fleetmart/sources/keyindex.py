"""Which days of an event history may hold a key.

Beside every written day lie its facts (rows, least and greatest key, first and last event, greatest id) and a Bloom
sketch of its keys. The sketch is kept as rows (day, word, bits): a key's hash names one word of ``WORDS`` and ``BITS`` of its
64 bits, and the bits of a day's keys are merged by ``bit_or`` in the same aggregate that any two sketches would be. So
the keys of a load meet the sketches in an equi-join on the word, whatever the number of either, and a day is
left unread only if for each key at least one bit is missing. A sketch can name a day in vain, but never miss one.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.schemas import EVENT_TIMES, NATURAL_KEYS, struct_of
from fleetmart.sources.commitlog import AppendedTable

DAY = "_day"
#: Words of a sketch: 512 KB for a day at most.
WORDS = 1 << 16
BITS = 4


@dataclass(frozen=True)
class DayFacts:
    rows: int
    least: object
    greatest: object
    first: datetime | None
    last: datetime | None
    top_id: int | None


def _hash(key: Column, kind: str) -> Column:
    return F.xxhash64(key.cast(kind))


def sketch_word(key: Column, kind: str) -> Column:
    return F.pmod(_hash(key, kind), F.lit(WORDS)).cast("int")


def sketch_bits(key: Column, kind: str) -> Column:
    """The bits of a key in its word, taken from parts of the hash that do not choose the word."""
    bits = F.lit(0).cast("long")
    for i in range(BITS):
        place = F.shiftrightunsigned(_hash(key, kind), 16 + 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits


class KeyIndex:
    """Facts and sketches of all written days of one history. ``load`` names the folder a day was written in."""

    def __init__(self, spark: SparkSession, root: str, table: str):
        self.spark, self.table = spark, table
        self.folder = f"{root}/{table}-index"
        self.key = NATURAL_KEYS[table][0]
        self.kind = struct_of(table)[self.key].dataType.simpleString()
        schema = (
            f"load string, day date, rows long, least {self.kind}, greatest {self.kind}, "
            "first timestamp_ntz, last timestamp_ntz, top_id long"
        )
        self._facts = AppendedTable(spark, f"{self.folder}/facts", schema)

    def add(self, written: DataFrame, load: str) -> None:
        """Index the days just written; reads their keys, dates and ids only."""
        when = F.col(EVENT_TIMES[self.table])
        key = F.col(self.key).cast(self.kind)
        facts = written.groupBy(F.col(DAY).alias("day")).agg(
            F.count("*").alias("rows"),
            F.min(key).alias("least"),
            F.max(key).alias("greatest"),
            F.min(when).cast("timestamp_ntz").alias("first"),
            F.max(when).cast("timestamp_ntz").alias("last"),
            F.max("ID").cast("long").alias("top_id"),
        )
        sketches = written.where(F.col(self.key).isNotNull()).groupBy(
            F.col(DAY).alias("day"), sketch_word(F.col(self.key), self.kind).alias("word")
        ).agg(F.bit_or(sketch_bits(F.col(self.key), self.kind)).alias("bits"))
        sketches.write.mode("overwrite").parquet(f"{self.folder}/keys/{load}")
        # The facts come last: a day counts as indexed when its facts are there.
        facts = facts.select(F.lit(load).alias("load"), "*")
        facts.coalesce(1).write.mode("append").parquet(f"{self.folder}/facts")

    def forget_all_but(self, loads: set[str]) -> None:
        """Put the facts of the named loads into one file; those of all others go."""
        held = [r for r in self._facts.rows() if r["load"] in loads]
        if len(held) < len(self._facts.rows()) or self._facts.file_count() > 1:
            self._facts.replace([tuple(r) for r in held])

    def facts(self, days: Iterable[tuple[date | None, str]]) -> dict[date | None, DayFacts]:
        """Facts of days by the load that wrote each; days without any are not in the result."""
        held = {(r["load"], r["day"]): r for r in self._facts.rows()}
        found = {}
        for day, load in days:
            if row := held.get((load, day)):
                found[day] = DayFacts(*[row[c] for c in ("rows", "least", "greatest", "first", "last", "top_id")])
        return found

    def holding(self, keys: DataFrame, days: Iterable[tuple[date | None, str]]) -> set[date | None]:
        """Days that may hold one of ``keys`` (one column); those never indexed always may.

        The keys' range is compared with each day's first, so that sketches of days out of range are not read.
        """
        days = list(days)
        facts = self.facts(days)
        unknown = {day for day, _ in days if day not in facts}
        (name,) = keys.columns
        key = F.col(name).cast(self.kind)
        least, greatest = keys.agg(F.min(key), F.max(key)).first()
        if least is None:
            return unknown
        near = {
            (load, day)
            for day, load in days
            if day in facts and facts[day].least is not None
            and facts[day].least <= greatest and least <= facts[day].greatest
        }
        loads = sorted({load for load, _ in near})
        if not loads:
            return unknown
        asked = keys.select(
            sketch_word(F.col(name), self.kind).alias("word"), sketch_bits(F.col(name), self.kind).alias("asked")
        ).distinct()
        found = set()
        schema = "day date, word int, bits long"
        paths = [f"{self.folder}/keys/{load}" for load in loads]
        held = self.spark.read.schema(schema).option("basePath", f"{self.folder}/keys").parquet(*paths)
        load = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("load")
        held = held.select("day", "word", "bits", load)
        hits = held.join(asked, "word").where(F.col("bits").bitwiseAND(F.col("asked")) == F.col("asked"))
        for row in hits.select("load", "day").distinct().collect():
            if (row["load"], row["day"]) in near:
                found.add(row["day"])
        return unknown | found
