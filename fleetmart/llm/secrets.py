"""Secret scans over a ledger of blobs: every text that ever stood somewhere is scanned once per rule version.

A blob is a text, named by its SHA-256. The ledger is a folder of Parquet batches (blob, rule, version, spans);
a scan asks it which pairs of blob and rule version are missing, scans those and appends them as one batch.
Findings are then joined back to every path (row) that holds the blob.

Defined results: a NULL text is the empty text; a NULL path keeps its row; repeated rows get a result each; an
empty table gives no rows and an empty batch; very long texts are scanned whole; other columns are left behind.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one blob's findings are spread over so many keys before they meet its paths.
SALTS = 16
SPANS = "array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of a pattern that do not overlap; those with less than ``least`` characters in ``group`` drop."""

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0
    flags: int = 0


# The patterns and least lengths that are asked for.
RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2,
         re.IGNORECASE | re.ASCII),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 20),
    Rule("hex", 1, r"[0-9a-f]+", 24),
)


def spans(rule: Rule, text: str) -> list[tuple[int, int]]:
    """Start and end (exclusive) in code points of what the rule finds."""
    found = []
    for m in re.finditer(rule.pattern, text, rule.flags):
        start, end = m.span(rule.group)
        if end - start >= rule.least:
            found.append(m.span())
    return found


def _fast(rule: Rule) -> Rule:
    """The rule with its least length inside the pattern, where a run of one class makes that the same matches.

    A run that is too short has no longer match inside, so the engine may skip it without handing it over.
    """
    if rule.group == 0 and rule.pattern.endswith("]+"):
        lead = re.match(r"[A-Za-z]*", rule.pattern).end()
        return Rule(rule.kind, rule.version, f"{rule.pattern[:-1]}{{{rule.least - lead},}}", rule.least)
    return rule


def _scan(rules: tuple[Rule, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fast = {(r.kind, r.version): _fast(r) for r in rules}
        for batch in batches:
            blobs, names, versions, found = [], [], [], []
            for blob, text, todo in zip(batch["blob"], batch["text"], batch["todo"]):
                value = text.as_py()
                for t in todo.as_py():
                    rule = fast[t["rule"], t["version"]]
                    blobs.append(blob.as_py())
                    names.append(rule.kind)
                    versions.append(rule.version)
                    found.append([{"start": a, "end": b} for a, b in spans(rule, value)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(blobs, pa.binary()), pa.array(names, pa.string()), pa.array(versions, pa.int32()),
                 pa.array(found, kind)],
                names=["blob", "rule", "version", "spans"],
            )

    return scan


class Ledger:
    """What has been scanned, by which rule version, and what was found."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        schema = f"blob binary, rule string, version int, spans {SPANS}"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def unseen(self, blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """blob, text, todo: the rule versions that have not seen the blob; none left, no row."""
        wanted = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
        seen = self.rows().groupBy(F.col("blob").alias("seen_blob")).agg(
            F.collect_set(F.struct("rule", "version")).alias("seen"))
        todo = F.array_except(wanted, F.coalesce("seen", F.slice(wanted, 1, 0)))
        joined = blobs.join(seen, F.col("blob") == F.col("seen_blob"), "left")
        return joined.select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)

    def scan(self, texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan what is new in ``texts`` (column text) and append it as one batch, all or nothing."""
        blobs = texts.select(blob_of(F.coalesce("text", F.lit(""))).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
        blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
        schema = f"blob binary, rule string, version int, spans {SPANS}"
        new = self.unseen(blobs, rules).mapInArrow(_scan(rules), schema)
        new.write.parquet(f"{self.path}/batch-{uuid.uuid4().hex}")


def blob_of(c):
    return F.unhex(F.sha2(c, 256))


def findings(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, path: str = "doc_id",
             keep: list[str] | None = None) -> DataFrame:
    """One row for each row of ``docs`` (path, text): ``row``, a struct of the columns to keep (the path), and spans
    (kind, start, end; by start, then in the rules' order).

    Only blobs in which something was found are joined, each of them under all salts, so that the many paths of
    one blob are met by several tasks.
    """
    ranks = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    current = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    hits = ledger.rows().where(F.array_contains(current, F.struct("rule", "version")) & (F.size("spans") > 0))
    hits = hits.select("blob", "rule", F.explode("spans").alias("s"))
    spot = F.struct(F.col("s.start").alias("start"), ranks[F.col("rule")].alias("rank"), F.col("rule").alias("kind"),
                    F.col("s.end").alias("end"))
    hits = hits.groupBy("blob").agg(F.sort_array(F.collect_set(spot)).alias("spots"))
    hits = hits.select("blob", "spots", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    held = docs.select(
        F.struct(*(keep or [path])).alias("row"),
        blob_of(F.coalesce("text", F.lit(""))).alias("blob"),
        F.pmod(F.xxhash64(path), F.lit(SALTS)).cast("int").alias("salt"),
    )
    out = held.join(hits, ["blob", "salt"], "left")
    shown = F.transform(
        F.coalesce("spots", F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return out.select("row", shown.alias("spans"))


def redact(c, spots):
    """The text with each span replaced by the kind in brackets; overlapping spans are replaced as one."""
    merged = F.aggregate(
        spots,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"],
                   F.concat(acc["out"], F.substr(c, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]")))
            .otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        ),
    )
    return F.concat(merged["out"], F.substr(c, merged["at"] + 1))
