"""The corpus pipeline: documents through five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.llm import language, neardup, packing, secrets, toxicity
from fleetmart.llm.base import shared_folder, ship, staged, table


def rebuilt(docs: DataFrame, changed: dict[str, Column]) -> list[Column]:
    """The columns of ``docs`` out of a column ``row`` that holds them, some with new values; no other names are used, so
    none can clash with those of ``docs``."""
    return [changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in which no language can be told, as they are NULL or hold no letter, go, and no others do. A NULL ``lang``
    becomes the language that the model tells, and stays NULL if nothing could be learned. Equal rows, rows with one id and
    NULL ids each stay or go by their own text; long texts are read whole; no rows give no rows; other columns are kept."""
    ship(spark)
    model = language.fit(docs.where(~language.held_out()))
    found = language.scored(docs, model).where("p.letters")
    told = F.when(F.col("p.lang_pred") != language.UNKNOWN, F.col("p.lang_pred")).cast(docs.schema["lang"].dataType)
    return found.select(*rebuilt(docs, {"lang": F.coalesce(F.col("row")["lang"], told)}))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the last classifier of the chain takes for toxic go. NULL texts count as empty; equal texts share their
    fate; long texts are read whole; without labelled rows, as without any, nothing goes; other columns are kept."""
    ship(spark)
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    found = toxicity.scored(docs, chain).where(F.col("p.toxic") < toxicity.THRESHOLD)
    return found.select(*rebuilt(docs, {}))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id, of several the one whose text has the
    least hash, of equal rows one. Texts without words, NULL ones among them, all stay; long texts are compared whole; no
    rows give no rows; other columns are kept."""
    ship(spark)
    return neardup.one_of_each(docs)


def scrub_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found in a text is replaced by its kind in brackets; ``n_chars`` follows the text. All rows stay, equal
    ones and those with one id, too; a NULL text stays NULL; long texts are scanned whole; no rows give no rows; other
    columns are kept."""
    ship(spark)
    ledger = secrets.Ledger(spark, shared_folder(spark, "secret-ledger"))
    ledger.scan(docs)
    found = secrets.findings(docs, ledger, keep=docs.columns)
    hit = F.size("spans") > 0
    text = F.when(hit, secrets.redact(F.col("row")["text"], F.col("spans"))).otherwise(F.col("row")["text"])
    changed = {"text": text}
    if "n_chars" in docs.columns:
        length = F.length(text).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(hit, length).otherwise(F.col("row")["n_chars"])
    return found.select(*rebuilt(docs, changed))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 1024. A NULL text has its end token only; equal rows are packed each; long texts are cut
    into pieces, never shortened; no rows give no rows; other columns are left behind."""
    ship(spark)
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


STAGES = [
    ("language", known_language),
    ("toxicity", without_toxic),
    ("near-duplicates", without_copies),
    ("secret scan", scrub_secrets),
    ("packing", pack_sequences),
]

#: Tokenizing, training and regular expressions with positions are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
