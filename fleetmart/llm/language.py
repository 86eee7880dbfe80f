"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and cut into words of letters, each with a blank at either end; its n-grams of one to four
characters inside the words are hashed into buckets. Training counts buckets per language, in tasks and then by a
grouped sum over all texts; the matrix of log-probabilities (buckets x languages, bounded by both) is broadcast and
batches of texts are scored with numpy, a few hundred thousand characters at a time.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, and so is every text if nothing could
be learned; rows without a language are not learned from; a NULL id counts as held out; repeated rows are learned
and scored each; equal scores go to the language first in the alphabet; other columns are left behind by
``predict`` and kept by ``scored``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
SMOOTHING = 0.5
UNKNOWN = "und"
#: Characters that are worked on at once.
CHUNK = 1 << 18


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def code_points(text: str) -> np.ndarray:
    """Code points of the lower-cased text with 0 for all but letters, runs of 0 as one, 0 at both ends."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    kept = np.where(_letters()[raw], raw, 0).astype(np.uint32)
    kept = np.concatenate([np.zeros(1, np.uint32), kept, np.zeros(1, np.uint32)])
    return kept[np.concatenate([[True], (kept[1:] != 0) | (kept[:-1] != 0)])]


def grams(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the n-grams' places and buckets. None has a blank but as its first or last character."""
    blank = points == 0
    state = np.zeros(len(points), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        n = len(points) - order + 1
        if n <= 0:
            return
        state = state[:n] * np.uint32(0x01000193) + points[order - 1 :]
        good = np.ones(n, bool)
        for i in range(order):
            if order == 1 or 0 < i < order - 1:
                good &= ~blank[i : i + n]
        if order == 2:
            good &= ~(blank[:n] & blank[1 : 1 + n])
        if order in ORDERS:
            at = np.flatnonzero(good)
            mixed = (state[at] + np.uint32(order * 0x632BE5AB & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
            yield at, ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(16)


def pieces(points: np.ndarray) -> Iterator[np.ndarray]:
    """Stretches of whole words, as long as CHUNK or a longer word asks for."""
    start = 0
    while start < len(points) - 1:
        end = len(points)
        if end - start > CHUNK:
            blanks = np.flatnonzero(points[start + CHUNK :] == 0)
            end = start + CHUNK + int(blanks[0]) + 1
        yield points[start:end]
        start = end - 1  # the blank ends one word and begins the next


def batches(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of several texts at a time, and the number of the text that each place belongs to."""
    held, owners, size = [], [], 0
    for i, text in enumerate(texts):
        for part in pieces(code_points(text)) if text else ():
            held.append(part)
            owners.append(np.full(len(part), i))
            size += len(part)
            if size >= CHUNK:
                yield np.concatenate(held), np.concatenate(owners)
                held, owners, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(owners)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: Log-probability of each bucket (row) in each language (column), and of the languages.
    matrix: np.ndarray
    prior: np.ndarray


def _count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for part in parts:
        by_language: dict[str, list[str]] = {}
        for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist()):
            by_language.setdefault(lang, []).append(text)
        for lang, texts in by_language.items():
            own = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            own[BUCKETS] += len(texts)
            for points, _ in batches(texts):
                for _, buckets in grams(points):
                    own[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
    for lang, own in counts.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())],
            names=["lang", "bucket", "n"],
        )


def fit(docs: DataFrame) -> Model:
    """Learn from all rows of ``docs`` (text, lang) that have both."""
    learned = docs.select("text", F.col("lang").cast("string").alias("lang")).dropna()
    counts = learned.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counts.toPandas()
    languages = sorted(rows["lang"].unique())
    table = np.zeros((BUCKETS + 1, len(languages)))
    column = {lang: i for i, lang in enumerate(languages)}
    table[rows["bucket"].to_numpy(), rows["lang"].map(column).to_numpy(dtype=int)] = rows["n"].to_numpy()
    seen = table[:BUCKETS] + SMOOTHING
    return Model(languages, np.log(seen / seen.sum(axis=0)), np.log(np.maximum(table[BUCKETS], 1)))


def scores(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and its posterior probability for each text."""
    return _scores(model, texts)[:2]


def _scores(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``scores``, and whether each text has a letter."""
    total = np.zeros((len(texts), len(model.languages)))
    letters = np.zeros(len(texts), np.int64)
    for points, owners in batches(texts):
        letters += np.bincount(owners[points != 0], minlength=len(texts))
        for at, buckets in grams(points):
            own = owners[at]
            if len(own):
                starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                total[own[starts]] += np.add.reduceat(model.matrix[buckets], starts, axis=0)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), letters > 0
    total += model.prior
    best = total.argmax(axis=1)
    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    known = letters > 0
    return [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, share, 0.0), known


def scorer(model: Model, spark) -> Column:
    """A function of a text column: struct of lang_pred, score and letters (whether there is one). It is called
    nondeterministic so that a filter on its result does not compute it twice."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, letters boolean")
    def predict_language(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            lang, score, letters = _scores(shared.value, part.astype(object).where(part.notna(), None).to_list())
            yield pd.DataFrame({"lang_pred": lang, "score": score, "letters": letters})

    return predict_language.asNondeterministic()


def held_out() -> Column:
    """Rows that are never learned from: a quarter by checksum of the id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """row, a struct of all columns of ``docs``, and p, a struct of lang_pred, score and letters."""
    predict = scorer(model, docs.sparkSession)
    return docs.select(F.struct(*docs.columns).alias("row"), predict("text").alias("p"))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text)."""
    shown = docs.select("doc_id", "text").withColumn("held_out", held_out())
    return scored(shown, model).select("row.doc_id", "row.held_out", "p.lang_pred", "p.score")
