"""Toxicity: a chain of linear classifiers, each of which sees what the earlier ones think.

Categories are label columns in a fixed order. Each has a logistic regression over the presence of words and word
beginnings, and over the earlier categories' probabilities. So that a later model learns from probabilities as
doubtful as those it will meet, training takes out-of-fold ones: labelled texts fall into folds, and a text's
earlier probabilities come from models fitted on the other folds.

Models are fitted on a bounded sample of labelled rows: ``SAMPLE`` for each value of the last label, those with
the smallest hash of their id. Features are counted in Spark over the sample, the ``FEATURES`` that tell most about
a category are kept, and the small matrix that is left is solved with numpy, where a feature counts as much as it
tells: so the penalty falls on words that stand in few texts by chance. All texts are scored, whole.

Defined results: a NULL text has no features, and so the base rate; a row with a NULL label teaches nothing about
that category; labels of unknown ids are ignored, and repeated ones count once, by their maximum; without labels, or
with one value only, a category's probability is that value's (0 without any); repeated rows are scored each;
empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Label columns, earlier ones first; the last is the one that is asked for.
CATEGORIES = ("quality", "toxic")
#: Labelled rows for each value of the last category, at most.
SAMPLE = 5000
#: Features kept for each category, at most, and the least number of sampled texts that hold one.
FEATURES = 2000
LEAST_TEXTS = 3
PREFIXES = (4, 5, 6, 7)
FOLDS = 3
PENALTY = 0.05
STEPS = 120
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    """Words, and beginnings of longer words (with ``^``), of the lower-cased text."""
    words = set(_WORD.findall(text.lower())) if text else set()
    out = set(words)
    for n in PREFIXES:
        out.update(["^" + w[:n] for w in words if len(w) > n])
    return out


@dataclass(frozen=True)
class Linear:
    weights: dict[str, float]
    bias: float
    #: Weights of the earlier categories' probabilities, as log-odds.
    chain: tuple[float, ...]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def log_odds(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def solve(row: np.ndarray, col: np.ndarray, scale: np.ndarray, dense: np.ndarray, y: np.ndarray):
    """Penalised logistic regression over a sparse matrix (row, col), with a value for each column, and dense columns.

    Returns weights for 0/1 features, dense weights and the bias.
    """
    n, width, value = len(y), len(scale), scale[col]
    weights = np.zeros(width + dense.shape[1] + 1)
    rate = np.clip((y.sum() + 0.5) / (n + 1), 1e-4, 1 - 1e-4)
    weights[-1] = log_odds(rate)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, weights[col] * value, n) + dense @ weights[width:-1] + weights[-1]
        off = sigmoid(z) - y
        gradient = np.concatenate([np.bincount(col, off[row] * value, width), dense.T @ off, [off.sum()]])
        gradient[:-1] += PENALTY * weights[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        pace = 0.1 if step < STEPS * 2 // 3 else 0.02
        weights -= pace * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights[:width] * scale, weights[width:-1], weights[-1]


def fit_chain(texts: list[np.ndarray], names: list[str], labels: np.ndarray, folds: np.ndarray,
              tells: list[dict[str, float]]) -> list[Linear]:
    """One model for each column of ``labels`` (NaN: not known), in their order.

    ``texts`` has the places of each text's features in ``names``, ``tells``, for each column, how much each feature
    that may be used tells about it.
    """
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts]).astype(np.int64)
    col = np.concatenate([np.empty(0, np.int64), *texts]).astype(np.int64)
    earlier = np.zeros((len(texts), 0))
    chain = []
    for y, weight in zip(labels.T, tells):
        scale = np.array([weight.get(name, 0.0) for name in names])
        scale /= scale.max(initial=0.0) or 1.0
        known = ~np.isnan(y)
        values = np.unique(y[known])

        def fitted(rows: np.ndarray):
            at = np.flatnonzero(rows)
            if len(np.unique(y[at])) < 2:
                only = float(y[at][0]) if len(at) else 0.0
                return np.zeros(len(names)), np.zeros(earlier.shape[1]), float(log_odds(only))
            renumber = np.full(len(texts), -1)
            renumber[at] = np.arange(len(at))
            mine = renumber[row] >= 0
            return solve(renumber[row[mine]], col[mine], scale, log_odds(earlier[at]), y[at])

        def probability(model) -> np.ndarray:
            weights, dense, bias = model
            return sigmoid(np.bincount(row, weights[col], len(texts)) + log_odds(earlier) @ dense + bias)

        out_of_fold = np.full(len(texts), float(values[0]) if len(values) == 1 else 0.0)
        for fold in np.unique(folds) if len(values) == 2 else ():
            out_of_fold[folds == fold] = probability(fitted(known & (folds != fold)))[folds == fold]
        weights, dense, bias = fitted(known)
        chain.append(Linear({n: float(w) for n, w in zip(names, weights) if w}, float(bias), tuple(map(float, dense))))
        earlier = np.column_stack([earlier, out_of_fold])
    return chain


def _places(names):
    """The features of a text that are among ``names``, as sorted places there."""

    def places(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {name: i for i, name in enumerate(names.value)}
        for part in parts:
            found = [sorted(place[f] for f in text.as_py() if f in place) for text in part["features"]]
            columns = [part[c] for c in part.schema.names if c != "features"]
            kept = [c for c in part.schema.names if c != "features"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.int32()))], names=[*kept, "places"])

    return places


def _text_features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        found = [sorted(features(t)) for t in part["text"].to_pylist()]
        columns = [part[c] for c in part.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(found, pa.list_(pa.string()))],
            names=[*(c for c in part.schema.names if c != "text"), "features"],
        )


def sampled(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """fold, text and the labels of at most ``SAMPLE`` labelled texts for each value of the last category.

    The sampled ids are few by that bound, so they are sent to the texts, and no text moves but theirs.
    """
    spark = docs.sparkSession
    one = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        *[F.max(F.col(c).cast("double")).alias(c) for c in categories])
    order = F.xxhash64("doc_id")
    last = F.col(categories[-1])
    rows = [r for value in (0.0, 1.0) for r in one.where(last == value).orderBy(order, "doc_id").limit(SAMPLE).collect()]
    ids = spark.createDataFrame(
        [(int(r["doc_id"]), *[r[c] for c in categories]) for r in rows],
        "_id long, " + ", ".join(f"`{c}` double" for c in categories),
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(ids), "_id").withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int"))
    return found.groupBy("text", "fold").agg(*[F.max(c).alias(c) for c in categories])


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> list[Linear]:
    """Learn the chain from ``labels`` (doc_id and the categories, 0 or 1) of ``docs`` (doc_id, text)."""
    from fleetmart.llm.base import staged

    kinds = ", ".join(f"`{c}` double" for c in categories)
    found = sampled(docs, labels, categories).select("fold", *categories, "text")
    held = staged(found.mapInArrow(_text_features, f"fold int, {kinds}, features array<string>"), "toxicity-sample")
    totals = held.agg(*[F.sum((F.col(c) == v).cast("long")).alias(f"{c}{v}") for c in categories for v in (0, 1)]).first()
    counts = held.select(F.explode("features").alias("feature"), *categories).groupBy("feature").agg(
        F.count("*").alias("n"),
        *[F.sum((F.col(c) == v).cast("double")).alias(f"{c}{v}") for c in categories for v in (0, 1)],
    )
    counts = counts.where(F.col("n") >= LEAST_TEXTS)
    tells: list[dict[str, float]] = []
    for c in categories:
        share = lambda v: (F.coalesce(F.col(f"{c}{v}"), F.lit(0.0)) + 0.5) / ((totals[f"{c}{v}"] or 0) + 1)  # noqa: E731, B023
        told = counts.select("feature", (F.abs(F.log(share(1)) - F.log(share(0))) * F.sqrt("n")).alias("tells"))
        best = told.orderBy(F.desc("tells"), "feature").limit(FEATURES).collect()
        tells.append({r["feature"]: r["tells"] for r in best})
    names = sorted(set().union(*tells))
    shared = docs.sparkSession.sparkContext.broadcast(names)
    few = held.select("fold", *categories, "features").mapInArrow(_places(shared), f"fold int, {kinds}, places array<int>")
    few = few.orderBy("fold", "places", *categories).toArrow()
    return fit_chain(
        [np.array(p.as_py(), np.int64) for p in few["places"]],
        names,
        np.column_stack([few[c].to_numpy() for c in categories]).astype(float),
        few["fold"].to_numpy(),
        tells,
    )


def probabilities(chain: list[Linear], text: str | None) -> list[float]:
    """One for each category, the earlier ones feeding the later."""
    found, out = features(text), []
    for model in chain:
        z = model.bias + sum(model.weights[f] for f in found & model.weights.keys())
        z += sum(w * log_odds(p) for w, p in zip(model.chain, out))
        out.append(float(sigmoid(z)))
    return out


def scorer(chain: list[Linear], spark, categories: tuple[str, ...] = CATEGORIES) -> Column:
    """A function of a text column: struct of one probability for each category."""
    shared = spark.sparkContext.broadcast(chain)

    @F.pandas_udf(", ".join(f"`{c}` double" for c in categories))
    def predict_toxicity(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            yield pd.DataFrame([probabilities(shared.value, t) for t in part], columns=list(categories), dtype=float)

    return predict_toxicity


def scored(docs: DataFrame, chain: list[Linear], categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """row, a struct of all columns of ``docs``, and p, a struct of the categories' probabilities."""
    predict = scorer(chain, docs.sparkSession, categories)
    return docs.select(F.struct(*docs.columns).alias("row"), predict("text").alias("p"))
