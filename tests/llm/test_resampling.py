"""Checksums against zlib, features and draws against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from fleetmart.llm import ORACLE, QUERIES, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, run):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, run + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, run=1):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = Counter(bucket(f) for _, t in rows for f in plain_features(t, run)[1])
    t = Counter(bucket(f) for x in target for f in plain_features(x, run)[1])
    all_s, all_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    out, eligible = [], []
    for i, (doc, text) in enumerate(rows):
        words, found = plain_features(text, run)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(found), weight, score, None])
        if len(words) >= 20:
            eligible.append((-score, -1 if doc is None else doc, i))
    for place, (_, _, i) in enumerate(sorted(eligible)[: len(eligible) * 10 // 100], 1):
        out[i][4] = place
    return sorted(map(tuple, out), key=str)


def run(spark, rows, target, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS part", "3 AS rank")
    wanted = spark.createDataFrame([(1, t) for t in target], "item_id long, text string")
    return sorted(map(tuple, resampling.resample(docs, wanted, **options).collect()), key=str)


def test_spans_against_zlib():
    rng = random.Random(1)
    parts = [rng.randbytes(n) for n in [1, 2, 3, 63, 64, 65, 127, 128, 129, 191, 192, 193, 1000, 4097, 5]]
    ends = np.cumsum([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    found = resampling.crc32_spans(data, ends - [len(p) for p in parts], ends)
    assert found.tolist() == [zlib.crc32(p) for p in parts]


TARGET = ["the Quick brown fox", "fox über 自然 9", None, "", "lazy dogs the the"]


def texts(n):
    rng = random.Random(2)
    vocabulary = "the Quick brown FOX über 自然 9 lazy dog-s k'x \x00 \t é".split(" ")
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 60)))) for i in range(n)]
    long = "w" * 500 + " " + " ".join(rng.choices(vocabulary, k=60_000))
    return rows + [(n, None), (None, "the " * 30), (n + 1, ""), (n + 2, long), (3, rows[3][1]), (3, "the " * 25), (n + 3, "|;|")]


@pytest.mark.parametrize("words", [1, 2])
def test_against_plain(spark, words):
    rows = texts(150)
    assert run(spark, rows, TARGET, run=words) == brute(rows, TARGET, words)


def test_edges(spark):
    assert run(spark, [], TARGET) == []
    rows = texts(30)
    assert run(spark, rows, []) == brute(rows, [])
    few = [(i, "one two") for i in range(9)]
    assert run(spark, few, TARGET) == brute(few, TARGET)


def test_equal_rows(spark):
    """Rows with one id and text tie; as many of them are drawn as there are places."""
    rows = [(1, "alpha " * 20)] * 40
    assert run(spark, rows, TARGET) == brute(rows, TARGET)


def test_sql(spark, given):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{given.folder}/{name}.parquet'")
    expected = con.execute(ORACLE["op12_importance_resampling"]).fetchall()
    assert sorted(map(tuple, QUERIES["op12_importance_resampling"](spark, given.folder).collect()), key=str) == sorted(expected, key=str)
