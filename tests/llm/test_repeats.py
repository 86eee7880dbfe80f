"""Repeated bytes against a count of all strings, and the transform against plain comparisons."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from fleetmart.llm import QUERIES, repeats


def brute(rows, least=repeats.LEAST):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i : i + least] for r in raws for i in range(len(r) - least + 1))
    out = []
    for (doc, _), raw in zip(rows, raws):
        gone = bytearray(len(raw))
        for i in range(len(raw) - least + 1):
            if seen[raw[i : i + least]] > 1:
                gone[i : i + least] = b"\x01" * least
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS h", "2 AS key", "3 AS copies", "4 AS n")
    found = repeats.repeated_bytes(docs, **options).collect()
    return sorted(
        ((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), r.kept_sha256) for r in found), key=str
    )


def prose(rng, n):
    return " ".join(rng.choice("lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy 自然 é".split()) + str(rng.randrange(40)) for _ in range(n))


def planted(seed, passages=4, docs=60):
    """Texts around shared passages whose ends differ, near copies with changed words, and whole copies."""
    rng = random.Random(seed)
    shared = [prose(rng, rng.choice([30, 32, 50, 120])) for _ in range(passages)]
    rows = []
    for i in range(docs):
        text = " ".join([prose(rng, rng.randrange(0, 40)), rng.choice(shared), prose(rng, rng.randrange(0, 40))])
        if i % 5 == 0:
            words = text.split()
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        rows.append((i, text))
        if i % 4 == 0:
            rows.append((1000 + i, rows[rng.randrange(len(rows))][1]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_strings(spark, seed):
    rows = planted(seed)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("crowd", [1, 4])
def test_crowded_anchors(spark, crowd):
    """Every anchor whose segments differ goes through the finer levels."""
    rows = planted(3, passages=1, docs=40)
    assert run(spark, rows, crowd=crowd) == brute(rows)


def test_edges(spark):
    rng = random.Random(5)
    exact, long = "x" * 199, prose(rng, 4000)
    rows = [
        (1, None), (None, ""), (2, "a" * 500), (3, "ab" * 300), (4, exact), (4, exact), (5, "é" * 100), (6, "é" * 100), (7, "y" * 200),
        (8, long), (9, long[:3000] + "!" + long[3000:]), (None, long[100:420]), (10, "z" * 199 + "q" + "z" * 199),
        (11, "w" * 200), (11, "w" * 200),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_given(spark, given):
    rows = [tuple(r) for r in given.documents.select("doc_id", "text").collect()]
    found = sorted(map(tuple, QUERIES["op11_repeated_bytes"](spark, given.folder).collect()), key=str)
    assert found == brute(rows)


def test_kept(spark):
    text = "äbc" + "r" * 250 + "def" + "r" * 220 + "g"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    found = repeats.repeated_bytes(docs).join(docs, "doc_id")
    shown = found.select("doc_id", repeats.kept(found["text"], found["spans"]).alias("kept"), "kept_sha256").collect()
    out = {r.doc_id: (bytes(r.kept), r.kept_sha256) for r in shown}
    assert out[1][0] == "äbcdefg".encode()
    assert all(hashlib.sha256(raw).hexdigest() == digest for raw, digest in out.values())


def test_windows_against_plain_comparison():
    rng = random.Random(7)
    for _ in range(200):
        least = rng.choice([1, 2, 5, 9, 30])
        letters = rng.choice([b"ab", b"abcd", bytes(range(256))])
        pool = [bytes(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(3)]
        parts = [b"".join(rng.choice(pool) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 6))]
        times = [rng.choice([1, 1, 2]) for _ in parts]
        seen = Counter()
        for p, n in zip(parts, times):
            for i in range(len(p) - least + 1):
                seen[p[i : i + least]] += n
        expected = [[seen[p[i : i + least]] > 1 for i in range(len(p) - least + 1)] for p in parts]
        assert [f.tolist() for f in repeats.repeated_windows(parts, np.array(times), least)] == expected


def test_prefix_lengths():
    """The intervals give the common prefixes of sorted rotations, and stop at the bound."""
    rng = random.Random(8)
    text = np.array([rng.randrange(1, 4) for _ in range(120)] + [0])
    order = repeats.rotations(text, 200)
    turned = [np.roll(text, -i).tolist() for i in order]
    assert turned == sorted(turned)
    plain = [0] + [next(k for k, (x, y) in enumerate(zip(a, b)) if x != y) for a, b in zip(turned, turned[1:])]
    assert repeats.bounded_prefixes(text[order - 1], 4).tolist() == [n if n < 4 else -1 for n in plain]


def test_rotations_are_sorted_as_packed_numbers(monkeypatch):
    """Keys carry their places, so no 64-bit keys are sorted through places; symbols are sorted as 16-bit numbers."""
    widths, plain = [], np.argsort
    monkeypatch.setattr(repeats.np, "argsort", lambda x, **options: widths.append(x.itemsize) or plain(x, **options))
    found = repeats.repeated_windows([b"abcd" * 60, b"xbcd" * 60], np.array([1, 1]), 200)
    assert all(f.all() for f in found)
    assert widths and max(widths) <= 2


def test_rotations_of_a_long_text():
    """Places of more than 21 bits do not fit beside their keys."""
    rng = np.random.default_rng(9)
    text = np.append(rng.integers(1, 4, (1 << 21) + 5), 0)
    order = repeats.rotations(text, 9)
    assert np.array_equal(np.sort(order), np.arange(len(text)))
    key = np.zeros(len(text), np.int64)
    for i in range(9):
        key = key * 4 + text[(order + i) % len(text)]
    assert (key[1:] >= key[:-1]).all()
