"""Alignment against a plain version that walks all tokens."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fleetmart.llm import QUERIES, alignment

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def plain():
    """Text to (id, bytes) of all tokens of both sides, straight from the two libraries."""
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[2])
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}

    def tokens(text):
        found = a.encode(f" {text}", add_special_tokens=False)
        left = [(i, bytes(letters[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        return left, right

    return tokens


def brute(rows, tokens):
    documents, counts = [], Counter()
    for _, text in rows:
        a, b = tokens(text) if text else ([], [])
        whole = f" {text}".encode()
        if not (b"".join(t for _, t in a) == whole == b"".join(t for _, t in b)):
            a, b = [], []
        groups, left, right, at, to = [], [], [], 0, 0
        queue = list(b)
        for i, token in a:
            left.append(i)
            at += len(token)
            while queue and to + len(queue[0][1]) <= at:
                right.append(queue[0][0])
                to += len(queue.pop(0)[1])
            if at == to:
                groups.append((left, right))
                left, right = [], []
        documents.append((a, b, groups))
        counts.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for (doc, _), (a, b, groups) in zip(rows, documents):
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(counts[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(told.encode()).hexdigest() if told else ""
        out.append((doc, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return sorted(out, key=str)


def run(spark, rows, block=alignment.BLOCK):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS pair", "3 AS n_a", "4 AS place")
    return sorted(map(tuple, alignment.align(docs, *FILES, block)[0].collect()), key=str)


def edges():
    rng = random.Random(3)
    words = "the Tokenizer's naïve 自然語言 <|endoftext|> </s> ▁ <0x41> 12345 é \U0001f600 supercalifragilistic".split(" ")
    rows = [(i, rng.choice([" ", "  ", "\n", "\t"]).join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(60)]
    rows += [(100, None), (None, ""), (101, " "), (102, "\x00"), (103, "a▁b"), (104, "<|endoftext|>"), (105, "ﬁ ½ Å"), (7, "the the"), (7, "the the")]
    return rows + [(106, "x" * 1500 + " end"), (107, " ".join(rng.choices(words[:3], k=20_000))), (108, " lead and trail "), (109, "\nline")]


@pytest.mark.parametrize("block", [alignment.BLOCK, 200])
def test_against_plain(spark, plain, block):
    assert run(spark, edges(), block) == brute(edges(), plain)


def test_empty(spark, plain):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == brute([(1, None), (2, "")], plain)


def test_given(spark, given, plain):
    rows = [tuple(r) for r in given.documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_tokenizer_alignment"](spark, given.folder).collect()), key=str) == brute(rows, plain)


def test_pairs(spark):
    docs = spark.createDataFrame([(1, "the cat"), (2, "the dog"), (3, "the the")], "doc_id long, text string")
    pairs = alignment.align(docs, *FILES)[1].collect()
    assert max(p.n for p in pairs) == 3
    assert all(p.best for p in pairs if p.n == 3)


def test_long_run_is_not_remembered_wrongly(spark, plain):
    """Equal ids on one side with other ids on the other are windows of their own."""
    rows = [(i, t) for i, t in enumerate(["ab abc", "ab ab c", "abc ab", "a b abc", "ab abc"])]
    assert run(spark, rows) == brute(rows, plain)
