import zlib
from array import array
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given as draw
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetmart.llm import QUERIES, packing

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = Tokenizer.from_file(FILES[0])


@settings(max_examples=300, deadline=None)
@draw(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("  \n\t'sdl0١²éÉß中🙂")), max_size=60))
def test_encoder_is_the_librarys(text):
    assert packing.encoder(*FILES)(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a<|endoftext|> b", "x" * 5000, " " * 5000 + "y", "\n" * 1500])
def test_encoder_of_odd_texts(text):
    assert packing.encoder(*FILES)(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("length", [1, 5, 31, 32, 33, 700, 1023, 1024, 1025, 5000])
def test_cuts(length):
    pieces = packing.cuts(length)
    assert sum(pieces) == length and min(pieces) > 0 and max(pieces) <= 1024
    assert sum(p < packing.GRAIN for p in pieces) <= 1


def check(rows, texts):
    """rows: (doc_id, start, length, crc, doc_tokens, sequence_id, offset); ids that are texts' keys once each."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, total, sequence, offset in rows:
        docs[doc].append((start, length, crc, total))
        sequences[sequence].append((offset, length))
    assert set(docs) == set(texts)
    for doc, pieces in docs.items():
        ids = LIBRARY.encode(texts[doc] or "", add_special_tokens=False).ids + [0]
        at = 0
        for start, length, crc, total in sorted(pieces):
            assert (start, total) == (at, len(ids))
            assert zlib.crc32(array("I", ids[start : start + length]).tobytes()) == crc
            at += length
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences)


def test_query(spark, given):
    texts = {r.doc_id: r.text for r in given.documents.collect()}
    rows = [tuple(r) for r in QUERIES["op10_packing"](spark, given.folder).collect()]
    n = check(rows, texts)
    tokens = sum(r[2] for r in rows)
    assert n <= tokens / 1024 * 1.02 + 4


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a b c " * 20000), (None, "x")] + [(i, "one word") for i in range(10, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "offset": F.lit(0)})
    out = packing.pack(docs, *FILES).withColumn("ids", F.crc32("ids"))
    check([tuple(r) for r in out.collect()], dict(rows))
    twice = packing.pack(docs.where("doc_id = 2").union(docs.where("doc_id = 2")), *FILES)
    assert twice.count() == 2
    assert packing.pack(docs.limit(0), *FILES).count() == 0
