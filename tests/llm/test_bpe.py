import hashlib
import unicodedata

import public_tokenizers
import pytest
from hypothesis import given as draw
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetmart.llm import QUERIES, bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ours(text, frequent=("the", "and", "é", "!!!")):
    vocabulary = bpe.Vocabulary(PATH) if not hasattr(ours, "v") else ours.v
    ours.v = vocabulary
    lexicon = bpe.Lexicon(bpe.compile_lexicon({w.encode(): vocabulary.merge(w) for w in frequent}))
    return bpe.encode_text(bpe._Memory(vocabulary, lexicon), text)


@settings(max_examples=300, deadline=None)
@draw(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("  \n'sdlreaΣσİß²9éÉ中🙂é")), max_size=60))
def test_ids_and_text_are_the_librarys(text):
    expected = LIBRARY.encode(text, add_special_tokens=False)
    ids = ours(text)
    assert ids == expected.ids
    assert ours.v.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", " ", "a<|endoftext|>B <|startoftext|>", "x" * 3000, "aaaa" * 700 + "!", "!?" * 900, "we've WE'LL 'S 's123",
    "՘ new letters \U00010d50", "ΑΣ ΣΑΣ.", "\x00\x1c\x85\xa0​",
])
def test_odd_texts(text):
    assert ours(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_words_of_all_code_points():
    """Each code point between letters, alone and before a digit."""
    vocabulary = bpe.Vocabulary(PATH)
    signs = bpe._byte_signs()
    for c in range(0x30000):
        if 0xD800 <= c < 0xE000 or unicodedata.category(chr(c)) == "Co":
            continue
        text = f"ab{chr(c)}cd {chr(c)} {chr(c)}{chr(c)}1"
        cut = LIBRARY.pre_tokenizer.pre_tokenize_str(LIBRARY.normalizer.normalize_str(text))
        assert ["".join(signs[b] for b in w.encode()) for w in vocabulary.words(text)] == [w for w, _ in cut]


@settings(max_examples=200, deadline=None)
@draw(st.dictionaries(st.binary(max_size=6), st.lists(st.integers(0, 9), max_size=5).map(tuple), max_size=40), st.binary(max_size=6))
def test_lexicon_holds_what_it_was_given(entries, other):
    lexicon = bpe.Lexicon(bpe.compile_lexicon(entries))
    for word, ids in entries.items():
        assert lexicon.get(word) == ids
    assert lexicon.get(other) == entries.get(other)


def test_lexicon_is_minimal():
    words = [f"{a}{b}ing".encode() for a in "pqrs" for b in "aeiou"]
    lexicon = bpe.Lexicon(bpe.compile_lexicon({w: (1,) for w in words}))
    assert len(lexicon.final) == 1 + 1 + 4  # the start, one state after the first letter, then i, n, g and the end
    assert len(bpe.Lexicon(bpe.compile_lexicon({})).final) == 1


def test_documents(spark, given):
    rows = [(1, None), (2, ""), (3, "The the THE and 42 <|endoftext|>"), (3, "twice"), (3, "twice"), (None, "é " * 40000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("x"), "word": F.lit(1)})
    assert sorted(bpe.frequent_words(docs, PATH, 3)) == ["the", "twice", "é"]
    assert sorted(bpe.frequent_words(docs, PATH, 2)) == ["the", "é"]
    name = bpe.publish_lexicon(docs, PATH, 5)
    out = sorted(((r.doc_id or 0, list(r.ids), r.decoded) for r in bpe.encode_documents(docs, PATH, name).collect()))
    expected = [(i or 0, LIBRARY.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    assert out == sorted((i, ids, LIBRARY.decode(ids, skip_special_tokens=False)) for i, ids in expected)
    none = docs.limit(0)
    assert bpe.encode_documents(none, PATH, bpe.publish_lexicon(none, PATH)).count() == 0


def test_query(spark, given):
    texts = {r.doc_id: r.text for r in given.documents.collect()}
    out = QUERIES["op6_bpe"](spark, given.folder).collect()
    assert len(out) == len(texts)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in out:
        ids = LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(" ".join(map(str, ids))), digest(decoded))


def test_long_and_usual_merges_agree():
    """The queue gives what the library's merger gives, for words of any length."""
    import random

    rng, vocabulary = random.Random(3), bpe.Vocabulary(PATH)
    for _ in range(3000):
        word = "".join(rng.choices("aeiounrst!?é中", k=rng.randrange(1, 20)))
        data = word.encode()
        ids = [*(vocabulary.byte_ids[b] for b in data[:-1]), vocabulary.last_ids[data[-1]]]
        assert vocabulary._merge_long(ids) == vocabulary.merge(word)


def test_memory_keeps_what_is_met(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    vocabulary = bpe.Vocabulary(PATH)
    memory = bpe._Memory(vocabulary, bpe.Lexicon(bpe.compile_lexicon({})))
    text = " ".join(f"the w{i} of" for i in "abcdefghijkl")
    assert bpe.encode_text(memory, text) == LIBRARY.encode(text, add_special_tokens=False).ids
    assert len(memory) <= 5 and len(memory.before) <= 5 and ("the" in memory or "the" in memory.before)
