import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetmart.llm import secrets
from tests_llm_brute import groups


@pytest.fixture(scope="module")
def stages(spark, given, tmp_path_factory):
    """The output of every stage over the given documents, with odd rows and a column more."""
    odd = [(90001, None), (90002, ""), (90003, "12 !"), (90004, "token = abcdefgh1 here"), (90005, "token = abcdefgh1 here"), (None, "a b")]
    more = spark.createDataFrame(odd, "doc_id long, text string").withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit("odd"), "n_chars": F.length("text").cast("long")})
    docs = given.documents.select("doc_id", "text", "lang", "source", "n_chars").unionByName(more).withColumn("p", F.lit("kept"))
    out, folder = [docs], tmp_path_factory.mktemp("stages")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], given.folder).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_language_keeps_what_has_letters(stages):
    assert rows(stages[1]) == [r for r in rows(stages[0]) if re.search(r"[^\W\d_]", r[1] or "")]


def test_language_of_unlabelled_texts(spark, given):
    """Unlabelled corpora lose no text with letters; where some rows have labels, the others get the model's."""
    texts = ["the cat sat on the mat", "le chat est sur la table", "12 !", None]
    docs = spark.createDataFrame([(i, texts[i % 4]) for i in range(40)], "doc_id long, text string")
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    out = corpus_pipeline.known_language(spark, bare, given.folder)
    assert sorted((r.doc_id, r.lang) for r in out.collect()) == [(i, None) for i in range(40) if i % 4 < 2]
    right = F.when(F.col("doc_id") % 4 == 0, "und").when(F.col("doc_id") % 4 == 1, "fr")
    some = docs.withColumn("lang", F.when(F.col("doc_id") < 30, right))
    out = corpus_pipeline.known_language(spark, some, given.folder)
    assert "".join(out._jdf.queryExecution().executedPlan().toString()).count("ArrowEvalPython") == 1
    assert {(r.doc_id, r.lang) for r in out.collect()} == {
        (i, None if i >= 30 and i % 4 == 0 else ["und", "fr"][i % 4]) for i in range(40) if i % 4 < 2}


def test_toxic_go(stages, given):
    toxic = {r.doc_id for r in given.labels.where("toxic = 1").collect()}
    clean = {r.doc_id for r in given.labels.where("toxic = 0").collect()}
    before, after = ({r[0] for r in rows(df)} for df in stages[1:3])
    assert len(after & toxic) <= 0.3 * len(before & toxic) and len(after & clean) >= 0.98 * len(before & clean)


def test_one_of_each_group(stages):
    before = rows(stages[2])
    kept = [(doc, text) for (doc, text), (_, _, _, kept) in zip(before, groups(before)) if kept]
    assert rows(stages[3]) == kept


def test_secrets_are_scrubbed(stages):
    before, after = ({r.doc_id: r for r in df.collect()} for df in stages[3:5])
    assert set(before) == set(after)
    for doc, r in after.items():
        hit = any(secrets.spans(rule, before[doc].text) for rule in secrets.RULES)
        assert hit == (r.text != before[doc].text)
        assert not any(secrets.spans(rule, r.text) for rule in secrets.RULES)
        assert not hit or r.n_chars == len(r.text)
    assert after[90004].text == "[assign] here"


def test_packing_holds_all(stages):
    ends = stages[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert sorted((r.doc_id for r in ends), key=str) == [d for d, _ in rows(stages[4])]
    assert all(r.n == r.m for r in ends)


def test_run(spark, given):
    assert corpus_pipeline.run(spark, given.folder).columns[:3] == ["doc_id", "start", "length"]


def test_clashing_names(spark, given):
    """Columns that are called like what the stages make are kept."""
    names = ["_told", "_scrubbed", "_changed", "row", "p", "spans", "group", "place", "key", "id", "text_key", "letters"]
    docs = given.documents.limit(40).select("*", *[F.lit(f"own {n}").alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, given.folder)
        assert out.columns == docs.columns and out.count() > 0
        assert {tuple(r) for r in out.select(*names).collect()} == {tuple(f"own {n}" for n in names)}


def test_no_documents(spark, given):
    docs = given.documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, given.folder).count() == 0
