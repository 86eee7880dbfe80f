import zlib

import numpy as np
from pyspark.sql import functions as F

from fleetmart.llm import QUERIES, language, toxicity


def test_grams_stay_inside_words():
    points = language.code_points("Ab1c, É")
    assert "".join(chr(p) if p else "_" for p in points) == "_ab_c_é_"
    found = {n: len(at) for n, (at, _) in zip(language.ORDERS, language.grams(points))}
    assert found == {1: 4, 2: 7, 3: 4, 4: 1}


def test_long_texts_are_cut_between_words(monkeypatch):
    text = "der die das und " * 300
    whole = [b for _, b in language.grams(language.code_points(text))]
    monkeypatch.setattr(language, "CHUNK", 50)
    parts = [[b for _, b in language.grams(p)] for p in language.pieces(language.code_points(text))]
    for order in range(4):
        together = np.concatenate([p[order] for p in parts])
        assert np.array_equal(np.sort(together), np.sort(whole[order]))


def test_language_of_odd_rows(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "le chat est sur la table", "fr"), (3, None, "fr"), (4, "le", None),
            (5, "123 !!", "en"), (None, "the", "en"), (7, "", None), (7, "the cat", "en"), (7, "the cat", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit(1), "row": F.lit(2)})
    out = language.predict(docs, language.fit(docs)).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in out) == [
        (0, "en"), (1, "en"), (2, "fr"), (3, "und"), (4, "fr"), (5, "und"), (7, "en"), (7, "en"), (7, "und")]
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.lang_pred != "und") for r in out)
    nothing = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(docs.limit(0), nothing).count() == 0


def test_language_matches_plain_counts(spark):
    """The scores against the same model written out with dictionaries."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("ab ab ba", "x"), ("bb ba", "y"), ("ab", "y")])]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["x", "y"]
    total = {lang: np.zeros(language.BUCKETS) for lang in "xy"}
    for _, text, lang in rows:
        for _, buckets in language.grams(language.code_points(text)):
            for b in buckets:
                total[lang][b] += 1
    z = []
    for lang, n in (("x", 1), ("y", 2)):
        p = (total[lang] + language.SMOOTHING) / (total[lang] + language.SMOOTHING).sum()
        z.append(np.log(n) + sum(np.log(p[b]) for _, bs in language.grams(language.code_points("ab b")) for b in bs))
    got, score = language.scores(model, ["ab b"])
    expected = np.exp(z) / np.exp(z).sum()
    assert got == ["xy"[int(np.argmax(z))]] and abs(score[0] - expected.max()) < 1e-9


def test_language_query(spark, given):
    out = {r.doc_id: r for r in QUERIES["op7_language"](spark, given.folder).collect()}
    truth = {r.doc_id: r for r in given.documents.collect()}
    assert set(out) == set(truth)
    for i, r in out.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    held = [i for i, r in out.items() if r.held_out and truth[i].lang]
    assert sum(out[i].lang_pred == truth[i].lang for i in held) >= 0.97 * len(held)


def test_chain_feeds_later_models():
    rng = np.random.default_rng(0)
    first = rng.integers(0, 2, 400).astype(float)
    texts = [np.array([0 if f else 1]) for f in first]
    labels = np.column_stack([first, first])
    chain = toxicity.fit_chain(texts, ["a", "b"], labels, rng.integers(0, 3, 400), [dict.fromkeys("ab", 1.0)] * 2)
    assert len(chain) == 2 and chain[0].chain == () and len(chain[1].chain) == 1 and chain[1].chain[0] > 0
    low, high = (toxicity.probabilities(chain, t) for t in ("b", "a"))
    assert high[0] > 0.9 > 0.1 > low[0] and high[1] > 0.9 > 0.1 > low[1]


def test_chain_without_labels():
    assert toxicity.probabilities(toxicity.fit_chain([], [], np.zeros((0, 2)), np.zeros(0), [{}, {}]), "x")[1] < 0.01
    only = toxicity.fit_chain([np.array([0]), np.array([], int)], ["a"], np.array([[1.0, np.nan], [1.0, np.nan]]), np.array([0, 1]), [{"a": 1.0}] * 2)
    assert toxicity.probabilities(only, None)[0] > 0.99 and toxicity.probabilities(only, None)[1] < 0.01


def test_toxicity_of_odd_rows(spark):
    docs = [(i, f"good word{i % 7}" if i % 2 else f"vile word{i % 7}") for i in range(200)] + [(900, None), (None, "vile"), (901, "")]
    labels = [(i, i % 2, 1 - i % 2) for i in range(200)] + [(1, None, None), (5000, 1, 1), (None, 0, 1), (2, 0, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"toxic": F.lit("x"), "p": F.lit(1)})
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = toxicity.fit(d, lab)
    out = toxicity.scored(d, chain).collect()
    assert len(out) == 203 and all(len(r.row) == 4 for r in out)
    assert all((r.p.toxic > 0.5) == (r.row.text or "").startswith("vile") for r in out if r.row.text)
    assert toxicity.scored(d.limit(0), toxicity.fit(d.limit(0), lab.limit(0))).count() == 0


def test_toxicity_on_held_out_labels(spark):
    """Fitted without a quarter of the labels, and measured on that quarter."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    apart = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    chain = toxicity.fit(docs, labels.where(~apart))
    rows = toxicity.scored(docs.join(labels.where(apart).select("doc_id", F.col("toxic").alias("y")), "doc_id"), chain)
    rows = rows.select("row.y", "p.toxic").collect()
    caught = [r.toxic >= toxicity.THRESHOLD for r in rows if r.y == 1]
    spared = [r.toxic < toxicity.THRESHOLD for r in rows if r.y == 0]
    assert len(caught) > 50 and sum(caught) >= 0.88 * len(caught) and sum(spared) >= 0.99 * len(spared)


def test_solve_against_newton_steps():
    """The same penalised regression on a full matrix, solved by Newton's method."""
    rng = np.random.default_rng(8)
    n, width = 300, 12
    held = rng.random((n, width)) < 0.3
    scale, dense = rng.uniform(0.3, 1, width), rng.normal(size=(n, 1))
    y = (rng.random(n) < toxicity.sigmoid(held @ rng.normal(size=width) * 2 + dense[:, 0] - 0.5)).astype(float)
    x = np.column_stack([held * scale, dense, np.ones(n)])
    penalty = np.diag([toxicity.PENALTY] * (width + 1) + [0.0])
    plain = np.zeros(width + 2)
    for _ in range(50):
        p = toxicity.sigmoid(x @ plain)
        plain -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (p - y) + penalty @ plain)
    row, col = np.nonzero(held)
    weights, chained, bias = toxicity.solve(row, col, scale, dense, y)
    mine = toxicity.sigmoid(held @ weights + dense @ chained + bias)
    assert np.abs(mine - toxicity.sigmoid(x @ plain)).max() < 0.02


def test_toxicity_reads_long_texts_to_the_end(spark):
    docs = [(i, f"good word{i % 7}" if i % 2 else f"vile word{i % 7}") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    chain = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels)
    ends = spark.createDataFrame([(0, "vile"), (1, "good")], "doc_id long, text string")
    long = ends.withColumn("text", F.concat(F.repeat(F.lit("plain filler "), 150_000), "text"))
    got, alone = ([tuple(r.p) for r in toxicity.scored(d, chain).orderBy("row.doc_id").collect()] for d in (long, ends))
    assert got == alone and got[0][1] > 0.5 > got[1][1]
