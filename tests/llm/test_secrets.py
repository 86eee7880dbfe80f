import hashlib
import re

from pyspark.sql import functions as F

from fleetmart.llm import QUERIES, secrets
from fleetmart.llm.base import shared_folder

PLAIN = [
    ("assign", r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.I | re.A),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, 0),
    ("hex", r"[0-9a-f]+", 0, 24, 0),
]


def brute(text):
    found = []
    for rank, (kind, pattern, group, least, flags) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or "", flags):
            if len(m[group]) >= least:
                found.append((m.start(), rank, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(found)]


TEXTS = [
    None, "", "token=token =abcdefgh", "Password: 'hunter22' pAsswd=x", "aſecret=abcdefgh ſecret=abcdefgh",
    "AKIA" + "A" * 15, "AKIA" + "A" * 16, "xxAKIAAKIA" + "0" * 20, "0" * 23, "g" + "a1" * 12 + "g", "é🙂 api_key = \"" + "f" * 30 + '"',
    "token=" + "0" * 24 + " secret:AKIA" + "B" * 30, "word " * 50000 + "apikey:1234567" + " tail" * 1000,
]


def run(spark, rows, ledger):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"blob": F.lit(1), "spans": F.lit("x")})
    ledger.scan(docs)
    return secrets.findings(docs, ledger).select("row.doc_id", "spans")


def test_spans(spark):
    ledger = secrets.Ledger(spark, shared_folder(spark, "ledger"))
    rows = list(enumerate(TEXTS)) + list(enumerate(TEXTS[:4])) + [(None, TEXTS[3])]
    got = sorted((r.doc_id is None, r.doc_id or 0, [tuple(s) for s in r.spans]) for r in run(spark, rows, ledger).collect())
    assert got == sorted((i is None, i or 0, brute(t)) for i, t in rows)


def test_incremental(spark):
    ledger = secrets.Ledger(spark, shared_folder(spark, "ledger"))
    assert run(spark, [], ledger).count() == 0
    run(spark, [(1, "token: abcdef"), (2, "token: abcdef"), (3, "x")], ledger)
    assert ledger.rows().count() == 6
    run(spark, [(4, "token: abcdef"), (5, "y")], ledger)
    assert ledger.rows().count() == 9
    newer = (*secrets.RULES[:2], secrets.Rule("hex", 2, r"[0-9a-f]+", 2))
    docs = spark.createDataFrame([(1, "abc"), (2, "x")], "doc_id long, text string")
    ledger.scan(docs, newer)
    assert ledger.rows().count() == 9 + 3 + 1
    assert {r.row.doc_id: len(r.spans) for r in secrets.findings(docs, ledger, newer).collect()} == {1: 1, 2: 0}


def test_redact(spark):
    rows = [("é token=abcdef1 z", [("assign", 2, 15)]), ("none", []), ("abcdef", [("a", 0, 4), ("b", 2, 5)])]
    df = spark.createDataFrame(rows, "text string, spans array<struct<kind:string,start:int,end:int>>")
    got = [r[0] for r in df.select(secrets.redact(F.col("text"), F.col("spans"))).collect()]
    assert got == ["é [assign] z", "none", "[a]f"]


def test_query(spark, given):
    texts = {r.doc_id: r.text for r in given.documents.collect()}
    out = QUERIES["op3_secret_scan"](spark, given.folder).collect()
    assert len(out) == len(texts)
    for r in out:
        found = brute(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        kinds = [k for k, _, _ in found]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(kinds.count, ("assign", "access", "hex")))
        assert r.spans == joined and r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
