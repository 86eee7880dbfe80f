"""The registered corpus queries: each applies one operator to its whole table and shows its output as columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.llm import (
    alignment, bpe, chat, language, neardup, neighbours, packing, repeats, resampling, secrets, topk, toxicity, wrappers,
)
from fleetmart.llm.base import query, shared_folder, table


def _joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


OP1_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), escaped AS (
  SELECT *,
    replace(replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), '### ', '\### '), ': ', ':\ ') AS r,
    replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '\### ') AS t
  FROM given
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ' || r || ': ' || t || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


@query("op1_chat_formatting", OP1_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    events = chat.conversation_events(given.unionByName(chat.probe(spark)))
    out = chat.read_back(chat.format_conversations(events))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    learned = F.array_join("learned", "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op3_secret_scan")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ledger = secrets.Ledger(spark, shared_folder(spark, "secret-ledger"))
    ledger.scan(docs)
    found = secrets.findings(docs, ledger)
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "row.doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )


@query("op2_nearest_neighbours")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    vectors = vectors.where(F.col("vec_id").isNotNull() & neighbours.searchable(F.col("vector")))
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


@query("op4_main_text")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    texts = wrappers.main_texts(table(spark, folder, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op5_top_products", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "embeddings")
    given = given.where(F.col("vec_id").isNotNull() & topk.usable(F.col("embedding")))
    vectors = given.select("vec_id", topk.integer_vector(F.col("embedding")).alias("vector"))
    return topk.top_products(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@query("op6_bpe")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    out = bpe.encode_documents(docs, vocabulary, bpe.publish_lexicon(docs, vocabulary))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_language")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language.predict(docs, language.fit(docs.where(~language.held_out())))


@query("op8_toxicity")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    chain = toxicity.fit(docs, table(spark, folder, "labels"))
    p = toxicity.scored(docs, chain)
    return p.select(
        "row.doc_id", F.col("p.quality").alias("quality_score"), F.col("p.toxic").alias("toxic_score"),
        (F.col("p.toxic") >= toxicity.THRESHOLD).alias("toxic"),
    )


@query("op9_near_duplicates")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op10_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    pieces = packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op11_repeated_bytes")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.repeated_bytes(table(spark, folder, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


OP12_SQL = r"""
WITH RECURSIVE given AS (
  SELECT 's' AS side, doc_id, text FROM documents UNION ALL SELECT 't', NULL, text FROM benchmark
), numbered AS (SELECT *, row_number() OVER () AS place FROM given
), texts AS (
  SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM numbered
), register AS (
  SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))
), lookup AS (SELECT list(c ORDER BY i) AS of_byte FROM register
), vocabulary AS (SELECT DISTINCT unnest(words) AS word FROM texts
), coded AS (SELECT word, hex(encode(word)) AS code FROM vocabulary
), hashed AS (
  SELECT word, xor(list_reduce([4294967295] || list_transform(range(length(code) // 2), lambda k:
             CAST('0x' || substr(code, CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT)),
           lambda c, b: xor(c >> 8, of_byte[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
  FROM coded, lookup
), each AS (
  SELECT place, side, bucket, count(*) AS n
  FROM (SELECT place, side, unnest(words) AS word FROM texts) w JOIN hashed USING (word) GROUP BY ALL
), counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM each GROUP BY bucket
), totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counts
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(all_s + 10000 AS DOUBLE)
                                     / (CAST(s + 1 AS DOUBLE) * CAST(all_t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM counts, totals
), weight AS (SELECT place, sum(n) AS n, sum(n * gain) AS weight FROM each JOIN gain USING (bucket) WHERE side = 's' GROUP BY place
), scored AS (
  SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(w.weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(w.weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8)
              AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM texts LEFT JOIN weight w USING (place) WHERE side = 's'
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY n_features < 20, score DESC, doc_id NULLS FIRST) AS place,
         floor(10 * count(*) FILTER (n_features >= 20) OVER () / 100) AS drawn
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM ranked
"""


@query("op12_importance_resampling", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return resampling.resample(docs, table(spark, folder, "benchmark"))


@query("op13_tokenizer_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    files = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")]
    return alignment.align(docs, *files)[0]
