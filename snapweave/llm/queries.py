"""Registered queries of this package and their SQL, where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapweave.llm import (chat, decontaminate, fingerprint, hard_negatives, html_extract, langid, ngram_join, packing,
                           resample, simhash, toxicity, url_filter, warc)
from snapweave.llm.common import fold, scratch_path, table

TOXIC_FOLDS, TOXIC_HELD_OUT = 5, 0
LANG_FOLDS, LANG_HELD_OUT = 4, 2
TOKENIZER = "word_bpe_49k.json"
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block",
             "net/fr/": "block"}


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def toxicity_scorer(docs: DataFrame, labels: DataFrame) -> toxicity.Scorer:
    return toxicity.fit(docs, labels, fold("doc_id", TOXIC_FOLDS) != TOXIC_HELD_OUT)


def language_net(docs: DataFrame) -> langid.ByteConvNet | None:
    return langid.fit(docs, fold("doc_id", LANG_FOLDS) != LANG_HELD_OUT)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scorer = toxicity_scorer(docs, table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", (fold("doc_id", TOXIC_FOLDS) == TOXIC_HELD_OUT).alias("held_out"),
                        toxicity.scored("text", scorer).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "pages").select("page_id", "url", html_extract.extracted("html").alias("text"))
            .withColumn("n_chars", F.length("text").cast("bigint")))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES).select(
        F.col("key").alias("page_id"), "host", "path", "rule", "verdict", "block_probability")


def op5_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repaired(table(spark, sf_dir, "conversations"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (docs.select("doc_id", (fold("doc_id", LANG_FOLDS) == LANG_HELD_OUT).alias("held_out"),
                        langid.predicted("text", language_net(docs)).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score"))


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, tokenizer_path()).withColumn("ids_crc32", F.crc32("ids"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, path = table(spark, sf_dir, "pages"), scratch_path(spark, "warc")
    warc.write(pages, path)
    kind = pages.schema["page_id"].dataType
    return warc.read_records(spark, path).select(
        F.col("record_key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"), label=label)


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_simhash, op3_html_text, op4_url_filter, op5_chat_repair, op6_decontaminate, op7_fingerprint,
    op8_language, op9_packing, op10_warc, op11_hard_negatives,
    op12_resample, op13_ngram_join)}

ORACLE = {
    "op10_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
first AS (SELECT payload_digest AS d, max(page_id) AS m FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN m IS NOT NULL AND page_id IS DISTINCT FROM m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM p LEFT JOIN first ON payload_digest = d
""",
    "op11_hard_negatives": """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id, b.r, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT a, anchor_id, vec_id AS positive_id, score AS positive_score, r AS p FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.p ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON p.a = s.a AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
    "op12_resample": r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
found AS (
  SELECT r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM docs),
aimed AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
bytes AS (
  SELECT word, flatten(list_transform(range(CAST(octet_length(encode(word)) AS BIGINT)), lambda i:
      list_concat([CAST('0x' || substr(hex(encode(word)), CAST(2 * i + 1 AS INT), 2) AS BIGINT)],
                  CAST([-1, -1, -1, -1, -1, -1, -1, -1] AS BIGINT[])))) AS steps
  FROM (SELECT word FROM found UNION SELECT word FROM aimed)),
hashed AS (
  SELECT word, xor(list_reduce(steps, lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) WHEN c % 2 = 1
      THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
  FROM bytes),
s AS (SELECT bucket, count(*) AS s FROM found JOIN hashed USING (word) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM aimed JOIN hashed USING (word) GROUP BY 1),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000.0::DOUBLE)
      / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000.0::DOUBLE)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)),
weighed AS (SELECT r, count(*) AS n, CAST(sum(gain) AS BIGINT) AS w
            FROM found JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT r, doc_id, coalesce(n, 0) AS n_features, coalesce(w, 0) AS weight, coalesce(w, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weighed USING (r)),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS k, 10 * count(*) OVER () // 100 AS drawn
           FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= drawn THEN k END AS rank
FROM scored LEFT JOIN ranked USING (r)
""",
    "op13_ngram_join": r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM docs),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.r <> y.r GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON a = x.r JOIN sizes y ON b = y.r WHERE 100 * c >= 80 * (x.n + y.n - c)),
reached AS (SELECT r AS a, r AS b FROM docs UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
least_id AS (SELECT a AS r, min(doc_id) AS component_id FROM reached JOIN docs ON b = docs.r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs LEFT JOIN sizes USING (r) JOIN least_id USING (r)
""",
}
