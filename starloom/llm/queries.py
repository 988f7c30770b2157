"""Registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    conversation_repair,
    decontamination,
    gated_lm,
    hard_negatives,
    line_dedup,
    near_dedup,
    packing,
    quality_rules,
    substring_dedup,
    token_counts,
    toxicity,
    url_filters,
    warc,
)
from starloom.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


@_query
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(_table(spark, sf_dir, "pages"), rules)


ORACLE["op10_url_filters"] = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM parts, rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)
"""


@_query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.load_pieces(_tokenizer("piece_bpe_32k.model"))
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), pieces)


@_query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rules = quality_rules.learn_rules(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.judge_quality(quality_rules.text_statistics(docs), rules)


@_query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes and reads back an archive; a page's capture time is derived from its id."""
    path = scratch_path(spark, "warc")
    captured = F.timestamp_seconds(F.lit(1_704_067_200) + F.coalesce("page_id", F.lit(0)))
    warc.write_archive(_table(spark, sf_dir, "pages"), path, captured=captured)
    index = warc.index_captures(warc.read_archive(spark, path))
    return index.select(
        F.expr("try_cast(record_id AS bigint)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


ORACLE["op7_warc"] = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
coded AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(hex, CAST(10 * (i // 8) + 1 AS INT), 10) AS BIGINT)
        >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31 AS INT), 1)), '') AS payload_digest FROM hashed),
grouped AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS newest FROM coded)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to FROM grouped
"""


@_query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = toxicity.fold("doc_id", 4) == 2
    model = toxicity.learn_toxicity(docs, labels.where(~held_out))
    return model.score(docs).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@_query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = Path(_tokenizer("word_bpe_49k.json")).read_text()
    return packing.pack(packing.tokenize(_table(spark, sf_dir, "documents"), tokenizer))


@_query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


@_query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = toxicity.fold("doc_id", 10) == 0
    scores = gated_lm.score_texts(docs, docs.where(~held_out))
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    found = conversation_repair.repair_conversations(conversation_repair.damage(rows))
    every = rows.select("conv_id").distinct().withColumn("key", conversation_repair.conversation_key("conv_id"))
    digests = conversation_repair.message_digests(found.messages)
    joined = every.join(found.summary.drop("id"), "key", "left").join(digests, "key", "left")
    counts = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit(""), 256)
    return joined.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256")
    )


@_query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.remove_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op12_line_dedup"] = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(keeper) FILTER (doc_id <> keeper) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent USING (key) GROUP BY doc_id
"""


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh id are wrong on purpose."""
    vectors = _table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding"
    )
    return hard_negatives.mine_hard_negatives(vectors, F.col("id") % 100 == 0)


ORACLE["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS same,
    CAST(list_inner_product(a.v, v.v) AS BIGINT) AS score
  FROM v AS a, v WHERE a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank
  FROM positives JOIN pairs USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT * FROM ranked WHERE rank <= 5
"""


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
