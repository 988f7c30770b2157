"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and
returns rows with the columns of ``documents``; the last one returns packed pieces.
"""

from __future__ import annotations

from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import decontamination, near_dedup, packing, substring_dedup, toxicity
from starloom.scratch import materialise

#: Rows of an Arrow batch. 10,000 texts (Spark's default) are 33 MB, which executor and Python
#: worker each hold several times over; no stage's result depends on the number.
BATCH_ROWS = 1000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Documents that score this or more are rejected.
TOXIC = 0.3


def _in_small_batches(stage):
    """Sets the session's batches before a stage; they stay, as its rows are made when they are read."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rows = int(spark.conf.get(_ARROW_ROWS))
        spark.conf.set(_ARROW_ROWS, str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run_stage


@_in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, learned from labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn_toxicity(docs, labels.where(toxicity.fold("doc_id", 4) != 2))
    return model.keep_clean(docs, TOXIC)


@_in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group."""
    return near_dedup.keep_one_each(docs).select(*docs.columns)


@_in_small_batches
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 20 words or more that start earlier; ``n_chars`` follows the text."""
    kept = substring_dedup.remove_repeats(docs, rows=True)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@_in_small_batches
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of at most 4096 tokens."""
    import public_tokenizers

    tokenizer = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
    return packing.pack(packing.tokenize(docs, tokenizer))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = spark.conf.get(_ARROW_ROWS)
    try:
        for name, stage in STAGES[:-1]:
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:
        spark.conf.set(_ARROW_ROWS, rows)
