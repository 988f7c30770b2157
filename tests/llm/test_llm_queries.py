"""The registered queries on the smallest tables: SQL where there is some, brute force elsewhere."""

from __future__ import annotations

import os
import zlib

import duckdb
import pytest

import corpus_pipeline
from starloom.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return {
        name: duckdb.sql(f"SELECT * FROM '{SF_DIR}/{name}.parquet'").df()
        for name in ("documents", "labels", "benchmark", "pages")
    }


def test_every_operator_and_the_pipeline_are_registered():
    assert sorted(QUERIES) == sorted(
        [f"op{n}_{name}" for n, name in (
            (1, "lm_scoring"), (2, "toxicity"), (3, "packing"), (4, "quality_rules"), (5, "decontamination"),
            (6, "near_dedup"), (7, "warc"), (8, "token_counts"), (9, "substring_dedup"), (10, "url_filters"),
            (11, "conversation_repair"), (12, "line_dedup"), (13, "hard_negatives"))] + ["pipeline"]
    )


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("pages", "documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    rows = QUERIES[name](spark, SF_DIR)
    found = sorted((tuple(r[c] for c in sorted(rows.columns)) for r in rows.collect()), key=repr)
    oracle = con.sql(ORACLE[name])
    columns = sorted(oracle.columns)
    assert columns == sorted(rows.columns)
    wanted = oracle.project(", ".join(columns)).fetchall()
    assert found == sorted(wanted, key=repr)


def test_pipeline_stages_take_effect(spark, tables):
    from test_near_dedup import brute as components
    from test_substring_dedup import brute as repeats

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = _written(spark, stage(spark, docs, SF_DIR))
        assert docs.columns == before.columns, name
        kept.append({r.doc_id: r.text for r in docs.collect()})
    toxic, unique, trimmed, clean = kept
    groups = components(list(toxic.items()))
    assert set(unique) == {i for i, c in groups.items() if i == c}
    removed = {r[0]: r[2] for r in repeats(sorted(unique.items()), 20)}
    for i, text in trimmed.items():
        assert len(unique[i].encode().split()) - len(text.encode().split()) == removed[i]
    items = [" ".join(t.lower().split()) for t in tables["benchmark"].text]
    leaks = {i for i, text in trimmed.items() if any(x in " ".join(text.lower().split()) for x in items)}
    assert not leaks & set(clean)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in pieces} == set(clean)


def test_pipeline_works_in_small_batches_and_gives_the_session_back(spark, setting, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    setting(name, "10000")
    learn = corpus_pipeline.toxicity.learn_toxicity

    def learned(*args, **kwargs):
        seen.append(int(spark.conf.get(name)))
        return learn(*args, **kwargs)

    monkeypatch.setattr(corpus_pipeline.toxicity, "learn_toxicity", learned)
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[:1])
    corpus_pipeline.run(spark, SF_DIR)
    assert seen == [1000]
    assert spark.conf.get(name) == "10000"


def _written(spark, frame):
    from starloom.scratch import materialise

    return materialise(frame, "pipeline-test")


def test_folds_follow_the_text_of_the_id(spark):
    from starloom.llm.toxicity import fold

    ids = [0, 7, 123456789, -5]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", fold("doc_id", 10).alias("f")).collect()
    assert {r.doc_id: r.f for r in rows} == {i: zlib.crc32(str(i).encode()) % 10 for i in ids}
