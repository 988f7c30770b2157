"""Line de-duplication against a brute-force version."""

from __future__ import annotations

import random

import pytest
from llm_cases import edge_rows
from pyspark.sql import functions as F

from starloom.llm.line_dedup import LineRuns, remove_repeated_lines

BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=20, min_docs=3):
    """Sorted (id, lines, dropped, text); a null id is smaller than any other."""
    rank = lambda i: float("-inf") if i is None else i
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).translate(LOWER)
            if len(key) >= min_chars:
                holders.setdefault(key, set()).add(rank(doc))
    out = []
    for doc, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            held = holders.get(line.strip(BLANKS).translate(LOWER), ())
            if len(held) < min_docs or max(held) == rank(doc):
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def shared_lines(seed, docs, lines=40):
    own = random.Random(seed)
    pool = [f"  Line number {i} that is long enough " + "é" * (i % 3) for i in range(lines)] + ["short", "", "  "]
    rows = []
    for i in range(docs):
        text = [own.choice(pool) if own.random() < 0.6 else f"words of document {i} alone, line {k}" for k in range(own.randrange(1, 9))]
        rows.append((i * 7 % docs, "\n".join(t.upper() if own.random() < 0.1 else t for t in text)))
    return rows


@pytest.mark.parametrize("batches, fan_out", [(1, 2), (5, 2), (8, 4)])
def test_equals_brute_force(spark, documents, batches, fan_out):
    rows = shared_lines(batches, 120)
    got = remove_repeated_lines(documents(rows), batches=batches, fan_out=fan_out)
    assert found(got) == brute(rows)


def test_edges(spark, documents):
    line = "a line that is held by several documents"
    rows = edge_rows() + [(20, line), (21, f"\t{line.upper()}  \nx"), (None, f"{line}\n{line}"), (None, line + "\n"), (22, "y" * 19 + "\r\n" + line + "\r")]
    rows += [(23, "\n" * 30_000 + line), (24, (line + " again\n") * 3_000), (25, line + " again"), (26, line + " again\n\n")]
    # Two rows of one id are one document; nineteen code points are too few.
    rows += [(30, "only two documents hold this line"), (30, "only two documents hold this line"), (31, "only two documents hold this line")]
    rows += [(i, "nineteen chars long") for i in range(40, 45)]
    assert found(remove_repeated_lines(documents(rows), batches=3)) == brute(rows)


def test_empty_table(spark, documents):
    assert remove_repeated_lines(documents([(1, "x")]).limit(0)).collect() == []
    assert found(remove_repeated_lines(documents([(1, None), (2, "a")]))) == [(1, 1, 0, ""), (2, 1, 0, "a")]


def test_ids_have_to_be_numbers(spark):
    with pytest.raises(TypeError, match="number"):
        remove_repeated_lines(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_settled_hashes_are_not_added_again(spark, plan, setting):
    setting("spark.sql.shuffle.partitions", "3")
    runs = LineRuns(spark, min_docs=3, fan_out=4)
    frequent = spark.range(0, 100).select(F.lit(7).cast("long").alias("h1"), F.lit(7).cast("long").alias("h2"), "id")
    rare = spark.range(0, 50_000).select(F.col("id").alias("h1"), F.col("id").alias("h2"), "id")
    for first in (2_000_000, 1_000_000, 0):
        batch = frequent.unionByName(rare.where("h1 <> 7")).withColumn("doc", F.col("id") + first)
        # So many lines that none counts as hot.
        runs.add(batch.select("h1", "h2", "doc"), 10**9)
    held = [spark.table(table).where("h1 = 7").collect() for _, table in runs.runs()]
    assert [[r.n for r in rows] for rows in held] == [[100], [], []]
    merged = {r.h1: (r.n, r.keeper) for r in runs.merged().where("h1 in (7, 8)").collect()}
    assert merged == {7: (100, 2_000_099), 8: (3, 2_000_008)}
    runs.close()


def test_runs_are_merged_level_by_level(spark):
    runs = LineRuns(spark, fan_out=2)
    for i in range(7):
        runs.add(spark.createDataFrame([(1, 1, 100 - i), (i + 2, 2, 100 - i)], "h1 long, h2 long, doc long"), 2)
        assert [len(level) for level in runs.levels] == [int(b) for b in reversed(f"{i + 1:b}")]
    assert {r.h1: (r.n, r.keeper) for r in runs.merged().collect()}[1] == (7, 100)
    runs.close()


def test_plan_holds_no_python(spark, documents, plan):
    text = plan(remove_repeated_lines(documents(shared_lines(1, 30))))
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
