"""Registered queries over a whole small table, and the pipeline stage by stage."""

from __future__ import annotations

import importlib.util
import re
import subprocess
import sys

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from braidwork.llm.oracles import LLM_SQL
from braidwork.llm.queries import LLM_QUERIES
from tools.check_oracles import oracle_bag, oracle_connection, spark_bag

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in LLM_QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize(
    ("name", "table", "columns"),
    [
        ("op2", "documents", {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}),
        ("op4", "documents", {"doc_id", "size", "source_size", "target", "taken"}),
        ("op5", "conversations", {"conv_id", "turn", "text", "reply_turn"}),
        ("op8", "pages", {"page_id", "url", "text", "n_chars"}),
        ("op10", "documents", {"doc_id", "held_out", "score", "predicted"}),
    ],
)
def test_rows_in_rows_out(spark, name, table, columns):
    query = next(f for k, f in LLM_QUERIES.items() if k.startswith(name + "_"))
    got = query(spark, SF_SMALL)
    assert columns <= set(got.columns)
    assert got.count() == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_equals_its_sql(spark, name):
    con = oracle_connection(SF_SMALL)
    assert spark_bag(LLM_QUERIES[name](spark, SF_SMALL)) == oracle_bag(con, LLM_SQL[name])
    con.close()


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    rows = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        rows = corpus_pipeline.materialize(stage(spark, rows, SF_SMALL), name)
        kept[name] = rows
        if k < len(corpus_pipeline.STAGES) - 1:
            assert rows.columns == columns
    ids = {name: {r.doc_id for r in rows.select("doc_id").collect()} for name, rows in kept.items()}
    assert ids["ngram_jaccard"] <= ids["toxicity"] and ids["secrets"] == ids["ngram_jaccard"]
    assert ids["mixing"] <= ids["secrets"] and ids["bpe"] == ids["mixing"]
    # Five-word shingles at 0.8, against all pairs.
    sets = {}
    for r in kept["toxicity"].collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text.lower())
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}
    order = sorted(sets)
    for a in order:
        for b in order:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                old, new = max(up[a], up[b]), min(up[a], up[b])
                up = {i: new if c == old else c for i, c in up.items()}
    assert ids["ngram_jaccard"] == {i for i, c in up.items() if i == c}
    assert kept["secrets"].where(F.col("text").rlike("AKIA[A-Z2-7]{16}")).count() == 0
    assert kept["secrets"].where(F.col("n_chars") != F.char_length("text")).count() == 0
    assert kept["bpe"].where(~F.col("round_trip")).count() == 0
    assert kept["bpe"].count() == kept["mixing"].count()


def test_pipeline_of_odd_rows(spark, tmp_path):
    kind = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a b", "en", "s", 3), (2, "a b", "en", "s", 3)]
    rows += [(3, "x" * 40_000, "en", None, 40_000)]
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in got.collect()} <= {1, 2, 3, None}
    spark.createDataFrame([], kind).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_lists_the_queries():
    assert importlib.util.find_spec("corpus_pipeline") is not None
    code = "import __spark_entry__ as e; q = e.queries(); print('pipeline' in q, sum(k.startswith('op') for k in q), set(e.oracle_sql()) <= set(q))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=".")
    assert out.stdout.split() == ["True", "13", "True"], out.stderr
