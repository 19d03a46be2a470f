from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from braidwork.plans.oracles import oracle_queries
from braidwork.plans import queries as query_module
from braidwork.plans.queries import REGISTRY
from conftest import SF_SMALL
from tools.check_oracles import oracle_bag, oracle_connection, spark_bag


@pytest.fixture(scope="module")
def oracle():
    con = oracle_connection(SF_SMALL)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, oracle, name):
    columns, rows = spark_bag(entry.queries()[name](spark, SF_SMALL))
    expected_columns, expected = oracle_bag(oracle, entry.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected
    assert sum(rows.values()) > 0


def test_every_query_has_sql():
    assert set(REGISTRY) == set(oracle_queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["batch_id", "slot", "doc_id", "x", "y"] and df.count() > 0


FRESH = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", {call})
"""


@pytest.mark.parametrize(
    "call, rows",
    [
        ("entry.entry(spark).count()", 192),
        ("entry.queries()['batch_rows_keep'](spark, '/root/testdata/sf0.001').count()", 200),
        ("entry.queries()['cumulative_epochs'](spark, '/root/testdata/sf0.001').count()", 1500),
    ],
)
def test_first_query_of_a_fresh_session(call, rows):
    """Plans are also checked where column ids start at zero."""
    repo = os.path.dirname(os.path.abspath(entry.__file__))
    done = subprocess.run(
        [sys.executable, "-c", FRESH.format(repo=repo, call=call)], capture_output=True, text=True, timeout=300
    )
    assert f"ROWS {rows}" in done.stdout, done.stderr[-2000:]


def _written(spark, folder, texts):
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    documents.withColumns({"lang": F.lit("en"), "source": F.lit("s")}).write.parquet(f"{folder}/documents.parquet")
    vectors = [(k, [float(k % 7), k / 8, 2.0 * k]) for k in range(300)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def test_every_position_gets_its_whole_vector(spark, tmp_path):
    folder = _written(spark, tmp_path, [(1, "ab" * 30)])
    got = entry.queries()["embed_lookup"](spark, folder).orderBy("window", "pos").collect()
    tokens = [*("ab" * 30).encode(), 256, 0, 0, 0]
    whole = [(k // 32, k % 32, token, 257 + k % 32) for k, token in enumerate(tokens)]
    assert [(r["window"], r["pos"], r["token"]) for r in got] == [w[:3] for w in whole]
    # The middle component reaches the result through the total alone.
    assert [r["total"] for r in got] == [a % 7 + b % 7 + 2.125 * (a + b) for *_, a, b in whole]
    assert [(r["first"], r["last"]) for r in got] == [(a % 7 + b % 7, 2.0 * (a + b)) for *_, a, b in whole]


@pytest.mark.parametrize("ids", [[5, 3, 9, 1], [5, 3, 5, None]])
def test_packing_orders_documents_and_stores_no_windows(spark, tmp_path, monkeypatch, ids):
    texts = [(k, chr(97 + i) * (100 * i + 90)) for i, k in enumerate(ids)]
    stored = []
    real = query_module.materialize
    monkeypatch.setattr(query_module, "materialize", lambda df, label: stored.append(label) or real(df, label))
    got = entry.queries()["pack_batches"](spark, _written(spark, tmp_path, texts)).orderBy("batch_id").collect()
    rows = []
    for doc_id, text in texts:
        tokens = [*text.encode(), 256]
        cut = [tokens[a : a + 32] for a in range(0, len(tokens), 32)]
        rows += [((doc_id is not None, doc_id or 0, w), [*x, *[0] * (32 - len(x))]) for w, x in enumerate(cut)]
    rows = [",".join(map(str, x)) for _, x in sorted(rows, key=lambda r: r[0])]
    want = [rows[a : a + 8] for a in range(0, len(rows) // 8 * 8, 8)]
    # Rows of one id and window may stand in either order.
    found = sum((g["rows"].split(";") for g in got), [])
    assert len(found) == len(sum(want, [])) and set(found) <= set(rows)
    if len(set(ids)) == 4:
        assert [g["rows"].split(";") for g in got] == want and stored == ["texts"]
