from __future__ import annotations

import hashlib

import pytest

from braidwork.configs import ModelConfig, TokenizerConfig, TrainingConfig
from braidwork.plans import training_data as td
from braidwork.session import spread
from braidwork.streaming import feeds

END = "<|endoftext|>"
BYTE = TokenizerConfig(name="byte")
MODEL = ModelConfig(maxlen=20)


def encode(text: str, maxlen: int = 20) -> list[int]:
    ids = list(text.strip().encode()) + [256]
    return (ids + [0] * maxlen)[:maxlen]


TALES = [f"  tale number {i} " + "long " * (i % 4) for i in range(13)]


@pytest.fixture(scope="module")
def blocks(spark):
    rows = [(i, t) for i, t in enumerate(TALES)] + [(99, "   ")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def collect(df, id_col="doc_id"):
    return {(r["batch_id"], r["slot"]): (r[id_col], r["x"], r["y"]) for r in df.collect()}


@pytest.mark.parametrize("shuffle", [False, True])
def test_examples_end_to_end(blocks, shuffle):
    training = TrainingConfig(batch_size=4, shuffle=shuffle, seed=42)
    got = collect(td.training_examples(blocks, id_col="doc_id", text_col="text", model=MODEL, tokenizer=BYTE, training=training))
    order = list(range(13))
    if shuffle:
        order.sort(key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert sorted(got) == [(b, s) for b in range(3) for s in range(4)]
    for (batch, slot), (doc, x, y) in got.items():
        assert doc == order[batch * 4 + slot]
        assert x == encode(TALES[doc]) and y == x[1:] + [0]


def test_block_limit_comes_before_batching(blocks):
    training = TrainingConfig(batch_size=2)
    df = td.training_examples(blocks, id_col="doc_id", text_col="text", model=MODEL, tokenizer=BYTE, training=training, max_blocks=5)
    assert sorted(v[0] for v in collect(df).values()) == [0, 1, 2, 3]


@pytest.mark.parametrize("max_bytes", [50, 1_000_000])
@pytest.mark.parametrize("tokenizer", ["byte", "word"])
def test_examples_from_files_do_not_depend_on_splits(spark, tmp_path, max_bytes, tokenizer):
    (tmp_path / "a.txt").write_text("".join(t + END + "\n" for t in TALES[:7]))
    (tmp_path / "b.txt").write_text("".join(t + END + "\n" for t in TALES[7:]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = collect(
            td.training_examples_from_files(
                spark, str(tmp_path), model=MODEL, tokenizer=TokenizerConfig(name=tokenizer),
                training=TrainingConfig(batch_size=4, shuffle=True, seed=7), max_blocks=9,
            ),
            "block_ix",
        )
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    order = sorted(range(9), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest())
    assert [got[k][0] for k in sorted(got)] == order[:8]
    if tokenizer == "byte":
        assert all(x == encode(TALES[ix]) for ix, x, _ in got.values())
    else:
        lengths = {ix: sum(map(bool, x)) for ix, x, _ in got.values()}
        assert all(n == len(TALES[ix].split()) + 1 for ix, n in lengths.items())


def test_batch_count_errors():
    assert td.require_batches(100, 32) == 3
    with pytest.raises(ValueError, match="empty"):
        td.require_batches(0, 4)
    with pytest.raises(ValueError, match="one batch"):
        td.require_batches(3, 4)


def test_text_is_read_pruned_and_never_shuffled(spark, plan_of):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = plan_of(td.token_examples(docs, id_col="doc_id", text_col="text", model=MODEL, tokenizer=BYTE))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan and "Exchange" not in plan


def test_only_narrow_inputs_are_spread(spark):
    wide, narrow = spark.range(100, numPartitions=9), spark.range(100, numPartitions=2)
    assert spread(wide) is wide
    assert spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_streamed_blocks_equal_the_batch_form(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("".join(t + END + "\n" for t in TALES[:6]))
    rows = feeds.follow_examples(feeds.follow_blocks(spark, str(source), END), model=MODEL, tokenizer=BYTE)
    query = rows.writeStream.format("memory").queryName("streamed_rows").start()
    try:
        query.processAllAvailable()
        (source / "b.txt").write_text("".join(t + END for t in TALES[6:]))
        query.processAllAvailable()
        got = spark.table("streamed_rows").collect()
    finally:
        query.stop()
    assert sorted(r["x"] for r in got) == sorted(map(encode, TALES))
    assert all(r["y"] == r["x"][1:] + [0] for r in got)
    with pytest.raises(ValueError, match="byte"):
        feeds.follow_examples(rows, model=MODEL, tokenizer=TokenizerConfig(name="word"))
