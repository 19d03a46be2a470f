from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from braidwork.operators import ordering
from braidwork.operators.batching import assign_batches, batches_per_epoch, pack_batches, repeat_epochs
from braidwork.operators.joins import fits_broadcast, lookup_join, salted_join


def keyed(spark, ids, parts=3):
    return spark.createDataFrame([(i,) for i in ids], "id long").repartition(parts)


@pytest.mark.parametrize("parts", [1, 3, 7])
@pytest.mark.parametrize("n_buckets", [None, 2, 50])
def test_dense_index_is_the_rank_whatever_the_layout(spark, parts, n_buckets):
    ids = random.Random(5).sample(range(-(10**12), 10**12), 500) + list(range(500))
    df = keyed(spark, sorted(set(ids)), parts)
    bucket = ordering.range_bucket(df, [F.col("id")], n_buckets=n_buckets)
    got = ordering.dense_index(df, [F.col("id")], bucket=bucket, total="n").collect()
    assert {r["id"]: r["ix"] for r in got} == {v: i for i, v in enumerate(sorted(set(ids)))}
    assert {r["n"] for r in got} == {len(set(ids))}


def test_dense_index_of_mixed_keys_per_partition_value(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("aab"), rng.randrange(3), f"w{rng.randrange(9)}") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, p string, n long, w string")
    keys = [-F.col("n"), F.col("w"), F.col("id")]
    got = {r["id"]: r["ix"] for r in ordering.dense_index(df, keys, partition_by=["p"]).collect()}
    for p in "ab":
        own = sorted((r for r in rows if r[1] == p), key=lambda r: (-r[2], r[3], r[0]))
        assert [got[r[0]] for r in own] == list(range(len(own)))


def test_null_partition_values_are_a_group(spark):
    rows = [(1, None), (2, None), (3, "a"), (None, "a")]
    df = spark.createDataFrame(rows, "id long, p string")
    got = ordering.dense_index(df, [F.col("id")], partition_by=["p"]).collect()
    assert sorted((str(r["p"]), r["ix"]) for r in got) == [("None", 0), ("None", 1), ("a", 0), ("a", 1)]


def test_hot_partition_value_is_spread_over_buckets(spark):
    df = spark.range(2000).select(F.col("id"), F.lit("hot").alias("p"))
    bucket = ordering.range_bucket(df, [F.col("id")])
    sizes = [r["count"] for r in df.groupBy("p", bucket.alias("b")).count().collect()]
    assert len(sizes) >= ordering.MIN_BUCKETS and max(sizes) < 2000 / 4


def test_running_total_with_negative_values(spark):
    df = spark.range(100).select("id", ((F.col("id") * 7) % 11 - 5).alias("v"))
    got = ordering.running_total(df, F.col("v"), [F.col("id")]).orderBy("id").collect()
    total = 0
    for r in got:
        total += r["v"]
        assert r["running_total"] == total


def test_no_data_sized_single_partition_exchange(spark, plan_of):
    df = spark.range(5000)
    plan = plan_of(ordering.visit_order(df, "id", shuffle=True, seed=1, total="n"))
    # The one single-partition exchange orders bucket sums, after their final aggregate.
    assert plan.count("Arguments: SinglePartition") == 1
    assert "_bucket" in plan.split("Arguments: SinglePartition")[0].rsplit("Input", 1)[1]


def test_rows_move_once_even_without_a_broadcast(spark, plan_of):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("p"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(ordering.dense_index(df, [F.col("id")], partition_by=["p"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = plan.split("\n\n")[0]
    rows_side = [line for line in tree.splitlines() if line.lstrip().startswith(":")]
    assert sum("Exchange" in line for line in rows_side) == 1


def test_shuffled_order_depends_on_seed_only(spark):
    def order(seed, parts):
        df = keyed(spark, range(300), parts)
        rows = ordering.visit_order(df, "id", shuffle=True, seed=seed).orderBy("visit_ix").collect()
        return [r["id"] for r in rows]

    expected = sorted(range(300), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    assert order(42, 1) == order(42, 5) == expected
    assert order(43, 1) != expected and sorted(order(43, 1)) == list(range(300))
    plain = ordering.visit_order(keyed(spark, range(300)), "id", shuffle=False, seed=42)
    assert all(r["id"] == r["visit_ix"] for r in plain.collect())


@pytest.mark.parametrize("n, size, full", [(12, 4, 3), (9, 4, 2), (3, 4, 0)])
def test_batches_of_consecutive_records(spark, n, size, full):
    indexed = ordering.visit_order(spark.range(n), "id", shuffle=False, seed=0, total="n")
    dropped = assign_batches(indexed, "visit_ix", "n", size).collect()
    assert sorted((r["batch_id"], r["slot"], r["id"]) for r in dropped) == [
        (i // size, i % size, i) for i in range(full * size)
    ]
    kept = assign_batches(indexed, "visit_ix", "n", size, drop_remainder=False)
    assert kept.count() == n
    with pytest.raises(ValueError, match="batch_size"):
        assign_batches(indexed, "visit_ix", "n", 0)


def test_pack_and_repeat(spark):
    rows = spark.createDataFrame([(0, 1, [3, 4]), (0, 0, [1, 2]), (1, 0, [5, 6])], "batch_id long, slot int, tokens array<int>")
    packed = {r["batch_id"]: r["rows"] for r in pack_batches(rows).collect()}
    assert packed == {0: [[1, 2], [3, 4]], 1: [[5, 6]]}
    epochs = repeat_epochs(rows, 3).groupBy("epoch").count().collect()
    assert sorted((r["epoch"], r["count"]) for r in epochs) == [(1, 3), (2, 3), (3, 3)]


def test_batch_counts_tell_the_two_errors_apart(spark):
    df = spark.createDataFrame([(0, 4), (3, 4), (100, 32)], "n long, b long")
    got = batches_per_epoch(df, n_records="n", batch_size="b").orderBy("n").collect()
    assert [(r["n_batches"], r["status"]) for r in got] == [(0, "empty_dataset"), (0, "no_full_batch"), (3, "ok")]


@pytest.mark.parametrize("partition_by", [[], ["m"]])
def test_newest_breaks_ties_by_name_and_limits_before_the_exchange(spark, plan_of, partition_by):
    rows = [("a", "x", 3), ("a", "y", 3), ("a", "z", 1), ("b", "w", 2)]
    df = spark.createDataFrame(rows, "m string, name string, t int")
    top = ordering.newest(df, 2, time_col="t", name_col="name", partition_by=partition_by)
    got = [(r["m"], r["name"]) for r in top.collect()]
    if partition_by:
        assert sorted(got) == [("a", "x"), ("a", "y"), ("b", "w")]
        assert "WindowGroupLimit" in plan_of(top).split("Exchange")[1]
    else:
        assert got == [("a", "x"), ("a", "y")]
        assert "TakeOrderedAndProject" in plan_of(top)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.range(200).select("id", (F.col("id") % 3 * F.col("id") % 5).alias("k"))
    small = spark.createDataFrame([(0, "zero"), (1, "one"), (4, "four")], "k long, name string")
    plain = sorted(map(tuple, big.join(small, "k", how).collect()), key=str)
    assert sorted(map(tuple, salted_join(big, small, ["k"], F.col("id"), how=how).collect()), key=str) == plain
    assert fits_broadcast(small) and not fits_broadcast(small, max_rows=2)
    assert not fits_broadcast(small, max_text_bytes=10) and fits_broadcast(small, max_text_bytes=11)
    for broadcast in (True, False):
        joined = lookup_join(big, small, ["k"], F.col("id"), broadcast=broadcast, how=how)
        assert sorted(map(tuple, joined.collect()), key=str) == plain


def test_lookup_sides_beyond_the_bounds_never_pass_the_driver(spark, tmp_path, plan_of):
    spark.range(300_000).select("id", (F.col("id") % 7).alias("v")).write.parquet(f"{tmp_path}/small")
    small, big = spark.read.parquet(f"{tmp_path}/small"), spark.range(10).withColumn("k", F.col("id") % 3)
    assert not fits_broadcast(small)
    joined = lookup_join(big, small.withColumnRenamed("id", "k"), ["k"], F.col("id"), broadcast=False, how="left")
    assert "Broadcast" not in plan_of(joined) and joined.count() == 10
