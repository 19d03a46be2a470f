"""Global order without a single-task sort.

A running total over the whole table (a dense index is the running total of
1) is built from three parts that all spread over the cluster:

1. every row gets a *bucket*: a contiguous range of the order key;
2. bucket sums are formed with map-side combine, and turned into offsets by a
   window over the bucket sums only;
3. each bucket is scanned in order on its own, and the offset is added.

Order keys must be unique (end them with an id). Bucket limits come from a
hash sample of the key, so clustered keys still give even buckets, and a
partition value that holds a large share of the rows is spread over many
buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidwork.functions.draws import hash_key

MAX_BUCKETS = 32_768
MIN_BUCKETS = 16
ROWS_PER_BUCKET = 500_000
SAMPLES_PER_BUCKET = 32
FIRST_IN_ONE_TASK = 100_000


def _key(columns: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)])


def range_bucket(
    df: DataFrame, keys: Sequence[Column], *, n_buckets: int | None = None
) -> Column:
    """An expression giving the number of the key range a row falls into.

    Collects at most ``n_buckets`` sampled keys; they become a literal of the
    returned expression, so every branch of a plan uses the same limits.
    """
    keyed = df.select(_key(keys).alias("k"))
    n_rows = keyed.count()
    if n_buckets is None:
        n_buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, n_rows // ROWS_PER_BUCKET))
    rate = max(1, n_rows // (n_buckets * SAMPLES_PER_BUCKET))
    stride = max(1, min(SAMPLES_PER_BUCKET, n_rows // n_buckets))
    sample = keyed.where(F.pmod(F.xxhash64("k"), F.lit(rate)) == 0)
    limits = (
        # The sample is bounded by MAX_BUCKETS * SAMPLES_PER_BUCKET rows.
        sample.withColumn("r", F.row_number().over(Window.orderBy("k")))
        .where(F.col("r") % stride == 0)
        .orderBy("r")
        .select(F.to_json("k"))
        .collect()
    )
    if not limits:
        return F.lit(0)
    literal = F.from_json(
        F.lit("[" + ",".join(row[0] for row in limits) + "]"),
        T.ArrayType(keyed.schema["k"].dataType),
    )
    # Adding a partition-bound zero keeps the optimizer from rewriting joins on the
    # bucket in terms of this expression: in a fresh session it can push a filter that
    # names the key column to a side that does not have it.
    return _search(literal, len(limits), _key(keys)) + F.spark_partition_id() * 0


def _search(limits: Column, n: int, key: Column) -> Column:
    """Number of limits that are not above ``key``, by binary search."""
    jumps = [1 << p for p in reversed(range(n.bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, jumps)),
        F.lit(0),
        lambda lo, jump: F.when(F.get(limits, lo + jump - 1) <= key, lo + jump).otherwise(lo),
    )


def running_total(
    df: DataFrame,
    value: Column,
    keys: Sequence[Column],
    *,
    partition_by: Sequence[str] = (),
    bucket: Column | None = None,
    out: str = "running_total",
    grand_total: str | None = None,
) -> DataFrame:
    """Add the inclusive running sum of ``value`` in key order.

    A caller's own ``bucket`` must not decrease along the key order and, unless
    there is a partition, must have a bounded number of values (at most 65,536).
    """
    bucket = range_bucket(df, keys) if bucket is None else bucket
    base = df.withColumn("_bucket", bucket).withColumn("_value", value)
    part = []
    if partition_by:
        # One struct: never null itself, so rows with null partition values meet in the
        # join, on the same keys the window has already distributed them by.
        base = base.withColumn("_part", F.struct(*partition_by))
        part = ["_part"]

    sums = base.groupBy(*part, "_bucket").agg(F.sum("_value").alias("_sum"))
    by_bucket = Window.partitionBy(*part)
    before = F.sum("_sum").over(
        by_bucket.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    columns = [*part, "_bucket", F.coalesce(before, F.lit(0)).alias("_before")]
    if grand_total is not None:
        columns.append(F.sum("_sum").over(by_bucket).alias(grand_total))
    offsets = sums.select(*columns)
    if not part:
        # One row per bucket: 65,536 rows at most, whatever the table size.
        offsets = F.broadcast(offsets)

    in_bucket = (
        Window.partitionBy(*part, "_bucket")
        .orderBy(*keys)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        base.withColumn("_local", F.sum("_value").over(in_bucket))
        .join(offsets, [*part, "_bucket"])
        .withColumn(out, F.col("_before") + F.col("_local"))
        .drop(*part, "_bucket", "_value", "_before", "_local")
    )


def dense_index(
    df: DataFrame,
    keys: Sequence[Column],
    *,
    partition_by: Sequence[str] = (),
    bucket: Column | None = None,
    out: str = "ix",
    total: str | None = None,
) -> DataFrame:
    """Add a gap-free 0-based index in key order, optionally per partition value."""
    counted = running_total(
        df,
        F.lit(1).cast("long"),
        keys,
        partition_by=partition_by,
        bucket=bucket,
        out=out,
        grand_total=total,
    )
    return counted.withColumn(out, F.col(out) - 1)


def visit_order(
    df: DataFrame,
    id_col: str,
    *,
    shuffle: bool,
    seed: int,
    out: str = "visit_ix",
    total: str | None = None,
) -> DataFrame:
    """Number the records in the order a run visits them.

    Sequential order follows the id. A shuffled order follows a seeded digest
    of the id, so the same seed gives the same order on any cluster; the first
    four hex digits of the digest are even buckets by themselves.
    """
    if not shuffle:
        return dense_index(df, [F.col(id_col)], out=out, total=total)
    keyed = df.withColumn("_visit_key", hash_key(seed, F.col(id_col)))
    return dense_index(
        keyed,
        [F.col("_visit_key"), F.col(id_col)],
        bucket=F.substring("_visit_key", 1, 4),
        out=out,
        total=total,
    ).drop("_visit_key")


def first_rows(df: DataFrame, keys: Sequence[Column], n: int | None) -> DataFrame:
    """The first ``n`` rows in key order; ``None`` and 0 both mean all rows.

    A large ``n`` is found by a dense index (keys must be unique), so that the rows never
    meet in one task.
    """
    if n and n > FIRST_IN_ONE_TASK:
        return dense_index(df, keys, out="_first").where(F.col("_first") < n).drop("_first")
    return df.orderBy(*keys).limit(n) if n else df


def newest(
    df: DataFrame, n: int, *, time_col: str, name_col: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Newest ``n`` rows, newest first, name as tie-break; per partition value if given.

    Both forms cut to ``n`` rows before any exchange, so a partition value with
    a large share of the rows costs no more than the others.
    """
    order = [F.col(time_col).desc(), F.col(name_col).asc()]
    if not partition_by:
        return df.orderBy(*order).limit(n)
    ranked = df.withColumn(
        "recency", F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order))
    )
    return ranked.where(F.col("recency") <= n)
