"""Batches of consecutive records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidwork.functions.tokens import position_major


def assign_batches(
    indexed: DataFrame, ix: str, total: str, batch_size: int, *, drop_remainder: bool = True
) -> DataFrame:
    """Replace a dense index and the row total by ``batch_id`` and ``slot``."""
    if batch_size <= 0:
        raise ValueError(f"batch_size must be > 0, got {batch_size}")
    full = (F.col(total) - F.col(total) % batch_size).alias("_full")
    kept = indexed.where(F.col(ix) < full) if drop_remainder else indexed
    return (
        kept.withColumn("slot", (F.col(ix) % batch_size).cast("int"))
        .withColumn("batch_id", F.call_function("div", F.col(ix), F.lit(batch_size)).cast("long"))
        .drop(ix, total)
    )


def pack_batches(rows: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """One row per batch with ``rows``: the sequences in slot order (at most batch size)."""
    ordered = F.sort_array(F.collect_list(F.struct("slot", F.col(tokens_col).alias("t"))))
    return rows.groupBy("batch_id").agg(F.transform(ordered, lambda r: r["t"]).alias("rows"))


def to_position_major(packed: DataFrame, maxlen: int) -> DataFrame:
    """``batch_id, position, tokens``: token of every slot at each position."""
    return packed.select(
        "batch_id",
        F.posexplode(position_major(F.col("rows"), maxlen)).alias("position", "tokens"),
    )


def repeat_epochs(rows: DataFrame, epochs: int) -> DataFrame:
    """Every record once per epoch, in the same batch and slot each time."""
    return rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))


def batches_per_epoch(counts: DataFrame, *, n_records: str, batch_size: str) -> DataFrame:
    """Full batches for a table of (record count, batch size), with a status that tells an
    empty data set from one that is smaller than a batch."""
    n, size = F.col(n_records), F.col(batch_size)
    return counts.withColumn("n_batches", ((n - n % size) / size).cast("long")).withColumn(
        "status",
        F.when(n == 0, "empty_dataset").when(F.col("n_batches") <= 0, "no_full_batch").otherwise("ok"),
    )
