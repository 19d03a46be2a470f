"""Lookup joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.session import materialize

SALTS = 16
# Rows of one key that a task joins, beyond which the key is split.
ROWS_PER_TASK = 1_000_000
# Hashes by which keys are counted before they are counted one by one.
KEY_GROUPS = 4_096
# A lookup side within both bounds is sent to every executor. The driver holds such
# a table several times over while it is sent, so it must be small beside a driver of 1 GB.
BROADCAST_ROWS = 200_000
BROADCAST_TEXT_BYTES = 16 * 1024 * 1024


def fits_broadcast(
    small: DataFrame, *, max_rows: int = BROADCAST_ROWS, max_text_bytes: int = BROADCAST_TEXT_BYTES
) -> bool:
    """Measure a stored lookup table: few enough rows, and not too much text or arrays in them?"""
    sizes = [F.octet_length(name) for name, kind in small.dtypes if kind == "string"]
    sizes += [F.size(name) * 8 for name, kind in small.dtypes if kind.startswith("array")]
    per_row = sum((F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)) for n in sizes), F.lit(0)).cast("long")
    n_rows, n_bytes = small.agg(F.count(F.lit(1)), F.sum(per_row)).collect()[0]
    return n_rows <= max_rows and (n_bytes or 0) <= max_text_bytes


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salt: Column,
    *,
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join a table with hot keys to a lookup table.

    ``salt`` is any integer expression of the big side that varies within a
    key. The rows of a hot key go to ``salts`` tasks instead of one; the
    lookup side is replicated as often.

    The lookup side is shuffled in any case: by the size of its files alone Spark takes
    a compressed table, or its replicated form, for small and sends it through the driver.
    """
    own = F.coalesce(F.pmod(salt, F.lit(salts)), F.lit(0))
    left = big.withColumn("_salt", own.cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def heavy_keys(big: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``on.., _parts``: keys with more than ``rows_per_task`` rows and into how many parts to cut them.

    Counted with map-side combine; at most one row per ``rows_per_task`` rows of ``big``. Keys
    are first counted by ``KEY_GROUPS`` hashes, few rows whatever the number of keys; only keys
    of a hash with so many rows are counted one by one. ``big`` is read twice.
    """
    of = F.pmod(F.xxhash64(*on), F.lit(KEY_GROUPS)).cast("int")
    groups = big.groupBy(of.alias("g")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_task)
    # At most KEY_GROUPS numbers.
    full = [r["g"] for r in groups.select("g").collect()]
    counts = big.where(of.isin(full)).groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_task)
    return counts.select(*on, F.ceil(F.col("n") / rows_per_task).cast("int").alias("_parts"))


def split_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salt: Column,
    *,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join a table to a lookup table, cutting exactly the keys that are too big for one task.

    Each key of ``big`` with more than ``rows_per_task`` rows gets a number of parts from
    its own count; rows choose a part by ``salt``, and only the lookup rows of such keys
    are repeated, once per part. ``big`` is read twice and should be a stored table. Null
    keys match nothing and are split like others.
    """
    heavy = materialize(heavy_keys(big, on, rows_per_task), "heavy")
    if heavy.isEmpty():
        return big.join(small, list(on), how)
    names = [f"_heavy_{k}" for k in range(len(on))]
    # Proven small: a row here stands for more than rows_per_task rows.
    known = F.broadcast(heavy.select(*[F.col(c).alias(n) for c, n in zip(on, names)], "_parts"))

    def marked(df: DataFrame) -> DataFrame:
        same = F.lit(True)
        for c, n in zip(on, names):
            same = same & F.col(c).eqNullSafe(F.col(n))
        return df.join(known, same, "left").drop(*names)

    own = F.pmod(salt.cast("long"), F.coalesce("_parts", F.lit(1)))
    left = marked(big).withColumn("_part", F.coalesce(own, F.lit(0)).cast("int")).drop("_parts")
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    right = marked(small).withColumn("_part", F.explode(parts)).drop("_parts")
    return left.join(right, [*on, "_part"], how).drop("_part")


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salt: Column,
    *,
    broadcast: bool,
    how: str = "inner",
) -> DataFrame:
    """Broadcast the lookup side when it was measured to fit, else salt."""
    if broadcast:
        return big.join(F.broadcast(small), list(on), how)
    return salted_join(big, small, on, salt, how=how)
