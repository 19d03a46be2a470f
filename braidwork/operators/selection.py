"""Exact order statistics of a distributed column of magnitudes (values >= 0).

``median`` and ``percentile`` merge a map of all distinct values in one task.
Here a histogram on a logarithmic scale (a bounded number of bins, map-side
combined) bounds every rank by the limits of its bin. One more pass over the column
stores what lies within the bins asked for; all else happens on that bracket, whose bins
are split into linear sub-bins until they hold one value or few enough rows to sort in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from braidwork.session import materialize

BINS_PER_OCTAVE = 64
LINEAR_BINS = 65_536
SORT_LIMIT = 1_000_000
# Labels of the bins outside the finite positive numbers.
_ZERO_BIN, _INFINITE_BIN, _NAN_BIN = -1_000_000, 1_000_000, 1_000_001


def magnitude_bin(x: Column) -> Column:
    """A non-decreasing bin number; at most 2,100 octaves * BINS_PER_OCTAVE of them."""
    return (
        F.when(F.isnan(x), F.lit(_NAN_BIN))
        .when(x == float("inf"), F.lit(_INFINITE_BIN))
        .when(x == 0, F.lit(_ZERO_BIN))
        .otherwise(F.floor(F.log2(x) * BINS_PER_OCTAVE).cast("int"))
    )


@dataclass(frozen=True)
class Histogram:
    """Collected bins in ascending order; the row count is bounded by the bin formula."""

    bins: tuple[Row, ...]
    n: int
    n_nan: int
    n_null: int


def histogram(df: DataFrame, column: str, *extra: Column) -> Histogram:
    """One pass: per-bin count, smallest and largest value, plus ``extra`` aggregates."""
    rows = (
        df.groupBy(magnitude_bin(F.col(column)).alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(column).alias("lo"),
            F.max(column).alias("hi"),
            *extra,
        )
        .collect()
    )
    known = sorted((r for r in rows if r["bin"] is not None), key=lambda r: r["bin"])
    return Histogram(
        bins=tuple(known),
        n=sum(r["n"] for r in known),
        n_nan=sum(r["n"] for r in known if r["bin"] == _NAN_BIN),
        n_null=sum(r["n"] for r in rows if r["bin"] is None),
    )


def values_at(
    df: DataFrame,
    column: str,
    hist: Histogram,
    ranks: Sequence[int],
    *,
    sort_limit: int = SORT_LIMIT,
) -> list[float]:
    """The values at the given 0-based ranks of the sorted column.

    ``df`` is read once more at most, whatever the number of ranks and splits.
    """
    x = F.col(column)
    located = [_locate(list(hist.bins), rank) for rank in ranks]
    limits = sorted({(found["lo"], found["hi"]) for found, _ in located if found["lo"] != found["hi"]})
    if limits:
        within = F.lit(False)
        for lo, hi in limits:
            within = within | ((x >= lo) & (x <= hi))
        df = materialize(df.where(within).select(x), "bracket")
    return [_descend(df, column, found, rank, sort_limit) for found, rank in located]


def _locate(bins: list[Row], rank: int) -> tuple[Row, int]:
    """The bin that holds a rank, and the rank within it."""
    for found in bins:
        if rank < found["n"]:
            break
        rank -= found["n"]
    return found, rank


def _descend(df: DataFrame, column: str, found: Row, rank: int, sort_limit: int) -> float:
    x = F.col(column)
    while True:
        lo, hi = found["lo"], found["hi"]
        if lo == hi:
            return lo
        inside = df.where((x >= lo) & (x <= hi))
        if found["n"] <= sort_limit:
            ordered = F.sort_array(F.collect_list(x))
            return inside.agg(F.get(ordered, F.lit(rank)).alias("v")).collect()[0]["v"]
        cell = F.floor((x - lo) / (hi - lo) * LINEAR_BINS).cast("int")
        rows = (
            inside.groupBy(cell.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"))
            .collect()
        )
        found, rank = _locate(sorted(rows, key=lambda r: r["bin"]), rank)


def median_of(
    df: DataFrame, column: str, hist: Histogram, *, sort_limit: int = SORT_LIMIT
) -> float | None:
    """Exact median (mean of the two middle values when n is even); NaN if any value is."""
    if hist.n == 0:
        return None
    if hist.n_nan:
        return float("nan")
    ranks = sorted({(hist.n - 1) // 2, hist.n // 2})
    picked = values_at(df, column, hist, ranks, sort_limit=sort_limit)
    return picked[0] if picked[0] == picked[-1] else (picked[0] + picked[-1]) / 2.0
