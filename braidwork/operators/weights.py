"""Comparison of two weight tables.

A weight table has one row per chunk of a leaf: ``leaf, kind, chunk_id,
values``. Chunks have a bounded size, so an embedding matrix that holds a third
of a model is many rows with different join keys. Two tables may cut their leaves
differently: then chunks meet where their ranges of offsets overlap.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.functions.numbers import fixed_point, scientific
from braidwork.operators.ordering import running_total
from braidwork.operators.selection import SORT_LIMIT, Histogram, histogram, median_of
from braidwork.session import materialize

CHANGE_THRESHOLD = 1e-8
MIN_NORM = 1e-12
CHUNK_SIZE = 65_536


def chunk_leaves(leaves: DataFrame, values_col: str = "values", chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Cut whole leaves into chunk rows."""
    v = F.col(values_col)
    starts = F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(chunk_size))
    chunks = F.transform(starts, lambda s: F.slice(v, s, F.lit(chunk_size)))
    others = [c for c in leaves.columns if c != values_col]
    return leaves.select(*others, F.posexplode(chunks).alias("chunk_id", "values"))


def _square_sum(values: Column) -> Column:
    return F.aggregate(
        values, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )


def leaf_stats(weights: DataFrame) -> DataFrame:
    """``leaf, n_values, norm``: element count and L2 norm over all chunks of each leaf."""
    return (
        weights.select("leaf", F.size("values").alias("n"), _square_sum(F.col("values")).alias("ss"))
        .groupBy("leaf")
        .agg(F.sum("n").alias("n_values"), F.sqrt(F.sum("ss")).alias("norm"))
    )


def count_params(weights: DataFrame) -> DataFrame:
    """One row: number of trainable values (kind ``param``)."""
    return weights.where(F.col("kind") == "param").agg(
        F.coalesce(F.sum(F.size("values")), F.lit(0)).cast("long").alias("n_params")
    )


def _paired_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    b = leaf_stats(before).select("leaf", F.col("n_values").alias("n_before"), F.col("norm").alias("norm_before"))
    a = leaf_stats(after).select("leaf", F.col("n_values").alias("n_after"), F.col("norm").alias("norm_after"))
    return b.join(a, "leaf", "full_outer")


def _structure_problem() -> Column:
    return (
        F.when(F.col("n_before").isNull(), "only_after")
        .when(F.col("n_after").isNull(), "only_before")
        .when(F.col("n_before") != F.col("n_after"), "size_differs")
    )


def structure_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Leaves that do not match: ``leaf, n_before, n_after, problem``. Empty means comparable."""
    sizes = [
        w.groupBy("leaf").agg(F.sum(F.size("values")).alias(name))
        for w, name in ((before, "n_before"), (after, "n_after"))
    ]
    paired = sizes[0].join(sizes[1], "leaf", "full_outer")
    return paired.withColumn("problem", _structure_problem()).where(F.col("problem").isNotNull())


def _raise_mismatch(problems: DataFrame) -> None:
    examples = problems.orderBy("leaf").limit(3).collect()
    if examples:
        shown = ", ".join(f"{r['leaf']} ({r['problem']})" for r in examples)
        raise ValueError(f"the two weight tables have different structures: {shown}")


def require_same_structure(before: DataFrame, after: DataFrame) -> None:
    _raise_mismatch(structure_diff(before, after))


def norm_ratios(before: DataFrame, after: DataFrame) -> DataFrame:
    """``leaf, norm_before, norm_after`` after the structure check, as a stored leaf-level table."""
    paired = materialize(_paired_stats(before, after), "leaf-norms")
    _raise_mismatch(
        paired.withColumn("problem", _structure_problem()).where(F.col("problem").isNotNull())
    )
    return paired


def _ratio_summary(paired: DataFrame, ratio: Column, *, sort_limit: int) -> DataFrame:
    """One row of median, min and max over the non-null ratios, and both counts."""
    rated = paired.withColumn("ratio", ratio)
    kept = rated.where(F.col("ratio").isNotNull())
    median = median_of(kept, "ratio", histogram(kept, "ratio"), sort_limit=sort_limit)
    any_nan = F.coalesce(F.bool_or(F.isnan("ratio")), F.lit(False))
    nan, zero = F.lit(float("nan")), F.lit(0.0)
    return rated.agg(
        F.lit(0.0 if median is None else median).alias("median_ratio"),
        F.when(any_nan, nan).otherwise(F.coalesce(F.min("ratio"), zero)).alias("min_ratio"),
        F.when(any_nan, nan).otherwise(F.coalesce(F.max("ratio"), zero)).alias("max_ratio"),
        F.count("ratio").alias("compared_leaves"),
        (F.count(F.lit(1)) - F.count("ratio")).alias("skipped_leaves"),
    )


def compare_norms(before: DataFrame, after: DataFrame, *, sort_limit: int = SORT_LIMIT) -> DataFrame:
    """One row: median, min and max of norm(after) / norm(before) over the leaves.

    Leaves whose earlier norm is below ``MIN_NORM`` are skipped and counted;
    when all are, the ratios are 0. A NaN ratio makes all three NaN.
    """
    ratio = F.when(
        F.isnan("norm_before") | (F.col("norm_before") >= MIN_NORM),
        F.try_divide("norm_after", "norm_before"),
    )
    return _ratio_summary(norm_ratios(before, after), ratio, sort_limit=sort_limit)


def compare_norms_finite(
    before: DataFrame, after: DataFrame, *, sort_limit: int = SORT_LIMIT
) -> DataFrame:
    """Variant without the norm floor: only ratios that are not finite are skipped."""
    ratio = F.try_divide("norm_after", "norm_before")
    finite = F.when(~F.isnan(ratio) & (ratio != float("inf")), ratio)
    return _ratio_summary(norm_ratios(before, after), finite, sort_limit=sort_limit)


def norm_verdict(summary: DataFrame) -> DataFrame:
    """Add ``verdict`` and ``percent`` (distance of the median ratio from 1, in percent)."""
    percent = F.abs(F.col("median_ratio") - 1.0) * 100
    return summary.withColumn("percent", percent).withColumn(
        "verdict",
        F.when(percent < 1.0, F.concat(F.lit("very similar: "), fixed_point(percent, 2), F.lit("%")))
        .when(
            percent < 5.0,
            F.concat(F.lit("moderately different: "), fixed_point(percent, 1), F.lit("%")),
        )
        .otherwise(
            F.concat(
                F.when(F.col("median_ratio") > 1.0, "grown by ").otherwise("shrunk by "),
                fixed_point(percent, 1),
                F.lit("%"),
            )
        ),
    )


def _joined_chunks(before: DataFrame, after: DataFrame) -> DataFrame:
    b = before.select("leaf", "chunk_id", F.col("values").alias("v_before"))
    a = after.select("leaf", "chunk_id", F.col("values").alias("v_after"))
    both_empty = (F.size("v_before") == 0) & (F.size("v_after") == 0)
    return b.join(a, ["leaf", "chunk_id"], "full_outer").where(~F.coalesce(both_empty, F.lit(False)))


def _placed_pieces(weights: DataFrame, grid: int, values: str) -> DataFrame:
    """``leaf, slot, lo, hi, values``: chunks with their offsets in the leaf, cut at multiples of ``grid``."""
    sized = weights.select("leaf", "chunk_id", "values", F.size("values").cast("long").alias("n"))
    # Only sizes are summed up along a leaf; chunks with the same id would have no order.
    ends = running_total(
        materialize(sized.select("leaf", "chunk_id", "n"), "chunk-sizes"), F.col("n"),
        [F.col("leaf"), F.col("chunk_id")], partition_by=["leaf"], out="end",
    )
    placed = sized.join(ends.select("leaf", "chunk_id", (F.col("end") - F.col("n")).alias("start")), ["leaf", "chunk_id"])
    placed = placed.where("n > 0").withColumn("end", F.col("start") + F.col("n"))
    slots = F.sequence(F.floor(F.col("start") / grid), F.floor((F.col("end") - 1) / grid))
    cut = placed.select("*", F.explode(slots).alias("slot"))
    lo = F.greatest("start", F.col("slot") * grid).alias("lo")
    hi = F.least("end", (F.col("slot") + 1) * grid).alias("hi")
    cut = cut.select("leaf", "slot", "values", "start", lo, hi)
    piece = F.slice("values", (F.col("lo") - F.col("start") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int"))
    return cut.select("leaf", "slot", "lo", "hi", piece.alias(values))


def overlapping_chunks(before: DataFrame, after: DataFrame) -> DataFrame:
    """``leaf, v_before, v_after``: the values of both tables side by side, whatever their chunks.

    Both must hold the same leaves with as many values. Pieces meet on (leaf, stretch
    of offsets), where a piece overlaps a few others at most; each overlap is cut out of
    both sides, so every value comes up once.
    """
    largest = [t.agg(F.max(F.size("values"))).first()[0] or 1 for t in (before, after)]
    grid = max(largest)
    b = _placed_pieces(before, grid, "v_before").withColumnsRenamed({"lo": "lo_b", "hi": "hi_b"})
    a = _placed_pieces(after, grid, "v_after").withColumnsRenamed({"lo": "lo_a", "hi": "hi_a"})
    met = b.join(a, ["leaf", "slot"]).where((F.col("lo_b") < F.col("hi_a")) & (F.col("lo_a") < F.col("hi_b")))
    met = met.withColumn("lo", F.greatest("lo_a", "lo_b")).withColumn("n", F.least("hi_a", "hi_b") - F.col("lo"))

    def shared(values: str, start: str) -> Column:
        return F.slice(values, (F.col("lo") - F.col(start) + 1).cast("int"), F.col("n").cast("int")).alias(values)

    return met.select("leaf", shared("v_before", "lo_b"), shared("v_after", "lo_a"))


def _chunks_agree(before: DataFrame, after: DataFrame) -> bool:
    """Do both tables cut their leaves alike? Reads sizes only."""
    b, a = (
        w.where(F.size("values") > 0).select("leaf", "chunk_id", F.size("values").alias(n))
        for w, n in ((before, "n_before"), (after, "n_after"))
    )
    return b.join(a, ["leaf", "chunk_id"], "full_outer").where(~F.col("n_before").eqNullSafe(F.col("n_after"))).isEmpty()


def _differences() -> Column:
    return F.zip_with(
        "v_before", "v_after", lambda b, a: F.abs(b.cast("double") - a.cast("double"))
    )


def _is_changed(diff: Column, threshold: float) -> Column:
    # NaN sorts above every number here, but a NaN difference is not a change.
    return (diff > threshold) & ~F.isnan(diff)


def compare_states(
    before: DataFrame,
    after: DataFrame,
    *,
    threshold: float = CHANGE_THRESHOLD,
    sort_limit: int = SORT_LIMIT,
) -> DataFrame:
    """One row of per-value change statistics, all exact.

    The first pass joins chunk by chunk and collects a magnitude histogram of
    the differences with counts, sums and extremes per bin (a bounded number
    of bins). It brackets the median; a second pass stores the differences within
    the bracket, and the tables are not joined again. Neither the differences nor
    any group of them are ever gathered in one place. Tables whose chunks differ
    are joined where their chunks overlap.
    """
    if not threshold > 0:
        raise ValueError(f"threshold must be positive, got {threshold}")
    changed = F.count_if(_is_changed(F.col("d"), threshold)).alias("changed")
    diffs = _joined_chunks(before, after).select(F.explode_outer(_differences()).alias("d"))
    hist = histogram(diffs, "d", changed, F.sum("d").alias("total"))
    if hist.n_null:
        # A chunk without a partner or of another length: another structure, or only other chunks.
        require_same_structure(before, after)
        diffs = overlapping_chunks(before, after).select(F.explode(_differences()).alias("d"))
        hist = histogram(diffs, "d", changed, F.sum("d").alias("total"))
    if hist.n == 0:
        raise ValueError("the weight tables hold no values to compare")
    median = median_of(diffs, "d", hist, sort_limit=sort_limit)
    return _state_row(before.sparkSession, hist, median, threshold)


def _state_row(spark, hist: Histogram, median: float, threshold: float) -> DataFrame:
    nan = float("nan") if hist.n_nan else None
    changed = sum(b["changed"] for b in hist.bins)
    row = (
        hist.n,
        changed,
        changed / hist.n * 100.0,
        median,
        nan if nan is not None else math.fsum(b["total"] for b in hist.bins) / hist.n,
        nan if nan is not None else max(b["hi"] for b in hist.bins),
        nan if nan is not None else min(b["lo"] for b in hist.bins),
        threshold,
    )
    return spark.createDataFrame(
        [row],
        "total_params long, changed_params long, percent_changed double, median_change double, "
        "mean_change double, max_change double, min_change double, change_threshold double",
    )


def state_verdict(summary: DataFrame) -> DataFrame:
    """Add ``unchanged_params`` and ``verdict``."""
    percent, median = F.col("percent_changed"), F.col("median_change")
    one_decimal = F.concat(fixed_point(percent, 1), F.lit("%"))
    return summary.withColumn(
        "unchanged_params", F.col("total_params") - F.col("changed_params")
    ).withColumn(
        "verdict",
        F.when(
            percent < 1.0, F.concat(F.lit("nearly identical: "), fixed_point(percent, 2), F.lit("% changed"))
        )
        .when(percent < 50.0, F.concat(F.lit("minority changed: "), one_decimal))
        .when(
            median < 1e-4,
            F.concat(F.lit("subtly different: "), one_decimal, F.lit(" changed, median "), scientific(median)),
        )
        .otherwise(
            F.concat(
                F.lit("substantially different: "),
                one_decimal,
                F.lit(" changed, median "),
                fixed_point(median, 6),
            )
        ),
    )


def leaf_change_stats(
    before: DataFrame, after: DataFrame, *, threshold: float = CHANGE_THRESHOLD
) -> DataFrame:
    """Change statistics per leaf; each chunk is reduced in its own row before the shuffle.

    Both tables must have the same leaves with as many values, in chunks of any size. A leaf with a NaN
    difference has NaN for its mean, largest and smallest change.
    """
    if not threshold > 0:
        raise ValueError(f"threshold must be positive, got {threshold}")
    require_same_structure(before, after)
    d = F.col("d")
    if _chunks_agree(before, after):
        met = _joined_chunks(before, after)
    else:
        met = overlapping_chunks(before, after)
    chunk = met.select("leaf", _differences().alias("d"))
    reduced = chunk.select(
        "leaf",
        F.exists(d, F.isnan).alias("nan"),
        F.size(d).alias("n"),
        F.size(F.filter(d, lambda x: _is_changed(x, threshold))).alias("changed"),
        F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x).alias("total"),
        F.array_max(d).alias("hi"),
        F.array_min(d).alias("lo"),
    )
    return reduced.groupBy("leaf").agg(
        F.sum("n").alias("total_params"),
        F.sum("changed").alias("changed_params"),
        (F.sum("changed") / F.sum("n") * 100.0).alias("percent_changed"),
        (F.sum("total") / F.sum("n")).alias("mean_change"),
        F.max("hi").alias("max_change"),
        F.when(F.bool_or("nan"), F.lit(float("nan"))).otherwise(F.min("lo")).alias("min_change"),
    )
