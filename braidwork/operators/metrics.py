"""Step plans and training-metric tables.

Steps are numbered from 0 without gaps within each ``(run_id, epoch)``; that
makes the window of a step plain arithmetic plus an offset per epoch, so no
window function ever runs over the steps of a run, and a run with a large
share of all steps is aggregated by as many tasks as any other data. Only
epoch and phase counts are put in order, in buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.functions.schedule import warmup_cosine_rate
from braidwork.operators.joins import salted_join
from braidwork.operators.ordering import running_total
from braidwork.session import materialize

STEPS_PER_TASK_ROW = 10_000
ORDINALS_PER_BUCKET = 4_096


def _div(a: Column, n: int) -> Column:
    return F.call_function("div", a.cast("long"), F.lit(n))


def run_step_plan(runs: DataFrame) -> DataFrame:
    """Add ``total_steps``, ``warmup_steps`` and ``status`` to a table with
    ``n_batches, epochs, warmup_rate``."""
    total = (F.col("n_batches") * F.col("epochs")).cast("long")
    warmup = F.greatest(F.lit(1), (total * F.col("warmup_rate")).cast("long")).cast("long")
    usable = F.col("n_batches") > 0
    return (
        runs.withColumn("total_steps", F.when(usable, total))
        .withColumn("warmup_steps", F.when(usable, warmup))
        .withColumn(
            "status",
            F.when(~usable, "no_batches")
            .when(F.col("warmup_steps") >= F.col("total_steps"), "no_decay_steps")
            .otherwise("ok"),
        )
    )


def _rate(step: Column) -> Column:
    return warmup_cosine_rate(
        step,
        F.col("total_steps"),
        F.col("warmup_steps"),
        F.col("lr_init_value"),
        F.col("lr_peak_value"),
        F.col("lr_end_value"),
    )


def lr_schedule(plans: DataFrame) -> DataFrame:
    """``run_id, step, learning_rate`` for every step of every run whose status is ok.

    A run is first cut into stretches of steps, which are spread over the
    cluster and expanded there, so one very long run is not one task's work.
    """
    stretch = F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("total_steps") - 1, F.lit(STEPS_PER_TASK_ROW).cast("long"))
    )
    spread = (
        plans.where(F.col("status") == "ok").withColumn("_from", stretch).repartition("run_id", "_from")
    )
    last = F.least(F.col("_from") + STEPS_PER_TASK_ROW, F.col("total_steps")) - 1
    steps = spread.withColumn("step", F.explode(F.sequence(F.col("_from"), last)))
    return steps.select("run_id", "step", _rate(F.col("step")).alias("learning_rate"))


def _ordered_sums(
    df: DataFrame, value: str, ordinal: str, partition: str, grand_total: str | None = None
) -> DataFrame:
    """Add ``_upto``: the running sum of ``value`` by an ordinal number within a partition.

    Stretches of the ordinal are the buckets, so even a run with very many
    epochs is summed by many tasks.
    """
    return running_total(
        df,
        F.col(value),
        [F.col(ordinal)],
        partition_by=[partition],
        bucket=_div(F.col(ordinal), ORDINALS_PER_BUCKET),
        out="_upto",
        grand_total=grand_total,
    )


def partial_windows(steps: DataFrame, every: int) -> DataFrame:
    """Loss sums per ``(run_id, epoch, w)`` where ``w`` counts ``every`` steps within the
    epoch, combined map-side."""
    return steps.groupBy("run_id", "epoch", _div(F.col("step"), every).alias("w")).agg(
        F.sum("loss").alias("loss_sum"),
        F.count(F.lit(1)).alias("n_losses"),
        F.max("step").alias("last_step"),
    )


def close_windows(partials: DataFrame, every: int) -> DataFrame:
    """Merge partial windows into the logged ones: ``run_id, g, end_epoch, end_step,
    n_losses, window_mean``.

    A window closes at every ``every``-th step of an epoch. Steps after the
    last close of an epoch carry over into the first window of the next one;
    steps never followed by a close are not reported.
    """
    closes = partials.groupBy("run_id", "epoch").agg(
        _div(F.sum("n_losses"), every).alias("n_closed")
    )
    offsets = _ordered_sums(closes, "n_closed", "epoch", "run_id", grand_total="n_windows").select(
        "run_id", "epoch", (F.col("_upto") - F.col("n_closed")).alias("first_g"), "n_windows"
    )
    placed = salted_join(partials, offsets, ["run_id", "epoch"], F.col("w"))
    return (
        placed.withColumn("g", F.col("first_g") + F.col("w"))
        .where(F.col("g") < F.col("n_windows"))
        .groupBy("run_id", "g")
        .agg(
            # Epoch and step in one long, which a hash aggregate can keep the maximum of.
            F.max(F.shiftleft(F.col("epoch").cast("long"), 32) + F.col("last_step")).alias("end"),
            F.sum("n_losses").alias("n_losses"),
            (F.sum("loss_sum") / F.sum("n_losses")).alias("window_mean"),
        )
        .select(
            "run_id",
            "g",
            F.shiftright("end", 32).cast("int").alias("end_epoch"),
            F.col("end").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("end_step"),
            "n_losses",
            "window_mean",
        )
    )


def loss_windows(steps: DataFrame, every: int) -> DataFrame:
    """Mean loss of every logged window of ``run_id, epoch, step, loss``.

    The partial windows are stored, because closing them needs their counts as
    well as their sums: the steps are read and shuffled once.
    """
    if every <= 0:
        raise ValueError(f"log_every_n_steps must be > 0, got {every}")
    return close_windows(materialize(partial_windows(steps, every), "partial-windows"), every)


def epoch_mean_loss(windows: DataFrame) -> DataFrame:
    """Mean of the window means logged in each epoch; no row for an epoch without any."""
    return windows.groupBy("run_id", F.col("end_epoch").alias("epoch")).agg(
        F.count(F.lit(1)).alias("n_windows"), F.avg("window_mean").alias("mean_loss")
    )


def final_loss(windows: DataFrame, runs: DataFrame) -> DataFrame:
    """``run_id, final_loss`` for every run: its last window mean, null without one."""
    last = windows.groupBy("run_id").agg(F.max_by("window_mean", "g").alias("final_loss"))
    return runs.select("run_id").join(last, "run_id", "left")


def logged_lr(windows: DataFrame, plans: DataFrame) -> DataFrame:
    """Windows with the learning rate that is logged beside them.

    The logged rate is looked up at the step number within the epoch, while
    training itself follows the step number of the whole run. ``status`` is that of
    the run's plan; without a usable plan the rate is null, and ``no_plan`` says
    that there is none.
    """
    columns = ["total_steps", "warmup_steps", "lr_init_value", "lr_peak_value", "lr_end_value"]
    planned = plans.select("run_id", "status", *columns)
    joined = salted_join(windows, planned, ["run_id"], F.col("g"), how="left")
    rate = F.when(F.col("status") == "ok", _rate(F.col("end_step")))
    rated = joined.withColumn("learning_rate", rate).drop(*columns)
    return rated.withColumn("status", F.coalesce("status", F.lit("no_plan")))


def loss_history(windows: DataFrame, phases: DataFrame) -> DataFrame:
    """``lineage, ix, phase, g, window_mean``: the window means of all phases of a lineage in
    phase order under one running index.

    ``phases`` maps ``run_id`` to ``(lineage, phase)``. Windows are dense per
    run, so the index is the window number plus the window counts of earlier
    phases; only those counts are ordered.
    """
    counts = windows.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_windows")).join(phases, "run_id")
    offsets = _ordered_sums(counts, "n_windows", "phase", "lineage").select(
        "run_id", "lineage", "phase", (F.col("_upto") - F.col("n_windows")).alias("_first")
    )
    placed = salted_join(windows, offsets, ["run_id"], F.col("g"))
    return placed.select(
        "lineage", (F.col("_first") + F.col("g")).alias("ix"), "phase", "g", "window_mean"
    )


def metric_schema_check(metrics: DataFrame, name_col: str, declared: Sequence[str]) -> DataFrame:
    """Row counts per metric name, declared or not: ``name, n, status``."""
    return (
        metrics.groupBy(F.col(name_col).alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn(
            "status", F.when(F.col("name").isin(list(declared)), "declared").otherwise("unknown_metric")
        )
    )


def record_metrics(metrics: DataFrame, name_col: str, declared: Sequence[str]) -> DataFrame:
    """The rows of declared metrics only."""
    return metrics.where(F.col(name_col).isin(list(declared)))
