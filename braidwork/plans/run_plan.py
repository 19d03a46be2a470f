"""What a training run will do, worked out before it starts."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidwork.configs import TrainingConfig
from braidwork.operators.metrics import run_step_plan
from braidwork.plans.training_data import require_batches


def previous_epochs(context: DataFrame | None) -> int:
    """Epochs trained before, from one row of ``resume_context``; a fresh run has none."""
    if context is None:
        return 0
    rows = context.select("bundle", "previous_epochs", "status").limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a run resumes from exactly one bundle")
    if rows[0]["status"] != "ok":
        raise ValueError(f"cannot resume from {rows[0]['bundle']!r}: {rows[0]['status']}")
    return rows[0]["previous_epochs"]


def plan_run(
    token_rows: DataFrame, training: TrainingConfig, *, run_id: str, resume_from: DataFrame | None = None
) -> DataFrame:
    """One row: record and batch counts, step counts, epochs before and after.

    ``token_rows`` is the stored table that ``batch_token_rows`` reads; only
    its row count is used.
    """
    n_records = token_rows.count()
    settings = {
        "run_id": run_id,
        "n_records": n_records,
        "n_batches": require_batches(n_records, training.batch_size),
        "previous_epochs": previous_epochs(resume_from),
        **dataclasses.asdict(training),
    }
    row = token_rows.sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in settings.items()])
    return run_step_plan(row).withColumn(
        "cumulative_epochs", F.col("previous_epochs") + F.col("epochs")
    )
