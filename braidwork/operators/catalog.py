"""Catalog, lineage and configuration tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.operators.joins import split_join
from braidwork.operators.ordering import newest, running_total
from braidwork.session import materialize


def run_name(model: Column, created: Column) -> Column:
    """``<model>_<yyyyMMdd>_<HHmmss>``, read off the wall-clock text of the timestamp."""
    digits = F.regexp_replace(F.substring(created.cast("string"), 1, 19), "[-:]", "")
    return F.concat_ws("_", model, F.replace(digits, F.lit(" "), F.lit("_")))


def latest_bundle(
    catalog: DataFrame, *, time_col: str = "mtime", name_col: str = "bundle"
) -> DataFrame:
    """The newest bundle as one row, or no row for an empty catalog."""
    return newest(catalog, 1, time_col=time_col, name_col=name_col)


def latest_bundles(
    catalog: DataFrame,
    n: int = 2,
    *,
    time_col: str = "mtime",
    name_col: str = "bundle",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Up to ``n`` newest bundles, over the whole catalog or for every model."""
    return newest(catalog, n, time_col=time_col, name_col=name_col, partition_by=partition_by)


def checkpoint_pairs(
    catalog: DataFrame, *, model_col: str, time_col: str = "mtime", name_col: str = "bundle"
) -> DataFrame:
    """Per model the pair to compare: newest bundle as ``after``, the one before it as
    ``before``; models with a single bundle get the status ``too_few``."""
    top = newest(catalog, 2, time_col=time_col, name_col=name_col, partition_by=[model_col])
    name = F.col(name_col)
    return (
        top.groupBy(model_col)
        .agg(
            F.max(F.when(F.col("recency") == 2, name)).alias("before"),
            F.max(F.when(F.col("recency") == 1, name)).alias("after"),
        )
        .withColumn("status", F.when(F.col("before").isNull(), "too_few").otherwise("ok"))
    )


def resolve_pair(
    catalog: DataFrame, before: str | None = None, after: str | None = None
) -> tuple[str, str, bool]:
    """Names of the two bundles to compare and whether they are the same one.

    Give both names, or neither to take the two newest of the catalog.
    """
    if (before is None) != (after is None):
        raise ValueError("give both bundle names or neither")
    if before is None:
        names = [r["bundle"] for r in latest_bundles(catalog, 2).select("bundle").collect()]
        if len(names) < 2:
            raise ValueError(f"two bundles are needed, found {len(names)}")
        after, before = names
    return before, after, before == after


def cumulative_epochs(
    phases: DataFrame, *, lineage: str, order_by: Sequence[str], epochs: str = "epochs"
) -> DataFrame:
    """Add ``previous_epochs`` and ``cumulative_epochs`` along each lineage.

    The running sum is bucketed, so a lineage with a large share of all phases
    is not one task's work.
    """
    total = running_total(
        phases,
        F.col(epochs).cast("long"),
        [F.col(c) for c in order_by],
        partition_by=[lineage],
        out="cumulative_epochs",
    )
    return total.withColumn("previous_epochs", F.col("cumulative_epochs") - F.col(epochs))


def resume_lineage(
    runs: DataFrame, *, run: str = "run_id", parent: str = "resumed_from", epochs: str = "epochs"
) -> DataFrame:
    """``run, root, depth, previous_epochs, cumulative_epochs, problem`` from links to the run before.

    Pointer doubling: every run knows an ancestor, its distance and the epochs in between,
    and each round asks that ancestor for its own, so a chain of n runs takes log2(n) rounds
    and runs that have reached their root rest. Several runs may continue the same one.
    A run that names an unknown one starts a lineage (``unknown_parent``); a run whose links
    never reach a root has no lineage (``cycle``: null root, depth and sums); rows of one run
    that name different parents are one run with the smallest (``several_parents``). Rows
    without a run are left out; null epochs count as 0.
    """
    given = runs.where(F.col(run).isNotNull()).groupBy(F.col(run).alias("run")).agg(
        F.min(parent).alias("parent"), F.count_distinct(parent).alias("parents"),
        F.coalesce(F.max(epochs), F.lit(0)).cast("long").alias("epochs"),
    )
    links = materialize(given, "links")
    known = links.select(F.col("run").alias("parent"), F.lit(True).alias("known"))
    placed = split_join(links, known, ["parent"], F.xxhash64("run"), how="left")
    is_root = F.col("known").isNull()
    # ``above``: epochs of the runs from this one up to, but without, the ancestor; with it once it is a root.
    placed = materialize(
        placed.select(
            "run", F.when(is_root, F.col("run")).otherwise(F.col("parent")).alias("at"),
            F.when(is_root, 0).otherwise(1).cast("long").alias("depth"),
            F.col("epochs").alias("above"), is_root.alias("done"), "epochs",
            F.when(F.col("parents") > 1, "several_parents")
            .when(F.col("parent").isNotNull() & is_root, "unknown_parent").alias("problem"),
        ),
        "lineage",
    )
    # Runs that are done are stored once; a round stores the runs that still waited.
    ended, waiting = placed.where("done"), placed.where(~F.col("done"))
    for _ in range(max(1, links.count()).bit_length()):
        if waiting.isEmpty():
            break
        asked = ended.unionByName(waiting).select(
            F.col("run").alias("at"), F.col("at").alias("next"), F.col("depth").alias("more"),
            F.col("above").alias("more_above"), F.col("done").alias("there"),
        )
        moved = split_join(waiting, asked, ["at"], F.xxhash64("run"), how="left").select(
            "run", F.col("next").alias("at"), (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("above") + F.col("more_above")).alias("above"), F.col("there").alias("done"), "epochs", "problem",
        )
        stored = materialize(moved, "lineage")
        ended, waiting = ended.unionByName(stored.where("done")), stored.where(~F.col("done"))
    reached = F.col("done")
    total = F.when(reached, F.col("above"))
    return ended.unionByName(waiting).select(
        F.col("run").alias(run), F.when(reached, F.col("at")).alias("root"), F.when(reached, F.col("depth")).alias("depth"),
        (total - F.col("epochs")).alias("previous_epochs"), total.alias("cumulative_epochs"),
        F.when(~reached, "cycle").otherwise(F.col("problem")).alias("problem"),
    )


def resume_context(catalog: DataFrame, metadata: DataFrame) -> DataFrame:
    """``bundle, previous_epochs, status`` for every bundle; without readable metadata there
    is nothing to resume from."""
    joined = catalog.select("bundle").join(metadata, "bundle", "left")
    prior = F.col("metadata.cumulative_epochs_completed")
    return joined.select(
        "bundle",
        prior.alias("previous_epochs"),
        F.when(prior.isNull(), "no_readable_metadata").otherwise("ok").alias("status"),
    )


def assemble_metadata(runs: DataFrame) -> DataFrame:
    """``bundle, json``: the sidecar document of every run.

    Needs ``bundle, cumulative_epochs_completed, final_loss, model_config,
    training_config, tokenizer_config, created_at`` (the configurations as
    structs). A run without a loss keeps the key, with null.
    """
    document = F.struct(
        "cumulative_epochs_completed",
        "final_loss",
        "model_config",
        "training_config",
        "tokenizer_config",
        "created_at",
    )
    return runs.select("bundle", F.to_json(document, {"ignoreNullFields": "false"}).alias("json"))


# The settings that a run may override.
OVERRIDABLE = ("batch_size", "epochs", "max_stories", "seed", "shuffle")


def apply_overrides(
    overrides: DataFrame, defaults: Mapping[str, Any], fields: Sequence[str] = OVERRIDABLE
) -> DataFrame:
    """Fill null overrides from the defaults; 0 and false are overrides, not gaps."""
    unknown = set(fields) - set(defaults)
    if unknown:
        raise ValueError(f"no default for {sorted(unknown)}")
    return overrides.withColumns(
        {name: F.coalesce(F.col(name), F.lit(defaults[name])) for name in fields}
    )


def config_struct(config: Mapping[str, Any], **replaced: Column) -> Column:
    """A configuration as a struct column; keyword columns replace single fields."""
    return F.struct(
        *[replaced.get(name, F.lit(value)).alias(name) for name, value in config.items()]
    )
