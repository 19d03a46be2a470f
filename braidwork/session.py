"""Session set-up and the one place that decides where intermediate tables live."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "braidwork", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Only settings that are safe at any scale are fixed here; cluster sizing
    (executors, memory, shuffle partitions) stays with the submitter.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Where it is unset the warehouse serves, which every executor reaches as well.
    """
    context = spark.sparkContext
    current = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if not current:
        current = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/braidwork/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage so that a lost executor never re-runs it, fixes the rows
    that later branches of a plan see, and keeps column pruning and size
    statistics for those branches.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Even out an input with fewer partitions than the cluster has cores.

    Tokenising costs far more per byte than moving text. A large input has
    more splits than cores and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
