"""A store of weight bundles on shared storage, published through a manifest.

Layout: ``<root>/weights/version=<v>/bundle=<name>/*.parquet`` holds weights, written once
and never changed. ``<root>/log/epoch=<e>/*.json`` is the manifest log: a save writes its
weights under a new version first, and then one log file with a row per bundle (version,
sizes, checksum, metadata document), which appears as a whole or not at all. Readers know
only what the log names, so a save that stops half way changes nothing: the old weights
stay, and never with new metadata. ``<root>/index/epoch=<e>`` is the state of the log before
epoch ``e``, one row per bundle, so that a catalog is read from the newest index and the few
log files behind it, without listing the store.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidwork.configs import METADATA_SCHEMA

WEIGHTS_SCHEMA = T.StructType(
    [
        T.StructField("leaf", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("shape", T.ArrayType(T.IntegerType())),
        T.StructField("chunk_id", T.IntegerType()),
        T.StructField("values", T.ArrayType(T.FloatType())),
    ]
)
ROWS_PER_FILE = 1_000_000
_NAME = re.compile(r"[A-Za-z0-9_.\-]+")
_KEYS = [T.StructField("version", T.StringType()), T.StructField("bundle", T.StringType())]
_STORED_WEIGHTS = T.StructType([*WEIGHTS_SCHEMA, *_KEYS])
# A row of the log; ``version`` is null where only metadata were given, ``json`` where none were.
_LOG = (
    "bundle string, seq long, version string, mtime timestamp, n_files long, n_bytes long, n_rows long, "
    "checksum long, json string"
)
_WEIGHT_FIELDS = ("version", "mtime", "n_files", "n_bytes", "n_rows", "checksum")


def check_bundle_name(name: str) -> None:
    if not _NAME.fullmatch(name):
        raise ValueError(f"bundle name may hold letters, digits, '_', '.', '-' only: {name!r}")


def _checked_name() -> Column:
    """The bundle column; a name that is no valid path part fails the write, before anything
    is committed and without a pass of its own."""
    name = F.col("bundle")
    allowed = F.coalesce(name.rlike(f"^{_NAME.pattern}$"), F.lit(False))
    refusal = F.raise_error(F.concat(F.lit("not a bundle name: "), F.coalesce(name, F.lit("null"))))
    return F.when(allowed, name).otherwise(refusal.cast("string")).alias("bundle")


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if _missing(error):
            return False
        raise
    return True


def _epoch(spark: SparkSession, root: str) -> int:
    """The newest epoch that has an index; 0 before the first one."""
    if not _path_exists(spark, f"{root}/index"):
        return 0
    found = spark.read.schema("bundle string, epoch int").parquet(f"{root}/index").agg(F.max("epoch")).first()
    return found[0] or 0


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The newest weights and the newest metadata document of every bundle, from index and log only.

    Columns as in the log; ``version`` is null for a bundle without weights.
    """
    epoch = _epoch(spark, root)
    rows = spark.createDataFrame([], _LOG)
    if epoch:
        rows = rows.unionByName(
            spark.read.schema(f"{_LOG}, epoch int").parquet(f"{root}/index").where(F.col("epoch") == epoch).drop("epoch")
        )
    if _path_exists(spark, f"{root}/log"):
        log = spark.read.schema(f"{_LOG}, epoch int").json(f"{root}/log")
        # A save that began before the index was written may have gone to the epoch before.
        rows = rows.unionByName(log.where(F.col("epoch") >= epoch - 1).drop("epoch"))
    order = F.col("seq")
    held = F.when(F.col("version").isNotNull(), order)
    told = F.when(F.col("json").isNotNull(), order)
    return rows.groupBy("bundle").agg(
        F.max("seq").alias("seq"),
        F.max_by(F.struct(*_WEIGHT_FIELDS), held).alias("w"),
        F.max_by("json", told).alias("json"),
    ).select("bundle", "seq", "w.*", "json")


def _publish(rows: DataFrame, root: str) -> None:
    """Append one file to the log: its appearance is the moment of the save."""
    spark = rows.sparkSession
    stamped = rows.select("bundle", F.lit(time.time_ns()).alias("seq"), *_WEIGHT_FIELDS, "json")
    # One small row per bundle, in one file.
    stamped.coalesce(1).write.mode("append").json(f"{root}/log/epoch={_epoch(spark, root)}")


def compact_log(spark: SparkSession, root: str) -> None:
    """Write the state of the log as the index of the next epoch; later readers start there.

    Two compactions at once write the same state twice, which is harmless; saves may go on.
    """
    state = manifest(spark, root)
    state.write.mode("overwrite").parquet(f"{root}/index/epoch={_epoch(spark, root) + 1}")


def _version_rows(spark: SparkSession, root: str, version: str) -> DataFrame:
    """Sizes and checksum of each bundle of a version, read back from what was written."""
    path = f"{root}/weights/version={version}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    sizes = _by_bundle(files.load(path))
    stored = spark.read.schema(T.StructType([*WEIGHTS_SCHEMA, _KEYS[1]])).parquet(path)
    return sizes.join(_checksums(stored), "bundle").withColumn("version", F.lit(version))


def _checksums(stored: DataFrame) -> DataFrame:
    """``bundle, n_rows, checksum``; the order of rows does not matter."""
    row = F.xxhash64("leaf", "kind", "shape", "chunk_id", "values")
    return stored.groupBy("bundle").agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(row).alias("checksum"))


def _by_bundle(files: DataFrame) -> DataFrame:
    return (
        files.groupBy(F.regexp_extract("path", r"/bundle=([^/]+)/[^/]+$", 1).alias("bundle"))
        .agg(
            F.max("modificationTime").alias("mtime"),
            F.count(F.lit(1)).alias("n_files"),
            F.sum("length").alias("n_bytes"),
        )
        .where(F.col("bundle") != "")
    )


def write_bundles(
    weights: DataFrame, root: str, *, metadata: DataFrame | None = None, force: bool = True
) -> None:
    """Save every bundle named in ``weights.bundle``, and the documents of ``metadata``, at once.

    ``metadata`` has columns ``bundle`` and ``json``, one row per bundle. A bundle that is
    there already is replaced; with ``force=False`` that is an error instead. Other bundles
    of the store are left alone. A bundle saved without a document keeps the one it had.
    If anything fails, the store stays as it was.
    """
    spark = weights.sparkSession
    if not force:
        stored = list_bundles(spark, root).select("bundle")
        clash = weights.select("bundle").join(stored, "bundle", "left_semi").limit(1).collect()
        if clash:
            raise FileExistsError(f"bundle {clash[0][0]!r} is already stored under {root}")
    columns = [F.col(f.name).cast(f.dataType) for f in WEIGHTS_SCHEMA]
    largest = weights.groupBy("bundle").count().agg(F.max("count")).collect()[0][0] or 0
    # As many files per bundle as the largest one needs, not one per task and bundle.
    piece = F.pmod(F.xxhash64("leaf", "chunk_id"), F.lit(largest // ROWS_PER_FILE + 1))
    spread = weights.select(*columns, _checked_name()).repartition("bundle", piece)
    version = uuid.uuid4().hex
    spread.write.partitionBy("bundle").parquet(f"{root}/weights/version={version}")
    rows = spark.createDataFrame([], _LOG) if not largest else _version_rows(spark, root, version)
    if metadata is not None:
        rows = rows.drop("json").join(metadata.select(_checked_name(), "json"), "bundle", "full_outer")
    else:
        rows = rows.withColumn("json", F.lit(None).cast("string"))
    _publish(rows, root)


def list_bundles(spark: SparkSession, root: str) -> DataFrame:
    """``bundle, mtime, n_files, n_bytes`` of every bundle that holds weights, from the manifest.

    The time is that of the newest file of the bundle's version.
    """
    held = manifest(spark, root).where(F.col("version").isNotNull())
    return held.select("bundle", "mtime", "n_files", "n_bytes")


def damaged_bundles(spark: SparkSession, root: str) -> DataFrame:
    """``bundle, n_rows, found_rows`` of bundles whose stored weights are not what was published."""
    told = manifest(spark, root).where(F.col("version").isNotNull()).select("bundle", "n_rows", "checksum")
    if not _path_exists(spark, f"{root}/weights"):
        return told.select("bundle", "n_rows", F.lit(0).cast("long").alias("found_rows"))
    found = _checksums(read_weights(spark, root)).withColumnsRenamed({"n_rows": "found_rows", "checksum": "found"})
    return (
        told.join(found, "bundle", "left")
        .where(~F.col("checksum").eqNullSafe(F.col("found")) | ~F.col("n_rows").eqNullSafe(F.col("found_rows")))
        .select("bundle", "n_rows", F.coalesce("found_rows", F.lit(0)).alias("found_rows"))
    )


def parse_metadata(json: Column) -> Column:
    """JSON text to the metadata struct; null when there is no usable metadata.

    Unusable are: no text, malformed JSON, anything but an object, and a
    missing or null epoch count. Other keys may be absent.
    """
    parsed = F.from_json(json, METADATA_SCHEMA)
    usable = F.trim(json).startswith("{") & parsed["cumulative_epochs_completed"].isNotNull()
    return F.when(usable, parsed)


def read_metadata(spark: SparkSession, root: str) -> DataFrame:
    """``bundle, metadata`` for every document of the store, unusable ones with null."""
    told = manifest(spark, root).where(F.col("json").isNotNull())
    return told.select("bundle", parse_metadata(F.col("json")).alias("metadata"))


def read_weights(spark: SparkSession, root: str) -> DataFrame:
    """The current weights of all bundles of the store."""
    stored = spark.read.schema(_STORED_WEIGHTS).parquet(f"{root}/weights")
    current = manifest(spark, root).where(F.col("version").isNotNull()).select("version", "bundle")
    return stored.join(current, ["version", "bundle"], "left_semi").select(*WEIGHTS_SCHEMA.fieldNames(), "bundle")


def load_weights(
    spark: SparkSession, root: str, bundle: str, *, expected: DataFrame | None = None
) -> DataFrame:
    """The weight table of one bundle.

    Three failures are told apart: no such bundle, a bundle without weights,
    and (with ``expected``) weights of another structure.
    """
    from braidwork.operators.weights import require_same_structure

    check_bundle_name(bundle)
    found = manifest(spark, root).where(F.col("bundle") == bundle).select("version").collect()
    if not found:
        raise FileNotFoundError(f"no bundle {bundle!r} under {root}")
    if found[0]["version"] is None:
        raise FileNotFoundError(f"bundle {bundle!r} under {root} has no weights")
    # One version holds the bundles of one save; the bundle's folder is all that is read.
    stored = spark.read.schema(T.StructType([*WEIGHTS_SCHEMA, _KEYS[1]])).parquet(f"{root}/weights/version={found[0]['version']}")
    weights = stored.where(F.col("bundle") == bundle).drop("bundle")
    if expected is not None:
        require_same_structure(expected, weights)
    return weights


def restore_status(catalog: DataFrame, metadata: DataFrame) -> DataFrame:
    """For every bundle: can a model be rebuilt from it, and if not, what is missing."""
    m = F.col("metadata")
    status = (
        F.when(m.isNull(), "no_metadata")
        .when(m["model_config"].isNull(), "no_model_config")
        .when(m["tokenizer_config"].isNull(), "no_tokenizer_config")
        .otherwise("ok")
    )
    return catalog.join(metadata, "bundle", "left").withColumn("status", status)


def restore_bundle(
    spark: SparkSession, root: str, bundle: str, *, expected: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Weights and one-row metadata of a bundle whose metadata is complete."""
    check_bundle_name(bundle)
    one = spark.createDataFrame([(bundle,)], "bundle string")
    found = read_metadata(spark, root).where(F.col("bundle") == bundle)
    checked = restore_status(one, found)
    status = checked.select("status").collect()[0][0]
    if status != "ok":
        raise ValueError(f"bundle {bundle!r} cannot be rebuilt: {status}")
    return load_weights(spark, root, bundle, expected=expected), checked
