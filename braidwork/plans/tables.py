"""How the given tables stand in for corpora, runs, bundles and weights."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidwork.configs import DEFAULT_DELIMITER, ModelConfig, TokenizerConfig
from braidwork.functions.tokens import byte_tokens, shift_left
from braidwork.operators.metrics import run_step_plan
from braidwork.operators.ordering import dense_index
from braidwork.operators.weights import chunk_leaves
from braidwork.operators.windows import byte_windows
from braidwork.plans.training_data import token_examples
from braidwork.session import spread
from braidwork.sources.blocks import normalize_blocks
from braidwork.sources.bundles import parse_metadata

DELIMITER = DEFAULT_DELIMITER
STEPS_PER_EPOCH = 25
LOG_EVERY = 4
WEIGHT_CHUNK = 16
BYTE_TOKENIZER = TokenizerConfig(name="byte")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text``, in enough partitions to tokenise with all cores."""
    return spread(load(spark, sf_dir, "documents").select("doc_id", "text"))


def csv(tokens: Column) -> Column:
    """Integer array as comma-joined text, so results compare across engines."""
    return F.array_join(tokens.cast("array<string>"), ",")


def token_rows(spark: SparkSession, sf_dir: str, maxlen: int) -> DataFrame:
    """``doc_id, x`` for every document."""
    return token_examples(
        documents(spark, sf_dir),
        id_col="doc_id",
        text_col="text",
        model=ModelConfig(maxlen=maxlen),
        tokenizer=BYTE_TOKENIZER,
    )


def whole_tokens(blocks: DataFrame, id_col: str) -> DataFrame:
    """``id, tokens``: all tokens of every cleaned text."""
    clean = normalize_blocks(blocks.select(id_col, "text"), "text", DELIMITER)
    return clean.select(id_col, byte_tokens(F.col("text"), DELIMITER).alias("tokens"))


def document_windows(spark: SparkSession, sf_dir: str, maxlen: int, *, targets: bool = False) -> DataFrame:
    """``doc_id, window, x`` (and ``y``): all tokens of every cleaned document, cut into windows."""
    clean = normalize_blocks(documents(spark, sf_dir), "text", DELIMITER)
    return byte_windows(clean, "text", DELIMITER, maxlen, targets=targets)


def scorer_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``x, y`` with all tokens of every document, the input of the next-token table."""
    rows = whole_tokens(documents(spark, sf_dir), "doc_id")
    return rows.select(F.col("tokens").alias("x"), shift_left(F.col("tokens")).alias("y"))


def _turn_key() -> Column:
    """``<conversation>/<turn>``: unique whatever the number of turns."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("conv_id", "turn")]
    return F.concat(parts[0], F.lit("/"), parts[1])


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``turn_id, text`` of every conversation turn."""
    return load(spark, sf_dir, "conversations").select(_turn_key().alias("turn_id"), "text")


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``prompt_id, tokens``: what users said, encoded without a delimiter at the end; may be empty."""
    said = load(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return said.select(
        _turn_key().alias("prompt_id"),
        byte_tokens(F.coalesce("text", F.lit("")), DELIMITER).alias("tokens"),
    )


def _leaves(spark: SparkSession, sf_dir: str, values: Column, chunk_size: int = WEIGHT_CHUNK) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    whole = vectors.select(
        F.format_string("leaf_%d", F.col("vec_id")).alias("leaf"),
        F.when(F.col("label") == 9, "other").otherwise("param").alias("kind"),
        F.array(F.size("embedding")).alias("shape"),
        "label",
        values.alias("values"),
    )
    return chunk_leaves(whole, chunk_size=chunk_size)


def weights_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One leaf per vector; the leaves of label 5 are all zero."""
    return _leaves(
        spark,
        sf_dir,
        F.transform(
            "embedding",
            lambda v: F.when(F.col("label") == 5, F.lit(0.0)).otherwise(v.cast("double")),
        ),
    )


def weights_after(spark: SparkSession, sf_dir: str, chunk_size: int = WEIGHT_CHUNK) -> DataFrame:
    """The same leaves scaled by a factor that depends on the label; label 0 is unchanged."""
    factor = F.lit(1.0) + F.col("label") * F.lit(0.01)
    return _leaves(spark, sf_dir, F.transform("embedding", lambda v: v.cast("double") * factor), chunk_size)


def weights_restructured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label 3 under another name, label 4 one value shorter."""
    after = weights_after(spark, sf_dir)
    label = F.col("label")
    last = F.col("chunk_id") == 3
    return after.withColumn(
        "leaf", F.when(label == 3, F.concat(F.lit("renamed_"), "leaf")).otherwise(F.col("leaf"))
    ).withColumn(
        "values",
        F.when((label == 4) & last, F.slice("values", 1, WEIGHT_CHUNK - 1)).otherwise(F.col("values")),
    )


def step_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as the training steps of a run, numbered in time order."""
    events = load(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "ts", "event_id", F.col("value").alias("loss")
    )
    numbered = dense_index(
        events, [F.col("ts"), F.col("event_id")], partition_by=["run_id"], out="s"
    )
    step = F.col("s") % STEPS_PER_EPOCH
    return numbered.select(
        "run_id",
        ((F.col("s") - step) / STEPS_PER_EPOCH + 1).cast("int").alias("epoch"),
        step.cast("int").alias("step"),
        "loss",
    )


def runs_of_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(F.col("user_id").alias("run_id")).distinct()


def metric_run_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A four-epoch plan for every run of ``step_metrics``."""
    return run_step_plan(
        runs_of_steps(spark, sf_dir).select(
            "run_id",
            F.lit(STEPS_PER_EPOCH).alias("n_batches"),
            F.lit(4).alias("epochs"),
            F.lit(0.1).alias("warmup_rate"),
            F.lit(0.0).alias("lr_init_value"),
            (F.lit(0.001) * (F.col("run_id") % 7)).alias("lr_peak_value"),
            F.lit(0.00001).alias("lr_end_value"),
        )
    )


def run_phases(runs: DataFrame) -> DataFrame:
    """Four consecutive runs make one lineage."""
    phase = (F.col("run_id") % 4).cast("int")
    return runs.select(
        "run_id", ((F.col("run_id") - phase) / 4).cast("long").alias("lineage"), phase.alias("phase")
    )


def customer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One planned run per customer, some without batches, some all warm-up."""
    key = F.col("c_custkey")
    return load(spark, sf_dir, "customer").select(
        key.alias("run_id"),
        (key % 40).alias("n_batches"),
        (F.lit(1) + F.col("c_nationkey") % 5).cast("long").alias("epochs"),
        ((key % 11) / F.lit(10.0)).alias("warmup_rate"),
        F.lit(0.0).alias("lr_init_value"),
        (F.lit(0.001) * (key % 7)).alias("lr_peak_value"),
        F.lit(0.00001).alias("lr_end_value"),
    )


def order_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bundles: the customer is the model, the order date the file time."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("bundle"),
        F.col("o_custkey").alias("model"),
        F.col("o_orderdate").alias("mtime"),
        (F.lit(1) + F.col("o_orderkey") % 5).alias("epochs"),
    )


def order_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs that continue the customer's order before. The first order of every tenth
    customer names the last one (a cycle), that of every eleventh an unknown one; a third of
    the orders of others skip one, so that some runs are continued twice."""
    own = Window.partitionBy("model").orderBy("mtime", "bundle")
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before, earlier = F.lag("bundle").over(own), F.lag("bundle", 2).over(own)
    skipping = (F.col("bundle") % 3 == 0) & earlier.isNotNull()
    parent = (
        F.when(before.isNull() & (F.col("model") % 10 == 0), F.last("bundle").over(whole))
        .when(before.isNull() & (F.col("model") % 11 == 0), F.lit(-1))
        .otherwise(F.when(skipping, earlier).otherwise(before))
    )
    return order_catalog(spark, sf_dir).select(
        F.col("bundle").alias("run_id"), parent.cast("long").alias("resumed_from"), "epochs"
    )


def order_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sidecar text per bundle, complete or broken in one of six ways, and its parsed form."""
    kind = F.col("bundle") % 7
    epochs = F.when(kind == 6, F.lit("null")).otherwise(F.col("epochs").cast("string"))
    parts = [
        F.when(kind != 4, F.concat(F.lit('"cumulative_epochs_completed":'), epochs)),
        F.concat(F.lit('"final_loss":'), F.col("model").cast("string"), F.lit(".5")),
        F.when(kind != 1, F.lit('"model_config":{"maxlen":128,"embed_dim":192}')),
        F.when(kind != 2, F.lit('"tokenizer_config":{"delimiter":"<|endoftext|>","name":"byte"}')),
        F.concat(F.lit('"created_at":"'), F.substring(F.col("mtime").cast("string"), 1, 10), F.lit('"')),
    ]
    body = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    text = (
        F.when(kind == 3, F.substring(body, 1, 40))
        .when(kind == 5, F.concat(F.lit("["), body, F.lit("]")))
        .otherwise(body)
    )
    return order_catalog(spark, sf_dir).select("bundle", parse_metadata(text).alias("metadata"))


def config_values(config: object) -> dict[str, object]:
    return dataclasses.asdict(config)
