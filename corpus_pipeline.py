"""From raw documents to token ids: five stages, each a DataFrame in and a DataFrame out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.llm.bpe_automaton import bpe_round_trip, default_path
from braidwork.llm.curriculum_mix import mix_plan, training_order
from braidwork.llm.ngram_jaccard import jaccard_components, one_per_component
from braidwork.llm.secret_forest import redact, scan_secrets
from braidwork.llm.toxicity_fm import score_toxicity, train
from braidwork.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the machine, fitted on the labelled ones, predicts toxic."""
    machine = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, machine).where("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return one_per_component(docs, jaccard_components(docs)).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets that the forest keeps masked in their texts."""
    clean = redact(docs, scan_secrets(docs))
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", length).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once per pass that takes words from them."""
    return training_order(docs, mix_plan(docs, by_row=True)).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text back."""
    coded = bpe_round_trip(docs, default_path(spark))
    return coded.select(
        "doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

# The fitted models, components and encodings are not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
