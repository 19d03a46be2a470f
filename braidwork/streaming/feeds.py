"""Delimited files as they arrive: the batch expressions behind a streaming reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.configs import ModelConfig, TokenizerConfig
from braidwork.functions.text import clean_decode, is_not_blank, terminate_block
from braidwork.functions.tokens import byte_example, shift_left
from braidwork.sources.blocks import check_delimiter


def follow_blocks(spark: SparkSession, folder: str, delimiter: str) -> DataFrame:
    """Blocks of every file that lands in ``folder``: ``file_path, text``. Stateless."""
    check_delimiter(delimiter)
    raw = spark.readStream.option("lineSep", delimiter).text(folder)
    return raw.where(is_not_blank(F.make_valid_utf8("value"))).select(
        F.col("_metadata.file_path").alias("file_path"),
        terminate_block(clean_decode(F.col("value")), delimiter).alias("text"),
    )


def follow_examples(
    blocks: DataFrame, *, model: ModelConfig, tokenizer: TokenizerConfig
) -> DataFrame:
    """Fixed-length (input, target) rows of a block stream; byte tokenizer only, because a
    word vocabulary needs the whole corpus."""
    if tokenizer.name != "byte":
        raise ValueError("a stream can be tokenised with the byte tokenizer only")
    x = byte_example(F.col("text"), tokenizer.delimiter, model.maxlen, tokenizer.pad_token_id)
    return blocks.withColumn("x", x).withColumn("y", shift_left(F.col("x"))).drop("text")
