"""From text blocks to batched (input, target) token rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.configs import ModelConfig, TokenizerConfig, TrainingConfig
from braidwork.functions.tokens import byte_example, shift_left, truncate_pad
from braidwork.operators.batching import assign_batches
from braidwork.operators.ordering import dense_index, first_rows, visit_order
from braidwork.operators.tokenizers import tokenize
from braidwork.session import materialize
from braidwork.sources.blocks import BLOCK_ORDER, normalize_blocks, scan_first_blocks


def _fixed_length_tokens(
    clean: DataFrame, *, id_cols: list[str], text_col: str, model: ModelConfig, tokenizer: TokenizerConfig
) -> DataFrame:
    """Replace the text by ``x``. One narrow pass for the byte tokenizer, so the text itself
    is never shuffled."""
    if tokenizer.name == "byte":
        x = byte_example(F.col(text_col), tokenizer.delimiter, model.maxlen, tokenizer.pad_token_id)
        return clean.select(*id_cols, x.alias("x"))
    keyed = clean.select(F.struct(*id_cols).alias("_id"), text_col)
    tokens = tokenize(keyed, tokenizer, id_col="_id", text_col=text_col, limit=model.maxlen)
    x = truncate_pad(F.col("tokens"), model.maxlen, tokenizer.pad_token_id)
    return tokens.select("_id.*", x.alias("x"))


def token_examples(
    blocks: DataFrame, *, id_col: str, text_col: str, model: ModelConfig, tokenizer: TokenizerConfig
) -> DataFrame:
    """``id, x``: fixed-length token rows of cleaned blocks."""
    clean = normalize_blocks(blocks.select(id_col, text_col), text_col, tokenizer.delimiter)
    return _fixed_length_tokens(
        clean, id_cols=[id_col], text_col=text_col, model=model, tokenizer=tokenizer
    )


def batch_token_rows(rows: DataFrame, id_col: str, training: TrainingConfig) -> DataFrame:
    """``batch_id, slot, id, x, y`` from stored token rows.

    The one wide step moves each row once, to its key range; full batches only.
    """
    indexed = visit_order(rows, id_col, shuffle=training.shuffle, seed=training.seed, total="n_rows")
    batched = assign_batches(indexed, "visit_ix", "n_rows", training.batch_size)
    return batched.select("batch_id", "slot", id_col, "x", shift_left(F.col("x")).alias("y"))


def training_examples(
    blocks: DataFrame,
    *,
    id_col: str,
    text_col: str,
    model: ModelConfig,
    tokenizer: TokenizerConfig,
    training: TrainingConfig,
    max_blocks: int | None = None,
) -> DataFrame:
    """Tokenise, pad, order, batch, add targets, for blocks that are in a table.

    The token rows are stored once: they are far smaller than the text, and
    the index needs their count before it can number them.
    """
    chosen = blocks
    if max_blocks:
        clean = normalize_blocks(blocks.select(id_col, text_col), text_col, tokenizer.delimiter)
        chosen = first_rows(clean, [F.col(id_col)], max_blocks)
    rows = token_examples(chosen, id_col=id_col, text_col=text_col, model=model, tokenizer=tokenizer)
    return batch_token_rows(materialize(rows, "token-rows"), id_col, training)


def indexed_file_tokens(
    spark: SparkSession,
    path: str | list[str],
    *,
    model: ModelConfig,
    tokenizer: TokenizerConfig,
    max_blocks: int | None = None,
) -> DataFrame:
    """``block_ix, x`` for delimited text files, numbered in file order and stored.

    The number depends on the files only, not on how the scan was split, so a
    seeded visit order is the same on every cluster.
    """
    blocks = scan_first_blocks(spark, path, tokenizer.delimiter, max_blocks)
    rows = _fixed_length_tokens(
        blocks, id_cols=list(BLOCK_ORDER), text_col="text", model=model, tokenizer=tokenizer
    )
    stored = materialize(rows, "token-rows")
    indexed = dense_index(stored, [F.col(c) for c in BLOCK_ORDER], out="block_ix")
    return materialize(indexed.select("block_ix", "x"), "indexed-token-rows")


def training_examples_from_files(
    spark: SparkSession,
    path: str | list[str],
    *,
    model: ModelConfig,
    tokenizer: TokenizerConfig,
    training: TrainingConfig,
    max_blocks: int | None = None,
) -> DataFrame:
    """The same as ``training_examples``, starting from delimited text files."""
    rows = indexed_file_tokens(spark, path, model=model, tokenizer=tokenizer, max_blocks=max_blocks)
    return batch_token_rows(rows, "block_ix", training)


def require_batches(n_records: int, batch_size: int) -> int:
    """Batches per epoch of a run, refusing a data set that fills none."""
    if n_records == 0:
        raise ValueError("the data set is empty")
    n_batches = n_records // batch_size
    if n_batches == 0:
        raise ValueError(f"{n_records} records do not fill one batch of {batch_size}")
    return n_batches
