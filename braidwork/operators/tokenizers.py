"""Tokenise jobs, chosen by name, and the word vocabulary."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidwork.configs import TOKENIZER_NAMES, TokenizerConfig, add_tokenizer_name
from braidwork.functions.lists import flat_lists, kept_values
from braidwork.functions.tokens import BYTE_DELIMITER_ID, BYTE_VOCAB_SIZE, byte_detokenize, byte_tokens
from braidwork.operators.joins import fits_broadcast
from braidwork.operators.ordering import dense_index
from braidwork.session import materialize

UNKNOWN_ID = 0
FIRST_WORD_ID = 1
_ID_MASK = (1 << 32) - 1
_GAPS = "[ \t\n\r\f\x0b]+"
# Rows of about so many characters share a dictionary; a word counts as so many of them.
CHARS_PER_RUN = 24_000_000
CHARS_PER_WORD = 7


def words(text: Column, delimiter: str) -> Column:
    """Text as an array of words; the delimiter is a word of its own wherever it occurs."""
    if any(c.isspace() for c in delimiter):
        raise ValueError("word tokenising needs a delimiter without white space")
    spaced = F.replace(text, F.lit(delimiter), F.lit(f" {delimiter} "))
    return F.array_remove(F.split(spaced, _GAPS), "")


def build_vocab(blocks: DataFrame, text_col: str, delimiter: str) -> DataFrame:
    """``token_id, token, n`` by falling frequency, then token; id 0 stays free for padding
    and unknown words.

    Counts are combined map-side, so frequent words cost no more to shuffle
    than rare ones; the id is a distributed dense index, not a global sort.
    """
    counts = (
        blocks.select(F.explode(words(F.col(text_col), delimiter)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = dense_index(
        materialize(counts, "word-counts"), [-F.col("n"), F.col("token")], out="token_id"
    )
    return ranked.select((F.col("token_id") + FIRST_WORD_ID).cast("int").alias("token_id"), "token", "n")


def tokenize_words(
    blocks: DataFrame,
    vocab: DataFrame,
    *,
    id_col: str,
    text_col: str,
    delimiter: str,
    broadcast: bool,
    limit: int | None = None,
) -> DataFrame:
    """``id, tokens`` with the ids of a vocabulary table; words outside it become 0.

    ``limit`` is for callers that keep only the first words of a text anyway.

    ``broadcast`` says that the vocabulary was measured to fit on every executor;
    otherwise runs of rows get a dictionary of their own words (``_by_dictionary``).
    """
    # The outer form keeps blocks without any word, with an empty sequence.
    pieces = words(F.col(text_col), delimiter)
    pieces = pieces if limit is None else F.slice(pieces, 1, limit)
    known = vocab.select("token", "token_id")
    if not broadcast:
        spaced, gaps = (delimiter, f" {delimiter} "), _GAPS

        def coded(texts: pa.Array, dictionary: pa.Table) -> pa.Array:
            lists = pc.split_pattern_regex(pc.replace_substring(pc.fill_null(texts, ""), *spaced), gaps)
            starts, flat = flat_lists(lists)
            starts, flat = kept_values(starts, flat, pc.not_equal(flat, "").to_numpy(zero_copy_only=False))
            if limit is not None:
                place = np.arange(len(flat)) - np.repeat(starts[:-1], np.diff(starts))
                starts, flat = kept_values(starts, flat, place < limit)
            at = pc.index_in(flat, value_set=dictionary.column("token").combine_chunks())
            ids = pc.fill_null(dictionary.column("token_id").combine_chunks().take(at), UNKNOWN_ID)
            return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), ids.cast(pa.int32()))

        return _by_dictionary(blocks.select(id_col, text_col), text_col, F.length(text_col), pieces, known, coded, "tokens array<int>")
    placed = blocks.select(id_col, F.posexplode_outer(pieces).alias("pos", "token"))
    named = placed.join(F.broadcast(known), "token", "left")
    # Position and id packed into one long: cheaper to collect and sort than a struct.
    token_id = F.coalesce("token_id", F.lit(UNKNOWN_ID))
    packed = F.shiftleft(F.col("pos").cast("long"), 32) + token_id
    ordered = F.sort_array(F.collect_list(packed))
    ids = F.transform(ordered, lambda p: p.bitwiseAND(F.lit(_ID_MASK)).cast("int"))
    return named.groupBy(id_col).agg(ids.alias("tokens"))


def detokenize_words(
    sequences: DataFrame,
    vocab: DataFrame,
    *,
    id_col: str,
    broadcast: bool,
) -> DataFrame:
    """``id, text``: words joined by single spaces, ids outside the vocabulary left out."""
    known = vocab.select("token_id", "token")
    if not broadcast:

        def named(sequences: pa.Array, dictionary: pa.Table) -> pa.Array:
            starts, flat = flat_lists(sequences)
            at = pc.index_in(flat, value_set=dictionary.column("token_id").combine_chunks().cast(flat.type))
            texts = dictionary.column("token").combine_chunks().take(at)
            starts, texts = kept_values(starts, texts, texts.is_valid().to_numpy(zero_copy_only=False))
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), texts), " ")

        size = F.greatest(F.size("tokens"), F.lit(0)) * CHARS_PER_WORD
        return _by_dictionary(sequences.select(id_col, "tokens"), "tokens", size, F.col("tokens"), known, named, "text string")
    placed = sequences.select(id_col, F.posexplode_outer("tokens").alias("pos", "token_id"))
    found = placed.join(F.broadcast(known), "token_id", "left")
    ordered = F.sort_array(F.collect_list(F.when(F.col("token").isNotNull(), F.struct("pos", "token"))))
    joined = F.array_join(F.transform(ordered, lambda p: p["token"]), " ")
    return found.groupBy(id_col).agg(joined.alias("text"))


def _by_dictionary(
    rows: DataFrame,
    value: str,
    chars: Column,
    pieces: Column,
    vocab: DataFrame,
    convert: Callable[[pa.Array, pa.Table], pa.Array],
    out: str,
) -> DataFrame:
    """``id, out`` for ``id, value``: only the distinct pieces of a run of rows meet the vocabulary.

    Rows are stored with their place, and runs of neighbours of about ``CHARS_PER_RUN``
    characters (``chars`` measures a row) share a dictionary: their distinct pieces, counted
    out where they were stored, joined to the vocabulary (key column first). Rows and
    dictionary of a run then meet in one task, where ``convert`` looks every piece up. What
    is shuffled is the rows once and the distinct pieces of a run, not every occurrence.
    """
    id_col, key = rows.columns[0], vocab.columns[0]
    stored = materialize(rows.select(F.monotonically_increasing_id().alias("_row"), id_col, value), "runs")
    n_rows, n_chars = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum(chars), F.lit(0))).first()
    # A power of two, so that a run never spans two partitions of the numbering.
    bits = min(20, max(0, (CHARS_PER_RUN * n_rows // max(n_chars, 1)).bit_length() - 1))
    run = F.shiftright("_row", bits).alias("_run")
    own = stored.select(run, F.explode(pieces).alias(key)).distinct()
    dictionary = own.join(vocab.hint("merge"), key)
    made, kind = out.split()
    schema = T.StructType([rows.schema[id_col], *T.StructType.fromDDL(f"{made} {kind}")])
    kind_arrow = pa.string() if kind == "string" else pa.list_(pa.int32())

    def look_up(texts: pa.Table, dictionary: pa.Table) -> pa.Table:
        # One Arrow batch at a time, so that the pieces of a whole run are never held at once.
        found = [convert(part, dictionary) for part in texts.column(value).chunks]
        return pa.table([texts.column(id_col), pa.chunked_array(found, kind_arrow)], [id_col, made])

    return stored.select(run, id_col, value).groupBy("_run").cogroup(dictionary.groupBy("_run")).applyInArrow(look_up, schema)


@dataclass(frozen=True)
class Tokenizer:
    """What a package supplies for a tokenizer of its own.

    ``encode(blocks, id_col, text_col)`` gives ``id, tokens`` (array of int), ``decode(sequences, id_col)``
    gives ``id, text``, one row per input row.
    """

    encode: Callable[[DataFrame, str, str], DataFrame]
    decode: Callable[[DataFrame, str], DataFrame]
    vocab_size: int
    end_token_id: int


_registered: dict[str, Tokenizer] = {}


def register_tokenizer(name: str, tokenizer: Tokenizer) -> None:
    """Make ``TokenizerConfig(name=name)`` valid everywhere; names of the library cannot be taken."""
    if name in TOKENIZER_NAMES:
        raise ValueError(f"{name} is a tokenizer of the library")
    add_tokenizer_name(name)
    _registered[name] = tokenizer


def tokenize(
    blocks: DataFrame,
    config: TokenizerConfig,
    *,
    id_col: str,
    text_col: str,
    vocab: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """``id, tokens`` with the tokenizer that the configuration names; ``limit`` cuts word sequences."""
    text = F.col(text_col)
    if config.name == "byte":
        return blocks.select(id_col, byte_tokens(text, config.delimiter).alias("tokens"))
    if config.name == "word":
        if vocab is None:
            vocab = build_vocab(blocks, text_col, config.delimiter)
        vocab = materialize(vocab, "vocab")
        return tokenize_words(
            blocks,
            vocab,
            id_col=id_col,
            text_col=text_col,
            delimiter=config.delimiter,
            broadcast=fits_broadcast(vocab),
            limit=limit,
        )
    if config.name in _registered:
        return _registered[config.name].encode(blocks, id_col, text_col).select(id_col, "tokens")
    raise ValueError(f"unknown tokenizer {config.name}")


def detokenize(
    sequences: DataFrame, config: TokenizerConfig, *, id_col: str, vocab: DataFrame | None = None
) -> DataFrame:
    """``id, text`` of ``id, tokens`` with the tokenizer that the configuration names."""
    if config.name == "byte":
        return sequences.select(id_col, byte_detokenize(F.col("tokens"), config.delimiter).alias("text"))
    if config.name == "word":
        if vocab is None:
            raise ValueError("the word tokenizer needs its vocabulary table")
        return detokenize_words(sequences, vocab, id_col=id_col, broadcast=fits_broadcast(vocab))
    if config.name in _registered:
        return _registered[config.name].decode(sequences, id_col).select(id_col, "text")
    raise ValueError(f"unknown tokenizer {config.name}")


def vocab_size(config: TokenizerConfig, vocab: DataFrame | None = None) -> int:
    """Number of ids the encoding can produce, whatever the corpus uses of it."""
    if config.name == "byte":
        return BYTE_VOCAB_SIZE
    if config.name == "word":
        if vocab is None:
            raise ValueError("the word tokenizer needs its vocabulary table")
        return vocab.count() + FIRST_WORD_ID
    if config.name in _registered:
        return _registered[config.name].vocab_size
    raise ValueError(f"unknown tokenizer {config.name}")


def end_token_id(config: TokenizerConfig, vocab: DataFrame | None = None) -> int:
    """The id that stands for the delimiter."""
    if config.name == "byte":
        return BYTE_DELIMITER_ID
    if config.name == "word":
        if vocab is None:
            raise ValueError("the word tokenizer needs its vocabulary table")
        found = vocab.where(F.col("token") == config.delimiter).select("token_id").collect()
        return found[0][0] if found else UNKNOWN_ID
    if config.name in _registered:
        return _registered[config.name].end_token_id
    raise ValueError(f"unknown tokenizer {config.name}")
