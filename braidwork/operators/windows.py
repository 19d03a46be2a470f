"""Whole texts as fixed windows of byte tokens, by array arithmetic on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidwork.functions.lists import flat_lists, text_tokens, window_values
from braidwork.functions.tokens import BYTE_DELIMITER_ID

# Texts of about so many bytes are cut into windows at a time.
SLICE_BYTES = 1 << 20


def byte_windows(
    blocks: DataFrame, text_col: str, delimiter: str, maxlen: int, *, pad_id: int = 0, targets: bool = False
) -> DataFrame:
    """The other columns of ``blocks`` with ``window, x`` (and ``y``): all byte tokens of every text.

    The same windows as ``token_windows`` of ``byte_tokens``: consecutive inputs of ``maxlen`` ids
    and, with ``targets``, their next-token targets, the last ones filled up with ``pad_id``. A null
    or empty text has none. Texts go to the worker as they are and come back as integers.
    """
    base = blocks.withColumn(text_col, F.col(text_col).cast("binary"))
    at, names = base.columns.index(text_col), [c for c in base.columns if c != text_col]
    lists = ["x", "y"] if targets else ["x"]
    marker, mark, slice_bytes = delimiter.encode(), BYTE_DELIMITER_ID, SLICE_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, start, tokens in text_tokens(batch.column(at), marker, mark, slice_bytes):
                counts, values = window_values(start, tokens, maxlen, pad_id, targets)
                rows = pa.array(np.repeat(np.arange(lo, hi), counts))
                first = np.repeat(np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
                window = pa.array((np.arange(len(rows)) - first).astype(np.int32))
                ends = pa.array(np.arange(0, (len(rows) + 1) * maxlen, maxlen, dtype=np.int32))
                cut = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in values]
                kept = [batch.column(batch.schema.names.index(c)).take(rows) for c in names]
                yield pa.RecordBatch.from_arrays([*kept, window, *cut], [*names, "window", *lists])

    ints = T.ArrayType(T.IntegerType())
    fields = [*[base.schema[c] for c in names], T.StructField("window", T.IntegerType())]
    return base.mapInArrow(run, T.StructType([*fields, *[T.StructField(c, ints) for c in lists]]))


def causal_sums(rows: DataFrame, tokens_col: str, out: str = "visible_sum") -> DataFrame:
    """``rows`` with ``out``: per position the sum over the tokens it may see, its own included."""
    names, at = rows.columns, rows.columns.index(tokens_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, flat = flat_lists(batch.column(at))
            sums = np.concatenate(([0], np.cumsum(flat.to_numpy(zero_copy_only=False), dtype=np.int64)))
            own = sums[1:] - np.repeat(sums[start[:-1]], np.diff(start))
            lists = pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(own))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*names, out])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out, T.ArrayType(T.LongType()))]))
