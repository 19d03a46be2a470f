"""Substring dedup by sliding spans of sentences.

A text is cut into sentences: after a word that ends in ASCII punctuation or in a full
stop, question or exclamation mark of other scripts or an ellipsis, and at line ends, so
that clauses and table cells count as well. Spans are runs of at least ``SENTENCES`` sentences with at
least ``WORDS`` words in all, hashed over their words: at every sentence the shortest that starts there and, with
``ends``, the shortest that ends there. Together they cover each sentence of any longer run: one too near the end of the run to start a
span inside it lies in the span that ends with the run.
Spans that occur more than once anywhere are joined globally; the occurrence with
the smallest (document, place) is the first, and sentences that any other
occurrence covers are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidwork.llm.batches import free_name, small_batches
from braidwork.llm.hashing import chunks, mix, sequence_hashes, text_bytes, word_hashes, word_limits
from braidwork.session import materialize

SENTENCES = 2
WORDS = 12
_STOP = np.zeros(256, bool)
_STOP[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
# UTF-8 of the marks that end a sentence outside ASCII, three bytes each.
_WIDE_STOPS = np.array([int.from_bytes(c.encode()) for c in "。！？…｡．"])


def sentence_starts(buf: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Indices of the words that begin a sentence; rows never share one."""
    if not len(start):
        return np.zeros(0, np.int64)
    stops = _STOP[buf[end - 1]]
    wide = np.flatnonzero((end - start >= 3) & (buf[end - 1] >= 0x80))
    tail = sum(buf[end[wide] - k].astype(np.int64) << 8 * (k - 1) for k in (1, 2, 3))
    stops[wide] = np.isin(tail, _WIDE_STOPS)
    lines = np.concatenate(([0], np.cumsum(buf == 0x0A)))
    broken = lines[start[1:]] > lines[end[:-1]]
    first = np.concatenate(([True], stops[:-1] | broken))
    rows = np.searchsorted(start, at[:-1])
    first[rows[rows < len(start)]] = True
    return np.flatnonzero(first)


def _cut(column: pa.Array) -> tuple[np.ndarray, ...]:
    buf, at = text_bytes(column)
    start, end = word_limits(buf, at)
    begins = sentence_starts(buf, at, start, end)
    # First word of each sentence and of none after the last; first sentence of each row.
    words = np.concatenate((begins, [len(start)]))
    rows = np.searchsorted(start[begins] if len(begins) else begins, at)
    return buf, at, start, end, words, rows


def _spans(column: pa.Array, sentences: int, words_wanted: int, ends: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each row hash, first sentence and number of sentences of all spans."""
    for lo, hi in chunks(column):
        buf, at, start, end, words, rows = _cut(column.slice(lo, hi - lo))
        hashes = mix(word_hashes(buf, start, end))
        i = np.arange(len(words) - 1)
        j = np.maximum(i + sentences, np.searchsorted(words, words[:-1] + words_wanted))
        ok = j <= np.repeat(rows[1:], np.diff(rows))
        # The shortest run that ends behind each sentence, where no shortest run from a start ends.
        back = np.minimum(i + 1 - sentences, np.searchsorted(words, words[1:] - words_wanted, "right") - 1)
        ended = np.zeros(len(words), bool)
        ended[j[ok]] = True
        more = ends & (back >= np.repeat(rows[:-1], np.diff(rows))) & ~ended[1:]
        first, last = np.concatenate((i[ok], back[more])), np.concatenate((j[ok], i[more] + 1))
        order = np.argsort(first, kind="stable")
        first, last = first[order], last[order]
        span = sequence_hashes(hashes, words[first], words[last])
        count = last - first
        place = np.searchsorted(first, rows)
        for r in range(hi - lo):
            a, b = place[r], place[r + 1]
            yield span[a:b], (first[a:b] - rows[r]), count[a:b]


def _span_table(docs: DataFrame, sentences: int, words: int, ends: bool) -> DataFrame:
    """``h, row, i, n`` of all spans of ``row, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0), np.int64)
            held, size = [], 0
            for r, (h, i, n) in enumerate(_spans(batch.column(1), sentences, words, ends)):
                if len(h):
                    held.append((h.view(np.int64), np.full(len(h), ids[r]), i.astype(np.int32), n.astype(np.int32)))
                    size += len(h)
                if held and (size > 50_000 or r == len(ids) - 1):
                    columns = [pa.array(np.concatenate(c)) for c in zip(*held)]
                    yield pa.RecordBatch.from_arrays(columns, ["h", "row", "i", "n"])
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], ["h", "row", "i", "n"])

    return small_batches(docs).mapInArrow(run, "h long, row long, i int, n int")


def _without(docs: DataFrame, text_col: str, spans_col: str) -> DataFrame:
    """Remove the sentences that ``spans_col`` (array of i, n; null: none) covers, and that column."""
    names = [c for c in docs.columns if c != spans_col]
    text_at, spans_at = docs.columns.index(text_col), docs.columns.index(spans_col)
    kept_at = [docs.columns.index(c) for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text_at)
            spans = batch.column(spans_at)
            texts, total, gone = [], [], []
            for lo, hi in chunks(column):
                buf, at, start, end, words, rows = _cut(column.slice(lo, hi - lo))
                raw = buf.tobytes()
                for r in range(hi - lo):
                    n = int(rows[r + 1] - rows[r])
                    total.append(n)
                    covers = spans[lo + r]
                    if not covers.is_valid:
                        texts.append(column[lo + r].as_py())
                        gone.append(0)
                        continue
                    mark = np.zeros(n + 1, np.int64)
                    i, m = (np.asarray(covers.values.field(k), np.int64) for k in range(2))
                    np.add.at(mark, i, 1)
                    np.add.at(mark, i + m, -1)
                    keep = np.cumsum(mark)[:n] == 0
                    # A sentence reaches to the start of the next one of its text.
                    begin = start[words[rows[r] : rows[r] + n]]
                    limit = np.concatenate((begin[1:], at[r + 1 : r + 2]))
                    edges = np.diff(np.concatenate(([0], keep.astype(np.int8), [0])))
                    runs = zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))
                    text = b"".join(raw[begin[a] : limit[b - 1]] for a, b in runs)
                    texts.append(text.decode().strip())
                    gone.append(int(n - keep.sum()))
            out = [batch.column(k) for k in kept_at]
            out[names.index(text_col)] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(total, pa.int64()), pa.array(gone, pa.int64())], [*names, "n_sentences", "n_removed"]
            )

    fields = [docs.schema[c] for c in names]
    more = [T.StructField(c, T.LongType()) for c in ("n_sentences", "n_removed")]
    return small_batches(docs).mapInArrow(run, T.StructType([*fields, *more]))


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sentences: int = SENTENCES, words: int = WORDS,
    ends: bool = False,
) -> DataFrame:
    """``docs`` without repeated spans in ``text_col``, with ``n_sentences`` and ``n_removed``.

    With ``ends`` all that any repeated run covers goes; without, the last sentences of a
    repeated region stay where no shortest run from a start stops exactly at its end.
    The first occurrence is the one with the smallest id (null first), then hash of
    row, then place; it stays, in a text that repeats itself as well. Rows with
    equal id and text are one document and stay or go together. Texts without a
    repeated span stay byte by byte; others lose the white space around what went.
    A text with fewer sentences or words than a span has none. Null stays null. An
    empty table gives no rows; other columns pass, ``n_sentences`` and ``n_removed``
    are replaced.
    """
    base = docs.drop("n_sentences", "n_removed")
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    texts = base.select(row.alias("row"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    spans = _span_table(texts, sentences, words, ends)
    # Equal rows give equal spans; a span that only they hold is not repeated.
    # Stored, so that both sides of the join are shuffled and a frequent span can be split.
    twice = materialize(
        spans.groupBy("h").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("h"), "twice"
    )
    repeated = materialize(spans.join(twice, "h").distinct(), "repeats")
    ids = base.select(row.alias("row"), F.col(id_col).alias("id")).distinct()
    placed = materialize(repeated.join(ids, "row"), "placed")
    first = materialize(placed.groupBy("h").agg(F.min(F.struct("id", "row", "i")).alias("first")), "first")
    later = placed.join(first, "h").where(
        (F.col("first.row") != F.col("row")) | (F.col("first.i") != F.col("i"))
    )
    at, spans_col = free_name(base, "_row"), free_name(base, "_spans")
    covered = later.groupBy(F.col("row").alias(at)).agg(F.collect_set(F.struct("i", "n")).alias(spans_col))
    marked = base.withColumn(at, row).join(covered, at, "left")
    return _without(marked.select(*base.columns, spans_col), text_col, spans_col)
