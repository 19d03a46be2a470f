"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words and the first four, five and six bytes of longer
words, hashed into a space of ``SPACE`` buckets; each bucket counts once. Buckets that
tell the labels apart (chi-squared over the training sample, counted by Spark, against
fixed limits) take part, however many they are. The machine adds to the linear weights a factor vector per term, so that a pair of
terms, an insult and the mention of a group, can weigh more than the two alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidwork.functions.lists import flat_lists, kept_values
from braidwork.llm.batches import small_batches
from braidwork.llm.hashing import chunks, distinct, mix, text_bytes, word_hashes, word_limits
from braidwork.session import materialize

# Bounds of the fit: labelled rows, buckets of the hash space.
SAMPLE_ROWS = 10_000
SPACE_BITS = 18
SPACE = 1 << SPACE_BITS
# The same at every size: labelled rows that hold a bucket, and its chi-squared.
LEAST_ROWS = 3
LEAST_CHI = 20.0
PREFIXES = (4, 5, 6)
FACTORS = 8
# Bytes of text whose words a worker holds at once; their arrays take some 30 times as much.
TEXT_BYTES = 256 << 10
_BREAK = np.ones(256, bool)
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def row_terms(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct buckets of the terms of each row."""
    for lo, hi in chunks(column, TEXT_BYTES):
        buf, at = text_bytes(column.slice(lo, hi - lo))
        start, end = word_limits(buf, at, _BREAK)
        terms, rows = [word_hashes(buf, start, end)], [np.searchsorted(at, start, "right") - 1]
        for n in PREFIXES:
            long = end - start > n
            prefix = word_hashes(buf, start[long], start[long] + n)
            terms.append(mix(prefix ^ np.uint64(n)))
            rows.append(rows[0][long])
        term, row = np.concatenate(terms) >> np.uint64(64 - SPACE_BITS), np.concatenate(rows)
        order = np.argsort(row, kind="stable")
        term, limits = term[order].astype(np.int64), np.searchsorted(row[order], np.arange(hi - lo + 1))
        for a, b in zip(limits[:-1], limits[1:]):
            yield distinct(term[a:b])


@dataclass
class Machine:
    """A fitted machine: bias, and per bucket that takes part (ascending) its weight and factors."""

    terms: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def places(self) -> np.ndarray:
        """For every bucket of the space its index among ``terms``, or -1."""
        out = np.full(SPACE, -1, np.int32)
        out[self.terms] = np.arange(len(self.terms))
        return out

    def score(self, found: np.ndarray) -> float:
        factors = self.factor[found]
        pairs = 0.5 * float((factors.sum(0) ** 2 - (factors**2).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weight[found].sum() + pairs, -40, 40))))


def fit_machine(
    terms: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, *,
    factors: int = FACTORS, steps: int = 500, rate: float = 0.05, decay: float = 1e-5, seed: int = 7,
) -> Machine:
    """Full-batch Adam on the logistic loss, over the non-zero entries only. One class only, or no
    rows: the smoothed share of label 1."""
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    rng = np.random.default_rng(seed)
    values = [
        np.array(np.log(share / (1 - share))),
        np.zeros(len(terms)),
        rng.normal(0, 0.05, (len(terms), factors)),
    ]
    if len(set(labels.tolist())) < 2 or not len(terms):
        return Machine(terms, float(values[0]), values[1], 0 * values[2])
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    term = np.concatenate(rows).astype(np.int64)
    by_row = lambda x: np.bincount(row, x, len(rows))
    by_term = lambda x: np.bincount(term, x, len(terms))
    first, second = [0 * v for v in values], [0 * v for v in values]
    for step in range(1, steps + 1):
        bias, weight, factor = values
        sums = np.stack([by_row(factor[term, f]) for f in range(factors)], 1)
        pairs = 0.5 * ((sums**2).sum(1) - by_row((factor**2).sum(1)[term]))
        z = np.clip(bias + by_row(weight[term]) + pairs, -40, 40)
        error = (1 / (1 + np.exp(-z)) - labels) / len(labels)
        back = by_term(error[row])
        pushed = error[:, None] * sums
        slope = np.stack([by_term(pushed[row, f]) for f in range(factors)], 1) - factor * back[:, None]
        gradients = [np.array(error.sum()), back + decay * weight, slope + decay * factor]
        for k, g in enumerate(gradients):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g**2
            fast = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            values[k] = values[k] - rate * fast
    return Machine(terms, float(values[0]), values[1], values[2])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id is one of them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


def kept_terms(sample: DataFrame, kept: np.ndarray) -> DataFrame:
    """``doc_id, toxic, terms`` with the kept buckets only, looked up inside the row: no row per
    term is made, shuffled or joined."""
    shared = sample.sparkSession.sparkContext.broadcast(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        takes_part = np.zeros(SPACE, bool)
        takes_part[shared.value] = True
        for batch in batches:
            starts, values = flat_lists(batch.column(2))
            starts, values = kept_values(starts, values, takes_part[values.to_numpy(zero_copy_only=False)])
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["doc_id", "toxic", "terms"])

    rows = sample.select("doc_id", "toxic", "terms")
    return small_batches(rows).mapInArrow(run, rows.schema)


def train(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on at most ``sample_rows`` labelled rows, those with the smallest hash of their id.

    Rows with a null label, without a document or held out are not used; of several
    documents of one id the text with the smallest hash is. What is counted, kept and
    fitted depends on these rows alone, by limits that are the same at every size.
    """
    usable = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample_rows)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
    # One row per label row, so that an id that is repeated very often cannot swamp the fit.
    one = met.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    rows = one.select("doc_id", "toxic", "t.text")

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(row_terms(batch.column(2)))
            at = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            values = np.concatenate([*found, np.zeros(0, np.int64)])
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["doc_id", "toxic", "terms"])

    schema = T.StructType([*rows.schema.fields[:2], T.StructField("terms", T.ArrayType(T.LongType()))])
    sample = materialize(small_batches(rows).mapInArrow(terms_of, schema), "terms")
    n, n1 = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).collect()[0]
    counts = (
        sample.select("toxic", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("toxic").alias("hits"))
        .where(F.col("df") >= LEAST_ROWS)
    )
    expected = F.col("df") * F.lit(n1 / max(n, 1))
    chi = (F.col("hits") - expected) ** 2 / (expected + F.lit(1e-9)) / (F.lit(1.0) - F.col("df") / (n + 1))
    # At most SPACE numbers, and lists of them for at most sample_rows rows.
    best = materialize(counts.where(chi >= LEAST_CHI).select("term"), "kept")
    kept = np.sort(np.array([r[0] for r in best.collect()], np.int64))
    small = kept_terms(sample, kept)
    got = small.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").collect()
    places = [np.searchsorted(kept, np.array(r[2], np.int64)) for r in got]
    return fit_machine(kept, places, np.array([r[1] for r in got], np.float64))


def score_toxicity(docs: DataFrame, machine: Machine, *, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Only the text is read; null and empty texts get the score of a text without
    kept terms. Every row is scored on its own, repeated rows alike; columns
    named ``score`` or ``predicted`` are replaced, all others pass.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(machine).values()))
    base = docs.drop("score", "predicted")
    names, at = base.columns, base.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Machine(*shared.value)
        places = model.places()
        for batch in batches:
            scores = []
            for found in row_terms(batch.column(at)):
                own = places[found]
                scores.append(model.score(own[own >= 0]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*names, "score"])

    scored = small_batches(base).mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
