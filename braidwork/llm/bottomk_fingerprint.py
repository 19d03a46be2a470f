"""Document fingerprints: bottom-k sketches of shingle hashes.

The sketch of a text is the k smallest distinct hashes of its shingles. Sketches
of parts merge into the sketch of the whole; two sketches estimate resemblance
and containment, one the number of distinct shingles. Hashes have 48 bits and are
written as one base64 text, smallest first, so equal sets of shingles have equal
fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidwork.llm.batches import small_batches
from braidwork.llm.hashing import batch_shingles, batch_words, chunks, distinct, text_bytes
from braidwork.operators.ordering import range_bucket

K = 128
WIDTH = 5
_BITS = 48


def sketches(column: pa.Array, *, k: int = K, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sketch of each row; fewer words than ``width`` are shingles one by one."""
    for lo, hi in chunks(column):
        words, at = batch_words(*text_bytes(column.slice(lo, hi - lo)))
        for i, values in enumerate(batch_shingles(words, at, width)):
            n = at[i + 1] - at[i]
            values = words[at[i] : at[i + 1]] if n < width else values
            yield distinct(values >> np.uint64(64 - _BITS))[:k]


def write_sketch(sketch: np.ndarray) -> str:
    raw = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return base64.b64encode(raw.tobytes()).decode()


def read_sketch(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, _BITS // 8)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, 2:] = raw
    return full.reshape(-1).view(">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, *, k: int = K) -> np.ndarray:
    """The sketch of the union of two sets."""
    return distinct(np.concatenate((a, b)))[:k]


def resemblance(a: np.ndarray, b: np.ndarray, *, k: int = K) -> float:
    """Estimated Jaccard similarity; two empty sets are alike."""
    both = merge(a, b, k=k)
    if not len(both):
        return 1.0
    return float((np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)).sum() / len(both))


def distinct_shingles(a: np.ndarray, *, k: int = K) -> float:
    """Estimated number of distinct shingles; exact for fewer than k."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**_BITS / float(a[-1])


def containment(a: np.ndarray, b: np.ndarray, *, k: int = K) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 for an empty ``a``."""
    if not len(a):
        return 1.0
    similar = resemblance(a, b, k=k)
    common = similar / (1 + similar) * (distinct_shingles(a, k=k) + distinct_shingles(b, k=k))
    return min(1.0, common / distinct_shingles(a, k=k))


def with_next(docs: DataFrame, n_buckets: int) -> DataFrame:
    """``bucket, extra, doc_id, text`` in order within each bucket, one shuffle of the texts.

    Buckets are ranges of ``doc_id``. The first row of the following bucket (of the
    first one, after the last) is repeated behind each bucket, with ``extra`` set.
    """
    ranged = docs.withColumn("bucket", range_bucket(docs, [F.col("doc_id")], n_buckets=n_buckets))
    # At most n_buckets rows.
    firsts = ranged.groupBy("bucket").agg(F.min(F.struct("doc_id"))["doc_id"].alias("first")).orderBy("bucket").collect()
    spark = docs.sparkSession
    known = [(r[0], r[1], firsts[i - 1][0]) for i, r in enumerate(firsts)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    starts = spark.createDataFrame(known, f"bucket int, first {kind}, before int")
    copied = F.when(
        F.col("doc_id").eqNullSafe(F.col("first")), F.array(F.lit(False), F.lit(True))
    ).otherwise(F.array(F.lit(False)))
    rows = ranged.join(F.broadcast(starts), "bucket").withColumn("extra", F.explode(copied))
    rows = rows.select(
        F.when(F.col("extra"), F.col("before")).otherwise(F.col("bucket")).alias("bucket"), "extra", "doc_id", "text"
    )
    return rows.repartition("bucket").sortWithinPartitions("bucket", "extra", "doc_id", "text")


def fingerprint_edits(docs: DataFrame, *, k: int = K, width: int = WIDTH, n_buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text is the text with its last quarter (rounded down) replaced by
    as many code points from the start of the next document, or all it has; the
    next is by ascending ``doc_id`` (null first; equal ids by text), after the last
    the first. Null texts are empty; an empty text has an empty fingerprint, alike
    to other empty ones only. Equal rows are rows of their own. Extra columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    plain = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if n_buckets is None:
        n_buckets = min(32_768, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = with_next(plain, n_buckets)
    kind = docs.schema["doc_id"].dataType

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[str], list[str]]]:
        """Ids, flags and texts of consecutive rows, the last row of a batch led into the next."""
        held = None
        for batch in batches:
            bucket, extra, ids, texts = (batch.column(i).to_pylist() for i in range(4))
            if held is not None:
                bucket, extra, ids, texts = [held[0], *bucket], [held[1], *extra], [held[2], *ids], [held[3], *texts]
            if bucket:
                held = bucket[-1], extra[-1], ids[-1], texts[-1]
            yield extra, ids, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for extra, ids, texts in pairs(batches):
            lo = 0
            while lo < len(texts) - 1:
                hi, size = lo, 0
                while hi < len(texts) - 1 and size < 4 << 20:
                    size += len(texts[hi])
                    hi += 1
                part = [i for i in range(lo, hi) if not extra[i]]
                own = list(sketches(pa.array(texts[lo : hi + 1], pa.large_string()), k=k, width=width))
                quarter = [len(texts[i]) // 4 for i in part]
                edited = [texts[i][: len(texts[i]) - q] + texts[i + 1][:q] for i, q in zip(part, quarter)]
                other = list(sketches(pa.array(edited, pa.large_string()), k=k, width=width))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[i] for i in part], pa_kind),
                        pa.array([len(texts[i]) for i in part], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                        pa.array([write_sketch(own[i - lo]) for i in part], pa.string()),
                        pa.array([write_sketch(s) for s in other], pa.string()),
                        pa.array([resemblance(own[i - lo], s, k=k) for i, s in zip(part, other)], pa.float64()),
                        pa.array([resemblance(own[i - lo], own[i - lo + 1], k=k) for i in part], pa.float64()),
                        pa.array([distinct_shingles(own[i - lo], k=k) for i in part], pa.float64()),
                    ],
                    names,
                )
                lo = hi

    from pyspark.sql.pandas.types import to_arrow_type

    pa_kind = to_arrow_type(kind)
    names = [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        "near_edited", "near_next", "distinct_shingles",
    ]
    schema = (
        f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double, distinct_shingles double"
    )
    return small_batches(ordered).mapInArrow(run, schema)
