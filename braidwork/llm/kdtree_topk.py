"""Exact top-k search by inner product with one KD-tree per shard.

A shard is a run of rows of one input partition. Its tree splits at the median of
the widest dimension and keeps tight bounding boxes. The score of a query with any
point of a box is at most the sum over dimensions of the larger product with the
two limits; best-first traversal opens boxes by that bound and stops below the
k-th best score. Every block of queries first meets one shard; the k-th scores it
finds there are carried to all other shards, which return only what may still count.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from braidwork.llm.batches import small_batches
from braidwork.session import materialize

SHARD_ROWS = 8_192
BLOCK_QUERIES = 1_024
LEAF_ROWS = 256
_HIT_FIELDS = ("query_key", "query_id", "vec_id", "score")
_HITS = "array<struct<" + ",".join(f"{c}:bigint" for c in _HIT_FIELDS) + ">>"


def pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data), allow_pickle=False) as found:
        return {k: found[k] for k in found.files}


def build_tree(
    ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS, keys: np.ndarray | None = None
) -> dict[str, np.ndarray]:
    """Nodes as arrays: row range, children (-1: leaf) and tight box. ``keys`` tell rows apart, else ids do."""
    order, nodes, todo = np.arange(len(ids)), [], [(0, len(ids), -1, 0)]
    while todo:
        lo, hi, parent, side = todo.pop()
        own = points[order[lo:hi]]
        low, high = own.min(0), own.max(0)
        nodes.append([lo, hi, -1, -1, low, high])
        if parent >= 0:
            nodes[parent][2 + side] = len(nodes) - 1
        spread = high - low
        if hi - lo > leaf_rows and len(spread) and spread.max() > 0:
            widest, mid = int(spread.argmax()), (hi - lo) // 2
            part = np.argpartition(own[:, widest], mid)
            order[lo:hi] = order[lo:hi][part]
            me = len(nodes) - 1
            todo += [(lo, lo + mid, me, 0), (lo + mid, hi, me, 1)]
    return {
        "ids": ids[order],
        "keys": (ids if keys is None else keys)[order],
        "points": points[order],
        "rows": np.array([n[:4] for n in nodes], np.int64),
        "low": np.array([n[4] for n in nodes]),
        "high": np.array([n[5] for n in nodes]),
    }


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of whole-numbered doubles; beyond 2**53 with Python's integers."""
    n = min(a.shape[-1], b.shape[-1])
    a, b = a[..., :n], b[..., :n]
    if a.size and b.size and n * float(np.abs(a).max()) * float(np.abs(b).max()) >= 2**53:
        whole = np.frompyfunc(int, 1, 1)
        return whole(a) @ whole(b).T
    return (a @ b.T).astype(np.int64)


def search(tree: dict[str, np.ndarray], block: dict[str, np.ndarray], k: int) -> list[list[tuple[int, int]]]:
    """For each query its best ``(score, -vec_id)`` of the shard, best first; below ``floor`` left out."""
    queries, n = block["points"], min(block["points"].shape[1], tree["points"].shape[1])
    up, down = np.maximum(queries[:, :n], 0), np.minimum(queries[:, :n], 0)
    bounds = products(up, tree["high"][:, :n]) + products(down, tree["low"][:, :n])
    rows, out = tree["rows"].tolist(), []
    for i, own in enumerate(block.get("keys", block["ids"]).tolist()):
        least, best = block["floor"][i], []
        bound = bounds[i].tolist()
        queue = [(-bound[0], 0)]
        while queue:
            top, node = heapq.heappop(queue)
            if -top < least or (len(best) == k and -top < best[0][0]):
                break
            lo, hi, left, right = rows[node]
            if left >= 0:
                heapq.heappush(queue, (-bound[left], left))
                heapq.heappush(queue, (-bound[right], right))
                continue
            scores = products(tree["points"][lo:hi], queries[i : i + 1])[:, 0]
            ids, keys = tree["ids"][lo:hi], tree["keys"][lo:hi]
            floor = max(least, best[0][0]) if len(best) == k else least
            for j in np.flatnonzero((scores >= floor) & (keys != own)).tolist():
                item = (int(scores[j]), -int(ids[j]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        out.append(sorted(best, reverse=True))
    return out


def _matrix(lists: pa.Array) -> np.ndarray:
    """Scaled vectors as whole-numbered doubles; shorter ones are filled with zeros."""
    at = np.asarray(lists.offsets)
    values = np.floor(256.0 * np.asarray(lists.values, np.float64))
    sizes = np.diff(at)
    width = int(sizes.max(initial=0))
    out = np.zeros((len(lists), width))
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(at[0], at[-1]) - np.repeat(at[:-1], sizes)] = values[at[0] : at[-1]]
    return out


def _chunked(rows: DataFrame, most: int, tree: bool) -> DataFrame:
    """``key, body``: runs of at most ``most`` rows of a partition as trees or query blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count, number = 0, TaskContext.get().partitionId() << 32

        def body() -> pa.RecordBatch:
            width = max(p.shape[1] for _, p, _ in held)
            ids, keys = (np.concatenate([h[k] for h in held]) for k in (0, 2))
            points = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for _, p, _ in held])
            if tree:
                data = pack(**build_tree(ids, points, keys=keys))
            else:
                floor = np.full(len(ids), -(1 << 63), np.int64)
                data = pack(ids=ids, keys=keys, points=points, floor=floor)
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([data], pa.binary())], ["key", "body"])

        for batch in batches:
            at = 0
            while at < len(batch):
                piece = batch.slice(at, most - count)
                ids, keys = (np.asarray(piece.column(k), np.int64) for k in (0, 2))
                held.append((ids, _matrix(piece.column(1)), keys))
                count, at = count + len(piece), at + len(piece)
                if count == most:
                    yield body()
                    held, count, number = [], 0, number + 1
        if held:
            yield body()

    return small_batches(rows).mapInArrow(run, "key long, body binary")


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """``block, body, hits``: the blocks with the floors found, and what each found in its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                block = unpack(batch.column(1)[i].as_py())
                found = search(unpack(batch.column(2)[i].as_py()), block, k)
                full = np.array([x[k - 1][0] if len(x) == k else -(1 << 63) for x in found], np.int64)
                block["floor"] = np.maximum(block["floor"], full)
                hits = [
                    {"query_key": key, "query_id": q, "vec_id": -other, "score": score}
                    for key, q, best in zip(block["keys"].tolist(), block["ids"].tolist(), found)
                    for score, other in best
                ]
                kind = pa.list_(pa.struct([(c, pa.int64()) for c in _HIT_FIELDS]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([pack(**block)], pa.binary()), pa.array([hits], kind)],
                    ["block", "body", "hits"],
                )

    return small_batches(pairs).mapInArrow(run, f"block long, body binary, hits {_HITS}")


def exact_topk(vectors: DataFrame, queries: DataFrame, *, k: int = 5, row_key: str | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of ``vectors`` for every query, whole search.

    Both tables have ``vec_id, embedding``. Components count as ``floor(256 * x)``;
    the score is the integer inner product, ties go to the smaller ``vec_id``.
    ``row_key`` names a column of both tables that tells rows apart (64-bit integers):
    then only the query's own row is no candidate, and every query row has a list of its
    own. Without it rows with the query's id are no candidates for it, and queries that
    repeat id and vector count once. Fewer candidates than
    ``k`` give fewer rows. Rows with a null id, a null vector, or null or
    non-finite components take no part; a shorter vector counts as filled with
    zeros. A repeated row is a candidate as often as it occurs. Scores beyond 64 bits fail the job. Extra columns are ignored.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad
    wanted = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")]
    wanted.append(F.col(row_key or "vec_id").cast("long").alias("key"))
    base, asked = (t.where(usable).select(*wanted) for t in (vectors, queries))
    trees = materialize(_chunked(base, SHARD_ROWS, True).withColumnRenamed("key", "shard"), "trees")
    blocks = materialize(
        _chunked(asked.dropDuplicates(["vec_id", "embedding", "key"]), BLOCK_QUERIES, False).withColumnRenamed("key", "block"),
        "blocks",
    )
    # One number per block of queries; every block meets every shard.
    keys = F.array(*[F.lit(r[0]) for r in blocks.select("block").collect()]).cast("array<bigint>")
    pairs = materialize(trees.select("shard", F.explode(keys).alias("block")), "pairs")
    home = pairs.groupBy("block").agg(F.min(F.struct(F.xxhash64("block", "shard").alias("h"), "shard"))["shard"].alias("shard"))
    tree_body = trees.select("shard", F.col("body").alias("tree"))

    def met(of: DataFrame, bodies: DataFrame) -> DataFrame:
        return of.join(bodies, "block").join(tree_body, "shard").select("block", "body", "tree")

    first = materialize(_searched(met(home, blocks), k), "hits")
    others = pairs.join(home, ["block", "shard"], "left_anti")
    rest = _searched(met(others, first.select("block", "body")), k)
    hits = first.select("hits").union(rest.select("hits")).select(F.explode("hits").alias("hit")).select("hit.*")
    by_query = Window.partitionBy("query_key").orderBy(F.col("score").desc(), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
