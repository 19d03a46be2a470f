"""Near-duplicate vectors by a pigeonhole join over subspaces.

Unit vectors with a cosine of at least c are at most 2 - 2c apart in squared
distance. After a rotation onto the principal axes the coordinates are cut into
blocks, each with a budget in proportion to its share of the variance. Budgets add up
to the whole, so a pair that is close enough keeps the budget of one block at least:
a range join per block finds a superset of all pairs.

1. Equal vectors are one class with a weight. A bounded sample of classes gives the
   rotation, the blocks, a median-split tree per block and the centres of dense balls.
2. All members of a ball of less than half the distance limit link with each other. A
   ball that nothing else comes near is answered as a whole, so a large group of near
   copies costs one row per member. Other balls are dissolved.
3. Per block every vector lives in one cell of the tree, and visits the cells that its
   budget reaches; of two cells one visits the other. Crowded cells are dealt out.
4. A task holds the vectors of one cell and streams its visitors past them in small
   batches. Pairs that keep the block's budget are verified on the spot over all
   coordinates, in the first block whose budget they keep, so each pair counts once.
   Tasks return a count per vector and a spanning forest of the links, never the pairs.
5. Coordinates travel in single precision; pairs too near the limit for that are
   verified afterwards in double precision on the vectors as given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.llm.batches import small_batches
from braidwork.llm.components import connected_components
from braidwork.session import materialize

SAMPLE_ROWS = 8_192
BALL_SAMPLE = 4_096
BLOCK_DIMS = 16
CELL_ROWS = 16_384
MAX_CELLS = 1_024
# A ball needs this many of the sampled vectors; the centres are a broadcast literal.
BALL_MEMBERS = 32
MAX_BALLS = 64
# Blocks with less of the variance get no budget: they would tell nothing apart.
LEAST_SHARE = 0.01
# Slack of single precision: of a squared distance in one block, and of a cosine.
SLACK = 1e-5
_CHUNK = 512
_SENT_ROWS = 20_000


@dataclass
class Tree:
    """Median splits of one block; ``left < 0`` marks a leaf, whose cell is ``-left - 1``."""

    dim: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    low: list[np.ndarray] = field(default_factory=list)
    high: list[np.ndarray] = field(default_factory=list)

    @staticmethod
    def grow(points: np.ndarray, cells: int) -> Tree:
        tree, width = Tree(), points.shape[1]
        todo = [(points, cells, np.full(width, -np.inf), np.full(width, np.inf), -1, 0)]
        while todo:
            own, n, low, high, parent, side = todo.pop()
            at = len(tree.dim)
            if parent >= 0:
                (tree.left if side == 0 else tree.right)[parent] = at
            spread = own.std(0) if len(own) > 1 else np.zeros(width)
            split = int(spread.argmax()) if width else 0
            middle = float(np.median(own[:, split])) if len(own) > 1 else 0.0
            tree.dim.append(split)
            tree.value.append(middle)
            if n < 2 or not spread.max(initial=0) > 0 or not (own[:, split] < middle).any():
                tree.left.append(-len(tree.low) - 1)
                tree.right.append(-1)
                tree.low.append(low)
                tree.high.append(high)
                continue
            tree.left.append(0)
            tree.right.append(0)
            below = own[:, split] < middle
            least, most = low.copy(), high.copy()
            most[split] = least[split] = middle
            todo.append((own[below], n // 2, low, most, at, 0))
            todo.append((own[~below], n // 2, least, high, at, 1))
        return tree

    def cells(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        dim, value, left, right = map(np.asarray, (self.dim, self.value, self.left, self.right))
        at = np.zeros(len(points), np.int64)
        while True:
            inner = np.flatnonzero(left[at] >= 0)
            if not len(inner):
                return -left[at] - 1
            node = at[inner]
            at[inner] = np.where(points[inner, dim[node]] < value[node], left[node], right[node])

    def reached(self, points: np.ndarray, radius: float) -> np.ndarray:
        """For each point the cells within ``radius``, as a matrix of booleans."""
        low, high = np.array(self.low), np.array(self.high)
        squared = np.zeros((len(points), len(low)))
        for k in range(points.shape[1]):
            x = points[:, k : k + 1]
            squared += np.maximum(0, np.maximum(low[:, k] - x, x - high[:, k])) ** 2
        return squared <= radius**2


@dataclass
class Layout:
    """What the sample decides: rotation, blocks with budgets, trees, balls."""

    rotation: np.ndarray
    blocks: list[tuple[int, int, float]]  # first and last coordinate, squared budget
    trees: list[Tree]
    centres: np.ndarray
    ball_radius: float
    limit: float


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors of unit length; shorter ones are filled with zeros."""
    lists = lists.cast(pa.list_(pa.float64()))
    at = np.asarray(lists.offsets)
    sizes = np.diff(at)
    out = np.zeros((len(lists), width))
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(at[0], at[-1]) - np.repeat(at[:-1], sizes)] = np.asarray(lists.values)[at[0] : at[-1]]
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _dense_balls(points: np.ndarray, radius: float) -> np.ndarray:
    """Centres of balls that hold many of ``points``, the fullest first."""
    found, left = [], np.ones(len(points), bool)
    near = (points @ points.T) >= 1 - radius**2 / 2
    while len(found) < MAX_BALLS:
        counts = (near & left).sum(1) * left
        if not len(counts) or counts.max() < BALL_MEMBERS:
            break
        centre = points[near[counts.argmax()] & left].mean(0)
        inside = np.linalg.norm(points - centre, axis=1) <= radius
        inside[counts.argmax()] = True
        found.append(centre)
        left &= ~inside
    return np.array(found).reshape(len(found), points.shape[1])


def _layout(sample: np.ndarray, limit: float, width: int, block_dims: int) -> Layout:
    spread = np.cov(sample.T).reshape(width, width) if len(sample) > 1 else np.eye(width)
    variance, axes = np.linalg.eigh(spread)
    rotation, variance = axes[:, ::-1], np.maximum(variance[::-1], 0)
    turned = sample @ rotation
    cuts = [(a, min(width, a + block_dims)) for a in range(0, width, block_dims)]
    shares = np.array([variance[a:b].sum() for a, b in cuts])
    shares = shares / shares.sum() if shares.sum() > 0 else np.full(len(cuts), 1 / len(cuts))
    shares = np.where(shares < LEAST_SHARE, 0, shares)
    shares /= shares.sum()
    blocks = [(a, b, limit * s + SLACK) for (a, b), s in zip(cuts, shares) if s > 0]
    radius = 0.49 * limit**0.5
    return Layout(rotation, blocks, [], _dense_balls(turned[:BALL_SAMPLE], radius), radius, limit)


def _turned(classes: DataFrame, layout: Layout) -> DataFrame:
    """``node, weight, least, point, ball, near``: rotated coordinates in single precision, the ball or -1,
    and the other balls whose members could be within the limit."""
    rotation, centres, radius = layout.rotation, layout.centres, layout.ball_radius
    reach = layout.limit**0.5 + radius + 1e-4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = (_matrix(batch.column(3), len(rotation)) @ rotation).astype(np.float32)
            own, near = np.full(len(points), -1, np.int32), [[]] * len(points)
            if len(centres):
                wide = points.astype(np.float64)
                squared = (wide**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * wide @ centres.T
                away = np.sqrt(np.maximum(squared, 0))
                best = away.argmin(1)
                inside = away[np.arange(len(best)), best] <= radius
                own[inside] = best[inside]
                close = away <= reach
                close[np.arange(len(best))[inside], best[inside]] = False
                near = [np.flatnonzero(x).tolist() for x in close]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _binary(points), pa.array(own), pa.array(near, pa.list_(pa.int32()))],
                ["node", "weight", "least", "point", "ball", "near"],
            )

    rows = classes.select("node", "weight", "least", "vector")
    kind = classes.schema["least"].dataType.simpleString()
    return small_batches(rows).mapInArrow(
        run, f"node long, weight long, least {kind}, point binary, ball int, near array<int>"
    )


def _binary(points: np.ndarray) -> pa.Array:
    size = points.shape[1] * 4
    at = np.arange(len(points) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(
        pa.binary(), len(points), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(points).tobytes())]
    )


def _points(column: pa.Array, width: int) -> np.ndarray:
    column = column.cast(pa.binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros((0, width), np.float32)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(np.float32).reshape(len(column), width)


def _sent(active: DataFrame, layout: Layout, deals: list[np.ndarray]) -> DataFrame:
    """``seat, guest, node, weight, point``: each vector at home (guest 0) and where it visits (guest 1).

    A seat is a share of a cell of a block. ``deals[b][c]`` is the first seat of cell c of block b,
    counted over all blocks; the next cell's first seat ends it.
    """
    blocks, trees, width = layout.blocks, layout.trees, len(layout.rotation)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, weights = (np.asarray(batch.column(k), np.int64) for k in (0, 1))
            points = _points(batch.column(2), width)
            for (a, b, budget), tree, first in zip(blocks, trees, deals):
                own = points[:, a:b].astype(np.float64)
                cell = tree.cells(own)
                shares = np.diff(first)
                # Nodes are numbered by partition and row; the product spreads their low bits.
                spread = (nodes * np.int64(0x9E3779B97F4A7C1 | 1)) >> 20 & 0x7FFFFFFF
                home = first[cell] + spread % shares[cell]
                seats = np.arange(first[0], first[-1])
                reach = np.repeat(tree.reached(own, budget**0.5 + SLACK), shares, axis=1)
                even = (seats[None, :] + home[:, None]) % 2 == 0
                go = reach & ((home[:, None] < seats) == even) & (home[:, None] != seats)
                row, at = np.nonzero(go)
                who = np.concatenate((np.arange(len(nodes)), row))
                seat = np.concatenate((home, seats[at]))
                guest = np.concatenate((np.zeros(len(nodes), np.int8), np.ones(len(row), np.int8)))
                for lo in range(0, len(who), _SENT_ROWS):
                    part = slice(lo, lo + _SENT_ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(seat[part]), pa.array(guest[part]), pa.array(nodes[who[part]]),
                            pa.array(weights[who[part]]), _binary(points[who[part]]),
                        ],
                        ["seat", "guest", "node", "weight", "point"],
                    )

    rows = active.select("node", "weight", "point")
    return small_batches(rows).mapInArrow(run, "seat long, guest byte, node long, weight long, point binary")


def _group(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the edges ``a, b`` and the given labels."""
    while True:
        low = labels.copy()
        least = np.minimum(labels[a], labels[b])
        for end in (a, b, labels[a], labels[b]):
            np.minimum.at(low, end, least)
        low = low[low]
        if (low == labels).all():
            return low
        labels = low


class _Seat:
    """One seat: the vectors at home, what was counted for them and how they hang together."""

    def __init__(self, nodes: np.ndarray, weights: np.ndarray, points: np.ndarray, block: int, layout: Layout) -> None:
        self.nodes, self.weights, self.points, self.block, self.layout = nodes, weights, points, block, layout
        self.counts, self.labels = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        self.most = layout.limit / 2
        a, b, _ = layout.blocks[block]
        own = points[:, a:b]
        half = (own * own).sum(1, keepdims=True) / 2
        self.right = np.concatenate((own, np.ones_like(half), -half), axis=1).T.copy()

    def meet(self, points: np.ndarray, after: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``i, j, unsure`` of the close pairs of ``points`` and those at home, in this block first.

        ``after``: only pairs with a later one at home.
        """
        blocks = self.layout.blocks
        a, b, budget = blocks[self.block]
        own = points[:, a:b]
        half = (own * own).sum(1, keepdims=True) / 2
        left = np.concatenate((own, -half, np.ones_like(half)), axis=1)
        hit = left @ self.right >= np.float32(-budget / 2 - SLACK)
        i, j = np.divmod(np.flatnonzero(hit.ravel()), hit.shape[1])
        if after is not None:
            later = j > after[i]
            i, j = i[later], j[later]
        kept = []
        for lo in range(0, len(i), 200_000):
            x, y = i[lo : lo + 200_000], j[lo : lo + 200_000]
            squared, total, ok = (points[x].astype(np.float64) - self.points[y]) ** 2, 0.0, True
            for k in range(squared.shape[1]):
                total = total + squared[:, k]
            # Column by column, so that every block decides alike about a pair.
            for other, (p, q, most) in enumerate(blocks[: self.block + 1]):
                part = 0.0
                for k in range(p, q):
                    part = part + squared[:, k]
                ok = ok & ((part <= most) == (other == self.block))
            ok = ok & (total <= self.layout.limit + 2 * SLACK)
            kept.append((x[ok], y[ok], total[ok] > self.layout.limit - 2 * SLACK))
        if not kept:
            return i[:0], j[:0], np.zeros(0, bool)
        i, j, unsure = (np.concatenate(x) for x in zip(*kept))
        return i, j, unsure

    def visit(self, nodes: np.ndarray, weights: np.ndarray, points: np.ndarray, at_home: int | None) -> Iterator[tuple]:
        """Take in some vectors, those at home from index ``at_home`` on or visitors; yields ``kind, a, b, n`` arrays."""
        after = None if at_home is None else np.arange(at_home, at_home + len(nodes))
        i, j, unsure = self.meet(points, after)
        if unsure.any():
            yield 2, nodes[i[unsure]], self.nodes[j[unsure]], None
            i, j = i[~unsure], j[~unsure]
        if not len(i):
            return
        np.add.at(self.counts, j, weights[i])
        if at_home is not None:
            np.add.at(self.counts, i + at_home, self.weights[j])
            self.labels = _group(len(self.nodes), i + at_home, j, self.labels)
            return
        counts = np.zeros(len(nodes), np.int64)
        np.add.at(counts, i, self.weights[j])
        seen = np.flatnonzero(counts)
        yield 0, nodes[seen], None, counts[seen]
        n = len(self.nodes)
        labels = _group(n + len(nodes), j, i + n, np.concatenate((self.labels, np.arange(n, n + len(nodes)))))
        self.labels = labels[:n]
        yield 1, nodes[seen], self.nodes[labels[n + seen]], None

    def close(self) -> Iterator[tuple]:
        seen = np.flatnonzero(self.counts)
        yield 0, self.nodes[seen], None, self.counts[seen]
        tied = np.flatnonzero(self.labels != np.arange(len(self.labels)))
        yield 1, self.nodes[tied], self.nodes[self.labels[tied]], None


def _met(sent: DataFrame, layout: Layout, deals: list[np.ndarray]) -> DataFrame:
    """``kind, a, b, n``: links counted for ``a`` (0), edges of a forest (1), pairs to verify (2)."""
    width, ends = len(layout.rotation), np.array([d[-1] for d in deals])

    def batch_of(found: tuple) -> pa.RecordBatch:
        kind, a, b, n = found
        none = pa.nulls(len(a), pa.int64())
        columns = [pa.array(np.full(len(a), kind, np.int8)), pa.array(a), none if b is None else pa.array(b)]
        return pa.RecordBatch.from_arrays([*columns, none if n is None else pa.array(n)], ["kind", "a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, seat = None, [], None

        def open_seat() -> Iterator[tuple]:
            nonlocal seat, held
            nodes, weights, points = (np.concatenate(x) for x in zip(*held))
            held = []
            seat = _Seat(nodes, weights, points, int(np.searchsorted(ends, at, "right")), layout)
            for lo in range(0, len(nodes), _CHUNK):
                part = slice(lo, lo + _CHUNK)
                yield from seat.visit(nodes[part], weights[part], points[part], lo)

        def pieces() -> Iterator[tuple]:
            nonlocal at, seat
            for batch in batches:
                seats, guests = np.asarray(batch.column(0)), np.asarray(batch.column(1))
                nodes, weights = np.asarray(batch.column(2)), np.asarray(batch.column(3))
                points = _points(batch.column(4), width)
                edges = np.flatnonzero((np.diff(seats) != 0) | (np.diff(guests) != 0)) + 1
                for lo, hi in zip([0, *edges], [*edges, len(seats)]):
                    if lo == hi:
                        continue
                    if seats[lo] != at:
                        if held:
                            yield from open_seat()
                        if seat is not None:
                            yield from seat.close()
                        at, seat = seats[lo], None
                    if guests[lo] == 0:
                        held.append((nodes[lo:hi], weights[lo:hi], points[lo:hi]))
                        continue
                    if held:
                        yield from open_seat()
                    # A seat without anyone at home has nobody to visit.
                    for k in range(lo, hi if seat is not None else lo, _CHUNK):
                        part = slice(k, min(hi, k + _CHUNK))
                        yield from seat.visit(nodes[part], weights[part], points[part], None)
            if held:
                yield from open_seat()
            if seat is not None:
                yield from seat.close()

        for found in pieces():
            if len(found[1]):
                yield batch_of(found)

    lined = sent.repartition("seat").sortWithinPartitions("seat", "guest")
    return small_batches(lined).mapInArrow(run, "kind byte, a long, b long, n long")


def _cosine(a: Column, b: Column) -> Column:
    def product(x: Column, y: Column) -> Column:
        pairs = F.zip_with(x, y, lambda p, q: F.coalesce(p * q, F.lit(0.0)))
        return F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)

    return product(a, b) / (F.sqrt(product(a, a)) * F.sqrt(product(b, b)))


def _seats(active: DataFrame, layout: Layout, cell_rows: int) -> list[np.ndarray]:
    """The first seat of each cell of each block: crowded cells get several."""
    trees, blocks, width = layout.trees, layout.blocks, len(layout.rotation)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(tree.low), np.int64) for tree in trees]
        for batch in batches:
            points = _points(batch.column(0), width).astype(np.float64)
            for (a, b, _), tree, count in zip(blocks, trees, counts):
                np.add.at(count, tree.cells(points[:, a:b]), 1)
        for k, count in enumerate(counts):
            cells = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cells), k)), pa.array(cells), pa.array(count[cells])], ["block", "cell", "n"]
            )

    counted = small_batches(active.select("point")).mapInArrow(run, "block long, cell long, n long")
    # One row per cell: MAX_CELLS per block at most.
    found = counted.groupBy("block", "cell").agg(F.sum("n").alias("n")).collect()
    deals, start = [], 0
    for k, tree in enumerate(trees):
        shares = np.ones(len(tree.low), np.int64)
        for r in found:
            if r.block == k:
                shares[r.cell] = -(-r.n // cell_rows)
        deals.append(start + np.concatenate(([0], np.cumsum(shares))))
        start = int(deals[-1][-1])
    return deals


def near_vectors(
    vectors: DataFrame, *, cosine: float = 0.9, block_dims: int = BLOCK_DIMS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (``vec_id, embedding``).

    Two rows link when the cosine of their vectors is at least ``cosine``, in double
    precision; ``n_links`` counts the other rows a row links with, ``component_id`` is
    the smallest id that links reach, the row's own included, and ``kept`` tells whether
    that is the row's own. Null vectors, those without length and those with null or
    non-finite components link with nothing. A shorter vector counts as filled with
    zeros. Repeated ids are rows of their own; a null id links like any other and is the
    smallest only where there is no other. No rows give no rows; other columns are ignored.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    plain = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    largest = F.array_max(F.transform("vector", F.abs))
    usable = F.coalesce(finite & (largest > 0), F.lit(False))
    # A power of two keeps all digits and lets squares neither overflow nor vanish.
    power = F.pow(F.lit(2.0), -F.greatest(F.lit(-1000), F.least(F.lit(1000), F.floor(F.log2(largest)))))
    key = F.struct(F.xxhash64("vector").alias("p"), F.xxhash64(F.lit(1), "vector").alias("q"))
    rows = materialize(
        plain.where(usable).select("vec_id", key.alias("key"), F.transform("vector", lambda x: x * power).alias("vector")),
        "vectors",
    )
    classes = materialize(
        rows.groupBy("key").agg(
            F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"), F.first("vector").alias("vector")
        ).withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    width = classes.agg(F.max(F.size("vector"))).first()[0] or 1
    sample = classes.orderBy(F.xxhash64("key"), "node").limit(SAMPLE_ROWS).select("vector").collect()
    units = _matrix(pa.array([r[0] for r in sample], pa.list_(pa.float64())), width) if sample else np.zeros((0, width))
    layout = _layout(units, 2 - 2 * cosine, width, block_dims)
    turned = materialize(_turned(classes, layout), "turned")
    # At most MAX_BALLS numbers.
    touched = [r[0] for r in turned.select(F.explode("near").alias("ball")).distinct().collect()]
    whole = (F.col("ball") >= 0) & ~F.col("ball").isin(touched)
    balls = turned.where(whole)
    ball_sums = balls.groupBy("ball").agg((F.sum("weight") - 1).alias("n_links"), F.min("least").alias("component_id"))
    in_balls = balls.select("node", "ball").join(F.broadcast(ball_sums), "ball").select("node", "n_links", "component_id")

    active = turned.where(~whole)
    n_active, n_cells = active.count(), 1
    while n_cells < MAX_CELLS and n_cells * cell_rows < n_active:
        n_cells *= 2
    spread = units @ layout.rotation
    for k in range(len(layout.centres)):
        if k not in touched:
            spread = spread[np.linalg.norm(spread - layout.centres[k], axis=1) > layout.ball_radius]
    layout.trees = [Tree.grow(spread[:, a:b], n_cells) for a, b, _ in layout.blocks]
    deals = _seats(active, layout, cell_rows)
    met = materialize(_met(_sent(active, layout, deals), layout, deals), "met")

    pairs = met.where("kind = 2").select("a", "b")
    left, right = (
        classes.select(F.col("node").alias(s), F.col("vector").alias(f"v{s}"), F.col("weight").alias(f"w{s}")) for s in "ab"
    )
    exact = pairs.join(left, "a").join(right, "b").where(_cosine(F.col("va"), F.col("vb")) >= cosine)
    exact = materialize(exact.select("a", "b", "wa", "wb"), "verified")
    counts = (
        met.where("kind = 0").select(F.col("a").alias("node"), "n")
        .union(exact.select("a", "wb")).union(exact.select("b", "wa"))
        .groupBy("node").agg(F.sum("n").alias("n"))
    )
    edges = met.where("kind = 1").select("a", "b").union(exact.select("a", "b"))
    groups = connected_components(edges)
    named = turned.select("node", "weight", "least").join(counts, "node", "left").join(groups, "node", "left")
    named = named.withColumn("comp", F.coalesce("comp", "node"))
    linked = materialize(named.where(F.col("n").isNotNull()), "linked")
    smallest = linked.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_links = linked.join(smallest, "comp").select(
        "node", (F.col("weight") - 1 + F.col("n")).alias("n_links"), "component_id"
    )
    answers = by_links.union(in_balls).join(classes.select("node", "key"), "node").drop("node")
    copies = classes.where("weight > 1").join(answers, "key", "left_anti").select(
        (F.col("weight") - 1).alias("n_links"), F.col("least").alias("component_id"), "key"
    )
    answers = materialize(answers.unionByName(copies), "answers")
    found = rows.select("vec_id", "key").union(plain.where(~usable).select("vec_id", F.lit(None)))
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return found.join(answers, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
