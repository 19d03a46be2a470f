"""N-gram Jaccard join with block-skipped position lists and derived answers.

Texts become sets of shingle hashes; two texts link when the Jaccard similarity
of their sets reaches a threshold. The join is exact (up to clashes of 64-bit
hashes) and works on *classes*, the distinct sets, so copies cost one row each.

1. ``shingle_table`` reads the texts once and keeps, of each set, its size, a
   128-bit digest and the start of the set in hash order.
2. ``crowded_classes``: by the prefix theorem, sets that reach the threshold
   with some other set have several shared shingles in that start. Most sets
   have none and are done.
3. ``shared_lists``: for the rest, shingles that only one set holds drop out of
   the lists; they count as the first positions of the set, ordered by how many
   sets hold a shingle, rarest first.
4. Index lists hold (shingle, position, size) of each set's prefix. Every set is
   verified against one leader of its lists first. The members of a leader's
   component take their answer from it: pairs inside a component are never formed.
5. What is left is joined list by list in blocks of similar size and position:
   headers are compared first, and block pairs that the size filter, the
   position filter or a common component rules out are skipped as a whole.
6. Pairs of different components take their answer from their leaders where they can:
   leaders are measured against each other once, and by the triangle inequality of the
   Jaccard distance that distance, give or take both members' distances to their
   leaders, decides many members' pairs without reading their sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidwork.llm.batches import free_name, small_batches
from braidwork.llm.components import connected_components
from braidwork.llm.hashing import chunks, mix, shingle_sets
from braidwork.session import materialize

# A list of ids is sent to every executor up to this many rows, else joined by shuffle.
BROADCAST_IDS = 1_000_000
POSITION_BLOCK = 8


def _least_overlap(n: int, num: int, den: int) -> int:
    """Shingles that any set similar to one of ``n`` has in common with it."""
    return (num * n + den - 1) // den


def _prefix(n: int, num: int, den: int) -> tuple[int, int]:
    """Length of the start to keep, and how many of it a similar set must share."""
    p = n - _least_overlap(n, num, den) + 1
    shared = max(1, min(p // 2, n // 20))
    return min(n, p + shared - 1), shared


def _digest(values: np.ndarray) -> bytes:
    parts = [mix(values ^ np.uint64(c)).sum(dtype=np.uint64) for c in (0x5BD1E995, 0xC2B2AE3D27D4EB4F)]
    return np.array(parts, np.uint64).tobytes()


def _long_lists(lists: list[np.ndarray]) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
    values = np.concatenate([*lists, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values))


def _sets(docs: DataFrame, width: int, num: int, den: int, whole: bool) -> DataFrame:
    """``doc_id, row, n, set_id, need, hashes`` from ``doc_id, text, row``; the hashes whole or their start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for full in batches:
            # Small batches go on, so that no worker holds many sets.
            for lo, hi in chunks(full.column(1)):
                batch = full.slice(lo, hi - lo)
                n, set_id, need, lists = [], [], [], []
                for values in shingle_sets(batch.column(1), width):
                    length, shared = _prefix(len(values), num, den)
                    n.append(len(values))
                    set_id.append(_digest(values) if len(values) else None)
                    need.append(shared)
                    lists.append(values if whole else values[:length])
                columns = [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(set_id, pa.binary())]
                columns += [pa.array(need, pa.int64()), _long_lists(lists)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n", "set_id", "need", "hashes"])

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("row", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("set_id", T.BinaryType()),
            T.StructField("need", T.LongType()),
            T.StructField("hashes", T.ArrayType(T.LongType())),
        ]
    )
    return small_batches(docs).mapInArrow(run, schema)


def crowded_classes(classes: DataFrame) -> DataFrame:
    """``rep`` of the classes whose start shares enough shingles with other classes."""
    starts = classes.select(
        F.xxhash64("set_id").alias("key"), "need", F.explode("hashes").alias("h")
    )
    # Stored, so that both sides of the join are shuffled and a frequent shingle can be split.
    shared = materialize(
        starts.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("h"), "shared"
    )
    met = starts.join(shared, "h").groupBy("key").agg(
        F.count(F.lit(1)).alias("met"), F.min("need").alias("need")
    )
    keys = met.where("met >= need").select("key")
    return classes.withColumn("key", F.xxhash64("set_id")).join(keys, "key", "left_semi").select("rep")


def shared_lists(sets: DataFrame) -> DataFrame:
    """``node, n, rep, set_id, hashes``: shingles that several sets hold, rarest first."""
    each = sets.select("node", F.explode("hashes").alias("h"))
    df = materialize(each.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "df")
    lists = each.join(df, "h").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("df", "h"))).alias("shared")
    )
    return sets.drop("hashes").join(lists, "node").select(
        "node", "n", "rep", "set_id", F.col("shared.h").alias("hashes")
    )


class _Threshold:
    """The integer forms of the similarity conditions."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den

    def sizes(self, small: Column, large: Column) -> Column:
        return small * self.den >= large * self.num

    def overlap(self, most: Column, n1: Column, n2: Column) -> Column:
        return most * (self.num + self.den) >= (n1 + n2) * self.num


def _measured(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """``a, b, na, nb, inter``: sizes and intersection of the pairs ``a, b``."""
    left = lists.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha"))
    right = lists.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb"))
    inter = F.size(F.array_intersect("ha", "hb")).cast("long").alias("inter")
    # Both lists stay in the task that meets them; only numbers leave it.
    return pairs.join(right, "b").join(left, "a").select("a", "b", "na", "nb", inter)


def _verify(pairs: DataFrame, lists: DataFrame, t: _Threshold) -> DataFrame:
    """The measured pairs that reach the threshold."""
    return _measured(pairs, lists).where(t.overlap(F.col("inter"), F.col("na"), F.col("nb")))


def _distance() -> Column:
    return 1 - F.col("inter") / (F.col("na") + F.col("nb") - F.col("inter"))


def derived_answers(pairs: DataFrame, lists: DataFrame, t: _Threshold) -> DataFrame:
    """``a, b, answer`` of ``a, b, lead_a, lead_b, gap_a, gap_b``: true and false where the leaders'
    distance decides, null where the pair itself must be verified.

    A set without a leader leads itself at distance 0.
    """
    ahead = F.least("lead_a", "lead_b").alias("a"), F.greatest("lead_a", "lead_b").alias("b")
    # A pair of two leaders would be measured twice.
    member = (F.col("gap_a") > 0) | (F.col("gap_b") > 0)
    leads = _measured(pairs.where(member).select(*ahead).distinct(), lists)
    leads = materialize(leads.select(F.col("a").alias("p"), F.col("b").alias("q"), _distance().alias("apart")), "leads")
    named = pairs.withColumn("p", F.least("lead_a", "lead_b")).withColumn("q", F.greatest("lead_a", "lead_b"))
    both = F.col("gap_a") + F.col("gap_b")
    limit = F.lit(1 - t.num / t.den)
    # Bounds are given a margin for rounding; what lies within it is verified.
    answer = F.when(F.col("apart") + both < limit - 1e-9, True).when(F.col("apart") - both > limit + 1e-9, False)
    return named.join(leads, ["p", "q"], "left").select("a", "b", answer.alias("answer"))


def _leader_pairs(index: DataFrame, t: _Threshold) -> DataFrame:
    """``a, b``: for each set the first leader, in order of ``rep``, that one of its lists offers."""
    leaders = index.groupBy("h").agg(F.min(F.struct("rep", "node", "n", "pos")).alias("first"))
    offers = index.join(leaders, "h").where(
        (F.col("first.node") != F.col("node"))
        & t.sizes(F.least("n", "first.n"), F.greatest("n", "first.n"))
        & t.overlap(
            F.least(F.col("n") - F.col("pos"), F.col("first.n") - F.col("first.pos")),
            F.col("n"),
            F.col("first.n"),
        )
    )
    best = offers.groupBy("node").agg(F.min(F.struct("first.rep", "first.node")).alias("best"))
    return best.select(F.col("best.node").alias("a"), F.col("node").alias("b"))


def _block_pairs(index: DataFrame, t: _Threshold) -> DataFrame:
    """``a, b`` in different components that share a list and pass the filters there, with
    ``lead_a, lead_b, gap_a, gap_b``.

    ``index`` has ``h, pos, node, n, comp, leader, gap``: ``gap`` is the known
    distance of the set to its ``leader``, which may be itself.
    """
    mixed = (
        index.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    )
    open_lists = index.join(mixed.select("h"), "h")
    band = F.floor(F.log(F.col("n")) * F.lit(2.0 / np.log(t.den / t.num))).cast("long")
    rows = open_lists.select(
        F.struct(band.alias("s"), F.floor(F.col("pos") / POSITION_BLOCK).cast("long").alias("p")).alias("block"),
        "h", "pos", "node", "n", "comp", "leader", "gap",
    )
    rows = materialize(rows, "lists")
    head = rows.groupBy("h", "block").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("pos").alias("at"),
        F.min("comp").alias("lo"), F.max("comp").alias("hi"),
    )
    x, y = (head.select("h", *[F.col(c).alias(f"{c}_{s}") for c in head.columns[1:]]) for s in "xy")
    c = F.col
    kept = x.join(y, "h").where(
        (c("block_x") <= c("block_y"))
        & t.sizes(c("most_x"), c("least_y"))
        & t.sizes(c("most_y"), c("least_x"))
        & t.overlap(
            F.least(c("most_x") - c("at_x"), c("most_y") - c("at_y")), c("least_x"), c("least_y")
        )
        & ((c("lo_x") != c("hi_x")) | (c("lo_y") != c("hi_y")) | (c("lo_x") != c("lo_y")))
    )
    blocks = kept.select("h", "block_x", "block_y")
    rx, ry = (rows.select("h", *[F.col(k).alias(f"{k}_{s}") for k in rows.columns if k != "h"]) for s in "xy")
    met = blocks.join(rx, ["h", "block_x"]).join(ry, ["h", "block_y"]).where(
        (c("comp_x") != c("comp_y"))
        & ((c("block_x") < c("block_y")) | (c("node_x") < c("node_y")))
        & t.sizes(F.least("n_x", "n_y"), F.greatest("n_x", "n_y"))
        & t.overlap(F.least(c("n_x") - c("pos_x"), c("n_y") - c("pos_y")), c("n_x"), c("n_y"))
    )
    one, other = (F.struct(c(f"node_{s}").alias("node"), c(f"leader_{s}").alias("lead"), c(f"gap_{s}").alias("gap")) for s in "xy")
    ends = met.select(F.least(one, other).alias("l"), F.greatest(one, other).alias("r"))
    return ends.groupBy(F.col("l.node").alias("a"), F.col("r.node").alias("b")).agg(
        F.min("l.lead").alias("lead_a"), F.min("r.lead").alias("lead_b"),
        F.min("l.gap").alias("gap_a"), F.min("r.gap").alias("gap_b"),
    )


def jaccard_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    width: int = 5, num: int = 80, den: int = 100,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, set_id, row`` of every row of ``docs``.

    ``set_id`` is the digest of the set of shingles, ``row`` the hash of the text.

    Rows link when ``den * |intersection| >= num * |union|`` of their sets of
    ``width``-word shingles; ``component_id`` is the smallest id that links
    reach, the row's own included. A text of fewer words is one shingle. A text
    without words, or null, has no shingle, links with nothing and is its own
    component. Rows of equal text are one class whatever their ids; a repeated
    id is several rows. A null id links like any other and is never the smallest
    unless the component has no other. Other columns are ignored; an empty table
    gives an empty result.
    """
    t = _Threshold(num, den)
    text = F.col(text_col).cast("string")
    plain = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"))
    sets = materialize(_sets(plain, width, num, den, whole=False), "sets")
    full = sets.where(F.col("set_id").isNotNull())
    classes = full.groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.first("need").alias("need"), F.first("hashes").alias("hashes")
    )
    crowded = materialize(crowded_classes(classes), "crowded")
    ids = crowded.select(F.col("rep").alias("_rep"))
    ids = F.broadcast(ids) if crowded.count() <= BROADCAST_IDS else ids
    again = plain.join(ids, F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi")
    nodes = materialize(
        _sets(again, width, num, den, whole=True)
        .where(F.col("set_id").isNotNull())
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("hashes").alias("hashes"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    lists = shared_lists(nodes)
    lists = materialize(lists.where(t.sizes(F.size("hashes").cast("long"), F.col("n"))), "lists")

    # Shingles of one set only come first; where they fill the prefix, no other set is similar.
    alone = F.col("n") - F.size("hashes")
    prefix = F.col("n") - F.floor((F.col("n") * num + den - 1) / den).cast("long") + 1
    index = materialize(
        lists.where(prefix > alone).select(
            "node", "n", "rep", alone.alias("alone"),
            F.posexplode(F.slice("hashes", F.lit(1), (prefix - alone).cast("int"))).alias("k", "h"),
        ).select("h", (F.col("alone") + F.col("k")).alias("pos"), "node", "n", "rep"),
        "index",
    )
    direct = materialize(_verify(_leader_pairs(index, t), lists, t), "links")
    groups = connected_components(direct)
    known = direct.select(F.col("b").alias("node"), F.col("a").alias("leader"), _distance().alias("gap"))
    placed = index.join(groups, "node", "left").join(known, "node", "left")
    placed = placed.withColumn("comp", F.coalesce("comp", "node")).withColumn("leader", F.coalesce("leader", "node"))
    placed = placed.withColumn("gap", F.coalesce("gap", F.lit(0.0)))
    answers = materialize(derived_answers(materialize(_block_pairs(placed, t), "pairs"), lists, t), "answers")
    rest = _verify(answers.where(F.col("answer").isNull()).select("a", "b"), lists, t).select("a", "b")
    rest = rest.union(answers.where("answer").select("a", "b"))
    groups = connected_components(direct.select("a", "b").union(rest))

    named = nodes.select("node", "set_id", "rep").join(groups, "node")
    smallest = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    moved = named.join(smallest, "comp").select("set_id", "component_id")
    reps = full.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    placed_sets = materialize(reps.join(moved, "set_id", "left").select(
        "set_id", F.coalesce("component_id", "rep").alias("component_id")
    ), "classes")
    return sets.select("doc_id", "row", F.col("n").alias("n_shingles"), "set_id").join(
        placed_sets, "set_id", "left"
    ).select(
        "doc_id", "n_shingles",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.lower(F.hex("set_id")).alias("set_id"), "row",
    )


def one_per_component(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text``, others) that stay when each component keeps one.

    ``found`` is ``jaccard_components(docs)``. The row with the component's id stays,
    of several the one with the smallest hash of its text; rows equal in id and text
    are kept once. Rows of a component without any id are all kept.
    """
    heads = found.where(F.col("component_id").isNotNull() & (F.col("doc_id") == F.col("component_id")))
    best = heads.groupBy("component_id", F.col("set_id").isNull().alias("bare")).agg(F.min("row").alias("row"))
    key = free_name(docs, "_key")
    keys = best.select(F.struct(F.col("component_id").alias("doc_id"), "row").alias(key)).union(
        found.where(F.col("component_id").isNull()).select(F.struct("doc_id", "row").alias(key)).distinct()
    )
    keyed = docs.withColumn(key, F.struct("doc_id", F.xxhash64(F.col("text").cast("string")).alias("row")))
    return keyed.join(keys, key, "left_semi").dropDuplicates([key]).drop(key)
