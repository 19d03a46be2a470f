"""Mixing sources to target weights by a time-varying curriculum.

Each source has a schedule, a piecewise linear weight over training time 0 to 1.
Its integral is the weight by which the source shares the words of the mix; its
running integral is the demand for the source's words up to a time. A document
takes a stretch of its source's demand, and the time at which the running demand
reaches that stretch, the inverse, is its position. Sorting all documents by
position gives the training order. All of it is expressions and windows; running
sums of a source are cut into ranges of a hash, so a source with a third of all
rows is many window partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidwork.llm.batches import free_name
from braidwork.operators.ordering import running_total
from braidwork.session import materialize

Schedule = Sequence[tuple[float, float]]
# Knots (time, weight) with integrals 3, 1 and 2: the first source grows, the second fades.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 1.5), (1.0, 4.5)), ((0.0, 1.5), (1.0, 0.5)), ((0.0, 2.0), (1.0, 2.0)))


def integral(schedule: Schedule) -> float:
    return math.fsum((t2 - t1) * (w1 + w2) / 2 for (t1, w1), (t2, w2) in zip(schedule, schedule[1:]))


def invert(schedule: Schedule, share: Column) -> Column:
    """The time at which the running integral reaches ``share`` (0 to 1) of the whole."""
    whole, done, out = integral(schedule), 0.0, None
    pieces = list(zip(schedule, schedule[1:]))
    for (t1, w1), (t2, w2) in pieces:
        area = share * F.lit(whole) - F.lit(done)
        slope = 2 * (w2 - w1) / (t2 - t1)
        root = F.sqrt(F.greatest(F.lit(w1 * w1) + F.lit(slope) * area, F.lit(0.0)))
        time = F.lit(t1) + F.when(area > 0, 2 * area / (F.lit(w1) + root)).otherwise(0.0)
        done += (t2 - t1) * (w1 + w2) / 2
        below = share * F.lit(whole) <= F.lit(done)
        out = F.when(below, time) if out is None else out.when(below, time)
    return out.otherwise(F.lit(float(schedule[-1][0])))


def source_targets(sources: DataFrame, schedules: Sequence[Schedule], share: float, cap: float) -> DataFrame:
    """``source, source_size, kind, target`` from ``source, source_size``, one row per source.

    Sources in code point order, null last, use the schedules in turn and share
    ``share`` of all words by their integrals. A target stops at ``cap`` times
    the source's size; its excess goes to the others by weight, until none is above.
    The windows run over one row per source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    kind = F.pmod(F.row_number().over(ordered) - 1, F.lit(len(schedules)))
    weights = F.array(*[F.lit(integral(s)) for s in schedules])
    base = sources.withColumn("kind", kind).withColumn("weight", F.get(weights, F.col("kind")))
    most = F.col("source_size") * F.lit(float(cap))
    base = base.withColumn("most", most).withColumn("ratio", F.col("most") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0))) * F.lit(float(share))
    levels = base.withColumn("level", (total - full) / rest).withColumn("place", F.row_number().over(by_ratio))
    holds = F.col("level") <= F.col("ratio")
    level = F.min(F.when(holds, F.struct("place", "level"))).over(Window.partitionBy(F.lit(0)))["level"]
    target = F.coalesce(F.least(F.col("most"), level * F.col("weight")), F.col("most"))
    return levels.select("source", "source_size", "kind", target.alias("target"))


def mix_plan(
    docs: DataFrame, *, schedules: Sequence[Schedule] = SCHEDULES, share: float = 1.5, cap: float = 2.0, by_row: bool = False,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, positions`` of every row of ``docs``; with ``by_row``
    also ``row``, which tells ``training_order`` different rows apart.

    ``size`` counts the words of the text (null: 0). A source's documents are
    taken in the order of a hash of their id, over and over, until its target,
    rounded to whole words, is met: ``taken`` is what the mix takes of the
    document, at most ``ceil(cap)`` times its size, the last one in part.
    ``positions`` holds the training time of each pass that takes from it (empty:
    none). Rows with equal id and size tie and may swap places. Null ids and
    sources are values like others; an empty table gives no rows. Extra columns
    are ignored.
    """
    words = F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    named = F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    row = [row_hash(docs).alias("row")] if by_row else []
    sized = docs.select("doc_id", "source", words.alias("size"), F.md5(named).alias("_key"), *row)
    sized = materialize(sized, "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, schedules, share, cap)
    keyed = targets.withColumnRenamed("source", "_source")
    behind = running_total(
        sized,
        F.col("size"),
        [F.col("_key"), F.col("doc_id"), F.col("size")],
        partition_by=["source"],
        bucket=F.substring("_key", 1, 3),
        out="_end",
    )
    joined = behind.join(keyed, F.col("source").eqNullSafe(F.col("_source")))
    start, need = F.col("_end") - F.col("size"), F.round("target").cast("long")
    parts, times = [], []
    for k in range(math.ceil(cap)):
        begin = start + k * F.col("source_size")
        part = F.greatest(F.lit(0), F.least(F.col("size"), need - begin))
        at = begin / F.greatest(need, F.lit(1))
        when = F.lit(None).cast("double")
        for i, schedule in enumerate(schedules):
            when = F.when(F.col("kind") == i, invert(schedule, at)).otherwise(when)
        parts.append(part)
        times.append(F.when(part > 0, when))
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", *(["row"] if by_row else []),
        sum(parts[1:], parts[0]).alias("taken"),
        F.array_compact(F.array(*times)).alias("positions"),
    )


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that can be hashed."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))])


def training_order(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of ``docs``, once per pass that takes from them, range-sorted by position.

    ``plan`` is ``mix_plan(docs, by_row=True)``. Documents that the mix takes nothing of go.
    Every row has its own passes; equal rows have theirs together.
    """
    key, at = free_name(docs, "_row"), free_name(docs, "_position")
    passes = plan.select(F.col("row").alias(key), F.explode("positions").alias(at))
    keyed = docs.withColumn(key, row_hash(docs))
    repeated = materialize(plan.groupBy("row").count().where("count > 1").select(F.col("row").alias(key)), "repeated")
    if not repeated.isEmpty():
        # One of several equal rows stands for all, as their passes come together.
        once = keyed.join(repeated, key, "left_semi").dropDuplicates([key])
        keyed = keyed.join(repeated, key, "left_anti").unionByName(once)
    ordered = passes.join(keyed, key).repartitionByRange(at, "doc_id")
    return ordered.sortWithinPartitions(at, "doc_id").select(*[F.col(f"`{c}`") for c in docs.columns])
