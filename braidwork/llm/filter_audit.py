"""Interaction audit of document filters over every order they could be applied in.

A document is described by the set (mask) of filters it fails. In a given order it
is removed at the first filter of its mask, so all orders that begin with the same
letters treat it alike, and in lexicographic order those are one interval of Lehmer
ranks. The audit therefore needs no pass per order: documents are counted by part,
mask and labels, each mask's removals become +count at the first rank of an
interval and -count behind its last one, and prefix sums over the ranks give every
order at once.

Duplicates (filter E) are counted without meeting in one task: equal texts share
all other bits, so they collapse to one row per part and labels before any shuffle
by text, with the smallest id and how many rows bear it.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidwork.session import materialize

FILTERS = "ABCDE"
# The limits of the five filters.
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_UPPER_PERCENT = 10
SIGNS = r"[#$%&*|]"
_BLANKS = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column) -> Column:
    """Bits 1, 2, 4 and 8 for the filters A to D that a text fails; ``text`` must not be null."""
    words = F.array_remove(F.split(text, _BLANKS), "")

    def bits(w: Column) -> Column:
        n, distinct = F.size(w), F.size(F.array_distinct(w))
        few = (n < LEAST_WORDS).cast("int")
        dull = (100 * distinct.cast("long") < LEAST_DISTINCT_PERCENT * n.cast("long")).cast("int")
        return few + 2 * dull

    # The words are cut once: a one-element array carries them to both counts.
    by_words = F.transform(F.array(words), bits)[0]
    size = F.char_length(text).cast("long")
    upper = size - F.char_length(F.translate(text, _UPPER, ""))
    loud = (100 * upper > MOST_UPPER_PERCENT * size).cast("int")
    return by_words + 4 * loud + 8 * text.rlike(SIGNS).cast("int")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by language and set of failed filters.

    ``docs`` has ``doc_id, lang, text``; ``labels`` has ``doc_id, quality, toxic``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    seen = docs.select(
        "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text_failures(text).cast("byte").alias("bits"),
    )
    # One row per id and text, so that a row that is repeated very often is one row from here on.
    seen = seen.groupBy("doc_id", "part", "digest", "bits").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    marked = seen.join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    has_id = F.col("doc_id").isNotNull()
    texts = marked.groupBy("digest", "part", "bits", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(has_id, F.col("n")).otherwise(0)).alias("n_ids"),
        F.min(F.when(has_id, F.struct("doc_id", "n"))).alias("first"),
    )
    # At most four rows per text and language.
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    own = F.when(F.col("first.doc_id") == smallest, F.col("first.n")).otherwise(0)
    copies = texts.select(
        "part", "bits", "good", "toxic", "n", F.when(F.col("n_ids") > 0, F.col("n_ids") - own).otherwise(0).alias("late")
    )
    split = F.array(
        F.struct(F.col("bits").cast("int").alias("mask"), (F.col("n") - F.col("late")).alias("n")),
        F.struct((F.col("bits") + 16).cast("int").alias("mask"), F.col("late").alias("n")),
    )
    each = copies.select("part", "good", "toxic", F.inline(split))
    return each.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def lehmer_rank(order: tuple[int, ...]) -> int:
    """Lexicographic rank of a permutation of 0 .. n-1, or of the first one that begins with ``order``."""
    n, rank = len(FILTERS), 0
    for i, x in enumerate(order):
        rank += (x - sum(y < x for y in order[:i])) * factorial(n - 1 - i)
    return rank


def removal_intervals() -> list[tuple[int, int, int, int]]:
    """``mask, step, first rank, rank behind the last``: where each mask is removed at each step."""
    out = []
    for step in range(1, len(FILTERS) + 1):
        for start in permutations(range(len(FILTERS)), step):
            passed = sum(1 << f for f in start[:-1])
            lo = lehmer_rank(start)
            hi = lo + factorial(len(FILTERS) - step)
            for mask in range(1 << len(FILTERS)):
                if not mask & passed and mask >> start[-1] & 1:
                    out.append((mask, step, lo, hi))
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per language, order of the five filters and step: what the step removes and what it costs.

    ``part`` is the language (null: the empty string), ``filter_order`` one of the 120
    orders, ``step`` 1 to 5. A null text counts as empty. A row with a null id is
    never a copy and makes no other row one; rows of equal id and text are not copies
    of each other. A document is good (toxic) if any label row of its id says so; ids
    without labels are neither. No documents, no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    counts = materialize(mask_counts(docs, labels), "masks")
    names = ["n", "good", "toxic"]
    table = spark.createDataFrame(removal_intervals(), "mask int, step int, lo int, hi int")
    # 32 masks at most per language meet a fixed table of intervals.
    hit = counts.join(F.broadcast(table), "mask")
    ends = F.array(
        F.struct(F.col("lo").alias("rank"), *[F.col(c) for c in names]),
        F.struct(F.col("hi").alias("rank"), *[(-F.col(c)).alias(c) for c in names]),
    )
    deltas = hit.select("part", "step", F.inline(ends)).groupBy("part", "step", "rank").agg(
        *[F.sum(c).alias(c) for c in names]
    )
    letters = [
        (step + 1, lehmer_rank(order), "".join(FILTERS[f] for f in order), order[step])
        for order in permutations(range(len(FILTERS))) for step in range(len(FILTERS))
    ]
    steps = F.broadcast(spark.createDataFrame(letters, "step int, rank int, filter_order string, filter int"))
    fails = [F.sum(F.when(F.col("mask").bitwiseAND(1 << f) != 0, F.col("n")).otherwise(0)) for f in range(len(FILTERS))]
    alone = [F.sum(F.when(F.col("mask") == 1 << f, F.col("n")).otherwise(0)) for f in range(len(FILTERS))]
    parts = counts.groupBy("part").agg(
        F.sum("n").alias("total"), F.array(*fails).alias("fails"), F.array(*alone).alias("alone")
    )
    # A fixed grid of 600 rows per language.
    ranks = F.explode(F.sequence(F.lit(0), F.lit(factorial(len(FILTERS)) - 1))).alias("rank")
    grid = parts.select("*", ranks).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    grid = grid.join(steps, ["rank", "step"]).join(deltas, ["part", "step", "rank"], "left")
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    summed = grid.select(
        "part", "step", "rank", "filter_order", "filter", "total", F.get("fails", "filter").alias("fails"),
        F.get("alone", "filter").alias("unique_fails"), *[F.sum(F.coalesce(c, F.lit(0))).over(along).alias(c) for c in names],
    )
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return summed.select(
        "part", "filter_order", "step",
        (F.col("total") - F.sum("n").over(so_far)).alias("kept"),
        F.col("n").alias("removed"), (F.col("fails") - F.col("n")).alias("redundant"), "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )
