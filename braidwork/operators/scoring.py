"""Next-token tables: counting, probabilities, loss and picks.

A logits table is ``ctx, token, logit``. Everything here works on any such
table; ``next_token_table`` builds one from (input, target) sequences. All
reductions per context are built-in aggregates with map-side combine, because
a frequent context may hold a large share of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidwork.functions.draws import uniform
from braidwork.operators.joins import fits_broadcast, lookup_join, salted_join


def check_sequence_length(examples: DataFrame, maxlen: int, column: str = "x") -> DataFrame:
    """Fail the job on a sequence that is longer than the model's positions."""
    too_long = F.raise_error(
        F.format_string(f"sequence of %d tokens exceeds maxlen {maxlen}", F.size(column))
    )
    checked = F.when(F.size(column) > maxlen, too_long.cast("array<int>")).otherwise(F.col(column))
    return examples.withColumn(column, checked)


def pair_counts(examples: DataFrame) -> DataFrame:
    """``ctx, token, n``: how often each target follows each input, over all positions."""
    named = examples.select(F.col("x").alias("ctx"), F.col("y").alias("token"))
    pairs = named.select(F.inline(F.arrays_zip("ctx", "token")))
    return pairs.groupBy("ctx", "token").agg(F.count(F.lit(1)).alias("n"))


def next_token_table(examples: DataFrame, *, alpha: float = 0.0) -> DataFrame:
    """``ctx, token, n, logit`` with logit = ln(n + alpha)."""
    return pair_counts(examples).withColumn("logit", F.log(F.col("n") + F.lit(alpha)))


def log_sum_exp(logits: DataFrame, *, temperature: float = 1.0) -> DataFrame:
    """``ctx, log_norm``: log of the summed exponentials, shifted by the maximum."""
    scaled = F.col("logit") / F.lit(temperature)
    peak = logits.groupBy("ctx").agg(F.max(scaled).alias("peak"))
    shifted = salted_join(logits, peak, ["ctx"], F.col("token"))
    return shifted.groupBy("ctx").agg(
        (F.max("peak") + F.log(F.sum(F.exp(scaled - F.col("peak"))))).alias("log_norm")
    )


def temperature_softmax(logits: DataFrame, temperature: float = 1.0) -> DataFrame:
    """Add ``p``: the probability of each token after its context."""
    if not temperature > 0:
        raise ValueError(f"temperature must be > 0, got {temperature}")
    norm = log_sum_exp(logits, temperature=temperature)
    joined = salted_join(logits, norm, ["ctx"], F.col("token"))
    return joined.withColumn(
        "p", F.exp(F.col("logit") / F.lit(temperature) - F.col("log_norm"))
    ).drop("log_norm")


def cross_entropy(
    pairs: DataFrame, logits: DataFrame, *, mask_token: int | None = None
) -> DataFrame:
    """One row: ``n_positions, loss``, the mean of -log p(target) over all positions.

    ``pairs`` is ``ctx, token, n``. Padding counts like any other position
    unless ``mask_token`` names a target to leave out. A target without a
    logit makes the loss infinite.
    """
    kept = pairs if mask_token is None else pairs.where(F.col("token") != mask_token)
    norms = log_sum_exp(logits)
    scored = kept.select("ctx", "token", "n").join(
        logits.select("ctx", "token", "logit"), ["ctx", "token"], "left"
    )
    nll = salted_join(scored, norms, ["ctx"], F.col("token"), how="left").withColumn(
        "nll", F.coalesce(F.col("log_norm") - F.col("logit"), F.lit(float("inf")))
    )
    return nll.agg(
        F.sum("n").alias("n_positions"),
        (F.sum(F.col("nll") * F.col("n")) / F.sum("n")).alias("loss"),
    )


def _pick(logits: DataFrame, score: Column) -> DataFrame:
    # Ties go to the smallest token id.
    best = F.max_by("token", F.struct(score.alias("s"), (-F.col("token")).alias("t")))
    return logits.groupBy("ctx").agg(best.alias("token"))


def greedy_next(logits: DataFrame) -> DataFrame:
    """``ctx, token``: the most probable next token of every context."""
    return _pick(logits, F.col("logit"))


def cumulative_table(logits: DataFrame, *, temperature: float = 1.0) -> DataFrame:
    """``ctx, tokens, cum``: one row per context with its tokens in order and the running sums of
    their softmax weights; a row holds at most one entry per token of the vocabulary."""
    if not temperature > 0:
        raise ValueError(f"temperature must be > 0, got {temperature}")
    by_ctx = Window.partitionBy("ctx")
    weight = F.exp((F.col("logit") - F.max("logit").over(by_ctx)) / F.lit(temperature))
    running = by_ctx.orderBy("token").rowsBetween(Window.unboundedPreceding, 0)
    summed = logits.select("ctx", "token", weight.alias("w")).select(
        "ctx", "token", F.sum("w").over(running).alias("cum")
    )
    ordered = F.array_sort(F.collect_list(F.struct("token", "cum")))
    packed = summed.groupBy("ctx").agg(ordered.alias("o"))
    return packed.select("ctx", F.col("o.token").alias("tokens"), F.col("o.cum").alias("cum"))


# A binary search of this many halvings covers any array that Spark can hold.
_JUMPS = [1 << k for k in range(30, -1, -1)]


def draw(tokens: Column, cum: Column, uniform_draw: Column) -> Column:
    """The first token whose running sum reaches the drawn share of the whole: one draw, one search."""
    target = uniform_draw * F.element_at(cum, -1)
    below = F.aggregate(
        F.filter(F.array(*map(F.lit, _JUMPS)), lambda jump: jump <= F.size(cum)),
        F.lit(0),
        # How many running sums lie below the target.
        lambda lo, jump: F.when(F.get(cum, lo + jump - 1) < target, lo + jump).otherwise(lo),
    )
    return F.get(tokens, below)


def sample_next(logits: DataFrame, *, temperature: float = 1.0, seed: int) -> DataFrame:
    """``ctx, token``: one seeded draw for every context."""
    table = cumulative_table(logits, temperature=temperature)
    return table.select("ctx", draw(F.col("tokens"), F.col("cum"), uniform(seed, F.col("ctx"))).alias("token"))


PAIR_ROWS = 100_000


def embed_lookup(
    sequences: DataFrame,
    token_table: DataFrame,
    position_table: DataFrame,
    *,
    id_col: str,
    maxlen: int,
    tokens_col: str = "tokens",
    derive: Sequence[Column] = (),
) -> DataFrame:
    """``id, pos, token, vector``: token vector plus position vector, element by element.

    With ``derive`` (named expressions of ``vector``) their results stand in its place. A vector depends on token and position only. Where there are few such pairs
    (``PAIR_ROWS``, measured) their sums and what is derived are formed once and broadcast; else the
    position table is broadcast and frequent tokens are split over tasks. A token or
    position without a vector fails the job.
    """
    placed = sequences.select(id_col, F.posexplode(tokens_col).alias("pos", "token"))
    tokens = token_table.select("token", F.col("vector").cast("array<double>").alias("_tv"))
    positions = position_table.where(F.col("pos").between(0, maxlen - 1)).select(
        "pos", F.col("vector").cast("array<double>").alias("_pv")
    )
    missing = F.raise_error(F.format_string("no vector for token %d at position %d", "token", "pos"))
    wanted = list(derive) or [F.col("vector")]
    if fits_broadcast(tokens, max_rows=PAIR_ROWS // maxlen):
        # Bounded by PAIR_ROWS.
        placed_tokens = tokens.withColumn("pos", F.explode(F.sequence(F.lit(0), F.lit(maxlen - 1))))
        pairs = placed_tokens.join(F.broadcast(positions), "pos").select(
            "token", "pos", F.zip_with("_tv", "_pv", lambda t, p: t + p).alias("vector")
        ).where("vector IS NOT NULL").select("token", "pos", F.struct(*wanted).alias("_found"))
        joined = placed.join(F.broadcast(pairs), ["token", "pos"], "left")
    else:
        joined = lookup_join(
            placed, tokens, ["token"], F.col("pos"), broadcast=fits_broadcast(tokens), how="left"
        ).join(F.broadcast(positions), "pos", "left")
        added = joined.withColumn("vector", F.zip_with("_tv", "_pv", lambda t, p: t + p))
        joined = added.withColumn("_found", F.when(F.col("vector").isNotNull(), F.struct(*wanted)))
    kind = joined.schema["_found"].dataType
    found = F.coalesce("_found", missing.cast(kind))
    return joined.select(id_col, "pos", "token", found.alias("_found")).select(id_col, "pos", "token", "_found.*")
