"""Variable-order contexts: what follows the last few tokens, not only the last one.

Sequences are counted once, by all their (context of ``order`` tokens, target) windows;
shorter contexts and continuation counts are sums over these distinct windows and never
read the sequences again. A context table is ``ctx array<int>, token, n, logit`` with
contexts of 1 to ``order`` tokens; of the contexts that a sequence ends with, the longest
one in the table decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.operators.joins import split_join
from braidwork.session import materialize

# Stands before the first token of a sequence; no vocabulary has it.
START = -1


def _names(order: int) -> list[str]:
    """Columns of a context of ``order`` tokens, the earliest first."""
    return [f"c{k}" for k in range(order, 0, -1)]


def gram_counts(examples: DataFrame, order: int) -> DataFrame:
    """``c<order> .. c1, token, n``: how often each target of ``y`` follows the last ``order``
    tokens of ``x``, over all positions; tokens before the first one are ``START``."""
    if order < 1:
        raise ValueError(f"order must be >= 1, got {order}")
    padded = examples.select(
        F.concat(F.array_repeat(F.lit(START), order - 1), "x").alias("x"), F.size("x").alias("n"), "y"
    )
    columns = [F.slice("x", F.lit(order - k + 1), F.col("n")).alias(f"c{k}") for k in range(order, 0, -1)]
    shifted = padded.where("n > 0").select(*columns, F.col("y").alias("token"))
    rows = shifted.select(F.inline(F.arrays_zip(*_names(order), "token")))
    return rows.groupBy(*_names(order), "token").agg(F.count(F.lit(1)).alias("n"))


def context_table(grams: DataFrame, order: int, *, alpha: float = 0.0) -> DataFrame:
    """``ctx, token, n, logit`` for all contexts of 1 to ``order`` tokens, logit = ln(n + alpha)."""
    names = _names(order)
    suffixes = [F.when(F.col(names[-k]) != START, F.array(*names[-k:])) for k in range(1, order + 1)]
    each = grams.select(F.explode(F.array(*suffixes)).alias("ctx"), "token", "n").where(F.col("ctx").isNotNull())
    counts = each.groupBy("ctx", "token").agg(F.sum("n").alias("n"))
    return counts.withColumn("logit", F.log(F.col("n") + F.lit(alpha)))


def suffix_keys(tokens: Column, order: int) -> Column:
    """The last 1 to ``order`` tokens, the longest first; lengths the sequence does not have are null."""
    keys = [F.when(F.size(tokens) >= k, F.slice(tokens, -k, k)) for k in range(order, 0, -1)]
    return F.array(*keys)


def _levels(grams: DataFrame, order: int) -> list[tuple[DataFrame, DataFrame]]:
    """Per context length 0 to ``order``: ``c.., token, n`` and ``c.., total, types``.

    The longest contexts count occurrences, shorter ones the different tokens in front.
    """
    levels = []
    for k in range(order, -1, -1):
        names = _names(order)[order - k :]
        count = F.sum("n") if k == order else F.count(F.lit(1))
        source = grams if k == order else levels[-1][0]
        entries = materialize(source.groupBy(*names, "token").agg(count.alias("n")), "entries")
        totals = entries.groupBy(*names).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
        levels.append((entries, materialize(totals, "totals")))
    return levels[::-1]


def held_out_loss(
    held: DataFrame, grams: DataFrame, order: int, *, vocab_size: int, discount: float = 0.75
) -> DataFrame:
    """One row ``n_positions, loss``: mean of -log p(target) over windows that were not counted.

    ``held`` and ``grams`` are ``gram_counts`` of the same order. Every count gives up
    ``discount``, and the mass given up goes to the next shorter context, whose counts
    are of different tokens in front; the empty context gives it to all ``vocab_size``
    tokens alike, so that no target is impossible. A context that was never counted
    passes everything on. No held-out window: 0 and null.
    """
    if not 0 < discount < 1:
        raise ValueError(f"discount must be between 0 and 1, got {discount}")
    scored = held.withColumn("p", F.lit(1.0 / vocab_size)).withColumnRenamed("n", "held")
    for k, (entries, totals) in enumerate(_levels(grams, order)):
        names = _names(order)[order - k :]
        scored = materialize(scored, "scored")
        # Both are keyed lookups; a context that fills many windows is split over tasks.
        salt = F.xxhash64(*_names(order), "token")
        scored = split_join(scored, entries, [*names, "token"], salt, how="left")
        if names:
            scored = split_join(materialize(scored, "scored"), totals, names, salt, how="left")
        else:
            # One row.
            scored = scored.join(F.broadcast(totals), F.lit(True), "left")
        own = F.greatest(F.coalesce("n", F.lit(0)) - F.lit(discount), F.lit(0.0)) / F.col("total")
        passed = F.lit(discount) * F.col("types") / F.col("total") * F.col("p")
        scored = scored.withColumn("p", F.when(F.col("total") > 0, own + passed).otherwise(F.col("p")))
        scored = scored.drop("n", "total", "types")
    return scored.agg(
        F.coalesce(F.sum("held"), F.lit(0)).alias("n_positions"),
        (F.sum(-F.log("p") * F.col("held")) / F.sum("held")).alias("loss"),
    )
