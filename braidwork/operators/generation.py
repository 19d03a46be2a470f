"""Token generation for a whole table of prompts at once.

All prompts advance together, one token per round. Scores depend on the longest known
context that a prompt ends with, so its state is its last few tokens and the tokens
produced so far; prompts that are done stop taking part.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidwork.configs import InferenceConfig
from braidwork.functions.draws import uniform
from braidwork.functions.tokens import last_tokens
from braidwork.operators.contexts import suffix_keys
from braidwork.operators.joins import BROADCAST_ROWS, fits_broadcast, split_join
from braidwork.operators.scoring import cumulative_table, draw, greedy_next
from braidwork.session import materialize

ROUNDS_PER_STAGE = 8


def prompt_problems(prompts: DataFrame, id_col: str = "prompt_id") -> DataFrame:
    """Prompts that cannot be continued because they hold no token."""
    return prompts.where(F.coalesce(F.size("tokens"), F.lit(0)) <= 0).select(
        id_col, F.lit("empty_prompt").alias("problem")
    )


def _spread(state: DataFrame) -> DataFrame:
    """Even out the prompts: the state is small, the work per row is not."""
    n = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return state.repartition(n, "prompt_id")


def generate(
    prompts: DataFrame,
    logits: DataFrame,
    config: InferenceConfig,
    *,
    end_token: int,
    greedy: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``prompt_id, tokens, new_tokens``: every prompt (ids are unique) with its continuation.

    ``logits`` is ``ctx, token, logit``; ``ctx`` is a token or an array of the last
    tokens (``contexts.context_table``). Of the contexts in the table that a prompt ends
    with the longest decides. Stops after ``max_new_tokens`` rounds, or earlier for a
    prompt that draws the end token (which is not appended) or that no context fits.
    Empty prompts are refused. Without a seed in the configuration a fresh one is drawn.

    The table is reduced to one row per context first: its best token, or its running
    sums for drawing by one digest and one search. While that has at most
    ``broadcast_rows`` rows (and is small in bytes) a round is a broadcast join per
    context length and a projection; a larger one is shuffled and joined once per round.
    """
    prompts = materialize(prompts.select("prompt_id", "tokens"), "prompts")
    if prompt_problems(prompts).limit(1).count():
        raise ValueError("every prompt must hold at least one token")
    seed = config.seed if config.seed is not None else random.SystemRandom().randrange(2**31)
    table = logits.select("ctx", "token", "logit")
    if not isinstance(table.schema["ctx"].dataType, T.ArrayType):
        table = table.withColumn("ctx", F.array("ctx"))
    if greedy:
        lookup = greedy_next(table)
    else:
        lookup = cumulative_table(table, temperature=config.temperature)
    lookup = materialize(lookup, "lookup")
    order = lookup.agg(F.max(F.size("ctx"))).first()[0] or 1
    found = [c for c in lookup.columns if c != "ctx"]

    def pick(step: int) -> Column:
        if greedy:
            return F.col("token").cast("int")
        drawn = uniform(seed, F.col("prompt_id"), F.lit(step))
        return draw(F.col("tokens"), F.col("cum"), drawn).cast("int")

    if fits_broadcast(lookup, max_rows=broadcast_rows):
        known = F.broadcast(lookup)

        def advance(state: DataFrame, step: int) -> DataFrame:
            best = state
            for k in range(order, 0, -1):
                own = known.select(F.col("ctx").alias(f"ctx{k}"), F.struct(*found).alias(f"found{k}"))
                key = F.when(F.size("last") >= k, F.slice("last", -k, k))
                best = best.join(own, key == F.col(f"ctx{k}"), "left").drop(f"ctx{k}")
            longest = F.coalesce(*[F.col(f"found{k}") for k in range(order, 0, -1)])
            best = best.select("prompt_id", "last", "new_tokens", longest.alias("found"))
            return best.select("prompt_id", "last", "new_tokens", "found.*").withColumn("pick", pick(step))
    else:

        def advance(state: DataFrame, step: int) -> DataFrame:
            # The state travels with its keys: one join and one aggregate per round. The table is
            # not repeated: only contexts that very many prompts end with are cut.
            keys = F.explode_outer(suffix_keys(F.col("last"), order))
            keyed = materialize(state.select("*", keys.alias("ctx")), "keyed")
            met = split_join(keyed, lookup.hint("merge"), ["ctx"], F.xxhash64("prompt_id"), how="left")
            longest = F.when(F.col(found[0]).isNotNull(), F.size("ctx"))
            return met.groupBy("prompt_id").agg(
                F.first("last").alias("last"),
                F.first("new_tokens").alias("new_tokens"),
                *[F.max_by(c, longest).alias(c) for c in found],
            ).withColumn("pick", pick(step))

    state = prompts.select(
        "prompt_id",
        last_tokens(F.col("tokens"), order).alias("last"),
        F.array().cast("array<int>").alias("new_tokens"),
    )
    state = _spread(state)
    for step in range(config.max_new_tokens):
        going_on = F.col("pick").isNotNull() & (F.col("pick") != end_token)
        state = advance(state, step).select(
            "prompt_id",
            F.when(going_on, last_tokens(F.concat("last", F.array("pick")), order)).alias("last"),
            F.when(going_on, F.concat("new_tokens", F.array("pick")))
            .otherwise(F.col("new_tokens"))
            .alias("new_tokens"),
        )
        if (step + 1) % ROUNDS_PER_STAGE == 0 and step + 1 < config.max_new_tokens:
            stored = materialize(state, "generation")
            if stored.where(F.col("last").isNotNull()).isEmpty():
                state = stored
                break
            state = _spread(stored)
    return prompts.join(state.select("prompt_id", "new_tokens"), "prompt_id").select(
        "prompt_id", F.concat("tokens", "new_tokens").alias("tokens"), "new_tokens"
    )
