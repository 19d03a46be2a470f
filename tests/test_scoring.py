from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from braidwork.configs import InferenceConfig
from braidwork.functions.draws import uniform
from braidwork.operators import generation as g
from braidwork.operators import scoring as s

LOGITS = [(0, 1, 0.0), (0, 2, 1.0), (0, 3, 1.0), (1, 0, -1e9), (1, 2, 0.0), (2, 5, 700.0), (2, 6, 710.0)]


@pytest.fixture(scope="module")
def logits(spark):
    return spark.createDataFrame(LOGITS, "ctx int, token int, logit double").repartition(3)


def softmax(values, temperature=1.0):
    z = np.array(values) / temperature
    e = np.exp(z - z.max())
    return e / e.sum()


@pytest.mark.parametrize("temperature", [0.5, 1.0, 2.0])
def test_probabilities_follow_the_temperature(logits, temperature):
    got = {(r["ctx"], r["token"]): r["p"] for r in s.temperature_softmax(logits, temperature).collect()}
    for ctx in (0, 1, 2):
        own = [(t, v) for c, t, v in LOGITS if c == ctx]
        for (token, _), p in zip(own, softmax([v for _, v in own], temperature)):
            assert got[ctx, token] == pytest.approx(p, abs=1e-12)
    with pytest.raises(ValueError, match="temperature"):
        s.temperature_softmax(logits, 0.0)


def test_greedy_pick_prefers_the_smaller_token_on_a_tie(logits):
    assert {r["ctx"]: r["token"] for r in s.greedy_next(logits).collect()} == {0: 2, 1: 2, 2: 6}


def test_draws_are_uniform_and_layout_free(spark):
    df = spark.range(20_000)
    u = np.array([r[0] for r in df.select(uniform(3, F.col("id"))).collect()])
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01 and abs(u.var() - 1 / 12) < 0.005
    again = df.repartition(7).select("id", uniform(3, F.col("id")).alias("u")).orderBy("id").collect()
    assert [r["u"] for r in again] == u.tolist()


def test_samples_follow_the_softmax(spark):
    weights = [0.0, 1.0, 2.0]
    df = spark.range(6000).select(F.col("id").alias("ctx"), F.posexplode(F.array(*map(F.lit, weights))).alias("token", "logit"))
    picks = Counter(r["token"] for r in s.sample_next(df, temperature=2.0, seed=11).collect())
    for token, p in enumerate(softmax(weights, 2.0)):
        assert picks[token] / 6000 == pytest.approx(p, abs=0.025)


def test_same_seed_same_sample(logits):
    def draw(seed, df):
        return {r["ctx"]: r["token"] for r in s.sample_next(df, seed=seed).collect()}

    assert draw(1, logits) == draw(1, logits.repartition(5))
    assert any(draw(k, logits) != draw(1, logits) for k in range(2, 12))


def test_pair_counts_keep_padding(spark):
    df = spark.createDataFrame([([1, 2, 0, 0], [2, 0, 0, 0])], "x array<int>, y array<int>")
    got = {(r["ctx"], r["token"]): (r["n"], r["logit"]) for r in s.next_token_table(df, alpha=1.0).collect()}
    assert {k: v[0] for k, v in got.items()} == {(1, 2): 1, (2, 0): 1, (0, 0): 2}
    assert got[0, 0][1] == pytest.approx(math.log(3))


def test_cross_entropy_is_the_mean_over_all_positions(spark, logits):
    pairs = spark.createDataFrame([(0, 1, 3), (0, 2, 1), (1, 2, 4), (2, 6, 2)], "ctx int, token int, n long")
    p0 = softmax([0.0, 1.0, 1.0])
    p2 = softmax([700.0, 710.0])
    expected = -(3 * math.log(p0[0]) + math.log(p0[1]) + 0.0 + 2 * math.log(p2[1])) / 10
    row = s.cross_entropy(pairs, logits).collect()[0]
    assert (row["n_positions"], row["loss"]) == (10, pytest.approx(expected))
    masked = s.cross_entropy(pairs, logits, mask_token=2).collect()[0]
    assert masked["n_positions"] == 5
    unseen = pairs.union(spark.createDataFrame([(0, 99, 1)], pairs.schema))
    assert s.cross_entropy(unseen, logits).collect()[0]["loss"] == math.inf


def test_embedding_is_token_plus_position(spark):
    rows = spark.createDataFrame([("s", [1, 0, 1])], "id string, tokens array<int>")
    tokens = spark.createDataFrame([(0, [1.0, 2.0]), (1, [10.0, 20.0])], "token int, vector array<float>")
    positions = spark.createDataFrame([(i, [0.5 * i, 0.0]) for i in range(3)], "pos int, vector array<float>")
    got = s.embed_lookup(rows, tokens, positions, id_col="id", maxlen=3).orderBy("pos").collect()
    assert [r["vector"] for r in got] == [[10.0, 20.0], [1.5, 2.0], [11.0, 20.0]]


def test_tokens_without_a_vector_fail_the_job(spark):
    rows = spark.createDataFrame([("s", [1, 7])], "id string, tokens array<int>")
    tokens = spark.createDataFrame([(1, [1.0])], "token int, vector array<float>")
    positions = spark.createDataFrame([(0, [0.0]), (1, [0.0])], "pos int, vector array<float>")
    with pytest.raises(PySparkException, match="no vector for token 7 at position 1"):
        s.embed_lookup(rows, tokens, positions, id_col="id", maxlen=2).collect()


def test_too_long_sequences_fail_the_job(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "x array<int>")
    assert s.check_sequence_length(df, 3).collect()[0]["x"] == [1, 2, 3]
    with pytest.raises(PySparkException, match="exceeds maxlen 2"):
        s.check_sequence_length(df, 2).collect()


# --- generation ---

CHAIN = [(1, 2, 5.0), (1, 9, 0.0), (2, 3, 5.0), (3, 99, 5.0), (3, 1, 0.0), (4, 4, 1.0), (8, 1, 0.0), (8, 4, 0.0)]
END = 99


@pytest.fixture(scope="module")
def chain(spark):
    return spark.createDataFrame(CHAIN, "ctx int, token int, logit double")


def prompts(spark, *tokens):
    return spark.createDataFrame(list(enumerate(tokens)), "prompt_id long, tokens array<int>")


def run(spark, chain, tokens, broadcast_rows=1000, **kw):
    config = InferenceConfig(**{k: v for k, v in kw.items() if k in ("max_new_tokens", "temperature", "seed")})
    out = g.generate(
        prompts(spark, *tokens), chain, config, end_token=END, greedy=kw.get("greedy", False), broadcast_rows=broadcast_rows
    )
    return {r["prompt_id"]: (r["tokens"], r["new_tokens"]) for r in out.collect()}


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_greedy_generation_stops_at_end_cap_and_dead_end(spark, chain, broadcast_rows):
    got = run(spark, chain, [[7, 1], [4], [9], [3]], broadcast_rows, max_new_tokens=5, greedy=True)
    assert got == {
        0: ([7, 1, 2, 3], [2, 3]),
        1: ([4] * 6, [4] * 5),
        2: ([9], []),
        3: ([3], []),
    }


def test_both_physical_forms_draw_the_same_tokens(spark, chain):
    many = [[8], [1], [8, 8], [3]] * 5
    one = run(spark, chain, many, 1000, max_new_tokens=10, temperature=3.0, seed=5)
    two = run(spark, chain, many, 0, max_new_tokens=10, temperature=3.0, seed=5)
    other = run(spark, chain, many, 1000, max_new_tokens=10, temperature=3.0, seed=6)
    assert one == two != other


def test_equal_prompts_are_drawn_independently(spark, chain):
    got = run(spark, chain, [[8]] * 40, max_new_tokens=1, seed=1)
    assert {tuple(v[1]) for v in got.values()} == {(1,), (4,)}


def test_long_generation_is_stored_in_between(spark, chain):
    got = run(spark, chain, [[4]], max_new_tokens=g.ROUNDS_PER_STAGE * 2 + 1, seed=0)
    assert got[0][1] == [4] * (g.ROUNDS_PER_STAGE * 2 + 1)


def test_no_seed_still_generates(spark, chain):
    assert run(spark, chain, [[4]], max_new_tokens=2)[0][0] == [4, 4, 4]


@pytest.mark.parametrize("empty", [[], None])
def test_empty_prompts_are_refused(spark, chain, empty):
    assert g.prompt_problems(prompts(spark, [1], empty)).count() == 1
    with pytest.raises(ValueError, match="at least one token"):
        run(spark, chain, [[1], empty])


def test_rounds_need_no_shuffle_once_prompts_are_spread(spark, chain, plan_of):
    config = InferenceConfig(max_new_tokens=3, seed=1)
    plan = plan_of(g.generate(prompts(spark, [4], [8]), chain, config, end_token=END))
    tree = plan.split("\n\n")[0]
    assert tree.count("BroadcastHashJoin LeftOuter") == 3
    assert "SortMergeJoin LeftOuter" not in tree and "HashAggregate" not in tree


def test_large_tables_take_one_join_per_round(spark, plan_of):
    logits = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.5), (2, 3, 0.1)], "ctx int, token int, logit double")
    asked = spark.createDataFrame([(i, [1]) for i in range(5)], "prompt_id long, tokens array<int>")
    joins = []
    for rounds in (1, 2, 3, 4):
        config = InferenceConfig(max_new_tokens=rounds, seed=1)
        done = g.generate(asked, logits, config, end_token=9, broadcast_rows=0)
        joins.append(plan_of(done).count("Join LeftOuter"))
        assert [r["new_tokens"] for r in done.collect() if r["prompt_id"] == 0][0][:1] == [2]
    assert [b - a for a, b in zip(joins, joins[1:])] == [joins[1] - joins[0]] * 3
