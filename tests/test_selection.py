from __future__ import annotations

import math

import numpy as np
import pytest

from braidwork.operators.selection import histogram, median_of, values_at

RNG = np.random.default_rng(3)
CASES = {
    "odd": RNG.random(1001),
    "even": RNG.random(1000),
    "wide": 10.0 ** RNG.uniform(-300, 300, 777),
    "mostly zero": np.concatenate([np.zeros(700), RNG.random(300)]),
    "half zero": np.concatenate([np.zeros(500), RNG.random(500) + 1]),
    "one value": np.full(50, 0.3),
    "two neighbours": np.array([0.1] * 400 + [math.nextafter(0.1, 1)] * 400),
    "single": np.array([7.5]),
    "denormal": np.array([5e-324, 1e-323, 1.5e-323, 2e-323]),
    "infinite tail": np.array([1.0, 2.0, math.inf, math.inf]),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("sort_limit", [1_000_000, 3])
def test_median_is_exact(spark, name, sort_limit):
    values = CASES[name]
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(5)
    got = median_of(df, "x", histogram(df, "x"), sort_limit=sort_limit)
    assert got == float(np.median(values))


def test_any_rank(spark):
    values = np.sort(CASES["wide"])
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    ranks = [0, 1, 388, 776]
    assert values_at(df, "x", histogram(df, "x"), ranks, sort_limit=2) == [values[r] for r in ranks]


def test_nan_wins_and_empty_has_no_median(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,)], "x double")
    assert math.isnan(median_of(df, "x", histogram(df, "x")))
    empty = df.where("x > 1e9 and not isnan(x)")
    assert median_of(empty, "x", histogram(empty, "x")) is None
