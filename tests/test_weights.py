from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from braidwork.operators import weights as w

NAN = float("nan")


def state(spark, leaves: dict[str, list[float]], chunk: int = 2, kind: str = "param"):
    rows = [(name, kind, [len(v)], v) for name, v in leaves.items()]
    whole = spark.createDataFrame(rows, "leaf string, kind string, shape array<int>, values array<double>")
    return w.chunk_leaves(whole, chunk_size=chunk)


BASE = {"a": [1.0, 2.0], "b": [3.0, 4.0]}


def norms(spark, before, after, **kw):
    return w.compare_norms(state(spark, before), state(spark, after), **kw).collect()[0]


def states(spark, before, after, **kw):
    return w.compare_states(state(spark, before), state(spark, after), **kw).collect()[0]


@pytest.mark.parametrize(
    "after, ratio",
    [(BASE, 1.0), ({"a": [2.0, 4.0], "b": [6.0, 8.0]}, 2.0), ({"a": [0.0, 0.0], "b": [0.0, 0.0]}, 0.0)],
)
def test_norm_ratios_of_scaled_states(spark, after, ratio):
    got = norms(spark, BASE, after)
    assert [got[c] for c in ("median_ratio", "min_ratio", "max_ratio")] == pytest.approx([ratio] * 3)
    assert (got["compared_leaves"], got["skipped_leaves"]) == (2, 0)


@pytest.mark.parametrize("small", [0.0, 1e-15])
def test_leaf_without_norm_is_skipped_and_counted(spark, small):
    got = norms(spark, {"a": [small, small], "b": [1.0, 2.0]}, {"a": [1.0, 2.0], "b": [2.0, 4.0]})
    assert (got["compared_leaves"], got["skipped_leaves"], got["median_ratio"]) == (1, 1, 2.0)


def test_all_leaves_skipped_gives_zeros(spark):
    got = norms(spark, {"a": [0.0]}, {"a": [5.0]})
    assert tuple(got) == (0.0, 0.0, 0.0, 0, 1)


def test_even_count_median_and_finite_variant(spark):
    before = {"a": [1.0], "b": [1.0], "c": [1e-13], "d": [0.0]}
    after = {"a": [1.0], "b": [4.0], "c": [1e-13], "d": [1.0]}
    assert norms(spark, before, after)["median_ratio"] == 2.5
    finite = w.compare_norms_finite(state(spark, before), state(spark, after)).collect()[0]
    assert (finite["median_ratio"], finite["compared_leaves"], finite["skipped_leaves"]) == (1.0, 3, 1)


def test_nan_weights_show_in_both_reports(spark):
    broken = {"a": [1.0, NAN], "b": [3.0, 4.0]}
    got = norms(spark, BASE, broken)
    assert all(math.isnan(got[c]) for c in ("median_ratio", "min_ratio", "max_ratio"))
    row = states(spark, BASE, broken)
    assert all(math.isnan(row[c]) for c in ("median_change", "mean_change", "max_change", "min_change"))
    assert (row["total_params"], row["changed_params"]) == (4, 0)


@pytest.mark.parametrize("compare", [w.compare_norms, w.compare_states])
@pytest.mark.parametrize(
    "after", [{"a": [1.0, 2.0]}, {"a": [1.0, 2.0], "c": [3.0, 4.0]}, {"a": [1.0, 2.0, 3.0], "b": [3.0, 4.0]}]
)
def test_other_structure_is_an_error(spark, compare, after):
    with pytest.raises(ValueError, match="different structures"):
        compare(state(spark, BASE), state(spark, after))


@pytest.mark.parametrize(("one", "two"), [(2, 1), (16, 7), (5, 64), (3, 3)])
def test_tables_may_cut_their_leaves_differently(spark, one, two):
    rng = np.random.default_rng(one)
    before = {"a": rng.random(61).tolist(), "b": rng.random(16).tolist(), "c": [1.0], "d": []}
    after = {k: [x * 1.5 for x in v] for k, v in before.items()}
    b, a, same = state(spark, before, chunk=one), state(spark, after, chunk=two), state(spark, after, chunk=one)
    met = w.overlapping_chunks(b, a).collect()
    assert sorted(x for r in met for x in r["v_before"]) == sorted(x for v in before.values() for x in v)
    assert all(y == x * 1.5 for r in met for x, y in zip(r["v_before"], r["v_after"], strict=True))
    assert w.compare_states(b, a).collect() == w.compare_states(b, same).collect()
    for got, want in zip(*[sorted(w.leaf_change_stats(b, x).collect()) for x in (a, same)], strict=True):
        assert tuple(got) == pytest.approx(tuple(want))
    uneven = a.where("leaf <> 'b'").union(b.where("leaf = 'b'")).union(state(spark, {"e": [0.0]}))
    with pytest.raises(ValueError, match="different structures"):
        w.compare_states(b, uneven)


def test_chunks_without_any_order_of_sizes(spark):
    """Chunk numbers may have gaps and chunks any size; an empty chunk changes nothing."""
    kind = "leaf string, kind string, chunk_id int, values array<double>"
    rows = [("a", "param", 9, [3.0, 4.0, 5.0]), ("a", "param", 2, [1.0]), ("a", "param", 5, [2.0]), ("a", "param", 7, [])]
    whole = [("a", "param", 0, [1.0, 2.0, 3.0, 4.0, 6.0])]
    row = w.compare_states(spark.createDataFrame(rows, kind), spark.createDataFrame(whole, kind)).collect()[0]
    assert (row["total_params"], row["changed_params"], row["max_change"]) == (5, 1, 1.0)


def test_values_are_read_twice_at_most(spark):
    reads = spark.sparkContext.accumulator(0)
    values = np.random.default_rng(1).random(4000).tolist()

    def seen(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    before = state(spark, {"a": [0.0] * 4000}, chunk=50)
    before = before.mapInPandas(seen, before.schema)
    # No bin is small enough to sort, so each middle rank needs several splits.
    row = w.compare_states(before, state(spark, {"a": values}, chunk=50), sort_limit=1).collect()[0]
    assert row["median_change"] == pytest.approx(np.median(values), abs=0)
    assert reads.value <= 2 * 80


def test_structure_diff_names_each_problem(spark):
    after = {"a": [1.0], "c": [1.0]}
    got = {r["leaf"]: r["problem"] for r in w.structure_diff(state(spark, BASE), state(spark, after)).collect()}
    assert got == {"a": "size_differs", "b": "only_before", "c": "only_after"}


def test_identical_and_different_states(spark):
    same = states(spark, BASE, BASE)
    assert tuple(same)[:7] == (4, 0, 0.0, 0.0, 0.0, 0.0, 0.0)
    mixed = states(spark, BASE, {"a": [1.0, 2.0], "b": [300.0, 400.0]})
    assert (mixed["changed_params"], mixed["percent_changed"]) == (2, 50.0)
    assert (mixed["median_change"], mixed["max_change"]) == (297.0 / 2, 396.0)


@pytest.mark.parametrize("delta, changed", [(1e-10, 0), (1e-8, 0), (1.0, 2)])
def test_threshold_is_strict(spark, delta, changed):
    row = states(spark, {"a": [0.0, 0.0]}, {"a": [delta, -delta]})
    assert row["changed_params"] == changed and row["change_threshold"] == 1e-8


@pytest.mark.parametrize("threshold", [0.0, -1.0, NAN])
def test_threshold_must_be_positive(spark, threshold):
    for compare in (w.compare_states, w.leaf_change_stats):
        with pytest.raises(ValueError, match="positive"):
            compare(state(spark, BASE), state(spark, BASE), threshold=threshold)


@pytest.mark.parametrize("after", [{"a": [1.0, 2.0]}, {"a": [1.0, 2.0], "c": [3.0]}, {"a": [1.0], "b": [3.0]}])
def test_leaf_statistics_need_the_same_structure(spark, after):
    before = {"a": [1.0, 2.0], "b": [3.0]}
    with pytest.raises(ValueError):
        w.leaf_change_stats(state(spark, before), state(spark, after)).collect()


def test_leaf_statistics_of_nan_are_nan(spark):
    before, after = {"a": [1.0, 2.0], "b": [3.0]}, {"a": [NAN, 2.5], "b": [3.0]}
    rows = {r["leaf"]: r for r in w.leaf_change_stats(state(spark, before), state(spark, after)).collect()}
    assert all(math.isnan(rows["a"][c]) for c in ("mean_change", "max_change", "min_change"))
    assert (rows["a"]["changed_params"], rows["b"]["max_change"]) == (1, 0.0)


def test_nothing_to_compare_is_an_error(spark):
    with pytest.raises(ValueError, match="no values"):
        states(spark, {"a": []}, {"a": []})


@pytest.mark.parametrize("sort_limit", [1_000_000, 2])
def test_statistics_match_numpy_on_one_dominant_leaf(spark, sort_limit):
    rng = np.random.default_rng(0)
    before = {"big": rng.normal(size=901).tolist(), "small": rng.normal(size=100).tolist()}
    after = {k: (np.array(v) + (rng.random(len(v)) < 0.4) * rng.normal(size=len(v))).tolist() for k, v in before.items()}
    d = np.abs(np.concatenate([before[k] for k in before]) - np.concatenate([after[k] for k in before]))
    row = states(spark, before, after, sort_limit=sort_limit)
    assert row["changed_params"] == (d > 1e-8).sum()
    assert row["median_change"] == np.median(d)
    assert row["max_change"] == d.max() and row["min_change"] == d.min()
    assert row["mean_change"] == pytest.approx(d.mean())
    per_leaf = {r["leaf"]: r for r in w.leaf_change_stats(state(spark, before), state(spark, after)).collect()}
    assert sum(r["changed_params"] for r in per_leaf.values()) == row["changed_params"]
    assert per_leaf["big"]["total_params"] == 901
    ratios = norms(spark, before, after)
    expected = [np.linalg.norm(after[k]) / np.linalg.norm(before[k]) for k in before]
    assert ratios["max_ratio"] == pytest.approx(max(expected))


@pytest.mark.parametrize(
    "median, text",
    [(1.005, "very similar: 0.50%"), (0.97, "moderately different: 3.0%"), (1.5, "grown by 50.0%"), (26.0, "grown by 2500.0%"), (0.5, "shrunk by 50.0%")],
)
def test_norm_verdicts(spark, median, text):
    df = spark.createDataFrame([(median,)], "median_ratio double")
    assert w.norm_verdict(df).collect()[0]["verdict"] == text


@pytest.mark.parametrize(
    "percent, median, text",
    [
        (0.5, 1.0, "nearly identical: 0.50% changed"),
        (20.0, 1.0, "minority changed: 20.0%"),
        (40.05, 1.0, f"minority changed: {40.05:.1f}%"),
        (90.05, 0.125, f"substantially different: {90.05:.1f}% changed, median {0.125:.6f}"),
        (99.25, 3.456e-9, f"subtly different: {99.25:.1f}% changed, median {3.456e-9:.2e}"),
        (80.0, 2e-5, "subtly different: 80.0% changed, median 2.00e-05"),
        (80.0, 0.5, "substantially different: 80.0% changed, median 0.500000"),
    ],
)
def test_state_verdicts(spark, percent, median, text):
    df = spark.createDataFrame([(percent, median, 10, 3)], "percent_changed double, median_change double, total_params long, changed_params long")
    row = w.state_verdict(df).collect()[0]
    assert (row["verdict"], row["unchanged_params"]) == (text, 7)


def test_only_trainable_values_are_counted(spark):
    both = state(spark, BASE).union(state(spark, {"rng": [1.0]}, kind="other"))
    assert w.count_params(both).collect()[0][0] == 4
    assert w.count_params(both.where(F.lit(False))).collect()[0][0] == 0
