from __future__ import annotations

import math

import pytest

from braidwork.operators import metrics as m

SCHEMA = "run_id string, epoch int, step int, loss double"


def logged(losses_per_epoch: list[list[float]], every: int) -> list[tuple[int, int, int, float]]:
    """The windows a step-by-step loop reports: (end_epoch, end_step, n, mean)."""
    out, pending = [], []
    for epoch, losses in enumerate(losses_per_epoch, 1):
        for step, loss in enumerate(losses):
            pending.append(loss)
            if (step + 1) % every == 0:
                out.append((epoch, step, len(pending), sum(pending) / len(pending)))
                pending = []
    return out


RUNS = {
    "even": [[0.5] * 4],
    "carry": [[1.0, 2.0, 3.0, 4.0, 5.0], [6.0, 7.0, 8.0, 9.0, 10.0]],
    "short epochs": [[1.0], [2.0, 3.0], [4.0], [5.0, 6.0, 7.0, 8.0]],
    "never": [[1.0], [2.0]],
    "long": [[float(i % 7) for i in range(101)] for _ in range(3)],
}


@pytest.fixture(scope="module")
def steps(spark):
    rows = [
        (run, epoch, step, loss)
        for run, epochs in RUNS.items()
        for epoch, losses in enumerate(epochs, 1)
        for step, loss in enumerate(losses)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("every", [1, 2, 3, 4])
@pytest.mark.parametrize("ordinals", [2, 4096])
def test_windows_equal_a_step_by_step_loop(steps, every, ordinals, monkeypatch):
    monkeypatch.setattr(m, "ORDINALS_PER_BUCKET", ordinals)
    got: dict[str, list] = {}
    for r in m.loss_windows(steps, every).orderBy("run_id", "g").collect():
        assert r["g"] == len(got.setdefault(r["run_id"], []))
        got[r["run_id"]].append((r["end_epoch"], r["end_step"], r["n_losses"], r["window_mean"]))
    for run, epochs in RUNS.items():
        expected = logged(epochs, every)
        assert [x[:3] for x in got.get(run, [])] == [x[:3] for x in expected]
        assert [x[3] for x in got.get(run, [])] == pytest.approx([x[3] for x in expected])


def test_window_size_must_be_positive(steps):
    with pytest.raises(ValueError, match="log_every_n_steps"):
        m.loss_windows(steps, 0)


def test_no_window_runs_over_the_steps(steps, plan_of):
    plan = plan_of(m.close_windows(m.partial_windows(steps, 2), 2))
    assert "SinglePartition" not in plan
    # Windows stand above the aggregate that reduces steps to epoch counts.
    windows = [line for line in plan.split("\n\n")[0].splitlines() if "Window" in line]
    assert windows and all("epoch" not in line for line in windows)
    assert "SortAggregate" not in plan


def test_epoch_mean_is_over_window_means(steps):
    got = {(r["run_id"], r["epoch"]): r["mean_loss"] for r in m.epoch_mean_loss(m.loss_windows(steps, 3)).collect()}
    first, second = logged(RUNS["carry"], 3)
    assert got["carry", 1] == pytest.approx(first[3]) and got["carry", 2] == pytest.approx(second[3])
    assert ("never", 1) not in got


def test_final_loss_is_null_without_a_window(steps):
    runs = steps.select("run_id").distinct()
    got = {r["run_id"]: r["final_loss"] for r in m.final_loss(m.loss_windows(steps, 3), runs).collect()}
    assert got["never"] is None and got["carry"] == pytest.approx(logged(RUNS["carry"], 3)[-1][3])


def plans(spark, rows):
    return m.run_step_plan(
        spark.createDataFrame(
            rows,
            "run_id string, n_batches long, epochs long, warmup_rate double, "
            "lr_init_value double, lr_peak_value double, lr_end_value double",
        )
    )


def test_step_plan_and_its_refusals(spark):
    rows = [(n, b, e, r, 0.0, 0.01, 1e-5) for n, b, e, r in [
        ("p", 100, 3, 0.1), ("floor", 5, 1, 0.1), ("none", 0, 3, 0.1), ("minus", -1, 3, 0.1), ("all", 4, 1, 1.0)]]
    got = {r["run_id"]: (r["total_steps"], r["warmup_steps"], r["status"]) for r in plans(spark, rows).collect()}
    assert got == {
        "p": (300, 30, "ok"),
        "floor": (5, 1, "ok"),
        "none": (None, None, "no_batches"),
        "minus": (None, None, "no_batches"),
        "all": (4, 4, "no_decay_steps"),
    }


def test_schedule_shape(spark):
    rows = [("s", 100, 1, 0.1, 0.0, 1e-2, 1e-5), ("flat", 20, 1, 0.2, 0.0, 0.0, 1e-5)]
    got: dict[str, list[float]] = {}
    for r in m.lr_schedule(plans(spark, rows)).orderBy("run_id", "step").collect():
        got.setdefault(r["run_id"], []).append(r["learning_rate"])
    s = got["s"]
    assert len(s) == 100 and s[0] == 0.0 and s[5] == pytest.approx(5e-3) and s[10] == pytest.approx(1e-2)
    assert all(a >= b for a, b in zip(s[10:], s[11:])) and min(s[10:]) >= 1e-5
    half = 1e-5 + (1e-2 - 1e-5) * 0.5 * (1 + math.cos(math.pi * 0.5))
    assert s[55] == pytest.approx(half)
    assert got["flat"] == [0.0] * 20


def test_long_runs_are_cut_into_stretches(spark, monkeypatch):
    monkeypatch.setattr(m, "STEPS_PER_TASK_ROW", 7)
    rows = m.lr_schedule(plans(spark, [("r", 25, 2, 0.1, 0.0, 0.1, 0.0)])).collect()
    assert sorted(r["step"] for r in rows) == list(range(50))


def test_logged_rate_uses_the_step_within_the_epoch(spark, steps):
    plan = plans(spark, [("carry", 5, 2, 0.1, 0.0, 0.1, 0.0)])
    got = m.logged_lr(m.loss_windows(steps, 3), plan).where("status = 'ok'").orderBy("g").collect()
    curve = {r["step"]: r["learning_rate"] for r in m.lr_schedule(plan).collect()}
    assert [r["learning_rate"] for r in got] == pytest.approx([curve[2], curve[2]])


def test_windows_of_runs_without_a_plan_stay(spark, steps):
    windows = m.loss_windows(steps, 3)
    none = plans(spark, [("other", 5, 2, 0.1, 0.0, 0.1, 0.0)])
    got = m.logged_lr(windows, none).collect()
    assert len(got) == windows.count() > 0
    assert {(r["status"], r["learning_rate"]) for r in got} == {("no_plan", None)}


@pytest.mark.parametrize("ordinals", [2, 4096])
def test_histories_run_on_across_phases(spark, steps, ordinals, monkeypatch):
    monkeypatch.setattr(m, "ORDINALS_PER_BUCKET", ordinals)
    phases = spark.createDataFrame([("carry", "L", 1), ("even", "L", 0), ("never", "L", 2), ("long", "M", 0)], "run_id string, lineage string, phase int")
    got = m.loss_history(m.loss_windows(steps, 2), phases).where("lineage = 'L'").orderBy("ix").collect()
    assert [r["ix"] for r in got] == list(range(len(got)))
    assert [r["phase"] for r in got] == [0, 0, 1, 1, 1, 1]


def test_unknown_metrics_are_reported_and_left_out(spark):
    df = spark.createDataFrame([("loss", 1.0), ("loss", 2.0), ("speed", 3.0)], "name string, value double")
    got = {r["name"]: (r["n"], r["status"]) for r in m.metric_schema_check(df, "name", ["loss"]).collect()}
    assert got == {"loss": (2, "declared"), "speed": (1, "unknown_metric")}
    assert m.record_metrics(df, "name", ["loss"]).count() == 2
