from __future__ import annotations

import dataclasses
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from braidwork.configs import (
    InferenceConfig,
    ModelConfig,
    TokenizerConfig,
    TrainingConfig,
)
from braidwork.operators import catalog as c
from braidwork.operators import rules as r
from braidwork.operators import weights as w
from braidwork.sources import bundles as b

DOC = {
    "cumulative_epochs_completed": 7,
    "final_loss": 0.25,
    "model_config": dataclasses.asdict(ModelConfig()),
    "training_config": dataclasses.asdict(TrainingConfig()),
    "tokenizer_config": dataclasses.asdict(TokenizerConfig()),
    "created_at": "2024-05-06T07:08:09",
}


def without(*keys):
    return json.dumps({k: v for k, v in DOC.items() if k not in keys})


@pytest.mark.parametrize(
    "text, readable",
    [
        (json.dumps(DOC), True),
        (json.dumps(DOC, indent=2), True),
        (without("final_loss", "model_config", "training_config", "tokenizer_config", "created_at"), True),
        (without("cumulative_epochs_completed"), False),
        (json.dumps(DOC | {"cumulative_epochs_completed": None}), False),
        (json.dumps([DOC]), False),
        (json.dumps(DOC)[:60], False),
        ("not json", False),
        ("", False),
        (None, False),
    ],
)
def test_metadata_is_read_or_absent(spark, text, readable):
    df = spark.createDataFrame([(text,)], "t string").select(b.parse_metadata(F.col("t")).alias("m"))
    got = df.collect()[0]["m"]
    assert (got is not None) == readable
    if readable:
        assert got["cumulative_epochs_completed"] == 7


@pytest.fixture
def store(spark, tmp_path):
    """Bundles one to three with weights; four has a sidecar only; two has no sidecar."""
    root = str(tmp_path / "store")
    rows = [(f"b{i}", f"leaf{j}", "param", [2], [float(i), float(j)]) for i in (1, 2, 3) for j in range(2)]
    whole = spark.createDataFrame(rows, "bundle string, leaf string, kind string, shape array<int>, values array<double>")
    side = spark.createDataFrame(
        [("b1", json.dumps(DOC, indent=1)), ("b3", without("model_config")), ("b4", json.dumps(DOC))],
        "bundle string, json string",
    )
    b.write_bundles(w.chunk_leaves(whole), root, metadata=side)
    return root


def test_catalog_lists_bundles_with_weights_only(spark, store):
    got = b.list_bundles(spark, store).collect()
    assert {x["bundle"] for x in got} == {"b1", "b2", "b3"}
    assert all(x["n_bytes"] > 0 and x["mtime"] is not None for x in got)
    assert b.list_bundles(spark, store + "-none").count() == 0
    assert b.read_metadata(spark, store + "-none").count() == 0


def test_restore_status_and_resume_context(spark, store):
    listed, side = b.list_bundles(spark, store), b.read_metadata(spark, store)
    status = {x["bundle"]: x["status"] for x in b.restore_status(listed, side).collect()}
    assert status == {"b1": "ok", "b2": "no_metadata", "b3": "no_model_config"}
    context = {x["bundle"]: (x["previous_epochs"], x["status"]) for x in c.resume_context(listed, side).collect()}
    assert context == {"b1": (7, "ok"), "b2": (None, "no_readable_metadata"), "b3": (7, "ok")}


def test_load_errors_are_told_apart(spark, store):
    with pytest.raises(FileNotFoundError, match="no bundle"):
        b.load_weights(spark, store, "b9")
    with pytest.raises(FileNotFoundError, match="has no weights"):
        b.load_weights(spark, store, "b4")
    other = b.load_weights(spark, store, "b1").where("leaf = 'leaf0'")
    with pytest.raises(ValueError, match="different structures"):
        b.load_weights(spark, store, "b1", expected=other)
    with pytest.raises(ValueError, match="bundle name"):
        b.load_weights(spark, store, "../b1")


def test_restore_needs_complete_metadata(spark, store):
    weights, meta = b.restore_bundle(spark, store, "b1")
    assert weights.count() == 2 and meta.select("metadata.model_config.maxlen").collect()[0][0] == 128
    for name, problem in (("b2", "no_metadata"), ("b3", "no_model_config")):
        with pytest.raises(ValueError, match=problem):
            b.restore_bundle(spark, store, name)


def test_saving_replaces_one_bundle_and_keeps_the_others(spark, store):
    row = [("b1", "leaf0", "param", [1], 0, [9.0])]
    new = spark.createDataFrame(row, "bundle string, leaf string, kind string, shape array<int>, chunk_id int, values array<double>")
    with pytest.raises(FileExistsError, match="b1"):
        b.write_bundles(new, store, force=False)
    b.write_bundles(new, store)
    assert [x["values"] for x in b.load_weights(spark, store, "b1").collect()] == [[9.0]]
    assert b.load_weights(spark, store, "b2").count() == 2
    b.write_bundles(new.withColumn("bundle", F.lit("b8")), store, force=False)
    with pytest.raises(PySparkException, match="not a bundle name: a/b"):
        b.write_bundles(new.withColumn("bundle", F.lit("a/b")), store)


def test_single_bundle_read_is_pruned(spark, store, plan_of):
    plan = plan_of(b.load_weights(spark, store, "b2"))
    assert "PartitionFilters: [isnotnull(bundle" in plan and "(bundle" in plan


def test_round_trip_changes_nothing(spark, store):
    one = b.load_weights(spark, store, "b1")
    b.write_bundles(one.withColumn("bundle", F.lit("copy")), store)
    row = w.compare_states(one, b.load_weights(spark, store, "copy", expected=one)).collect()[0]
    assert (row["total_params"], row["changed_params"], row["max_change"]) == (4, 0, 0.0)


def times(spark, rows):
    return spark.createDataFrame(rows, "model string, bundle string, mtime long")


def test_newest_bundles(spark):
    cat = times(spark, [("m", "x", 1_000_000), ("m", "y", 3_000_000), ("m", "z", 2_000_000)])
    assert [x["bundle"] for x in c.latest_bundle(cat).collect()] == ["y"]
    assert [x["bundle"] for x in c.latest_bundles(cat, 2).collect()] == ["y", "z"]
    assert c.latest_bundles(cat, 9).count() == 3
    assert c.latest_bundle(cat.where("mtime < 0")).count() == 0


def test_pairs_to_compare(spark):
    cat = times(spark, [("m", "x", 1), ("m", "y", 3), ("m", "z", 2), ("n", "w", 1)])
    got = {x["model"]: (x["before"], x["after"], x["status"]) for x in c.checkpoint_pairs(cat, model_col="model").collect()}
    assert got == {"m": ("z", "y", "ok"), "n": (None, "w", "too_few")}
    assert c.resolve_pair(cat) == ("z", "y", False)
    assert c.resolve_pair(cat, "x", "x") == ("x", "x", True)
    with pytest.raises(ValueError, match="both"):
        c.resolve_pair(cat, before="x")
    with pytest.raises(ValueError, match="found 1"):
        c.resolve_pair(cat.where("model = 'n'"))


def test_epochs_add_up_along_a_lineage(spark):
    df = spark.createDataFrame([("a", 0, 25), ("a", 2, 10), ("a", 1, 5), ("b", 0, 3)], "lineage string, phase int, epochs int")
    got = c.cumulative_epochs(df, lineage="lineage", order_by=["phase"]).collect()
    assert sorted((x["lineage"], x["phase"], x["previous_epochs"], x["cumulative_epochs"]) for x in got) == [
        ("a", 0, 0, 25), ("a", 1, 25, 30), ("a", 2, 30, 40), ("b", 0, 0, 3),
    ]


def test_assembled_metadata_can_be_read_back(spark):
    df = spark.range(2).select(
        F.format_string("run_%d", "id").alias("bundle"),
        F.lit(4).alias("cumulative_epochs_completed"),
        F.when(F.col("id") == 0, 0.5).alias("final_loss"),
        c.config_struct(dataclasses.asdict(ModelConfig()), maxlen=F.lit(64)).alias("model_config"),
        c.config_struct(dataclasses.asdict(TrainingConfig())).alias("training_config"),
        c.config_struct(dataclasses.asdict(TokenizerConfig())).alias("tokenizer_config"),
        F.lit("2024-01-01T00:00:00").alias("created_at"),
    )
    made = c.assemble_metadata(df)
    docs = {x["bundle"]: json.loads(x["json"]) for x in made.collect()}
    assert docs["run_1"]["final_loss"] is None and docs["run_0"]["model_config"]["maxlen"] == 64
    parsed = made.select(b.parse_metadata(F.col("json")).alias("m")).select("m.*").collect()
    assert {x["training_config"]["lr_peak_value"] for x in parsed} == {3e-4}


def test_run_names_and_overrides(spark):
    df = spark.sql("SELECT 'tiny' AS m, timestamp_ntz'2024-03-04 05:06:07.89' AS t")
    assert df.select(c.run_name(F.col("m"), F.col("t"))).collect()[0][0] == "tiny_20240304_050607"
    given = spark.createDataFrame([(None, 0, None, None, False)], "batch_size int, epochs int, max_stories int, seed int, shuffle boolean")
    defaults = dataclasses.asdict(TrainingConfig(shuffle=True))
    assert tuple(c.apply_overrides(given, defaults).collect()[0]) == (32, 0, 100, 42, False)
    with pytest.raises(ValueError, match="no default"):
        c.apply_overrides(given, {})


BAD = [
    (ModelConfig, "maxlen", 0), (ModelConfig, "vocab_size", 0), (ModelConfig, "embed_dim", -1),
    (ModelConfig, "num_heads", 0), (ModelConfig, "feed_forward_dim", 0),
    (ModelConfig, "num_transformer_blocks", 0), (ModelConfig, "embed_dim", 193),
    (TrainingConfig, "batch_size", 0), (TrainingConfig, "epochs", 0), (TrainingConfig, "max_stories", 0),
    (TrainingConfig, "num_workers", -1), (TrainingConfig, "warmup_rate", 1.5),
    (TrainingConfig, "warmup_rate", -0.1), (TrainingConfig, "lr_init_value", -1.0),
    (TrainingConfig, "lr_init_value", 1.0), (TrainingConfig, "lr_end_value", -1e-9),
    (TrainingConfig, "weight_decay", -0.1), (TrainingConfig, "log_every_n_steps", 0),
    (InferenceConfig, "max_new_tokens", 0), (InferenceConfig, "temperature", 0.0),
    (TokenizerConfig, "delimiter", ""), (TokenizerConfig, "pad_token_id", -1), (TokenizerConfig, "name", "nope"),
]


@pytest.mark.parametrize("config, field, value", BAD)
def test_bad_settings_are_refused_by_name(config, field, value):
    with pytest.raises(ValueError, match=field):
        config(**{field: value})


def test_table_check_agrees_with_the_single_check(spark):
    cases = [(i, f, v) for i, (cls, f, v) in enumerate(BAD) if cls is TrainingConfig]
    rows = [{"id": i} | dataclasses.asdict(TrainingConfig()) | {f: v} for i, f, v in cases]
    df = spark.createDataFrame(rows)
    got = {x["id"]: x["field"] for x in r.violations(df, r.TRAINING_RULES, ["id"]).collect()}
    assert got == {i: f for i, f, _ in cases}
    good = spark.createDataFrame([{"id": 1} | dataclasses.asdict(TrainingConfig())])
    assert r.violations(good, r.TRAINING_RULES, ["id"]).count() == 0


def test_zero_heads_break_one_rule_and_nulls_break_theirs(spark):
    base = {k: int(v) for k, v in dataclasses.asdict(ModelConfig()).items()}
    df = spark.createDataFrame([{"id": 0} | base | {"num_heads": 0}, {"id": 1} | base | {"maxlen": None}])
    got = sorted((x["id"], x["rule_ix"]) for x in r.violations(df, r.MODEL_RULES, ["id"]).collect())
    assert got == [(0, 3), (1, 0)]


def _bundle(spark, name, values):
    rows = [(name, f"leaf{j}", "param", [1], 0, [v]) for j, v in enumerate(values)]
    return spark.createDataFrame(rows, "bundle string, leaf string, kind string, shape array<int>, chunk_id int, values array<double>")


def _doc(spark, name, epochs):
    return spark.createDataFrame([(name, f'{{"cumulative_epochs_completed":{epochs}}}')], "bundle string, json string")


def _held(spark, root, name):
    values = sorted(x for r in b.load_weights(spark, root, name).collect() for x in r["values"])
    told = b.read_metadata(spark, root).where(F.col("bundle") == name).collect()
    return values, told[0]["metadata"]["cumulative_epochs_completed"] if told else None


def test_a_save_that_stops_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    b.write_bundles(_bundle(spark, "m", [1.0, 2.0]), root, metadata=_doc(spark, "m", 1))
    before = b.list_bundles(spark, root).collect()

    def stop(*args):
        raise OSError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(b, "_publish", stop)
        with pytest.raises(OSError, match="lost"):
            b.write_bundles(_bundle(spark, "m", [7.0]), root, metadata=_doc(spark, "m", 2))
    assert _held(spark, root, "m") == ([1.0, 2.0], 1) and b.list_bundles(spark, root).collect() == before
    assert b.damaged_bundles(spark, root).count() == 0
    b.write_bundles(_bundle(spark, "m", [7.0]), root, metadata=_doc(spark, "m", 2))
    assert _held(spark, root, "m") == ([7.0], 2)
    # Without a document the old one stays; a document alone is no bundle.
    b.write_bundles(_bundle(spark, "m", [8.0]), root)
    b.write_bundles(_bundle(spark, "m", []), root, metadata=_doc(spark, "only", 5))
    assert _held(spark, root, "m") == ([8.0], 2)
    assert [r["bundle"] for r in b.list_bundles(spark, root).collect()] == ["m"]
    assert b.read_weights(spark, root).count() == 1


def test_the_catalog_reads_index_and_log_only(spark, tmp_path, plan_of):
    root = str(tmp_path / "s")
    for k in range(4):
        b.write_bundles(_bundle(spark, f"m{k % 2}", [float(k)]), root, metadata=_doc(spark, f"m{k % 2}", k))
    want = {r["bundle"]: tuple(r) for r in b.manifest(spark, root).collect()}
    b.compact_log(spark, root)
    assert {r["bundle"]: tuple(r) for r in b.manifest(spark, root).collect()} == want
    b.write_bundles(_bundle(spark, "m1", [9.0]), root)
    b.compact_log(spark, root)
    b.write_bundles(_bundle(spark, "m2", [5.0]), root, metadata=_doc(spark, "m2", 9))
    assert [_held(spark, root, f"m{k}") for k in range(3)] == [([2.0], 2), ([9.0], 3), ([5.0], 9)]
    plan = plan_of(c.latest_bundles(b.list_bundles(spark, root), 2))
    assert "/weights" not in plan and "binaryFile" not in plan and "/log" in plan
    newest = [r["bundle"] for r in c.latest_bundles(b.list_bundles(spark, root), 2).collect()]
    assert newest == ["m2", "m1"]


def test_damaged_weights_are_named(spark, tmp_path):
    root = str(tmp_path / "s")
    b.write_bundles(_bundle(spark, "good", [1.0]).union(_bundle(spark, "bad", [2.0, 3.0])), root)
    version = b.manifest(spark, root).where("bundle = 'bad'").collect()[0]["version"]
    other = _bundle(spark, "bad", [4.0]).drop("bundle").withColumn("values", F.col("values").cast("array<float>"))
    other.write.mode("overwrite").parquet(f"{root}/weights/version={version}/bundle=bad")
    assert [tuple(r) for r in b.damaged_bundles(spark, root).collect()] == [("bad", 2, 1)]


def test_lineage_follows_links_of_any_shape(spark):
    chain = [(k, k - 1 if k else None, 2) for k in range(40)]
    branches = [(100, 5, 7), (101, 100, 1), (102, 100, 1)]
    odd = [(200, 999, 3), (201, 200, None), (300, 302, 1), (301, 300, 1), (302, 301, 1), (303, 302, 4), (400, 400, 1)]
    odd += [(500, 39, 1), (500, 3, 2), (None, 1, 1), (600, None, 5), (600, None, 5)]
    table = spark.createDataFrame(chain + branches + odd, "run_id long, resumed_from long, epochs long")
    got = {r["run_id"]: tuple(r)[1:] for r in c.resume_lineage(table.repartition(3)).collect()}
    assert all(got[k] == (0, k, 2 * k, 2 * k + 2, None) for k in range(40))
    assert got[100] == (0, 6, 12, 19, None) and got[101] == got[102] == (0, 7, 19, 20, None)
    assert got[200] == (200, 0, 0, 3, "unknown_parent") and got[201] == (200, 1, 3, 3, None)
    for k in (300, 301, 302, 303, 400):
        assert got[k] == (None, None, None, None, "cycle")
    assert got[500] == (0, 4, 8, 10, "several_parents") and got[600] == (600, 0, 0, 5, None)
    assert len(got) == 40 + 3 + 7 + 2 and c.resume_lineage(table.limit(0)).count() == 0


def test_lineage_stores_each_run_that_is_done_once(spark, monkeypatch):
    stored = []
    real = c.materialize
    monkeypatch.setattr(c, "materialize", lambda df, label: stored.append(real(df, label)) or stored[-1])
    # Most runs are roots: the rounds of the one long chain must not store them again.
    rows = [(k, None, 1) for k in range(100, 300)] + [(k, k - 1 if k else None, 1) for k in range(20)]
    found = c.resume_lineage(spark.createDataFrame(rows, "run_id long, resumed_from long, epochs long"))
    assert found.where("run_id = 19").first()["cumulative_epochs"] == 20 and found.count() == 220
    assert len(stored) > 4 and sum(df.count() for df in stored[2:]) < 100
