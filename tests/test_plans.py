from __future__ import annotations

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from braidwork.configs import InferenceConfig, ModelConfig, TokenizerConfig, TrainingConfig
from braidwork.functions.tokens import shift_left
from braidwork.operators.catalog import resume_context
from braidwork.operators.scoring import next_token_table
from braidwork.operators.tokenizers import build_vocab, tokenize
from braidwork.plans.comparison import compare_bundles
from braidwork.plans.continuation import continue_prompts
from braidwork.plans.run_plan import plan_run
from braidwork.sources import bundles as b

END = "<|endoftext|>"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bundles") / "store")
    document = json.dumps(
        {
            "cumulative_epochs_completed": 6,
            "model_config": dataclasses.asdict(ModelConfig()),
            "tokenizer_config": dataclasses.asdict(TokenizerConfig()),
        }
    )
    for name, scale, text in (("old", 1.0, document), ("new", 2.0, document), ("bare", 1.0, "{}")):
        rows = [(name, f"leaf{j}", "param", [2], 0, [scale * (j + 1), scale]) for j in range(3)]
        df = spark.createDataFrame(rows, "bundle string, leaf string, kind string, shape array<int>, chunk_id int, values array<double>")
        b.write_bundles(df, root, metadata=spark.createDataFrame([(name, text)], "bundle string, json string"))
    return root


def test_two_stored_bundles_are_compared(spark, store):
    result = compare_bundles(spark, store, before="old", after="new")
    assert not result.same_bundle
    assert result.norms.collect()[0]["verdict"] == "grown by 100.0%"
    row = result.states.collect()[0]
    assert (row["total_params"], row["changed_params"], row["median_change"]) == (6, 6, 1.0)
    same = compare_bundles(spark, store, before="old", after="old")
    assert same.same_bundle and same.states.collect()[0]["percent_changed"] == 0.0


def test_comparison_errors_say_which_side(spark, store):
    with pytest.raises(ValueError, match="'after' bundle.*no_metadata"):
        compare_bundles(spark, store, before="old", after="bare")
    with pytest.raises(ValueError, match="'before' bundle"):
        compare_bundles(spark, store, before="gone", after="new")
    with pytest.raises(ValueError, match="both"):
        compare_bundles(spark, store, before="old")
    with pytest.raises(ValueError, match="positive"):
        compare_bundles(spark, store, before="old", after="new", threshold=0)


def test_run_plan_counts_steps_and_epochs(spark, store):
    rows = spark.range(100)
    fresh = plan_run(rows, TrainingConfig(), run_id="r").collect()[0]
    assert (fresh["n_batches"], fresh["total_steps"], fresh["warmup_steps"]) == (3, 9, 1)
    assert (fresh["previous_epochs"], fresh["cumulative_epochs"], fresh["status"]) == (0, 3, "ok")
    context = resume_context(b.list_bundles(spark, store), b.read_metadata(spark, store))
    resumed = plan_run(rows, TrainingConfig(), run_id="r", resume_from=context.where("bundle = 'old'"))
    assert resumed.collect()[0]["cumulative_epochs"] == 9
    with pytest.raises(ValueError, match="cannot resume from 'bare'"):
        plan_run(rows, TrainingConfig(), run_id="r", resume_from=context.where("bundle = 'bare'"))
    with pytest.raises(ValueError, match="one batch"):
        plan_run(spark.range(3), TrainingConfig(), run_id="r")


@pytest.mark.parametrize("name", ["byte", "word"])
def test_prompts_are_continued_as_text(spark, name):
    config = TokenizerConfig(name=name)
    corpus = spark.createDataFrame([(0, f"ab cd {END}"), (1, f"ab cd {END}")], "id int, text string")
    vocab = build_vocab(corpus, "text", END) if name == "word" else None
    tokens = tokenize(corpus, config, id_col="id", text_col="text", vocab=vocab)
    examples = tokens.select(F.col("tokens").alias("x"), shift_left(F.col("tokens")).alias("y"))
    logits = next_token_table(examples)
    asked = spark.createDataFrame([(7, "ab")], "prompt_id long, text string")
    inference = InferenceConfig(max_new_tokens=int(3.0), seed=1)
    got = continue_prompts(asked, logits, config, inference, vocab=vocab, greedy=True).collect()
    assert [tuple(r) for r in got] == [(7, "ab cd")]
    if name == "word":
        with pytest.raises(ValueError, match="vocabulary"):
            continue_prompts(asked, logits, config, inference)
