"""Typed settings of a run. Invalid values are refused on construction."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

from braidwork.operators import rules as R

# The tokenizer names that can be configured.
TOKENIZER_NAMES = ("byte", "word")
DEFAULT_DELIMITER = "<|endoftext|>"
# Names that other packages registered in this process.
_more_names: list[str] = []


def add_tokenizer_name(name: str) -> None:
    if name not in _more_names:
        _more_names.append(name)


def tokenizer_names() -> tuple[str, ...]:
    """All names a configuration may give now."""
    return (*TOKENIZER_NAMES, *_more_names)


def _refuse_invalid(config: Any, rules: tuple[R.Rule, ...]) -> None:
    problem = R.first_problem(rules, dataclasses.asdict(config))
    if problem is not None:
        raise ValueError(problem)


# The names and defaults of the fields below are the interface.
@dataclass(frozen=True)
class ModelConfig:
    maxlen: int = 128
    vocab_size: int = 50257
    embed_dim: int = 192
    num_heads: int = 6
    feed_forward_dim: int = 512
    num_transformer_blocks: int = 6
    model_seed: int = 0

    def __post_init__(self) -> None:
        _refuse_invalid(self, R.MODEL_RULES)


@dataclass(frozen=True)
class TrainingConfig:
    batch_size: int = 32
    max_stories: int = 100
    shuffle: bool = False
    seed: int = 42
    num_workers: int = 0
    epochs: int = 3
    lr_init_value: float = 0.0
    lr_peak_value: float = 3e-4
    lr_end_value: float = 1e-5
    warmup_rate: float = 0.1
    weight_decay: float = 0.01
    log_every_n_steps: int = 2

    def __post_init__(self) -> None:
        _refuse_invalid(self, R.TRAINING_RULES)


@dataclass(frozen=True)
class TokenizerConfig:
    delimiter: str = DEFAULT_DELIMITER
    name: str = "byte"
    pad_token_id: int = 0

    def __post_init__(self) -> None:
        _refuse_invalid(self, R.tokenizer_rules(tokenizer_names()))


@dataclass(frozen=True)
class InferenceConfig:
    max_new_tokens: int = 50
    temperature: float = 1.0
    seed: int | None = None

    def __post_init__(self) -> None:
        _refuse_invalid(self, R.INFERENCE_RULES)


_SQL_TYPES = {
    "int": T.LongType(),
    "int | None": T.LongType(),
    "bool": T.BooleanType(),
    "float": T.DoubleType(),
    "str": T.StringType(),
}


def struct_of(config_class: type) -> T.StructType:
    """The Spark schema of one configuration class."""
    return T.StructType(
        [T.StructField(f.name, _SQL_TYPES[f.type]) for f in dataclasses.fields(config_class)]
    )


METADATA_SCHEMA = T.StructType(
    [
        T.StructField("cumulative_epochs_completed", T.LongType()),
        T.StructField("final_loss", T.DoubleType()),
        T.StructField("model_config", struct_of(ModelConfig)),
        T.StructField("training_config", struct_of(TrainingConfig)),
        T.StructField("tokenizer_config", struct_of(TokenizerConfig)),
        T.StructField("created_at", T.StringType()),
    ]
)
