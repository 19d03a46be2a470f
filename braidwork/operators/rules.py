"""Configuration rules, stated once and used two ways.

``violations`` checks a whole table of configurations in one projection;
``first_problem`` checks a single configuration on the driver. Rules keep
their order, so the lowest ``rule_ix`` of a row is the error that a driver-side
check of the same configuration would raise.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    field: str
    text: str
    holds: Callable[[Any], Any]
    """Works on a mapping of Python values and on a mapping of columns alike."""


def _number(holds: Any, *values: Any) -> Any:
    """The condition, broken by NaN, which a column would sort above every number."""
    if isinstance(holds, Column):
        for value in values:
            holds = holds & ~F.isnan(value.cast("double"))
    return holds


def above(field: str, bound: float) -> Rule:
    return Rule(field, f"{field} must be > {bound}", lambda c: _number(c[field] > bound, c[field]))


def at_least(field: str, bound: float) -> Rule:
    return Rule(field, f"{field} must be >= {bound}", lambda c: _number(c[field] >= bound, c[field]))


def within(field: str, low: float, high: float) -> Rule:
    return Rule(
        field,
        f"{field} must be in [{low}, {high}]",
        lambda c: _number((c[field] >= low) & (c[field] <= high), c[field]),
    )


def not_above(field: str, other: str) -> Rule:
    return Rule(
        field,
        f"{field} must be <= {other}",
        lambda c: _number(c[field] <= c[other], *(v for v in (c[field], c[other]) if isinstance(v, Column))),
    )


def multiple_of(field: str, other: str) -> Rule:
    # try_mod keeps a zero divisor, which has a rule of its own, from failing the job.
    def holds(c: Mapping[str, Any]) -> Any:
        if isinstance(c[other], Column):
            return F.coalesce(F.try_mod(c[field], c[other]) == 0, F.lit(True))
        return c[other] == 0 or c[field] % c[other] == 0

    return Rule(field, f"{field} must be a multiple of {other}", holds)


def not_empty(field: str) -> Rule:
    return Rule(field, f"{field} must not be empty", lambda c: c[field] != "")


def one_of(field: str, names: Sequence[str]) -> Rule:
    def holds(c: Mapping[str, Any]) -> Any:
        value = c[field]
        return value.isin(list(names)) if isinstance(value, Column) else value in names

    return Rule(field, f"{field} must be a registered name", holds)


MODEL_RULES = (
    above("maxlen", 0),
    above("vocab_size", 0),
    above("embed_dim", 0),
    above("num_heads", 0),
    above("feed_forward_dim", 0),
    above("num_transformer_blocks", 0),
    multiple_of("embed_dim", "num_heads"),
)

TRAINING_RULES = (
    above("batch_size", 0),
    above("epochs", 0),
    above("max_stories", 0),
    at_least("num_workers", 0),
    within("warmup_rate", 0.0, 1.0),
    at_least("lr_init_value", 0.0),
    not_above("lr_init_value", "lr_peak_value"),
    at_least("lr_end_value", 0.0),
    at_least("weight_decay", 0.0),
    above("log_every_n_steps", 0),
)

INFERENCE_RULES = (above("max_new_tokens", 0), above("temperature", 0.0))


def tokenizer_rules(known_names: Sequence[str]) -> tuple[Rule, ...]:
    return (
        not_empty("delimiter"),
        at_least("pad_token_id", 0),
        one_of("name", known_names),
    )


def first_problem(rules: Sequence[Rule], config: Mapping[str, Any]) -> str | None:
    """The first broken rule of one configuration, with the offending value."""
    for rule in rules:
        if not rule.holds(config):
            return f"{rule.text}, got {config[rule.field]!r}"
    return None


def violations(configs: DataFrame, rules: Sequence[Rule], id_cols: Sequence[str]) -> DataFrame:
    """One row per broken rule: id columns, ``rule_ix``, ``field``, ``rule``.

    A null field breaks its rules. No shuffle: the rules of a row are tested
    in place and only broken ones are expanded.
    """
    row = {name: F.col(name) for name in configs.columns}
    tested = F.array(
        *[
            F.when(
                ~F.coalesce(rule.holds(row), F.lit(False)),
                F.struct(
                    F.lit(ix).alias("rule_ix"),
                    F.lit(rule.field).alias("field"),
                    F.lit(rule.text).alias("rule"),
                ),
            )
            for ix, rule in enumerate(rules)
        ]
    )
    return configs.select(*id_cols, F.inline(F.array_compact(tested)))
