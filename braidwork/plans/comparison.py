"""Compare two stored bundles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from braidwork.operators.catalog import resolve_pair
from braidwork.operators.weights import (
    CHANGE_THRESHOLD,
    compare_norms,
    compare_states,
    norm_verdict,
    state_verdict,
)
from braidwork.sources.bundles import list_bundles, restore_bundle


@dataclass(frozen=True)
class Comparison:
    before: str
    after: str
    same_bundle: bool
    norms: DataFrame
    states: DataFrame


def compare_bundles(
    spark: SparkSession,
    root: str,
    *,
    before: str | None = None,
    after: str | None = None,
    threshold: float = CHANGE_THRESHOLD,
) -> Comparison:
    """Both reports, with verdicts, for two named bundles or for the two newest ones.

    Both bundles need complete metadata. ``same_bundle`` warns that a bundle
    is compared with itself.
    """
    if not threshold > 0:
        raise ValueError(f"threshold must be positive, got {threshold}")
    before, after, same = resolve_pair(list_bundles(spark, root), before, after)
    loaded = {}
    for role, name in (("before", before), ("after", after)):
        try:
            loaded[role], _ = restore_bundle(spark, root, name)
        except (FileNotFoundError, ValueError) as error:
            raise ValueError(f"cannot load the {role!r} bundle: {error}") from error
    pair = loaded["before"], loaded["after"]
    return Comparison(
        before=before,
        after=after,
        same_bundle=same,
        norms=norm_verdict(compare_norms(*pair)),
        states=state_verdict(compare_states(*pair, threshold=threshold)),
    )
