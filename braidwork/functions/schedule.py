"""Learning rate as a closed-form expression of the step number."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def warmup_cosine_rate(
    step: Column, total: Column, warmup: Column, init: Column, peak: Column, end: Column
) -> Column:
    """Linear rise ``init -> peak`` over ``warmup`` steps, then a half cosine
    ``peak -> end`` that finishes at ``total`` and stays there.

    With a peak of 0 the decay floor is 0, whatever ``end`` says.
    """
    rising = init + (peak - init) * step / warmup
    progress = F.least(step - warmup, total - warmup) / (total - warmup)
    floor = F.when(peak == 0, F.lit(0.0)).otherwise(end)
    falling = floor + (peak - floor) * F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * progress))
    return F.when(step < warmup, rising).otherwise(falling)
