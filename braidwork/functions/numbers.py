"""Numbers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_point(x: Column, digits: int) -> Column:
    """``x`` with ``digits`` decimals, rounded from its exact binary value.

    ``format_string`` and ``round`` start from the shortest decimal form
    instead and so would turn 90.05 (a little below it in binary) into 90.1.
    """
    return F.call_function("format_number", x, F.lit("0." + "0" * digits))


def scientific(x: Column) -> Column:
    """A magnitude below 1 like ``2.00e-05``."""
    return F.lower(F.call_function("format_number", x, F.lit("0.00E00")))
