"""Sizes of the Arrow batches that go to Python workers, and names for helper columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS = 2_000
BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches bounded to some megabytes where they are larger.

    Texts can be long: at the default sizes the buffers of a few tasks, in the
    worker and twice in its executor, take a large part of a small executor.
    """
    conf = df.sparkSession.conf
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(conf.get(rows)) <= ROWS:
        conf.set(rows, str(ROWS))
    given = conf.get(size).rstrip("b")
    # A size given in another unit is the caller's own choice.
    if given.isdigit() and int(given) > BYTES:
        conf.set(size, f"{BYTES}b")
    return df


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or the same behind more underscores if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
