"""Delimited text files as a table of blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.functions.text import clean_decode, is_not_blank, terminate_block


BLOCK_ORDER = ("file_path", "split_start", "row_in_scan")
FILES_FACTOR = 16


def check_delimiter(delimiter: str) -> None:
    """A delimiter with a newline could never be found inside one line of text."""
    if not delimiter:
        raise ValueError("delimiter must not be empty")
    if "\n" in delimiter or "\r" in delimiter:
        raise ValueError("delimiter must not contain a line break")


def scan_blocks(spark: SparkSession, path: str | list[str], delimiter: str) -> DataFrame:
    """Blocks of one or more files: ``file_path, split_start, row_in_scan, text``.

    The text source splits on the delimiter itself, so one large file is read
    by many tasks and no block crosses a task. Sorting by the first three
    columns gives file order. A missing path is an ``AnalysisException`` at
    once, an empty file gives no rows.
    """
    check_delimiter(delimiter)
    raw = spark.read.option("lineSep", delimiter).text(path)
    return raw.where(is_not_blank(F.make_valid_utf8("value"))).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row_in_scan"),
        terminate_block(clean_decode(F.col("value")), delimiter).alias("text"),
    )


def scan_first_blocks(
    spark: SparkSession, path: str | list[str], delimiter: str, n: int | None
) -> DataFrame:
    """The first ``n`` blocks in file order; ``None`` and 0 both mean all.

    Opens files from the front of the list, ever more of them, until ``n``
    blocks are found, so a small limit does not read a large corpus.
    """
    if not n:
        return scan_blocks(spark, path, delimiter)
    listed = spark.read.format("binaryFile").load(path)
    by_name = listed.select("path", F.col("_metadata.file_path").alias("uri")).orderBy("uri")
    opened = 1
    while True:
        files = [row["path"] for row in by_name.limit(opened).collect()]
        if not files:
            return scan_blocks(spark, path, delimiter)
        order = [F.col(c) for c in BLOCK_ORDER]
        found = scan_blocks(spark, files, delimiter).orderBy(*order).limit(n)
        if len(files) < opened or found.count() == n:
            return found
        opened *= FILES_FACTOR


def normalize_blocks(df: DataFrame, text_col: str, delimiter: str) -> DataFrame:
    """The same clean-up for text that is already in a table: strip, drop blanks, terminate."""
    # The blank test is separate from the strip, which the optimizer would otherwise repeat
    # in the filter.
    kept = df.where(is_not_blank(F.col(text_col)))
    return kept.withColumn(text_col, terminate_block(F.col(text_col), delimiter))


def write_delimited(df: DataFrame, text_col: str, path: str, delimiter: str) -> None:
    """Write one delimiter-terminated record per row, in parallel part files."""
    check_delimiter(delimiter)
    df.select(F.col(text_col).alias("value")).write.option("lineSep", delimiter).text(path)


def corpus_profile(blocks: DataFrame, text_col: str, order_col: str, preview: int = 300) -> DataFrame:
    """One row: piece count (with the blank tail after the last delimiter), length
    statistics and the opening characters of the first block."""
    n_chars = F.length(text_col).cast("long")
    return blocks.agg(
        (F.count(F.lit(1)) + 1).alias("n_pieces"),
        F.coalesce(F.min(n_chars), F.lit(0)).alias("min_chars"),
        F.coalesce(F.max(n_chars), F.lit(0)).alias("max_chars"),
        F.coalesce(F.round(F.sum(n_chars) / F.count(F.lit(1)), 6), F.lit(0.0)).alias("avg_chars"),
        F.min_by(F.substring(text_col, 1, preview), F.col(order_col)).alias("opening"),
    )
