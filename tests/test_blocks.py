from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from braidwork.functions.text import WHITESPACE
from braidwork.operators.ordering import first_rows
from braidwork.sources.blocks import BLOCK_ORDER, corpus_profile, normalize_blocks, scan_blocks, scan_first_blocks

END = "<|endoftext|>"
ONE, TWO, THREE = "A first short tale.", "Then a second one.", "And a third."


def write(tmp_path, content: str | bytes, name: str = "corpus.txt") -> str:
    path = tmp_path / name
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def texts(df) -> list[str]:
    return [r["text"] for r in df.orderBy(*BLOCK_ORDER).collect()]


def expected_blocks(content: str) -> list[str]:
    """What the rules say, in plain Python: split, strip, drop blanks, terminate."""
    pieces = content.replace("\r\n", "\n").replace("\r", "\n").split(END)
    return [p.strip() + END for p in pieces if p.strip()]


@pytest.mark.parametrize(
    "content",
    [
        f"{ONE}{END}\n",
        f"{ONE}{END}\n{TWO}{END}\n{THREE}{END}\n",
        f"{ONE}{END}{TWO}{END}\n",
        f"{ONE}{END}\n{TWO}",
        f"{END}{END}\n \t{END}{ONE}{END}",
        f"line one\nline two\n\nline four{END}\n\n\n",
        f"  {ONE}\u0085\x1c{END}\x1f{TWO}　{END}",
        f"dos\r\nlines\rhere{END}\r\n{TWO}{END}\r\n",
        "",
        "  \n\t",
        "no delimiter at all",
    ],
)
def test_scan_follows_the_block_rules(spark, tmp_path, content):
    assert texts(scan_blocks(spark, write(tmp_path, content), END)) == expected_blocks(content)


def test_whitespace_set_is_the_one_of_str_strip():
    assert set(WHITESPACE) == {c for c in map(chr, range(0x110000)) if c.isspace()}


def test_malformed_bytes_become_replacement_characters(spark, tmp_path):
    content = b"ok \xff\xfe mid \xe2\x82 cut " + END.encode() + b"\xf0\x9f\x98"
    expected = [p.strip() + END for p in content.decode("utf-8", "replace").split(END) if p.strip()]
    assert texts(scan_blocks(spark, write(tmp_path, content), END)) == expected


@pytest.mark.parametrize("max_bytes", [64, 200, 1_000_000])
def test_splits_do_not_change_the_blocks(spark, tmp_path, max_bytes):
    content = "".join(f"tale {i} " + "x" * (i % 37) + END + "\n" for i in range(300))
    path = write(tmp_path, content)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scanned = scan_blocks(spark, path, END)
        assert texts(scanned) == expected_blocks(content)
        if max_bytes < 1000:
            assert scanned.rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_missing_file_is_an_error_at_once(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        scan_blocks(spark, str(tmp_path / "nothing.txt"), END)


@pytest.mark.parametrize("delimiter", ["", "a\nb", "\r"])
def test_unusable_delimiters_are_refused(spark, tmp_path, delimiter):
    with pytest.raises(ValueError, match="delimiter"):
        scan_blocks(spark, write(tmp_path, "x"), delimiter)


@pytest.mark.parametrize("limit, count", [(2, 2), (None, 3), (0, 3), (9, 3)])
def test_block_limit_keeps_file_order_and_zero_means_all(spark, tmp_path, limit, count):
    path = write(tmp_path, f"{ONE}{END}\n{TWO}{END}\n{THREE}{END}\n")
    kept = first_rows(scan_blocks(spark, path, END), list(map(_col, BLOCK_ORDER)), limit)
    assert texts(kept) == [ONE + END, TWO + END, THREE + END][:count]


@pytest.mark.parametrize("n, files", [(1, 1), (2, 1), (3, 3), (7, 3), (None, 3)])
def test_limited_scan_opens_files_from_the_front(spark, tmp_path, n, files):
    folder = tmp_path / "in put"
    folder.mkdir()
    for name in "cab":
        (folder / f"{name} 1.txt").write_text(f"{name}-one{END}\n{name}-two{END}\n")
    got = scan_first_blocks(spark, str(folder), END, n)
    everything = [f"{name}-{k}{END}" for name in "abc" for k in ("one", "two")]
    assert texts(got) == everything[: n or 6]
    assert len(got.inputFiles()) == files


def test_limited_scan_of_an_empty_corpus(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert texts(scan_first_blocks(spark, str(tmp_path / "in"), END, 3)) == []
    assert texts(scan_first_blocks(spark, write(tmp_path, "", "e.txt"), END, 3)) == []


def _col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_table_text_gets_the_same_clean_up(spark):
    rows = [(1, f" \x1d{ONE}  "), (2, "   "), (3, ""), (4, None), (5, TWO)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r["doc_id"]: r["text"] for r in normalize_blocks(df, "text", END).collect()}
    assert got == {1: ONE + END, 5: TWO + END}


def test_profile_counts_the_blank_tail_and_shows_the_opening(spark):
    df = spark.createDataFrame([(1, "abc"), (0, "x" * 400)], "doc_id int, text string")
    row = corpus_profile(df, "text", "doc_id").collect()[0]
    assert (row["n_pieces"], row["min_chars"], row["max_chars"]) == (3, 3, 400)
    assert row["opening"] == "x" * 300
    assert corpus_profile(df.where("doc_id > 5"), "text", "doc_id").collect()[0]["n_pieces"] == 1
