"""String clean-up for text blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space when a block is
# stripped (ASCII controls 9-13 and 28-31, space, NEL and the Unicode spaces).
WHITESPACE_CODEPOINTS = (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760,
    8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202,
    8232, 8233, 8239, 8287, 12288,
)
WHITESPACE = "".join(map(chr, WHITESPACE_CODEPOINTS))


def strip_whitespace(text: Column) -> Column:
    """Remove white space, in the wide Unicode sense, from both ends.

    A character-set trim reads only the two ends, unlike an anchored regular
    expression, which would visit every white-space run of a long text.
    """
    return F.btrim(text, F.lit(WHITESPACE))


def is_not_blank(text: Column) -> Column:
    """Does anything but white space stand in the text? Reads up to the first such character."""
    return F.ltrim(text, F.lit(WHITESPACE)) != ""


def clean_decode(text: Column) -> Column:
    """Replace malformed UTF-8 by U+FFFD and fold all newline styles to ``\n``."""
    valid = F.make_valid_utf8(text)
    folded = F.regexp_replace(valid, "\r\n?", "\n")
    return F.when(F.contains(valid, F.lit("\r")), folded).otherwise(valid)


def terminate_block(text: Column, delimiter: str) -> Column:
    """The stored form of a block: stripped, with the delimiter attached."""
    return F.concat(strip_whitespace(text), F.lit(delimiter))
