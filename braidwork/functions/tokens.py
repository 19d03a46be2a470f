"""Token-sequence expressions.

The byte vocabulary has 257 ids: 0-255 are the UTF-8 bytes, 256 is the
delimiter. Between tokenising and the integer array a sequence is held as a
*token string*, one character per token with the token id as its code point.
Cutting, padding and counting tokens are then plain string operations on
compact UTF-8 data, and only the tokens that are kept become integers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BYTE_VOCAB_SIZE = 257
BYTE_DELIMITER_ID = 256
_DELIMITER_CHAR = chr(BYTE_DELIMITER_ID)
_TO_THE_END = 1 << 30


def byte_token_string(text: Column, delimiter: str) -> Column:
    """Whole text as a token string, each delimiter occurrence as one token."""
    as_bytes = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    marker = delimiter.encode("utf-8").decode("latin-1")
    return F.replace(as_bytes, F.lit(marker), F.lit(_DELIMITER_CHAR))


def token_string_ids(token_string: Column) -> Column:
    """Token string to ``array<int>``; an empty string gives an empty array."""
    # Splitting an empty string gives one empty piece, which is no token.
    chars = F.array_remove(F.split(token_string, F.lit("")), "")
    return F.transform(chars, lambda c: F.ascii(c))


def byte_tokens(text: Column, delimiter: str) -> Column:
    """Whole text to byte-vocabulary ids."""
    return token_string_ids(byte_token_string(text, delimiter))


def byte_detokenize(tokens: Column, delimiter: str) -> Column:
    """Byte-vocabulary ids back to text; malformed sequences become U+FFFD.

    Each id picks its piece from a constant array, so no string is built per token.
    """
    marker = delimiter.encode("utf-8").decode("latin-1")
    pieces = F.array(*[F.lit(chr(i)) for i in range(256)], F.lit(marker))
    chars = F.transform(tokens, lambda t: F.get(pieces, t))
    raw = F.encode(F.array_join(chars, ""), "ISO-8859-1")
    return F.make_valid_utf8(raw.cast("string"))


def truncate_pad(tokens: Column, maxlen: int, pad_id: int) -> Column:
    """Keep the first ``maxlen`` ids, fill up on the right with ``pad_id``."""
    padding = F.array_repeat(F.lit(pad_id), maxlen)
    return F.slice(F.concat(F.slice(tokens, 1, maxlen), padding), 1, maxlen)


def byte_example(text: Column, delimiter: str, maxlen: int, pad_id: int) -> Column:
    """``truncate_pad(byte_tokens(text))`` with cut and padding made on the token string.

    The whole text is encoded and searched for delimiters; the tokens past
    ``maxlen`` are dropped before they are turned into integers.
    """
    token_string = byte_token_string(text, delimiter)
    if pad_id < BYTE_VOCAB_SIZE:
        fixed = F.rpad(token_string, maxlen, F.lit(chr(pad_id)))
        return F.transform(F.split(fixed, F.lit("")), lambda c: F.ascii(c))
    return truncate_pad(token_string_ids(F.substring(token_string, 1, maxlen)), maxlen, pad_id)


def shift_left(tokens: Column) -> Column:
    """Next-token targets: drop the first id, append a literal 0."""
    return F.concat(F.slice(tokens, 2, _TO_THE_END), F.array(F.lit(0)))


def last_tokens(tokens: Column, n: int) -> Column:
    """The last ``n`` ids, or all where there are fewer."""
    return F.slice(tokens, F.greatest(F.size(tokens) - n + 1, F.lit(1)), F.lit(n))


def context_window(tokens: Column, maxlen: int) -> Column:
    """The last ``maxlen`` ids, filled up on the right with 0."""
    return truncate_pad(last_tokens(tokens, maxlen), maxlen, 0)


def context_length(tokens: Column, maxlen: int) -> Column:
    """How many positions of the context window hold real tokens."""
    return F.least(F.size(tokens), F.lit(maxlen))


def position_major(rows: Column, maxlen: int) -> Column:
    """Transpose ``array<array<int>>`` from (rows, positions) to (positions, rows)."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(maxlen - 1)),
        lambda p: F.transform(rows, lambda row: F.get(row, p)),
    )


def token_windows(tokens: Column, maxlen: int, pad_id: int = 0) -> Column:
    """Whole sequences as an array of ``window, x, y``: consecutive inputs of ``maxlen`` ids and
    their next-token targets, the last one filled up with ``pad_id``.

    A target window overlaps the next input window by one id, so every id but the last is
    a target once; an empty sequence has no window. ``tokens`` should be a plain column.
    """
    last = F.floor((F.size(tokens) - 1) / maxlen).cast("int")

    def window(k: Column) -> Column:
        inputs, targets = (F.slice(tokens, k * maxlen + shift, F.lit(maxlen)) for shift in (1, 2))
        return F.struct(
            k.alias("window"),
            truncate_pad(inputs, maxlen, pad_id).alias("x"),
            truncate_pad(targets, maxlen, pad_id).alias("y"),
        )

    windows = F.transform(F.sequence(F.lit(0), last), window)
    return F.when(F.size(tokens) > 0, windows).otherwise(F.slice(windows, 1, 0))


def causal_prefixes(tokens: Column) -> Column:
    """One struct per query position with aggregates over the keys it may see.

    One pass inside the row: no sequence is ever exploded, shuffled or paired
    with itself.
    """
    start = F.struct(
        F.lit(0).cast("long").alias("total"), F.array().cast("array<bigint>").alias("totals")
    )

    def visit(acc: Column, token: Column) -> Column:
        total = acc["total"] + token
        return F.struct(total.alias("total"), F.array_append(acc["totals"], total).alias("totals"))

    sums = F.aggregate(tokens, start, visit, lambda acc: acc["totals"])
    return F.zip_with(
        F.transform(tokens, lambda token, pos: F.struct(pos.alias("pos"), token.alias("token"))),
        sums,
        lambda seen, total: F.struct(
            seen["pos"].alias("pos"),
            seen["token"].alias("token"),
            (seen["pos"] + 1).cast("long").alias("n_visible"),
            total.alias("visible_sum"),
        ),
    )
