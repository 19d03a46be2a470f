from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from braidwork.configs import ModelConfig, TokenizerConfig
from braidwork.functions import tokens as tk
from braidwork.operators import tokenizers as tz
from braidwork.plans.training_data import token_examples

END = "<|endoftext|>"
TEXTS = [
    "plain", "", "déjà vu – 😀", END, f"a{END}b", f"{END}{END}", f"x{END}", "Ā<|endof", "\x00\x7f",
]


def python_bytes(text: str) -> list[int]:
    out: list[int] = []
    for i, piece in enumerate(text.split(END)):
        out += ([256] if i else []) + list(piece.encode())
    return out


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def column(df, expr) -> list:
    return [r[0] for r in df.orderBy("id").select(expr).collect()]


def test_byte_tokens_mark_every_delimiter(texts):
    assert column(texts, tk.byte_tokens(F.col("text"), END)) == [python_bytes(t) for t in TEXTS]


def test_byte_tokens_come_back_as_the_text(texts):
    back = tk.byte_detokenize(tk.byte_tokens(F.col("text"), END), END)
    assert column(texts, back) == TEXTS


def test_cut_characters_decode_to_replacements(spark):
    df = spark.createDataFrame([(0, [226, 130])], "id int, t array<int>")
    assert column(df, tk.byte_detokenize(F.col("t"), END)) == [bytes([226, 130]).decode("utf-8", "replace")]


@pytest.mark.parametrize("maxlen", [1, 4, 64])
@pytest.mark.parametrize("pad", [0, 5, 300])
def test_examples_have_fixed_length(texts, maxlen, pad):
    expected = [(python_bytes(t)[:maxlen] + [pad] * maxlen)[:maxlen] for t in TEXTS]
    assert column(texts, tk.byte_example(F.col("text"), END, maxlen, pad)) == expected
    padded = tk.truncate_pad(tk.byte_tokens(F.col("text"), END), maxlen, pad)
    assert column(texts, padded) == expected


@pytest.mark.parametrize(
    "tokens, target", [([5, 6, 7], [6, 7, 0]), ([9], [0]), ([1, 0, 0], [0, 0, 0])]
)
def test_targets_end_with_a_literal_zero(spark, tokens, target):
    df = spark.createDataFrame([(0, tokens)], "id int, t array<int>")
    assert column(df, tk.shift_left(F.col("t"))) == [target]


@pytest.mark.parametrize(
    "tokens, window, n", [([1, 2], [1, 2, 0, 0], 2), ([1, 2, 3, 4, 5, 6], [3, 4, 5, 6], 4), ([], [0] * 4, 0)]
)
def test_context_is_the_last_tokens_padded_on_the_right(spark, tokens, window, n):
    df = spark.createDataFrame([(0, tokens)], "id int, t array<int>")
    assert column(df, tk.context_window(F.col("t"), 4)) == [window]
    assert column(df, tk.context_length(F.col("t"), 4)) == [n]


def test_transpose_and_causal_expressions(spark):
    df = spark.createDataFrame([(0, [[1, 2, 3], [4, 5, 6]], [7, 8, 9])], "id int, r array<array<int>>, t array<int>")
    assert column(df, tk.position_major(F.col("r"), 3)) == [[[1, 4], [2, 5], [3, 6]]]
    seen = df.select(F.inline(tk.causal_prefixes(F.col("t")))).collect()
    assert [tuple(r) for r in seen] == [(0, 7, 1, 7), (1, 8, 2, 15), (2, 9, 3, 24)]


WORD_TEXTS = [f"the cat  the\ndog {END}", f"dog{END}the bird {END}", f"the {END}"]


@pytest.fixture(scope="module")
def word_blocks(spark):
    return spark.createDataFrame(list(enumerate(WORD_TEXTS)), "id int, text string")


def test_vocab_ranks_by_count_then_token(word_blocks):
    vocab = tz.build_vocab(word_blocks, "text", END).orderBy("token_id").collect()
    assert [tuple(r) for r in vocab] == [
        (1, END, 4), (2, "the", 4), (3, "dog", 2), (4, "bird", 1), (5, "cat", 1),
    ]


@pytest.mark.parametrize("broadcast", [True, False])
def test_word_tokens_and_back(spark, word_blocks, broadcast):
    vocab = tz.build_vocab(word_blocks, "text", END)
    more = word_blocks.union(spark.createDataFrame([(3, "the emu dog"), (4, " ")], "id int, text string"))
    coded = tz.tokenize_words(
        more, vocab, id_col="id", text_col="text", delimiter=END, broadcast=broadcast
    )
    assert {r["id"]: r["tokens"] for r in coded.collect()} == {
        0: [2, 5, 2, 3, 1], 1: [3, 1, 2, 4, 1], 2: [2, 1], 3: [2, 0, 3], 4: [],
    }
    back = tz.detokenize_words(coded, vocab, id_col="id", broadcast=broadcast)
    texts = {r["id"]: r["text"] for r in back.collect()}
    assert texts[3] == "the dog" and texts[4] == ""


def test_registered_tokenizer_runs_everywhere(spark, word_blocks, monkeypatch):
    monkeypatch.setattr(tz, "_registered", {})
    monkeypatch.setattr("braidwork.configs._more_names", [])
    lengths = tz.Tokenizer(
        encode=lambda df, i, t: df.select(i, F.transform(F.split(t, " "), F.char_length).alias("tokens")),
        decode=lambda df, i: df.select(i, F.array_join(F.transform("tokens", lambda n: F.repeat(F.lit("x"), n)), " ").alias("text")),
        vocab_size=50, end_token_id=49,
    )
    with pytest.raises(ValueError, match="registered name"):
        TokenizerConfig(name="lengths")
    with pytest.raises(ValueError, match="of the library"):
        tz.register_tokenizer("byte", lengths)
    tz.register_tokenizer("lengths", lengths)
    config = TokenizerConfig(name="lengths")
    blocks = spark.createDataFrame([(0, "a bbb cc"), (1, "dddd")], "id int, text string")
    got = tz.tokenize(blocks, config, id_col="id", text_col="text")
    assert {r["id"]: r["tokens"] for r in got.collect()} == {0: [1, 3, 2], 1: [4]}
    assert {r["id"]: r["text"] for r in tz.detokenize(got, config, id_col="id").collect()} == {0: "x xxx xx", 1: "xxxx"}
    assert tz.vocab_size(config) == 50 and tz.end_token_id(config) == 49
    model = ModelConfig(maxlen=4, vocab_size=50)
    rows = token_examples(blocks, id_col="id", text_col="text", model=model, tokenizer=config)
    # Cleaned blocks end with the delimiter, which this tokenizer takes as 13 letters of the last word.
    assert {r["id"]: r["x"] for r in rows.collect()} == {0: [1, 3, 15, 0], 1: [17, 0, 0, 0]}


def test_word_delimiter_must_be_one_word():
    with pytest.raises(ValueError, match="white space"):
        tz.words(F.lit("x"), "two words")


def test_tokenizer_registry(spark, word_blocks):
    byte = TokenizerConfig(name="byte")
    word = TokenizerConfig(name="word")
    vocab = tz.build_vocab(word_blocks, "text", END)
    assert tz.vocab_size(byte) == 257 and tz.end_token_id(byte) == 256
    assert tz.vocab_size(word, vocab) == 6 and tz.end_token_id(word, vocab) == 1
    got = tz.tokenize(word_blocks, word, id_col="id", text_col="text").where("id = 2").collect()
    assert got[0]["tokens"] == [2, 1]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 8, 9])
def test_windows_cover_whole_sequences(spark, n):
    df = spark.createDataFrame([(0, list(range(1, n + 1)))], "id int, t array<int>")
    got = df.select(F.inline(tk.token_windows(F.col("t"), 4, 0))).collect()
    assert [r["window"] for r in got] == list(range(-(-n // 4)))
    assert [i for r in got for i in r["x"] if i] == list(range(1, n + 1))
    assert [i for r in got for i in r["y"] if i] == list(range(2, n + 1))
    assert all(len(r["x"]) == len(r["y"]) == 4 for r in got)


def test_unknown_tokenizer_is_refused():
    with pytest.raises(ValueError, match="registered name"):
        TokenizerConfig(name="gpt2")


def test_words_meet_a_large_vocabulary_once_per_run_of_rows(spark, plan_of):
    texts = [(1, "the cat " * 400), (1, f"cat{END}the"), (None, None), (2, "\x0b the\u00a0cat  \u00e9 ")]
    blocks = spark.createDataFrame(texts, "id int, text string").coalesce(1)
    vocab = spark.createDataFrame([(1, "the"), (2, "cat"), (3, END), (4, "\u00e9")], "token_id int, token string")
    coded = tz.tokenize_words(blocks, vocab, id_col="id", text_col="text", delimiter=END, broadcast=False)
    # Rows that share an id stay rows of their own, and no occurrence is a row of a join.
    got = sorted(((r["id"] or 0, r["tokens"]) for r in coded.collect()), key=lambda r: (r[0], len(r[1])))
    assert got == [(0, []), (1, [2, 3, 1]), (1, [1, 2] * 400), (2, [0, 4])]
    back = tz.detokenize_words(coded, vocab, id_col="id", broadcast=False)
    for plan in (plan_of(coded), plan_of(back)):
        assert "FlatMapCoGroupsInArrow" in plan and "posexplode" not in plan and "BroadcastExchange" not in plan
    assert sorted(r["text"] for r in back.collect()) == ["", f"cat {END} the", "the cat " * 399 + "the cat", "\u00e9"]
    cut = tz.tokenize_words(blocks, vocab, id_col="id", text_col="text", delimiter=END, broadcast=False, limit=2)
    assert sorted(r["tokens"] for r in cut.collect()) == [[], [0, 4], [1, 2], [2, 3]]


@pytest.mark.parametrize("maxlen, slice_bytes", [(1, 1 << 20), (4, 5), (64, 1)])
def test_windows_by_arrays_equal_windows_by_expressions(spark, monkeypatch, maxlen, slice_bytes):
    from braidwork.operators import windows as w

    monkeypatch.setattr(w, "SLICE_BYTES", slice_bytes)
    rows = list(enumerate([*TEXTS, None, END[:5], END[5:], "y" * 300 + END]))
    df = spark.createDataFrame(rows, "id int, text string").coalesce(1)
    tokens = df.select("id", tk.byte_tokens(F.col("text"), END).alias("t"))
    want = tokens.where("size(t) > 0").select("id", F.inline(tk.token_windows(F.col("t"), maxlen, 3)))
    got = w.byte_windows(df, "text", END, maxlen, pad_id=3, targets=True)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    sums = w.causal_sums(got, "x").select("x", "visible_sum").collect()
    assert all(r["visible_sum"] == [sum(r["x"][: k + 1]) for k in range(maxlen)] for r in sums)
