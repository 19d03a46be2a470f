"""Byte-pair encoding and decoding by an automaton over tokens.

The merges are compiled in order, one gadget each, into a deterministic
automaton whose arcs carry tokens and whose paths are the correct tokenizations.
Before the first merge there is one state with an arc per byte. The gadget of the
k-th merge ``(u, v) -> w``

* splits the state behind every ``u`` arc, so that no ``v`` arc leaves it, and
* adds a ``w`` arc from every state with a ``u`` arc to where ``u v`` led before.

So all arcs of a token lead to one state, and a state is named by its token. The
arcs of ``w`` are those of ``v`` before step k, and whether ``w`` may follow a
token is whether ``u`` may after step k; a gadget is stored as those two
references and its step number (``compile_merges``). All arcs of a 50k vocabulary
would be some 10**9, so an arc is resolved from the gadgets on first use and kept
in the transition table of the worker.

Encoding a pre-split word walks the table, longest arc first; behind each byte
there is at most one state that a path reaches. Decoding emits the labels of the
arcs.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from braidwork.llm.batches import small_batches
from braidwork.llm.hashing import chunks

# Fixed value: the pre-split pattern of byte-level encodings.
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Bounds of what a worker remembers; beyond them it starts afresh.
KEPT_WORDS = 400_000
KEPT_OTHERS = 50_000
KEPT_ARCS = 200_000
DECODED_ROWS = 500
_SPACE_BLANK = re.compile(r"\s ").search


def _byte_of_char() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Gadgets:
    """The compiled merges. Tokens are ids; ``step`` is -1 for bytes."""

    labels: list[bytes]
    ids: dict[bytes, int]  # of tokens that some path of the automaton has
    left: list[int]
    right: list[int]
    step: list[int]
    merged: dict[int, int]  # left << 32 | right -> step
    special: dict[str, int]
    longest: int


def compile_merges(vocab: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]) -> Gadgets:
    """Apply one gadget per merge, in order."""
    byte = _byte_of_char()
    size = max([*vocab.values(), *special.values()], default=-1) + 1
    labels = [b""] * size
    for token, i in vocab.items():
        labels[i] = bytes(byte[c] for c in token)
    for token, i in special.items():
        labels[i] = token.encode()
    own = {v: k for k, v in special.items()}
    g = Gadgets(labels, {}, [-1] * size, [-1] * size, [-1] * size, {}, special, 1)
    for token, i in vocab.items():
        if len(labels[i]) == 1 and i not in own:
            g.ids[labels[i]] = i
    for k, (a, b) in enumerate(merges):
        u, v, w = vocab[a], vocab[b], vocab[a + b]
        # Without a path u v there is nothing to split and no arc to add.
        if g.ids.get(labels[u]) == u and g.ids.get(labels[v]) == v and follows(g, u, v, k):
            g.left[w], g.right[w], g.step[w] = u, v, k
            g.merged[u << 32 | v] = k
            g.ids[labels[w]] = w
            g.longest = max(g.longest, len(labels[w]))
    return g


def follows(g: Gadgets, x: int, y: int, before: int) -> bool:
    """Is there an arc ``y`` from the state behind ``x``, counting gadgets before step ``before``?"""
    while True:
        k = g.merged.get(x << 32 | y)
        if k is not None and k < before:
            return False
        if g.step[x] < 0 and g.step[y] < 0:
            return True
        if g.step[x] > g.step[y]:
            before, x = g.step[x], g.right[x]
        else:
            before, y = g.step[y] + 1, g.left[y]


def load_gadgets(path: str) -> Gadgets:
    """Compile the vocabulary file ``path`` (byte-level BPE without normaliser)."""
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in given["model"]["merges"]]
    special = {t["content"]: t["id"] for t in given["added_tokens"]}
    return compile_merges(given["model"]["vocab"], pairs, special)


def _spelling(ids: dict[bytes, int]) -> dict:
    """Tokens as nested tables: byte -> table, and None -> the token spelled so far."""
    root: dict = {}
    for label, token in ids.items():
        node = root
        for byte in label:
            node = node.setdefault(byte, {})
        node[None] = token
    return root


class Encoder:
    """Walks the automaton; keeps the arcs and words it has met."""

    def __init__(self, gadgets: Gadgets) -> None:
        self.g = gadgets
        self.root = _spelling(gadgets.ids)
        self.arcs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}  # by word, of a blank and the word
        self.elder: dict[str, bytes] = {}  # the words before; what is met again stays
        self.others: dict[str, bytes] = {}  # of other pre-split words, as they are
        self.split = regex.compile(PRE_SPLIT).findall
        self.specials = re.compile("|".join(re.escape(s) for s in gadgets.special)) if gadgets.special else None
        self.tails = {c: self.ids(c) for c in ",." if c.encode() in gadgets.ids}

    def word(self, data: bytes) -> list[int]:
        """Token ids of one pre-split word: the path of the automaton that spells it.

        A state behind a byte is reached by one path only, so a byte whose state
        led nowhere is never tried again and the walk is linear.
        """
        g, arcs = self.g, self.arcs
        n, at, dead, path, open_arcs = len(data), 0, set(), [], []
        while True:
            node, found = self.root, []
            for end in range(at, n):
                node = node.get(data[end])
                if node is None:
                    break
                if None in node:
                    found.append((node[None], end + 1))
            while True:
                while found:
                    token, end = found.pop()
                    if end in dead:
                        continue
                    if not path:
                        break
                    key = path[-1] << 32 | token
                    arc = arcs.get(key)
                    if arc is None:
                        arc = arcs[key] = follows(g, path[-1], token, 1 << 60)
                    if arc:
                        break
                else:
                    dead.add(at)
                    if not path:
                        raise ValueError("a byte has no token in this vocabulary")
                    found = open_arcs.pop()
                    at -= len(g.labels[path.pop()])
                    continue
                break
            path.append(token)
            open_arcs.append(found)
            at = end
            if at == n:
                if len(arcs) > KEPT_ARCS:
                    arcs.clear()
                return path

    def ids(self, word: str) -> bytes:
        """Ids (as int32 bytes) of any pre-split word."""
        found = self.others.get(word)
        if found is None:
            found = array("i", self.word(word.encode())).tobytes()
            if len(self.others) >= KEPT_OTHERS:
                self.others.clear()
            self.others[word] = found
        return found

    def spaced(self, part: str) -> bytes:
        """Ids of a blank and ``part``, which has no blank to split at."""
        if part.isalpha():
            found = self.words.get(part) or self.elder.get(part)
            if found is None:
                found = array("i", self.word(b" " + part.encode())).tobytes()
            if len(self.words) >= KEPT_WORDS // 2:
                self.words, self.elder = {}, self.words
            self.words[part] = found
            return found
        if part[-1:] in self.tails and part[:-1].isalpha():
            return self.spaced(part[:-1]) + self.tails[part[-1]]
        first, *rest = self.split(" " + part)
        if first[0] == " " and first[1:].isalpha():
            first = self.spaced(first[1:])
        else:
            first = self.ids(first)
        return b"".join([first, *map(self.ids, rest)])

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens: a blank after a word always starts a new word."""
        if not text:
            return b""
        if _SPACE_BLANK(text):
            first, *parts = re.split(r"(?<=\S)(?= )", text)
            parts = [p[1:] for p in parts]
        else:
            first, *parts = text.split(" ")
        found = list(map(self.words.get, parts))
        if None in found:
            found = [ids or self.spaced(part) for ids, part in zip(found, parts)]
        return b"".join([*map(self.ids, self.split(first)), *found])

    def text(self, text: str) -> bytes:
        if self.specials is None or not self.specials.search(text):
            return self.plain(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [self.plain(text[at : m.start()]), np.array([self.g.special[m[0]]], np.int32).tobytes()]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])


def _encoded(
    batches: Iterator[pa.RecordBatch], gadgets: Gadgets, at: int, names: list[str], out: str
) -> Iterator[pa.RecordBatch]:
    """The batches with the ids of the texts in column ``at`` behind the columns ``names``."""
    encoder = Encoder(gadgets)
    for whole in batches:
        # Small batches go on, so that no worker holds more than a few megabytes of ids.
        for lo, hi in chunks(whole.column(at)):
            batch = whole.slice(lo, hi - lo)
            ids = [encoder.text(t or "") for t in batch.column(at).to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
            data = pa.py_buffer(b"".join(ids))
            values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, data])
            lists = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*names, out])


def bpe_encode(docs: DataFrame, path: str, *, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text in ``out`` (array<int>).

    Null and empty texts give an empty array. Special tokens in a text become
    their id. Rows pass one by one, with all their other columns, so repeated
    rows and clashing ids do not matter; a column named ``out`` is replaced.
    No shuffle; a worker holds one Arrow batch and its bounded tables.
    """
    # Plain values: the vocabulary bounds their size.
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(load_gadgets(path)).values()))
    base = docs.drop(out) if out != text_col else docs
    names, at = base.columns, base.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encoded(batches, Gadgets(*shared.value), at, names, out)

    schema = T.StructType([*base.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return small_batches(base).mapInArrow(run, schema)


def emit_labels(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The bytes of all labels of ``ids`` in a row."""
    n = sizes[ids]
    end = np.cumsum(n)
    step = np.ones(int(end[-1]) if len(end) else 0, np.int64)
    some = n > 0
    first = (end - n)[some]
    if len(first):
        begin = starts[ids][some]
        step[first] = begin
        step[first[1:]] -= begin[:-1] + n[some][:-1] - 1
    return labels[np.cumsum(step)]


def _decoded(
    batches: Iterator[pa.RecordBatch], labels: list[bytes], at: int, names: list[str], out: str
) -> Iterator[pa.RecordBatch]:
    """The batches with the texts of the ids in column ``at`` behind the columns ``names``."""
    sizes = np.array([len(x) for x in labels], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(labels), np.uint8)
    for whole in batches:
        for lo in range(0, len(whole), DECODED_ROWS):
            batch = whole.slice(lo, DECODED_ROWS)
            texts = []
            for row in batch.column(at):
                ids = row.values.drop_null().to_numpy() if row.is_valid else np.zeros(0, np.int32)
                texts.append(emit_labels(ids, starts, sizes, data).tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, out])


def bpe_decode(docs: DataFrame, path: str, *, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of the token ids; bytes that are no UTF-8 become U+FFFD.

    Null and empty arrays give an empty text; null ids within one are skipped.
    An id outside the vocabulary fails the job. A column named ``out`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_gadgets(path).labels)
    base = docs.drop(out)
    names, at = base.columns, base.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoded(batches, shared.value, at, names, out)

    return small_batches(base).mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(out, T.StringType())]))


def bpe_round_trip(
    docs: DataFrame, path: str, *, text_col: str = "text", ids: str = "ids", decoded: str = "decoded",
    keep_text: bool = True,
) -> DataFrame:
    """``bpe_decode(bpe_encode(docs))``, both in one pass.

    A task keeps one Python worker instead of two. Workers stay for some time after
    their task with the memory they grew to, and the next job's memory adds to it.
    Without ``keep_text`` the texts do not come back from the worker and their column goes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(load_gadgets(path)).values()))
    base = docs.drop(ids, decoded)
    names, at = base.columns, base.columns.index(text_col)
    kept = [i for i in range(len(names)) if keep_text or i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gadgets = Gadgets(*shared.value)
        coded = (b.select([*kept, len(names)]) for b in _encoded(batches, gadgets, at, names, ids))
        yield from _decoded(coded, gadgets.labels, len(kept), [*(names[i] for i in kept), ids], decoded)

    schema = T.StructType([
        *(base.schema.fields[i] for i in kept),
        T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType()),
    ])
    return small_batches(base).mapInArrow(run, schema)


def default_path(spark: SparkSession) -> str:
    """The vocabulary file named by ``spark.braidwork.bpe.file``, else the installed public one."""
    named = spark.conf.get("spark.braidwork.bpe.file", None)
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
