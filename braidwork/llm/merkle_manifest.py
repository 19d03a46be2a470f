"""Merkle manifest of a table with a witness per row, built by aligned appends.

Leaves of a list (one per language) are appended in order to a frontier of complete
subtrees. A subtree that is still open holds the witnesses its leaves have so far;
when its sibling is complete, both are merged and the witnesses on either side grow
by the other's digest. A task appends aligned blocks of leaves this way, and the
roots of the blocks are appended in turn, block by block, until one root per list is
left; the roots of the lists are the leaves of one more list. A row's proof is its
witness in its block, then the witness of its block, and so on to the root. Only
block roots move up: no task and not the driver ever holds a whole list.

A witness is a sequence of steps from the leaf upwards: ``L`` or ``R`` and 32 bytes
for a sibling on the left or right, ``-`` where the node has none and is hashed alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidwork.llm.batches import small_batches
from braidwork.operators.ordering import dense_index
from braidwork.session import materialize

BLOCK_BITS = 10
TAMPERED = 7
_LEFT, _RIGHT, _ALONE = b"L", b"R", b"-"


def node(children: Sequence[bytes]) -> bytes:
    """Digest of a node: sha256 over the hex text of its children."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


class Frontier:
    """Complete subtrees of one list, the open ones with the witnesses of their leaves."""

    def __init__(self) -> None:
        self.open: list[tuple[int, bytes, int]] = []  # height, digest, first leaf
        self.witness: list[bytearray] = []

    def append(self, leaf: bytes) -> None:
        self.open.append((0, leaf, len(self.witness)))
        self.witness.append(bytearray())
        self._merge()

    def _merge(self) -> None:
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            height, right, middle = self.open.pop()
            _, left, first = self.open.pop()
            for w in self.witness[first:middle]:
                w += _RIGHT + right
            for w in self.witness[middle:]:
                w += _LEFT + left
            self.open.append((height + 1, node((left, right)), first))

    def close(self, height: int | None = None) -> bytes:
        """The root of all leaves; of a block inside a longer list, raised to ``height``."""
        while len(self.open) > 1 or (height is not None and self.open[0][0] < height):
            at, digest, first = self.open.pop()
            for w in self.witness[first:]:
                w += _ALONE
            self.open.append((at + 1, node((digest,)), first))
            self._merge()
        return self.open[0][1]


def steps(witness: bytes) -> Iterator[tuple[bytes, bytes | None]]:
    """The steps of a witness: kind, and the sibling's digest."""
    at = 0
    while at < len(witness):
        kind = witness[at : at + 1]
        size = 0 if kind == _ALONE else 32
        yield kind, witness[at + 1 : at + 1 + size] if size else None
        at += 1 + size


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for kind, sibling in steps(witness):
        leaf = node((leaf,) if sibling is None else (sibling, leaf) if kind == _LEFT else (leaf, sibling))
    return leaf


def proof_digest(witness: bytes) -> str:
    """sha256 over the hex text of all siblings, from the leaf upwards."""
    return hashlib.sha256("".join(s.hex() for _, s in steps(witness) if s is not None).encode()).hexdigest()


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: of each field its byte count, a colon and its value, or ``-`` for null."""
    return F.unhex(F.sha2(F.concat(*map(_field, fields)), 256))


def _appended(nodes: DataFrame, bits: int) -> DataFrame:
    """``nodes`` with their ``witness`` inside their block and, on the first of a block, its ``root``.

    ``nodes`` has ``part, pos, total, digest``, and other columns that pass.
    """
    names = nodes.columns
    schema = T.StructType(
        [*nodes.schema.fields, T.StructField("witness", T.BinaryType()), T.StructField("root", T.BinaryType())]
    )
    at = {c: names.index(c) for c in ("part", "pos", "total", "digest")}

    def close(held: list[pa.RecordBatch], frontier: Frontier) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        whole = rows.column(at["total"])[0].as_py() <= 1 << bits
        root = frontier.close(None if whole else bits)
        roots = pa.array([root] + [None] * (len(rows) - 1), pa.binary())
        witness = pa.array([bytes(w) for w in frontier.witness], pa.binary())
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rows.columns]
        return pa.RecordBatch.from_arrays([*columns, witness, roots], [*names, "witness", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        frontier, block = Frontier(), None
        for batch in batches:
            keys = [
                (p, i >> bits) for p, i in zip(batch.column(at["part"]).to_pylist(), batch.column(at["pos"]).to_pylist())
            ]
            digests = batch.column(at["digest"]).to_pylist()
            start = 0
            for i, key in enumerate(keys):
                if key != block:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if held:
                        yield close(held, frontier)
                    held, frontier, block, start = [], Frontier(), key, i
                frontier.append(digests[i])
            if len(keys) > start:
                held.append(batch.slice(start))
        if held:
            yield close(held, frontier)

    block = F.shiftright("pos", bits)
    lined = nodes.repartition("part", block).sortWithinPartitions("part", "pos")
    return small_batches(lined).mapInArrow(run, schema)


def _raised(nodes: DataFrame, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of appends of some lists, and ``part, root`` of each.

    The first round has the rows of ``nodes``; each further one the block roots of the one before.
    """
    rounds = []
    while True:
        done = materialize(_appended(nodes, bits), "witnesses")
        rounds.append(done)
        heads = done.where(F.col("root").isNotNull())
        most = done.agg(F.max("total")).first()[0] or 0
        if most <= 1 << bits:
            return rounds, heads.select("part", "root")
        total = F.shiftright(F.col("total") + (1 << bits) - 1, bits)
        nodes = heads.select("part", F.shiftright("pos", bits).alias("pos"), total.alias("total"), F.col("root").alias("digest"))


def _to_top(rounds: list[DataFrame], top: DataFrame, bits: int) -> DataFrame:
    """``part, block, subroot, root, above`` for the blocks of the first round, from those of the last.

    ``above`` holds the steps from the block's root to the root of all.
    """
    for done in reversed(rounds[1:]):
        own = done.select("part", "pos", "witness", F.shiftright("pos", bits).alias("block"))
        top = own.join(top, ["part", "block"]).select(
            "part", F.col("pos").alias("block"), "subroot", "root", F.concat("witness", "above").alias("above")
        )
    return top


def _verified(rows: DataFrame) -> DataFrame:
    """``witness`` and ``tampered`` replaced by ``proof_sha256, folded_root``."""
    names = [c for c in rows.columns if c not in ("witness", "tampered")]
    at = {c: rows.columns.index(c) for c in rows.columns}
    fields = [rows.schema[c] for c in names]
    more = [T.StructField(c, T.StringType()) for c in ("proof_sha256", "folded_root")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            witnesses = batch.column(at["witness"]).to_pylist()
            leaves = batch.column(at["tampered"]).to_pylist()
            proofs = pa.array([proof_digest(w) for w in witnesses], pa.string())
            folded = pa.array([fold(x, w).hex() for x, w in zip(leaves, witnesses)], pa.string())
            kept = [batch.column(at[c]) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, proofs, folded], [*names, "proof_sha256", "folded_root"])

    return small_batches(rows).mapInArrow(run, T.StructType([*fields, *more]))


def manifest(docs: DataFrame, *, bits: int = BLOCK_BITS) -> DataFrame:
    """``doc_id, lang, pos, leaf, subroot, root, witness, tampered`` of every row of ``docs``.

    ``docs`` has ``doc_id, source, lang, n_chars, text``; other columns are ignored.
    Lists are the languages, null first and a list of its own; rows of a list ascend by
    ``doc_id`` (null first), rows of equal id by their leaf, and equal rows take any order.
    ``tampered`` is the leaf with ``n_chars`` one higher where ``TAMPERED`` divides the
    CRC-32 of the decimal ``doc_id``, else the leaf; a null id or ``n_chars`` stays.
    Digests are binary. No rows give no rows. ``2 ** bits`` leaves are appended in one go.
    """
    if bits < 1:
        raise ValueError("a block has two leaves at least")
    head = [F.col("doc_id"), F.col("source"), F.col("lang")]
    leaf = leaf_digest(*head, F.col("n_chars"), F.col("text"))
    changed = leaf_digest(*head, F.col("n_chars") + 1, F.col("text"))
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    part = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    leaves = materialize(
        docs.select(
            "doc_id", "lang", part.alias("part"), leaf.alias("digest"),
            F.when(chosen & F.col("n_chars").isNotNull(), changed).alias("changed"),
        ),
        "leaves",
    )
    placed = dense_index(leaves, [F.col("doc_id"), F.col("digest")], partition_by=["part"], out="pos", total="total")
    rounds, roots = _raised(placed, bits)
    # The roots of the lists are one more list; an empty name stands for all of them.
    tops = dense_index(materialize(roots, "subroots"), [F.col("part")], out="pos", total="total")
    tops = tops.select(F.lit("").alias("part"), "pos", "total", F.col("root").alias("digest"), F.col("part").alias("name"))
    top_rounds, root = _raised(tops, bits)
    first_block = F.lit(0).cast("long").alias("block")
    end = root.select("part", first_block, F.lit(b"").alias("subroot"), "root", F.lit(b"").alias("above"))
    lists = top_rounds[0].withColumn("block", F.shiftright("pos", bits)).drop("root").join(
        _to_top(top_rounds, end, bits), ["part", "block"]
    )
    lists = lists.select(
        F.col("name").alias("part"), first_block, F.col("digest").alias("subroot"), "root",
        F.concat("witness", "above").alias("above"),
    )
    ends = materialize(_to_top(rounds, materialize(lists, "lists"), bits), "ends")
    rows = rounds[0].withColumn("block", F.shiftright("pos", bits)).drop("root")
    return rows.join(ends, ["part", "block"]).select(
        "doc_id", "lang", "pos", F.col("digest").alias("leaf"), "subroot", "root",
        F.concat("witness", "above").alias("witness"), F.coalesce("changed", "digest").alias("tampered"),
    )


def verify(rows: DataFrame) -> DataFrame:
    """Rows of ``manifest`` with hex digests, ``proof_sha256``, ``folded_root`` and ``verified``.

    ``folded_root`` is recomputed from the tampered leaf and the row's witness alone.
    """
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")]
    done = _verified(rows.select("doc_id", "lang", "pos", *hexed, "witness", "tampered"))
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))
