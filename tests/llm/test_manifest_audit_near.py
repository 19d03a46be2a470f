"""Filter audit, Merkle manifest and near-duplicate vectors against brute force."""

from __future__ import annotations

import hashlib
import zlib
from itertools import permutations

import numpy as np
import pytest

from braidwork.llm.filter_audit import FILTERS, audit, lehmer_rank
from braidwork.llm.merkle_manifest import Frontier, fold, manifest, verify
from braidwork.llm import vector_near_dedup as near

DOCS = "doc_id long, lang string, text string, part string, mask int, good boolean"
LABELS = "doc_id long, quality int, toxic int"


def _fails(rows):
    """The filters each row fails, by plain counting."""
    out = []
    for doc_id, _, text in rows:
        text = text or ""
        words = [w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w]
        upper = sum("A" <= c <= "Z" for c in text)
        copied = doc_id is not None and any(
            o[0] is not None and o[0] < doc_id and (o[2] or "") == text for o in rows
        )
        tests = [
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * upper > 10 * len(text),
            any(c in "#$%&*|" for c in text), copied,
        ]
        out.append({f for f, bad in zip(FILTERS, tests) if bad})
    return out


def _brute(rows, labels):
    fails = _fails(rows)
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    out = {}
    for part in {r[1] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, fails) if (r[1] or "") == part]
        shapley = dict.fromkeys(FILTERS, 0)
        for order in map("".join, permutations(FILTERS)):
            left = own
            for step, x in enumerate(order, 1):
                here = [(d, f) for d, f in left if x in f]
                shapley[x] += len(here)
                before = sum(x in f for _, f in own) - len(here)
                left = [(d, f) for d, f in left if x not in f]
                out[part, order, step] = [
                    len(left), len(here), before, sum(f == {x} for _, f in own),
                    sum(d in good for d, _ in here), sum(d in toxic for d, _ in here),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def _long(n, word="w{}"):
    return " ".join(word.format(i) for i in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    rows = [
        (1, "en", _long(120)), (2, "en", _long(120)), (2, "en", _long(120)), (3, None, _long(120)), (4, "", "a\tb\nc d"),
        (None, "en", _long(120)), (None, None, None), (5, "en", None), (6, "de", ""), (7, "de", _long(99) + " #"),
        (8, "de", _long(100, "W{}")), (9, "de", "same " * 200), (10, "fr", "x" * 50_000), (11, "en", _long(100) + " $ |"),
        (12, "en", "AB" + "c" * 18), (13, "en", "AB" + "c" * 17), (14, "fr", "ÄÖ\U0001f600 " * 60), (15, "fr", "a b " * 40 + _long(48)),
    ]
    return rows + [(100 + i, "en", _long(120)) for i in range(5)]


def test_audit_equals_running_every_order(spark, odd_rows):
    labels = [(1, 1, 1), (2, 1, 0), (2, 0, 1), (9, None, None), (10, 0, 1), (None, 1, 1), (999, 1, 1), (13, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", 3, True) for r in odd_rows], DOCS)
    got = audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    expected = _brute(odd_rows, [x for x in labels if x[0] is not None])
    assert len(got) == len(expected) == 600 * len({r[1] or "" for r in odd_rows})
    for r in got:
        row = (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        assert row == expected[r.part, r.filter_order, r.step], r


def test_audit_of_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "en", "a", "", 0, False)], DOCS)
    assert {r.kept for r in audit(one, labels).where("step = 5").collect()} == {0}


def test_ranks_follow_the_letters():
    orders = sorted(permutations(range(5)))
    assert [lehmer_rank(o) for o in orders] == list(range(120))
    assert lehmer_rank((2, 0)) == orders.index((2, 0, 1, 3, 4))


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(doc_id, source, lang, n_chars, text):
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return _h(*fields)


def _levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def _walk(levels, i):
    """Siblings of leaf ``i`` with their side."""
    for level in levels[:-1]:
        j = i ^ 1
        yield (level[j], j < i) if j < len(level) else (None, False)
        i >>= 1


def _manifest_by_hand(rows):
    lists = {}
    for r in rows:
        lists.setdefault(r[2], []).append(r)
    # Null first, then bytewise.
    langs = sorted(lists, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(lists[lang], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(*r)))
        trees[lang] = own, _levels([_leaf(*r) for r in own])
    top = _levels([trees[x][1][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        own, levels = trees[lang]
        for i, r in enumerate(own):
            path = [*_walk(levels, i), *_walk(top, k)]
            h = levels[0][i]
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                h = _leaf(*r[:3], r[3] + 1, r[4])
            for sibling, left in path:
                h = _h(h) if sibling is None else _h(sibling, h) if left else _h(h, sibling)
            proof = _h(*[s for s, _ in path if s is not None])
            out.append((r[0], levels[0][i], levels[-1][0], top[-1][0], proof, h, h == top[-1][0]))
    return sorted(out, key=str)


FIELDS = "doc_id long, source string, lang string, n_chars long, text string, part string, pos long, digest binary, root int"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize(("bits", "n"), [(1, 23), (2, 70), (10, 70)])
def test_manifest_equals_trees_built_by_hand(spark, bits, n):
    langs = ["en", "en", "de", "Z", "é", "", None]
    rows = [(i * 3 + 1, "s", langs[i % 7], i, "t" * i) for i in range(n)]
    rows += [(4, "s", "en", 1, "again"), (None, None, None, None, None), (7, "", "fr", None, "a\n☃"), (-5, "x", "en", -1, "")]
    docs = spark.createDataFrame([(*r, "p", 1, b"", 2) for r in rows], FIELDS)
    got = sorted([tuple(r[c] for c in COLUMNS) for r in verify(manifest(docs, bits=bits)).collect()], key=str)
    assert got == _manifest_by_hand(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_manifest_of_equal_rows_many_lists_and_no_rows(spark):
    same = [(7, "s", "en", 3, "abc")] * 5
    docs = spark.createDataFrame([(*r, "p", 1, b"", 2) for r in same], FIELDS)
    got = verify(manifest(docs, bits=1)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == _manifest_by_hand(same)
    many = [(i, None, f"l{i}", i, "x" * 30_000) for i in range(11)]
    docs = spark.createDataFrame([(*r, "p", 1, b"", 2) for r in many], FIELDS)
    got = verify(manifest(docs, bits=1)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == _manifest_by_hand(many)
    assert verify(manifest(docs.limit(0))).count() == 0
    with pytest.raises(ValueError, match="two leaves"):
        manifest(docs, bits=0)


@pytest.mark.parametrize("n", range(1, 18))
def test_witnesses_grow_with_later_leaves(n):
    frontier, leaves = Frontier(), [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    for i, leaf in enumerate(leaves):
        frontier.append(leaf)
        # A leaf of an open subtree knows the way to that subtree's root.
        for _, digest, first in frontier.open:
            assert fold(leaves[first], bytes(frontier.witness[first])) == digest
        assert sum(1 << height for height, _, _ in frontier.open) == i + 1
    root = frontier.close()
    assert root.hex() == _levels([x.hex() for x in leaves])[-1][0]
    assert all(fold(x, bytes(w)) == root for x, w in zip(leaves, frontier.witness))
    other = Frontier()
    other.append(leaves[0])
    assert fold(leaves[0], b"---") == other.close(3)


VECTORS = "vec_id long, embedding array<double>, node long, key string, n int, label int"


def _near_by_hand(rows, cosine):
    usable = [
        k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    width = max([len(rows[k][1]) for k in usable], default=1)
    units = np.zeros((len(rows), width))
    for k in usable:
        units[k, : len(rows[k][1])] = np.array(rows[k][1]) / max(map(abs, rows[k][1]))
        units[k] /= np.linalg.norm(units[k])
    links = units @ units.T >= cosine
    links[np.arange(len(rows)), np.arange(len(rows))] = False
    label = np.arange(len(rows))
    while True:
        low = np.array([min([label[k], *label[links[k]]]) for k in range(len(rows))])
        if (low == label).all():
            break
        label = low
    out = []
    for k, (vec_id, _) in enumerate(rows):
        ids = [rows[m][0] for m in np.flatnonzero(label == label[k]) if rows[m][0] is not None]
        least = min(ids, default=None)
        out.append((vec_id, int(links[k].sum()), least, vec_id == least))
    return sorted(out, key=str)


def _near(spark, rows, **kw):
    table = spark.createDataFrame([(i, v, 1, "k", 2, 3) for i, v in rows], VECTORS)
    got = near.near_vectors(table, **kw)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted([tuple(r) for r in got.collect()], key=str)


def _clouds(rng, width, sizes, spreads):
    out = []
    for n, spread in zip(sizes, spreads):
        centre = rng.normal(size=width)
        centre /= np.linalg.norm(centre)
        out += (centre + rng.normal(size=(n, width)) * spread).tolist()
    return out


@pytest.mark.parametrize(
    ("width", "block_dims", "cell_rows", "cosine"), [(12, 4, 60, 0.9), (12, 3, 5000, 0.9), (6, 2, 100, 0.97), (5, 16, 40, 0.8)]
)
def test_near_vectors_equal_all_pairs(spark, width, block_dims, cell_rows, cosine):
    rng = np.random.default_rng(width * 7 + block_dims)
    # Random ones, tight groups (whole balls), loose ones (chains) and copies.
    found = rng.normal(size=(350, width)).tolist()
    found += _clouds(rng, width, [180, 40, 60, 60, 3, 2], [0.01, 0.02, 0.12, 0.2, 0.05, 0.01])
    found += [found[0]] * 5 + [found[400]] * 20 + [(np.array(found[1]) * 4).tolist()]
    ids = rng.permutation(len(found)).tolist()
    rows = list(zip(ids, found))
    assert _near(spark, rows, block_dims=block_dims, cell_rows=cell_rows, cosine=cosine) == _near_by_hand(rows, cosine)


def test_near_vectors_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 2.0]),
        (8, [1.0, 2.0]), (8, [1.0, 2.0]), (9, [2.0, 4.0]), (10, [1.0]), (11, [1.0, 0.0]), (None, [0.0, 0.0, -1.0]),
        (None, [0.0, 0.0, -1.0]), (12, [1e300, 1e299]), (13, [1e-310, 1e-311]), (14, [-0.0, 3.0]), (15, [0.0, 3.0]),
        (16, [0.0, -3.0]), (17, [1e-200, 0.0, 5.0]),
    ]
    assert _near(spark, rows) == _near_by_hand(rows, 0.9)
    assert _near(spark, []) == []
    assert _near(spark, [(1, None)]) == [(1, 0, 1, True)]
    with pytest.raises(ValueError, match="cosine"):
        near.near_vectors(spark.createDataFrame([], VECTORS), cosine=0)


def test_near_vectors_at_the_limit_are_decided_in_double_precision(spark):
    # Cosines of 0.9 plus and minus 1e-9, beyond what single precision can tell.
    rows = []
    for k, off in enumerate([1e-9, -1e-9, 1e-12, -1e-12, 2e-6, -2e-6]):
        c, axis = 0.9 + off, [0.0] * 12
        x, y = axis.copy(), axis.copy()
        x[2 * k] = 1.0
        y[2 * k], y[2 * k + 1] = c, (1 - c * c) ** 0.5
        rows += [(2 * k, x), (2 * k + 1, y)]
    got = {i: n for i, n, *_ in _near(spark, rows)}
    assert [got[2 * k] for k in range(6)] == [1, 0, 1, 0, 1, 0]


def test_a_tight_group_is_answered_without_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = list(enumerate(_clouds(rng, 16, [400], [0.01]) + rng.normal(size=(100, 16)).tolist()))
    sent = []
    inner = near._sent
    monkeypatch.setattr(near, "_sent", lambda active, *a: sent.append(active.count()) or inner(active, *a))
    assert _near(spark, rows) == _near_by_hand(rows, 0.9)
    assert sent[0] <= 100


def test_each_pair_meets_once_in_its_block(spark):
    rng = np.random.default_rng(11)
    points = rng.normal(size=(300, 4))
    tree = near.Tree.grow(points, 8)
    home = tree.cells(points)
    assert sorted(set(home.tolist())) == list(range(8))
    reached = tree.reached(points, 0.4)
    assert reached[np.arange(300), home].all()
    close = ((points[:, None] - points[None]) ** 2).sum(2) <= 0.16
    for i, j in zip(*np.nonzero(close)):
        assert reached[i, home[j]]
    assert near.Tree.grow(np.zeros((5, 3)), 4).cells(np.zeros((2, 3))).tolist() == [0, 0]
    assert near.Tree.grow(np.zeros((0, 3)), 4).cells(np.ones((1, 3))).tolist() == [0]
