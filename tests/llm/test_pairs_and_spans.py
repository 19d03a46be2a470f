"""Jaccard join, sentence spans, fingerprints and search against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from braidwork.llm import bottomk_fingerprint as bk
from braidwork.llm import kdtree_topk as kd
from braidwork.llm import ngram_jaccard as nj
from braidwork.llm import sentence_spans as ss
from braidwork.llm.components import connected_components
from braidwork.llm.hashing import shingle_sets

DOCS = "doc_id long, text string, h long, n double"


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def shingles(text: str | None, width: int) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def prose(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) for _ in range(n)]


def corpus(seed: int) -> list[tuple]:
    rng, rows = random.Random(seed), []
    for base in range(6):
        w = prose(rng, rng.choice([4, 40, 90, 200]))
        for _ in range(rng.choice([1, 3, 12])):
            v = list(w)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                at = rng.randrange(len(v))
                v[at : at + rng.randint(0, 2)] = prose(rng, rng.randint(0, 2))
            rows.append(" ".join(v) or "x")
    passage = " ".join(prose(rng, 30))
    rows += [" ".join(prose(rng, 20)) + " " + passage for _ in range(8)]
    rows += ["", None, " \t\n ", "one", "One", "one two", "one two", "É x y", "é x y", "w " * 3000, "w w w w"]
    ids = list(range(100, 100 + len(rows)))
    rng.shuffle(ids)
    return [(i, t, 7, 0.5) for i, t in zip(ids, rows)] + [(ids[0], rows[0], 7, 0.5)]


def brute_components(rows: list[tuple], width: int, num: int, den: int) -> dict[tuple, int]:
    sets = {(i, t): shingles(t, width) for i, t, *_ in rows}
    keys = list(sets)
    up = {k: k for k in keys}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in keys:
        for b in keys:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    least = defaultdict(list)
    for k in keys:
        least[find(k)].append(k[0])
    return {k: min(least[find(k)]) for k in keys}


@pytest.mark.parametrize(("width", "num", "seed"), [(3, 90, 1), (5, 80, 2)])
def test_components_equal_brute_force(spark, width, num, seed):
    rows = corpus(seed)
    want = brute_components(rows, width, num, 100)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = nj.jaccard_components(docs, width=width, num=num)
    found = {(r.doc_id, r.row): (r.component_id, r.n_shingles) for r in got.collect()}
    hashed = {(r.doc_id, r.row): r.text for r in docs.selectExpr("doc_id", "text", "xxhash64(text) row").collect()}
    assert got.count() == len(rows)
    for key, text in hashed.items():
        assert found[key] == (want[key[0], text], len(shingles(text, width)))
    kept = nj.one_per_component(docs, got).collect()
    heads = {(i, t) for (i, t), c in want.items() if i == c}
    assert {(r.doc_id, r.text) for r in kept} == heads and len(kept) == len(heads)


def test_components_of_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], DOCS)
    assert nj.jaccard_components(empty).count() == 0
    rows = [(None, "a b c d e f", 1, 1.0), (5, "a b c d e f", 1, 1.0), (None, "only null ids here and more", 1, 1.0)]
    got = nj.jaccard_components(spark.createDataFrame(rows, DOCS))
    assert sorted(((r.doc_id, r.component_id) for r in got.collect()), key=str) == [(5, 5), (None, 5), (None, None)]
    assert nj.one_per_component(spark.createDataFrame(rows, DOCS), got).count() == 2


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91), (91, 91)], "a long, b long")
    got = {r.node: r.comp for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 91: 90}


def test_shingle_sets_of_odd_texts():
    texts = ["a b c", "A  B\tc", "", None, "x", "a b a b a b", "  lead", "q" * 3_000_000 + " b c d"]
    sizes = [len(s) for s in shingle_sets(pa.array(texts), 3)]
    assert sizes == [len(shingles(t, 3)) for t in texts]


def brute_spans(rows: list[tuple], sentences: int, least: int) -> dict[tuple, set[int]]:
    seen, where, covered = set(), [], defaultdict(set)
    docs = sorted({(i, t) for i, t, *_ in rows if t is not None}, key=lambda r: (r[0], r[1]))
    stop = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    for key in docs:
        spans, parts = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", key[1])], []
        for k, (a, b) in enumerate(spans):
            if k == 0 or key[1][spans[k - 1][1] - 1] in stop or "\n" in key[1][spans[k - 1][1] : a]:
                parts.append([])
            parts[-1].append(lower(key[1][a:b]))
        for i in range(len(parts)):
            j = i
            while j < len(parts) and (j - i < sentences or sum(map(len, parts[i:j])) < least):
                j += 1
            if j - i >= sentences and sum(map(len, parts[i:j])) >= least:
                where.append((tuple(w for p in parts[i:j] for w in p), key, i, j))
    times = Counter(w[0] for w in where)
    for span, key, i, j in where:
        if times[span] > 1 and span in seen:
            covered[key].update(range(i, j))
        seen.add(span)
    return covered


def test_repeated_spans_equal_brute_force(spark):
    rng = random.Random(5)

    def text(n: int) -> str:
        return " ".join(w + rng.choice(["", "", "", ".", ",", "!\n"]) for w in prose(rng, n))

    shared = text(60)
    rows = [(k, text(50) + " " + shared + " " + text(20), 1, 1.0) for k in range(6)]
    rows += [(10, shared + "\n" + shared, 1, 1.0), (11, "", 1, 1.0), (12, None, 1, 1.0), (13, "a. b. c.", 1, 1.0)]
    rows += [(14, "short. text.", 1, 1.0)] * 2 + [(0, text(90), 1, 1.0), (15, "one " * 5000, 1, 1.0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = ss.remove_repeats(docs)
    want = brute_spans(rows, ss.SENTENCES, ss.WORDS)
    assert got.columns == ["doc_id", "text", "h", "n", "n_sentences", "n_removed"] and got.count() == len(rows)
    by_id = defaultdict(list)
    for r in got.collect():
        by_id[r.doc_id].append(r)
    for i, t, *_ in rows:
        if len(by_id[i]) == 1:
            assert by_id[i][0].n_removed == len(want.get((i, t), ()))
    assert by_id[12][0].text is None and by_id[13][0].text == "a. b. c."
    middle = " ".join(shared.split()[20:40])
    assert sum(middle in " ".join((r.text or "").split()) for rs in by_id.values() for r in rs) == 1
    assert ss.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def all_runs(rows: list[tuple], sentences: int, least: int) -> dict[int, set[int]]:
    """Sentences that any repeated run covers, every run hashed; first occurrences stay."""
    first, where, covered = {}, [], defaultdict(set)
    for key, text in sorted((i, t) for i, t, *_ in rows):
        parts = [lower(x).split() for x in re.findall(r"[^.,]+[.,]?", text) if x.split()]
        for i in range(len(parts)):
            for j in range(i + sentences, len(parts) + 1):
                run = tuple(w for p in parts[i:j] for w in p)
                if len(run) >= least:
                    where.append((run, key, i, j))
                    first.setdefault(run, (key, i))
    for run, key, i, j in where:
        if first[run] != (key, i):
            covered[key].update(range(i, j))
    return covered


def test_repeated_regions_go_to_their_end(spark):
    rng = random.Random(12)
    clause = lambda n: " ".join(prose(rng, n)) + rng.choice(".,")
    tail = " ".join([clause(6), clause(6), clause(3)])
    rows = [(1, tail, 1, 1.0), (2, tail, 1, 1.0)]
    regions = [" ".join(clause(rng.randint(1, 14)) for _ in range(rng.randint(2, 9))) for _ in range(25)]
    for k in range(60):
        parts = [rng.choice(regions) if rng.random() < 0.5 else clause(rng.randint(1, 9)) for _ in range(6)]
        rows.append((10 + k, " ".join(parts), 1, 1.0))
    want = all_runs(rows, ss.SENTENCES, ss.WORDS)
    got = {r.doc_id: r for r in ss.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(3), ends=True).collect()}
    assert got[2].text == "" and got[2].n_removed == 3 and got[1].text == tail
    assert {i: r.n_removed for i, r in got.items()} == {i: len(want[i]) for i in got}


def test_fingerprints_of_edits_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(prose(rng, rng.choice([0, 1, 3, 30, 400]))), 1, 1.0) for k in range(0, 60, 2)]
    rows += [(7, None, 1, 1.0), (9, "é🙂 ü" * 9, 1, 1.0), (9, "é🙂 ü" * 9, 1, 1.0), (71, "same text", 1, 1.0), (73, "same text", 1, 1.0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = bk.fingerprint_edits(docs, n_buckets=5).collect()
    ordered = sorted(((i, t or "") for i, t, *_ in rows))
    want = Counter()
    for k, (i, t) in enumerate(ordered):
        after, q = ordered[(k + 1) % len(ordered)][1], len(t) // 4
        want[i, len(t), hashlib.sha256((t[: len(t) - q] + after[:q]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[71] == prints[73] and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert next(r for r in got if r.doc_id == 71).near_next == 1.0
    assert bk.fingerprint_edits(spark.createDataFrame([], DOCS)).count() == 0
    assert [r.near_next for r in bk.fingerprint_edits(spark.createDataFrame(rows[:1], DOCS)).collect()] == [1.0]


def test_sketches_merge_and_estimate():
    rng = random.Random(1)
    w = prose(rng, 4000)
    whole, a, b = (next(bk.sketches(pa.array([" ".join(x)]), width=1)) for x in (w, w[:3000], w[2000:]))
    assert (bk.merge(a, b) == whole).all() and (bk.read_sketch(bk.write_sketch(a)) == a).all()
    sa, sb = set(w[:3000]), set(w[2000:])
    assert abs(bk.resemblance(a, b) - len(sa & sb) / len(sa | sb)) < 0.15
    assert abs(bk.containment(b, a) - len(sa & sb) / len(sb)) < 0.25
    assert abs(bk.distinct_shingles(whole) / len(set(w)) - 1) < 0.3
    none = a[:0]
    assert bk.resemblance(none, none) == 1.0 and bk.resemblance(none, a) == 0.0


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_search_equals_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(kd, "SHARD_ROWS", 40)
    monkeypatch.setattr(kd, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(0, 1, 6) * scale).tolist(), 1) for i in range(300)]
    rows[50] = rows[7][:0] + (50, rows[7][1], 1)
    rows += [(400 + i, rows[7][1], 1) for i in range(60)]
    rows += [(None, [1.0] * 6, 1), (900, None, 1), (901, [None] * 6, 1), (950, [float("nan")] * 6, 1), (902, [float("inf")] + [0.0] * 5, 1), (903, [2.0], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = kd.exact_topk(vectors, vectors.where("vec_id % 50 = 0"), k=5).collect()
    good = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good[i] = [int(np.floor(256.0 * x)) for x in v]
    want = []
    for q in [i for i in good if i % 50 == 0]:
        scored = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_search_of_few_or_no_rows(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert kd.exact_topk(spark.createDataFrame([], kind), spark.createDataFrame([], kind)).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0], 1), (3, [1.0, 1.0], 1)], kind)
    assert [tuple(r) for r in kd.exact_topk(two, two.where("vec_id = 0")).collect()] == [(0, 1, 3, 3 * 65536)]


def test_only_the_querys_own_row_is_no_candidate(spark):
    rows = [(0, 50, [1.0, 0.0]), (1, 50, [0.5, 0.5]), (2, 50, [0.5, 0.5]), (3, 7, [0.25, 0.25])]
    table = spark.createDataFrame(rows, "row long, vec_id long, embedding array<double>")
    found = kd.exact_topk(table, table.where("vec_id % 50 = 0"), k=2, row_key="row").collect()
    lists = sorted([(r.rank, r.vec_id, r.score) for r in found if r.query_id == 50])
    assert len(found) == 6 and lists == sorted(
        [(1, 50, 256 * 128), (2, 50, 256 * 128)] + [(1, 50, 256 * 128), (2, 50, 2 * 128 * 128)] * 2
    )


def test_answers_are_derived_from_leaders(spark):
    """Two families around leaders that are alike, and one that is far away, at a threshold of 0.6."""
    sets = {0: list(range(100)), 1: [*range(5, 100), *range(500, 505)], 2: [*range(300, 390), *range(0, 10)]}
    members = {(f, k): [x + 0 for x in sets[f][k:]] + [9_000 + 100 * f + 10 * k + j for j in range(k)] for f in sets for k in (1, 2)}
    nodes, numbered = {}, {}
    for i, (name, values) in enumerate([*((f, v) for f, v in sets.items()), *members.items()]):
        nodes[i], numbered[name] = values, i
    lists = spark.createDataFrame([(i, len(v), v) for i, v in nodes.items()], "node long, n long, hashes array<long>")

    def apart(x, y):
        x, y = set(nodes[x]), set(nodes[y])
        return 1 - len(x & y) / len(x | y)

    rows = []
    for (f, k) in members:
        for (g, m) in members:
            if f < g:
                a, b = numbered[f, k], numbered[g, m]
                rows.append((a, b, numbered[f], numbered[g], apart(a, numbered[f]), apart(b, numbered[g])))
    pairs = spark.createDataFrame(rows, "a long, b long, lead_a long, lead_b long, gap_a double, gap_b double")
    got = {(r.a, r.b): r.answer for r in nj.derived_answers(pairs, lists, nj._Threshold(60, 100)).collect()}
    assert len(got) == len(rows)
    for (a, b), answer in got.items():
        assert answer is None or answer == (apart(a, b) <= 0.4)
    assert sum(x is True for x in got.values()) >= 3 and sum(x is False for x in got.values()) >= 6


def test_sentences_end_at_marks_of_other_scripts(spark):
    passage = "甲 乙 丙 丁 戊 己。 庚 辛 壬 癸 子 丑！ 寅 卯 辰 巳 午 未…"
    rows = [(1, passage, 1, 1.0), (2, f"one two three. {passage} four five six.", 1, 1.0)]
    got = {r.doc_id: r for r in ss.remove_repeats(spark.createDataFrame(rows, DOCS), ends=True).collect()}
    assert got[1].text == passage and got[1].n_sentences == 3
    assert got[2].n_removed == 3 and got[2].text == "one two three. four five six."
