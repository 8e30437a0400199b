import random

import numpy as np
import pytest

from sparkretail.llm import components as components_module
from sparkretail.llm import ngram_join
from sparkretail.llm.components import components
from sparkretail.llm.ngram_join import DivideSkip, block_links, join_forest, ngram_jaccard_join, parity_bits, required_overlap
from tests.llm.conftest import EDGE

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, k):
    w = (text or "").translate(LOWER).replace("\n", " ").replace("\t", " ").split(" ")
    w = [x for x in w if x]
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k, p):
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= p * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, n_base=12, words=60):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    passage = [rnd.choice(vocab) for _ in range(30)]
    rows, i = [], 0
    for b in range(n_base):
        base = [rnd.choice(vocab) + (str(b) if rnd.random() < 0.5 else "") for _ in range(rnd.choice([3, 10, words]))]
        if b % 3 == 0:
            base = passage + base
        for _ in range(rnd.choice([1, 2, 6, 15])):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                t[rnd.randrange(len(t))] = f"e{rnd.randrange(1000)}"
            rows.append((i, " ".join(t)))
            i += 1
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,p,limit", [(3, 90, 10**6), (5, 80, 10**6), (3, 90, 150)])
def test_components_equal_brute_force(spark, docs, k, p, limit):
    rows = near_copies(k * 100 + p)
    got = ngram_jaccard_join(docs(rows), k=k, threshold_pct=p, block_shingles=limit).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, k, p)


@pytest.mark.parametrize("k,p", [(3, 90), (5, 80)])
def test_width_of_separators_does_not_count(spark, docs, k, p):
    """Doubled spaces, CRLF, tabs, indentation: the same words are one set."""
    rnd = random.Random(k)
    rows = [(1, "a b c"), (2, "a  b c"), (3, "x y z x  y z x y z x y z")]
    for i, (_, t) in enumerate(near_copies(k, n_base=6)):
        wide = "".join(w + rnd.choice([" ", "  ", "\t", "\n", "\r\n", "\n\n    "]) for w in t.split(" "))
        rows += [(10 + 3 * i, t), (11 + 3 * i, t.replace(" ", "  ")), (12 + 3 * i, wide)]
    got = ngram_jaccard_join(docs(rows), k=k, threshold_pct=p).collect()
    want = brute([(i, t.replace("\r", " ")) for i, t in rows], k, p)
    assert want[2] == (1, 1) and {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_edges_of_the_input(spark, docs):
    got = ngram_jaccard_join(docs(EDGE), k=3, threshold_pct=90).collect()
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert len(got) == len(EDGE)
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (0, 3) and by[4] == (1, 4) and by[5] == (1, 5)
    assert by[6] == (5, 6) and by[9] == (5, 6) and by[7] == (1, 7) and by[8] == (1, 8)
    assert ngram_jaccard_join(docs([])).count() == 0


def test_divide_skip_equals_scan():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(20):
        base = rng.choice(300, rng.integers(1, 80), replace=False).astype(np.uint64)
        for _ in range(rng.integers(1, 8)):
            s = set(base.tolist())
            for _ in range(rng.integers(0, 4)):
                s.discard(next(iter(s))) if len(s) > 1 else None
                s.add(int(rng.integers(300)))
            sets.append(np.array(sorted(s), np.uint64))
    for p in (50, 80, 90, 100):
        index = DivideSkip(sets, p)
        index.HEAP_MOST = 40  # both ways of merging
        for q in sets:
            want = [i for i, s in enumerate(sets)
                    if 100 * len(np.intersect1d(q, s)) >= p * len(np.union1d(q, s))]
            assert sorted(index.search(q).tolist()) == want
        links = block_links(np.arange(len(sets)), sets, p)
        full = [(i, j) for i, q in enumerate(sets) for j in index.search(q) if i < j]
        assert _classes(links, len(sets)) == _classes(full, len(sets))


def _classes(edges, n):
    label = list(range(n))
    for a, b in edges:
        x, y = label[a], label[b]
        label = [min(x, y) if v in (x, y) else v for v in label]
    return label


def test_bitmaps_never_refuse_a_link():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(5, 400))
        a = rng.choice(2**60, n, replace=False).astype(np.uint64)
        b = a.copy()
        m = int(rng.integers(0, max(1, n // 9)))
        b[:m] = rng.choice(2**60, m, replace=False).astype(np.uint64)
        i = len(np.intersect1d(a, b))
        if i >= required_overlap(len(a), len(b), 80):
            e = join_forest(np.array([len(a), len(b)]), np.array([0, 1]), [parity_bits(a), parity_bits(b)], 80)
            assert e


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(50, 60), (60, 55), (70, 70)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    want = {i: 10 for i in range(10, 41)} | {50: 50, 55: 50, 60: 50}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_steps_end_with_stars(spark, docs, monkeypatch):
    """No step follows once all edges are stars; blocks that fit a task take no steps at all."""
    written = []

    def counted(df, name, write=components_module.stored):
        written.append(name)
        return write(df, name)

    monkeypatch.setattr(components_module, "stored", counted)
    for edges, steps in (([], 0), ([(1, 2), (3, 1), (1, 1), (7, 5)], 0), ([(i, i + 1) for i in range(3)], 2), ([(1, 3), (2, 3)], 1)):
        written.clear()
        got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
        assert written.count("edges") <= 1 + steps
        low = _classes(edges, 8)
        alone = {i for i in range(8) if not any(i in e for e in edges if e[0] != e[1])}
        assert {r.node: r.component for r in got.collect()} == {i: low[i] for i in range(8) if i not in alone}
    written.clear()
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[:40 + i] + [f"x{i}"])) for i in range(9)] + [(i, f"alone{i}") for i in range(20, 25)]
    got = ngram_jaccard_join(docs(rows), k=3, threshold_pct=90)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(rows, 3, 90)
    assert written.count("edges") <= 4  # stars and their pairs


def test_smallest_linked():
    rnd = random.Random(5)
    for n in (2, 10, 60):
        edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(n // 2 + 1)]
        low = _classes(edges, n)
        assert sorted(ngram_join.smallest_linked(edges)) == [(i, low[i]) for i in range(n) if low[i] != i]


def test_doc_ids_that_repeat_with_other_texts(spark, docs):
    """A doc_id is one node, whichever of its texts links; in blocks of one task and of several."""
    w = [f"w{i}" for i in range(80)]
    a, a2, b, b2, c = w[:40], w[:39] + ["y"], w[40:], w[40:79] + ["z"], ["c"] * 5
    rows = [(9, " ".join(a)), (4, " ".join(a2)), (4, " ".join(b)), (2, " ".join(b2)), (6, " ".join(c)), (9, " ".join(a)), (3, "only"), (6, "one")]
    for limit in (10**6, 30):
        got = ngram_jaccard_join(docs(rows), k=3, threshold_pct=90, block_shingles=limit).collect()
        by = {i: {r.component_id for r in got if r.doc_id == i} for i in (9, 4, 2, 6, 3)}
        assert by == {9: {2}, 4: {2}, 2: {2}, 6: {6}, 3: {3}} and len(got) == len(rows)


def test_one_of_each_group(spark, docs):
    d = docs([(1, "a"), (1, "a"), (2, "b"), (1, "c"), (None, "c"), (None, "d"), (4, None), (3, "b"), (4, "")])
    got = ngram_join.one_of_each_group(d)
    assert got.columns == d.columns
    assert sorted((r.doc_id or 0, r.text or "-") for r in got.collect()) == [(0, "d"), (1, "a"), (1, "c"), (2, "b"), (4, "-"), (4, "-")]
    assert ngram_join.one_of_each_group(docs([])).count() == 0
    many = docs([(i, "same words in every one of them " * 20) for i in range(50, 0, -1)])
    assert [r.doc_id for r in ngram_join.one_of_each_group(many).collect()] == [1]
