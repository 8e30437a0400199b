import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np

from sparkretail.llm import spelling
from sparkretail.llm.queries import op12_spelling_variants
from tests.llm.conftest import EDGE


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def counts(rows, least=6, least_n=5, every=199):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= least and n >= least_n}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, factor=5, **kw):
    n = counts(rows, **kw)
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in df.collect())


def variants_of(word, rng, k):
    letters = "abcdefghijéü×"
    out = set()
    for _ in range(k):
        i = rng.randrange(len(word))
        out.add(rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1:]]))
    return out


def corpus(seed, words=30, big=150):
    rng, rows, doc = random.Random(seed), [], 0
    for _ in range(words):
        w = "".join(rng.choice("abcdefghij") for _ in range(rng.choice((6, 7, 8, 9, 40))))
        family = {w: big} | {v: rng.choice((5, 7, 27)) for v in variants_of(w, rng, 6)}
        for v in list(family):
            family |= {x: 5 for x in variants_of(v, rng, 1)}
        for v, n in family.items():
            for _ in range(n):
                rows.append((doc, v if rng.random() < .5 else v.upper()))
                doc += 1
    return rows


def test_block_finds_all_near_pairs():
    rng = random.Random(3)
    for m in (6, 7, 11):
        words = sorted({"".join(rng.choice("abé") for _ in range(m + rng.randrange(2))) for _ in range(150)})
        q, w = spelling.Block(words, m).near(np.arange(len(words)))
        want = {(i, j) for i, j in itertools.permutations(range(len(words)), 2)
                if min(len(words[i]), len(words[j])) == m and one_edit(words[i], words[j])}
        assert len(q) == len(want) and set(zip(q.tolist(), w.tolist())) == want


def test_against_brute_force(docs):
    rows = corpus(1)
    want = brute(rows)
    assert any(r[3] for r in want) and any(r[5] != r[3] and r[3] for r in want)
    assert rows_of(spelling.variants(docs(rows))) == want


def test_hot_halves_are_split(docs, monkeypatch):
    """Words that all share a half, dealt over cells of a few words."""
    monkeypatch.setattr(spelling, "CELL_WORDS", 7)
    rng = random.Random(5)
    words = {"commonbeginning" + "".join(rng.choice("ab") for _ in range(rng.choice((9, 10)))) for _ in range(70)}
    words |= {"".join(rng.choice("ab") for _ in range(7)) + "ending" for _ in range(60)}
    rows = [(i, f"{w} {w}") for i, w in enumerate(sorted(words))] * 4
    assert rows_of(spelling.variants(docs(rows))) == brute(rows)


def test_long_words_and_edges(docs):
    long = "xy" * 30_000
    rows = [*EDGE * 5, *[(200 + i, f"{long} {long}q {long[1:]}") for i in range(5)], (None, "nothing"), (None, "nothing"),
            *[(300 + i, "straßen stra×en STRAßEN Straßen's naïveté naïveté") for i in range(6)]]
    assert rows_of(spelling.variants(docs(rows))) == brute(rows)
    assert spelling.variants(docs([])).count() == 0
    assert spelling.variants(docs([(1, None), (2, "short words no one")])).count() == 0


def test_ties_go_to_the_smallest(docs):
    rows = [(i, w) for w, n in (("abcdef", 5), ("abcdeg", 25), ("abcdeh", 25), ("abcdeé", 25)) for i in range(n)]
    got = {r[0]: r for r in rows_of(spelling.variants(docs(rows), drop_every=10**9))}
    assert got["abcdef"] == ("abcdef", 5, 3, "abcdeg", 25, "abcdeg") and got["abcdeg"][3] is None


def test_query(spark, sf_small, real):
    got = rows_of(op12_spelling_variants(spark, sf_small))
    assert got == brute([(r.doc_id, r.text) for r in real.collect()]) and any(r[3] for r in got)
