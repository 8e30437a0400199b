import hashlib

import pyarrow as pa

from sparkretail.llm import minhash
from tests.llm.conftest import EDGE


def test_edits_and_hashes(spark, docs):
    rows = [r for r in EDGE if r[0] != 9] + [(20, "ñandú 😀 é" * 5), (15, "x y z " * 50)]
    got = {}
    for r in minhash.edit_fingerprints(docs(rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    order = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    seen: dict = {}
    for i, (k, text) in enumerate(order):
        text, nxt = text or "", order[(i + 1) % len(order)][1] or ""
        h = len(text) // 2
        e = text[:len(text) - h] + nxt[:h]
        r = sorted(got[k], key=lambda r: r.edited_sha256)
        seen.setdefault(k, []).append((len(text), hashlib.sha256(e.encode()).hexdigest()))
        assert all(0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 for x in r)
    for k, want in seen.items():
        assert sorted((r.n_chars, r.edited_sha256) for r in got[k]) == sorted(want)
    assert minhash.edit_fingerprints(docs([])).count() == 0
    one = minhash.edit_fingerprints(docs([(3, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def test_many_ranges(spark, docs):
    rows = [(7 * i, f"text number {i} of some") for i in range(300)]
    cut = minhash.successor_blocks

    def small(d, rows_per_block=25):
        return cut(d, 25)

    minhash.successor_blocks = small
    try:
        got = {r.doc_id: r.edited_sha256 for r in minhash.edit_fingerprints(docs(rows)).collect()}
    finally:
        minhash.successor_blocks = cut
    for i, (k, t) in enumerate(rows):
        e = minhash.edited(t, rows[(i + 1) % 300][1])
        assert got[k] == hashlib.sha256(e.encode()).hexdigest()
    assert len(got) == 300


def test_likeness_estimates_jaccard():
    h = minhash.Hasher(256, 1)
    words = [f"v{i}" for i in range(400)]
    a, b = " ".join(words[:300]), " ".join(words[100:])
    s = h.signatures(pa.array([a, b, a.upper(), None, ""]))
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.1
    assert (s[0] == s[2]).all() and (s[3] == s[4]).all() and (s[3] == 0xFFFFFFFF).all()


def test_near_duplicates(spark, docs):
    base = [f"w{i}" for i in range(100)]
    copies = [(i, " ".join(base[:50] + [f"e{i}"] + base[51:])) for i in range(1, 8)]
    rows = [(0, " ".join(base)), *copies, (20, " ".join(base)), (30, "other text of its own here"), (31, None), (32, "")]
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs(rows)).collect()}
    assert {got[i] for i in [*range(8), 20]} == {0}
    assert (got[30], got[31], got[32]) == (30, 31, 32)


def test_near_duplicates_edges(spark, docs):
    """Empty table, repeated rows, null ids, very long texts."""
    assert minhash.near_duplicates(docs([])).count() == 0
    long = " ".join(f"v{i % 30011}" for i in range(60_000))
    rows = [(1, long), (2, long.upper() + " tail"), (3, "x" * 200_000), (4, "a b c d e f g"), (4, "a b c d e f g"),
            (5, "A  b c\nd e f g"), (None, None), (6, None), (7, "one"), (8, "ONE")]
    got = sorted((r.doc_id or 0, r.class_id or 0) for r in minhash.near_duplicates(docs(rows)).collect())
    assert got == [(0, 0), (1, 1), (2, 1), (3, 3), (4, 4), (4, 4), (5, 4), (6, 6), (7, 7), (8, 7)]
