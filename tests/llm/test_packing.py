import random
import zlib
from array import array
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkretail.llm import packing
from tests.llm.conftest import EDGE


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in {b for b in bins if b + items[i] <= capacity}:
            j = bins.index(room)
            bins[j] += items[i]
            go(i + 1, bins)
            bins[j] -= items[i]
        bins.append(items[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    rnd = random.Random(9)
    for _ in range(250):
        c = rnd.choice([10, 20, 50])
        count = Counter(rnd.randint(1, c) for _ in range(rnd.randint(0, 11)))
        fixed, left = packing.reduce_dominated(dict(count), c)
        used = Counter(left)
        for pattern, n in fixed:
            assert sum(s * k for s, k in pattern) <= c
            for s, k in pattern:
                used[s] += k * n
        assert +used == +count
        assert sum(n for _, n in fixed) + fewest(list(Counter(left).elements()), c) == fewest(list(count.elements()), c)


def test_exact_pair_that_does_not_dominate():
    count = Counter([10, 9, 8, 8, 7, 7, 6, 4])
    fixed, left = packing.reduce_dominated(dict(count), 20)
    assert sum(n for _, n in fixed) + fewest(list(Counter(left).elements()), 20) == 3


def test_plan_places_every_piece_once():
    rnd = random.Random(10)
    for _ in range(60):
        count = Counter(rnd.randint(1, 64) for _ in range(rnd.randint(1, 400)))
        seats = set()
        got = Counter()
        for s, rank, n, sequence, k, at in packing.plan(dict(count), 64):
            assert rank == got[s]
            got[s] += n
            for i in range(n):
                o = at + (i % k) * s
                for x in range(o, o + s):
                    assert x < 64 and (sequence + i // k, x) not in seats
                    seats.add((sequence + i // k, x))
        assert got == count
        assert len({q for q, _ in seats}) <= 1 + -(-sum(s * n for s, n in count.items()) * 11 // (9 * 64)) + 1


def test_pack_edge_rows(spark, docs):
    tok = Tokenizer.from_file(packing.default_tokenizer())
    rows = [*EDGE, (40, "a <|endoftext|> b"), (41, "tab\there  two  spaces\r\n\n"), (42, "日本語 text ñ 😀 x")]
    got = packing.pack(docs(rows), capacity=64).collect()
    by: dict = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for k in {r[0] for r in rows}:
        want = []
        for _, text in [r for r in rows if r[0] == k]:
            ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
            n = len(ids)
            cuts = [0, *range(n % 64 or 64, n + 1, 64)]
            want += [(i, a, b - a, zlib.crc32(array("I", ids[a:b]).tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(by[k]) == sorted(want)
    rooms: dict = {}
    for r in got:
        rooms.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for seats in rooms.values():
        at = 0
        for offset, length in sorted(seats):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(docs([])).count() == 0


@pytest.fixture(scope="module")
def encoders():
    return packing.TokenBytes(packing.default_tokenizer()), Tokenizer.from_file(packing.default_tokenizer())


@settings(max_examples=200, deadline=None)
@given(text=st.text(st.one_of(st.sampled_from("ab éß'!\n\t.19-—’"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_equal_the_tokenizer(encoders, text):
    fast, tok = encoders
    assert fast(text) == array("I", tok.encode(text, add_special_tokens=False).ids).tobytes()
