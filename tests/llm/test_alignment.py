import hashlib
import json
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkretail.llm import alignment
from sparkretail.llm.queries import op11_token_alignment
from tests.llm.conftest import EDGE

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
HARD = ["Hello  world\n\tx ", "naïve café <|endoftext|> <s> </s> <unk> <0x41>", "日本語 テキスト 😀👍🏽 ½", "a▁b", "▁", " ", "\n\n", "é \u0000 ﻿ x",
        "\r\n" * 50, "=" * 300, "١٢٣ Здравствуйте мир", "don't we'll I'VE", "aaaaaaaaaaaaaaaaaaaaaaa aaaaaaaa"]


@pytest.fixture(scope="module")
def plain():
    """Tokens of a text as (id, bytes) lists, by the libraries alone."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in keep} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in keep)}
    entry = {i: t for t, i in json.loads(Path(A).read_text("utf-8"))["model"]["vocab"].items()}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        x = [(i, bytes(byte[c] for c in entry[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, piece(i)) for i in b.encode(text)]
        whole = (" " + text).encode()
        if b"".join(t for _, t in x) != whole or b"".join(t for _, t in y) != whole:
            return [], []
        return x, y

    return tokens


def brute(plain, rows):
    """The contract, token by token."""
    all_links, out, count = [], [], Counter()
    for doc, text in rows:
        spans = []
        for side in plain(text):
            at, mine = 0, []
            for i, t in side:
                mine.append((i, at, at + len(t)))
                at += len(t)
            spans.append(mine)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, links, x, y = [], [], 0, 0
        for e in ends:
            p, q = [], []
            while x < len(spans[0]) and spans[0][x][2] <= e:
                p.append(spans[0][x])
                x += 1
            while y < len(spans[1]) and spans[1][y][2] <= e:
                q.append(spans[1][y])
                y += 1
            groups.append(",".join(str(i) for i, _, _ in p) + "|" + ",".join(str(i) for i, _, _ in q))
            links += [(i, j) for i, s, t in p for j, u, v in q if max(s, u) < min(t, v)]
        count.update(links)
        all_links.append(links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append([doc, len(spans[0]), len(spans[1]), len(groups), len(links), sha])
    top = defaultdict(int)
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    return sorted(((d, a, b, g, n, sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links), sha)
                   for (d, a, b, g, n, sha), links in zip(out, all_links)), key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


ROWS = [*EDGE[:7], (8, "x" * 20_000), (9, "A B C D E F G"), (10, "word " * 5_000), (None, "no id here"), *((100 + i, t) for i, t in enumerate(HARD))]


def test_edge_rows(docs, plain):
    assert rows_of(alignment.token_alignment(docs(ROWS))) == brute(plain, ROWS)
    empty = alignment.token_alignment(docs([]))
    assert empty.columns == COLUMNS and empty.count() == 0
    assert rows_of(alignment.token_alignment(docs([(1, None), (2, ""), (3, "▁")]))) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_rare_pairs_are_joined(docs, plain, monkeypatch):
    """With few pairs sent to every task the rest goes through the shuffle."""
    monkeypatch.setattr(alignment, "HOT", 3)
    assert rows_of(alignment.token_alignment(docs(ROWS))) == brute(plain, ROWS)


def test_query(spark, sf_small, real, plain):
    assert rows_of(op11_token_alignment(spark, sf_small)) == brute(plain, [(r.doc_id, r.text) for r in real.collect()])


def test_groups_and_counts(docs, plain):
    rows = ROWS[-len(HARD):]
    aligned = alignment.align(docs(rows)).collect()
    assert {r.doc_id: r.n_groups for r in aligned} == {d: r.groups.count(";") + 1 if r.groups else 0 for d, r in
                                                       ((r.doc_id, r) for r in aligned)}
    links = sum(r.n_links for r in aligned)
    counts = alignment.pair_counts(alignment.align(docs(rows))).collect()
    assert sum(r.n for r in counts) == links and len({r.pair for r in counts}) == len(counts)
    # the identity map joins equal bytes
    t = alignment.Tokens(A, B)
    assert all(t.bytes_a[i] == t.bytes_b[j] for i, j in enumerate(t.same) if j >= 0)


@pytest.fixture(scope="module")
def aligners():
    whole = alignment.Aligner(alignment.Tokens(A, B))
    whole.tokens.chunked = False
    parts = alignment.Aligner(alignment.Tokens(A, B))
    assert parts.tokens.chunked
    return parts, whole


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.text(" \t\n\rab;{}()>'1.,é", max_size=60), st.text(), st.text("the and ing\r\n", max_size=200),
    st.lists(st.sampled_from(["word", " word", "\r\n", "  ", "\n\n", "don't", "x;\r", "\t", "}\r\n", "é", "12", "'s "]), max_size=30).map("".join)),
    min_size=1, max_size=6))
def test_chunks_give_what_whole_texts_give(aligners, texts):
    """Also with chunks remembered from other texts."""
    a, b = (x.align(texts) for x in aligners)
    for c in ("n_a", "n_b", "n_groups", "n_links"):
        assert a[c].tolist() == b[c].tolist()
    assert a["groups"] == b["groups"]
    for c in ("same", "pairs"):
        assert all(x.tolist() == y.tolist() for x, y in zip(a[c], b[c]))


def test_memory_of_chunks_is_bounded(aligners, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    part = alignment.Aligner(aligners[0].tokens)
    for k in range(4):
        texts = [f"some words of text {k} {i} here" for i in range(5)]
        assert part.align(texts)["groups"] == aligners[1].align(texts)["groups"]
        assert len(part.number) < 40
    monkeypatch.setattr(alignment, "SLICE", 100)
    part.align(["x" * 1000])
    assert not part.number
