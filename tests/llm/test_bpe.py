import hashlib
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkretail.llm import bpe
from sparkretail.llm.queries import op13_bpe_codec
from tests.llm.conftest import EDGE

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["It's we'll I'VE 'S x'D 12a3 <|endoftext|>a<|startoftext|> <|EndOfText|> <|", "Été ÀÉÎ ß ÿ Ł × ÷ İı ŉ ǰ ſ", "ΣΑΣ σας ΑΣ",
        "é å 가 가", "日本語 テキスト 😀👍🏽 ½ ² Ⅷ ٣", "a b c\u0085d​e﻿\u0000f", "\x0b\x0c\x1c \t\r\n",
        "ñandú–—‘’“” ...!!! ==>", "x" * 5000, "é" * 3000, "!?" * 4000, "aB" * 2000 + "́", "ǀǃ İstanbul ﬁ ﬂ"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def codec():
    return bpe.WordBpe(PATH)


def ids_of(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def same(codec, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    packed = codec.encode(text)
    assert ids_of(packed) == want, repr(text[:80])
    assert codec.decode(packed) == library.decode(want, skip_special_tokens=False)


def test_hard_texts(codec, library):
    for text in HARD:
        same(codec, library, text)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(), st.text("abcdefghijklmnopqrstuvwxyz' ABC.1é<|>", max_size=150), st.text("tionghaedrs", max_size=300)))
def test_as_the_library(codec, library, text):
    same(codec, library, text)


def test_real_texts(codec, library, real):
    for r in real.collect():
        same(codec, library, r.text or "")


def test_scanning_and_heap_agree(codec):
    word = b"ationinghtheren" * 6
    parts = [*(codec.inner[b] for b in word[:-1]), codec.last[word[-1]]]
    assert len(parts) <= bpe.SCAN and codec._merge_long(parts) == codec.merge(word)


def test_memory_of_words_is_bounded(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    codec.known.clear()
    same(codec, library, " ".join(f"word{i}xy" for i in "abcdefghij"))
    assert len(codec.known) <= 3


def test_edge_rows(docs, library):
    rows = [*EDGE, (None, "no id"), *((100 + i, t) for i, t in enumerate(HARD))]
    got = sorted((r.doc_id or 0, bytes(r.ids), r.decoded) for r in bpe.encode_decode(docs(rows)).collect())
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d or 0, struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    assert bpe.encode_decode(docs([])).count() == 0


def test_query(spark, sf_small, library, real):
    got = {r.doc_id: r for r in op13_bpe_codec(spark, sf_small).collect()}
    assert len(got) == real.count()
    for r in real.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        row = got[r.doc_id]
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
