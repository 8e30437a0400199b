import itertools
import re
import time

import pytest

from sparkretail.llm import licenses
from tests.llm.conftest import EDGE

LOWER = {c: c + 32 for c in range(65, 91)}
BASE = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at = [(i, v) for i in range(len(words)) for k, v in BASE.items() if tuple(words[i:i + len(k)]) == k]
    first, last = min((i for i, _ in at), default=None), max((i for i, _ in at), default=None)
    return len(words), len(at), first, last, ",".join(sorted({v for _, v in at}))


def test_base_columns_equal_brute_force(spark, docs, real):
    made = [*EDGE, (50, "MIT License mit\tlicense; Apache-License general public license"), (51, "submit license mit licenses"),
            (52, "é mit license ñ"), (53, "mit license" * 2), (54, "mit  \n license mit license mit license")]
    for frame in (docs(made), real):
        texts = [(r.doc_id, r.text) for r in frame.collect()]
        got = licenses.scan(frame).collect()
        want = sorted((k, *brute(t)) for k, t in texts)
        assert sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == \
            sorted(want, key=lambda x: tuple(str(v) for v in x)) or sorted(
                map(str, [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got])) == sorted(map(str, want))
        for r in got:
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""} and 0 <= r.score < 1
            assert (r.score == 0) == (r.labels == "")
    assert licenses.scan(docs([])).count() == 0


def satisfied(text, held):
    """Whether the licenses held satisfy an expression: Python's own and/or."""
    words = re.findall(r"\(|\)|[a-z0-9.+\-]+", re.sub(r" with \S+?(?=[ )]|$)", "", text.lower()))
    return eval(" ".join(w if w in ("(", ")", "and", "or") else str(licenses.family(w) in held) for w in words))


@pytest.mark.parametrize("text", [
    "MIT", "MIT OR Apache-2.0", "MIT AND (GPL-2.0-only WITH Classpath-exception-2.0 OR BSD-3-Clause)", "A OR B AND C",
    "(A OR B) AND C", "A AND B OR A AND C", "(A OR B) AND (A OR C)", "GPL-2.0 OR GPL-3.0", "A AND (B AND (C OR (D AND MIT)))"])
def test_evaluation_equals_truth_tables(text):
    may, need = licenses.evaluate(licenses.parse_expression(text))
    names = sorted({licenses.family(w) for w in re.findall(r"[a-z0-9.+\-]+", re.sub(r" with \S+?(?=[ )]|$)", "", text.lower()))
                    if w not in ("and", "or")})
    sets = [set(c) for k in range(len(names) + 1) for c in itertools.combinations(names, k)]
    ways = [s for s in sets if satisfied(text, s)]
    least = [s for s in ways if not any(w < s for w in ways)]
    assert need == set.intersection(*map(set, ways)) and may >= set().union(*least) and may == set(names)


def test_hostile_lines_take_linear_time():
    s = licenses.Scanner()
    start = time.perf_counter()
    clauses = " AND ".join(f"(A{i} OR B{i})" for i in range(1000))
    nested = "(" * 1000 + "MIT" + " OR BSD)" * 1000
    got = s.scan(f"SPDX-License-Identifier: {clauses}\nSPDX-License-Identifier: {nested}\n")
    assert len(got.expressions) == 2 and {"mit", "bsd", "a0", "b999"} <= got.tagged and not got.required
    got = s.scan("SPDX-License-Identifier: " * 25_000 + "SPDX-License-Identifier: MIT\n" * 25_000)
    assert got.tagged == {"mit"} and len(got.expressions) == 25_000
    assert time.perf_counter() - start < 2


@pytest.mark.parametrize("text", ["", "AND", "MIT OR", "(MIT", "MIT)", "MIT BSD", "OR MIT", "()", "(MIT) BSD"])
def test_bad_expressions(text):
    assert licenses.parse_expression(text) is None


def test_tags(spark, docs):
    rows = [(1, "// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 OR MIT\nint x;"),
            (2, "SPDX-License-Identifier: Apache-2.0 and more words"), (3, "Licensed under CC BY-NC 4.0.")]
    got = {r.doc_id: r for r in licenses.scan(docs(rows)).collect()}
    assert got[1].labels == "gpl,mit" and got[1].n_base == 0 and got[1].score > 0.9
    assert got[1].expressions == ["gpl-2.0-only classpath-exception-2.0 with mit or"] and got[1].required == ""
    assert got[2].labels == "apache" and "cc-by-nc" in got[3].labels and got[2].required == "apache"
