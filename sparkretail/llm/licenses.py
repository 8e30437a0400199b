"""License scans.

An Aho-Corasick automaton over the normalised words finds notice phrases; a
second pattern set finds identifier tags in the raw text. A shunting-yard parser
turns the and/or/with expression after a tag into postfix form, whose
evaluation says which license families it can be satisfied with and which ones
every way to satisfy it needs. Both take time linear in the text, however many
tags and clauses it has.

``scan`` gives one row per row of ``docs``: repeated rows and null doc_ids are
rows like others, a null text counts as empty (no words, empty label strings,
score 0), texts of any length are scanned whole, extra columns are not read,
and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: phrases and labels that the contract fixes
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: further notice phrases
MORE_PHRASES = {
    "lesser general public license": "lgpl", "affero general public license": "agpl",
    "bsd license": "bsd", "mozilla public license": "mpl", "eclipse public license": "epl",
    "isc license": "isc", "boost software license": "bsl", "the unlicense": "unlicense",
    "creative commons attribution": "cc-by", "cc by": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd", "cc0": "cc0", "all rights reserved": "proprietary",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
#: identifier prefixes and their family
FAMILIES = (("lgpl", "lgpl"), ("agpl", "agpl"), ("gpl", "gpl"), ("apache", "apache"), ("mit", "mit"), ("bsd", "bsd"),
            ("mpl", "mpl"), ("epl", "epl"), ("isc", "isc"), ("bsl", "bsl"), ("unlicense", "unlicense"),
            ("cc0", "cc0"), ("cc-by-nc", "cc-by-nc"), ("cc-by-nd", "cc-by-nd"), ("cc-by-sa", "cc-by-sa"), ("cc-by", "cc-by"))
_TABLE = bytes(32 if not (48 <= i <= 57 or 97 <= i <= 122 or 65 <= i <= 90 or i >= 128)
               else i + 32 if 65 <= i <= 90 else i for i in range(256))
_TOKEN = re.compile(r"\(|\)|[a-z0-9.+\-]+")
_RANK = {"with": 3, "and": 2, "or": 1}


def family(identifier: str) -> str:
    return next((f for p, f in FAMILIES if identifier.startswith(p)), identifier)


def parse_expression(text: str) -> list[str] | None:
    """Postfix form of a license expression by the shunting-yard method; None
    if it is not well formed."""
    out: list[str] = []
    ops: list[str] = []
    operand = False  # whether an operand or a closing bracket came last
    for t in _TOKEN.findall(text.lower()):
        if t == "(":
            if operand:
                return None
            ops.append(t)
        elif t == ")":
            if not operand:
                return None
            while ops and ops[-1] != "(":
                out.append(ops.pop())
            if not ops:
                return None
            ops.pop()
        elif t in _RANK:
            if not operand:
                return None
            while ops and ops[-1] != "(" and _RANK[ops[-1]] >= _RANK[t]:
                out.append(ops.pop())
            ops.append(t)
            operand = False
        else:
            if operand:
                return None
            out.append(t)
            operand = True
    if not operand or "(" in ops:
        return None
    return out + ops[::-1]


def evaluate(postfix: list[str]) -> tuple[set[str], set[str]]:
    """``(possible, required)`` families: those that take part in some way to
    satisfy the expression, and those that every way needs. An exception after
    ``with`` belongs to the license before it. The smaller set is merged into
    the larger one, so the time is that of the operands."""
    stack: list[tuple[set[str], set[str]]] = []
    for t in postfix:
        if t not in _RANK:
            stack.append(({family(t)}, {family(t)}))
            continue
        (may_b, need_b), (may_a, need_a) = stack.pop(), stack.pop()
        if t == "with":
            stack.append((may_a, need_a))
            continue
        may, more = (may_a, may_b) if len(may_a) >= len(may_b) else (may_b, may_a)
        may |= more
        need, other = (need_a, need_b) if len(need_a) >= len(need_b) else (need_b, need_a)
        if t == "and":
            need |= other
        else:
            need = other & need
        stack.append((may, need))
    return stack[0]


@dataclass
class Scan:
    n_words: int
    base: list[tuple[int, str]] = field(default_factory=list)  # first word, label
    more: list[tuple[int, str]] = field(default_factory=list)
    expressions: list[str] = field(default_factory=list)  # postfix, as written
    tagged: set[str] = field(default_factory=set)
    required: set[str] = field(default_factory=set)

    def score(self) -> float:
        """Confidence that the text carries a license: each tag counts most,
        repeated notices add less and less."""
        miss = 0.4 ** min(2, len(self.base)) * 0.6 ** min(2, len(self.more)) * 0.05 ** min(1, len(self.expressions))
        return 1 - miss


class Scanner:
    def __init__(self) -> None:
        self.phrases, self.tags = ahocorasick.Automaton(), ahocorasick.Automaton()
        for p, label in {**MORE_PHRASES, **BASE_PHRASES}.items():
            self.phrases.add_word(f" {p} ", (len(p) + 2, label, p in BASE_PHRASES))
        for t in TAGS:
            self.tags.add_word(t, t)
        self.phrases.make_automaton()
        self.tags.make_automaton()

    def scan(self, text: str | None) -> Scan:
        raw = (text or "").encode()
        words = raw.translate(_TABLE).split()
        found = Scan(len(words))
        line = f" {b' '.join(words).decode()} "
        at = last = 0
        for end, (size, label, base) in self.phrases.iter(line):
            begin = end - size + 1
            at, last = at + line.count(" ", min(last, begin), max(last, begin)) * (1 if begin >= last else -1), begin
            (found.base if base else found.more).append((at, label))
        if ":" in (text or ""):
            low = raw.translate(_LOWER_ONLY).decode()
            ends = [(end + 1 - len(tag), end + 1) for end, tag in self.tags.iter(low)]
            for (_, begin), (stop, _) in zip(ends, [*ends[1:], (len(low), 0)]):
                # to the end of the line or to the next tag
                line_end = low.find("\n", begin, stop)
                expr = low[begin:stop if line_end < 0 else line_end].strip(" \t\r*/#-<>!")
                postfix = parse_expression(expr)
                if not postfix:
                    first = _TOKEN.search(expr)
                    postfix = parse_expression(first[0]) if first else None
                if postfix:
                    found.expressions.append(" ".join(postfix))
                    may, need = evaluate(postfix)
                    found.tagged |= may
                    found.required |= need
        return found


_LOWER_ONLY = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("required", T.StringType()),
    T.StructField("expressions", T.ArrayType(T.StringType())),
])


def scan(docs: DataFrame) -> DataFrame:
    """``labels``: of phrases and of the families that the expressions can be
    satisfied with; ``required``: the families that some expression needs in
    any case; all distinct, sorted, comma-joined. ``expressions`` in postfix."""
    def run(batches):
        s = Scanner()
        for t in batches:
            cols: list[list] = [[] for _ in SCHEMA.names[1:]]
            for text in t.column(1).to_pylist():
                f = s.scan(text)
                at, base = [x for x, _ in f.base], {x for _, x in f.base}
                row = (f.n_words, len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
                       ",".join(sorted(base | {x for _, x in f.more} | f.tagged)), f.score(), ",".join(sorted(f.required)), f.expressions)
                for c, v in zip(cols, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [t.column(0), *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string()),
                 pa.array(cols[5], pa.string()), pa.array(np.array(cols[6], float)),
                 pa.array(cols[7], pa.string()),
                 pa.array(cols[8], pa.list_(pa.string()))], names=SCHEMA.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
