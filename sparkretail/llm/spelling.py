"""Spelling variants: which words of a corpus are one edit from another one.

1. Every text gives its runs of letters; per task and batch they are counted
   before they are shuffled (``word_counts``).
2. Two words that differ by one inserted, deleted or replaced letter share the
   first half or the last half of the shorter one, so words are dealt by
   (length of the shorter, side, half). A half shared by many words is dealt
   over (query part, index part) cells of a bounded size, so neither a group
   nor its pairs meet in one task.
3. Within a task, words of whole cells form blocks with a bit-sliced position
   index: a bitset over the words for each (position, letter). All queries of a
   block run letter by letter; word-parallel recurrences keep the set of words
   without an error so far and, at positions shifted by one, the sets with one
   replaced, one additional and one missing letter (``Block.near``).
4. Each block gives per word its number of near words and the best one, summed
   up in Spark; roots come from pointer jumping, whose rounds are bounded since
   counts grow by a factor with every step.

Nothing but sizes reaches the driver. A null text has no words, a null doc_id
counts as the empty text in the hash, repeated rows count each, an empty table
gives an empty result, extra columns are not read. Ties between near words of
equal count go to the smallest in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.components import stored

_RUN = r"[a-zÀ-ÿ]{%d,}"
#: words and letters of one side of a cell (a longer word is a cell of its own)
CELL_WORDS, CELL_LETTERS = 2048, 1 << 17
#: distinct words that a task counts before it hands them on
COUNTED = 200_000


def word_counts(docs: DataFrame, least_length: int = 6, least_n: int = 5, drop_every: int = 199) -> DataFrame:
    """``word, n`` over all texts. A run whose document hash is divisible by
    ``drop_every`` loses one letter (simulated typing errors)."""
    run = re.compile(_RUN % least_length)

    def count(batches):
        found: Counter[str] = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

        for t in batches:
            for doc, text in zip(t.column("doc_id").to_pylist(), t.column("text").to_pylist()):
                if text is None:
                    continue
                start = zlib.crc32(b"%s:" % (b"" if doc is None else b"%d" % doc))
                # lower() of bytes changes A-Z alone
                for w, n in Counter(run.findall(text.encode().lower().decode())).items():
                    h = zlib.crc32(w.encode(), start)
                    if h % drop_every == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                        if len(w) < least_length:
                            continue
                    found[w] += n
                if len(found) >= COUNTED:
                    yield out()
                    found.clear()
        if found:
            yield out()

    return (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n))


class Block:
    """Words of ``m`` or ``m + 1`` letters (U+0061..U+00FF) and their index."""

    def __init__(self, words: list[str], m: int):
        self.m, self.n = m, len(words)
        self.wide = -(-self.n // 64)
        length = np.fromiter(map(len, words), np.int64, self.n)
        self.letters = np.zeros((self.n, m + 1), np.uint8)
        flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.letters[np.arange(m + 1) < length[:, None]] = flat
        self.long = length == m + 1
        # one row per (position, letter) that occurs, an empty one for the rest
        code = (np.arange(m + 1) << 8) + self.letters
        w, at = np.nonzero(self.letters)
        self.codes, row = np.unique(code[w, at], return_inverse=True)
        bits = np.zeros((len(self.codes) + 1, self.wide * 8), np.uint8)
        np.bitwise_or.at(bits, (row, w >> 3), np.left_shift(1, w & 7).astype(np.uint8))
        self.bits = bits.view("<u8")
        self.of_length = self._set(~self.long), self._set(self.long)

    def _set(self, flags: np.ndarray) -> np.ndarray:
        out = np.zeros(self.wide * 64, bool)
        out[:self.n] = flags
        return np.packbits(out, bitorder="little").view("<u8")

    def _rows(self, letters: np.ndarray, position: int) -> np.ndarray:
        """The bitsets of the queries' letters at a position."""
        code = (position << 8) + letters.astype(np.int64)
        row = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return self.bits[np.where(self.codes[row] == code, row, len(self.codes))]

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(query, word)`` numbers of the near pairs whose shorter word has
        m letters; ``queries`` are words of the block."""
        found = []
        most = max(1, (1 << 16) // self.wide)
        for is_long in (False, True):
            chosen = queries[self.long[queries] == is_long]
            for a in range(0, len(chosen), most):
                part = chosen[a:a + most]
                hits = self._missing(part) if is_long else self._replaced_or_added(part)
                q, at = np.nonzero(hits)
                bit = np.unpackbits(hits[q, at].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                k, b = np.nonzero(bit)
                found.append((part[q[k]], at[k] * 64 + b))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(map(np.concatenate, zip(*found)))

    def _replaced_or_added(self, part: np.ndarray) -> np.ndarray:
        """Queries of m letters: words with one other or one more letter."""
        text = self.letters[part]
        none = np.full((len(part), self.wide), ~np.uint64(0))  # no error yet
        other, more = np.zeros_like(none), np.zeros_like(none)
        for i in range(self.m):
            here = self._rows(text[:, i], i)
            more = (more | none) & self._rows(text[:, i], i + 1)
            other = (other & here) | (none & ~here)
            none &= here
        short, long = self.of_length
        return (other & short) | ((more | none) & long)

    def _missing(self, part: np.ndarray) -> np.ndarray:
        """Queries of m + 1 letters: words that lack one of them."""
        text = self.letters[part]
        none = np.full((len(part), self.wide), ~np.uint64(0))
        less = np.zeros_like(none)
        for i in range(self.m + 1):
            less = (less & self._rows(text[:, i], i - 1)) | none if i else none.copy()
            none &= self._rows(text[:, i], i)
        return less & self.of_length[0]


def _best(words: list[str], n: np.ndarray, q: np.ndarray, w: np.ndarray):
    """Per query its number of near words and the best one."""
    order = np.empty(len(words), np.int64)
    order[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    by = np.lexsort((order[w], -n[w], q))
    q, w = q[by], w[by]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    return q[first], np.diff(np.r_[first, len(q)]), w[first]


_FOUND = "word string, n_near long, best_n long, best string"


def _search(batches):
    """Near words of each cell; rows arrive sorted by (m, side, half, cell)."""

    def block(rows):
        m, words = rows[0][0], [r[5] for r in rows]
        b, n = Block(words, m), np.array([r[6] for r in rows], np.int64)
        cells = np.cumsum([i > 0 and rows[i][:5] != rows[i - 1][:5] for i in range(len(rows))])
        asks, asked = (np.array([r[7] != role for r in rows]) for role in ("word", "query"))
        q, w = b.near(np.flatnonzero(asks))
        keep = asked[w] & (cells[q] == cells[w])
        q, w = q[keep], w[keep]
        if len(q):  # words that share both halves are met by their first one
            ends = np.array([r[1] == "last" for r in rows])
            half = m // 2
            keep = ~ends[q] | (b.letters[q, :half] != b.letters[w, :half]).any(axis=1)
            q, w = q[keep], w[keep]
        at, count, best = _best(words, n, q, w)
        return pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in at], pa.string()), pa.array(count, pa.int64()), pa.array(n[best], pa.int64()),
             pa.array([words[i] for i in best], pa.string())], names=["word", "n_near", "best_n", "best"])

    rows, letters, cell_at = [], 0, 0  # cell_at: where the last cell begins
    for t in batches:
        for r in zip(*(c.to_pylist() for c in t.columns)):
            if rows and r[:5] != rows[-1][:5]:
                if r[0] != rows[-1][0] or len(rows) >= CELL_WORDS or letters >= CELL_LETTERS:
                    yield block(rows)
                    rows, letters = [], 0
                cell_at = len(rows)
            rows.append(r)
            letters += len(r[5])
    if rows:
        yield block(rows)


def near_words(words: DataFrame, least_length: int) -> DataFrame:
    """``word, n_near, best_n, best`` of every word of ``words`` (distinct
    ``word, n`` of at least ``least_length`` letters) that has a near word."""
    size = F.length("word")

    def halves(m) -> list:
        half = F.floor(m / 2).cast("int")
        return [F.struct(m.alias("m"), F.lit("first").alias("side"), F.left("word", half).alias("half")),
                F.struct(m.alias("m"), F.lit("last").alias("side"), F.right("word", m - half).alias("half"))]

    key = ["m", "side", "half"]
    keyed = (words.select("word", "n", F.explode(F.array(*halves(size), *halves(size - 1))).alias("k"))
             .select("k.*", "word", "n").where(F.col("m") >= least_length))
    parts = F.greatest(F.ceil(F.col("rows") / CELL_WORDS), F.ceil(F.col("letters") / CELL_LETTERS)).cast("int")
    sizes = stored(keyed.groupBy(*key).agg(F.count("*").alias("rows"), F.sum(F.length("word")).alias("letters"))
                   .where("rows > 1").select(*key, "rows", parts.alias("parts")), "halves")
    total = sizes.agg(F.sum(F.col("rows") * F.greatest(F.lit(1), 2 * F.col("parts") - 1))).first()[0] or 0
    mine = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    cell = lambda q, w, role: F.struct(q.alias("q"), w.alias("w"), F.lit(role).alias("role"))
    each = F.sequence(F.lit(0), F.col("parts") - 1)
    cells = F.when(F.col("parts") == 1, F.array(cell(F.lit(0), F.lit(0), "both"))).otherwise(F.concat(
        F.transform(each, lambda j: cell(mine, j, "query")), F.transform(each, lambda j: cell(j, mine, "word"))))
    dealt = (keyed.join(sizes, key).select(*key, "word", "n", F.explode(cells).alias("c"))
             .select(*key, "c.q", "c.w", "word", "n", "c.role"))
    found = (dealt.repartition(max(1, -(-total // 16384)), *key, "q", "w").sortWithinPartitions(*key, "q", "w")
             .mapInArrow(_search, _FOUND))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct(
        (-F.col("best_n")).alias("less"), "best")).alias("top"))
        .select("word", "n_near", (-F.col("top.less")).alias("best_n"), "top.best"))


def _roots(formed: DataFrame, factor: int) -> DataFrame:
    """``word, root`` of the words that have a form. A form's count is at
    least ``factor`` times as large, so chains have fewer than
    log(2 ** 63) steps to that base; each round doubles those taken."""
    steps, most = 1, 63
    while factor ** most >= 2 ** 63:
        most -= 1
    at = stored(formed.select("word", F.col("form").alias("root")), "roots")
    while steps < most:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = at.join(ahead, "root", "left")
        new = stored(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
                     "roots")
        at = new.select("word", "root")
        if new.where("moved").isEmpty():
            break
        steps *= 2
    return at


def variants(docs: DataFrame, least_length: int = 6, least_n: int = 5, factor: int = 5, drop_every: int = 199) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of at least
    ``least_length`` letters and ``least_n`` occurrences: the number of words
    one edit away, the commonest of them if it occurs ``factor`` times as often,
    and the last word that following forms leads to (itself without one)."""
    words = stored(word_counts(docs, least_length, least_n, drop_every), "words")
    near = near_words(words, least_length)
    is_form = F.col("best_n") >= factor * F.col("n")
    formed = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(formed.where("form is not null"), factor)
    return (formed.join(roots, "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
