"""Alignment of the tokens of two tokenizers over the same bytes.

A is a byte-level BPE (``byte_bpe_50k.json``) that encodes a space and the
text, B a sentencepiece model (``piece_bpe_32k.model``) that adds the space
itself. Byte offsets where a token of A and one of B both end cut them into
groups; tokens whose byte ranges overlap are linked.

Per vocabulary, an identity map holds for each A id the B id of the same bytes.
A group of one A token and its identical B token takes the fast path: such
groups are counted in vectors of the vocabulary's length. Only the links of the
other, irregular groups are counted as pairs and shuffled.

* ``align(docs)``: one pass; neither tokenizer joins a word with the white
  space after it, so plain texts are aligned chunk by chunk (white space and
  what follows), each distinct chunk once per task; per row its groups as text and, once per distinct
  entry, its identity tokens and irregular pairs with their numbers.
* ``pair_counts(aligned)``: how many links of all documents hold each pair.
* ``link_scores(aligned, counts)``: per row the links whose pair is the
  commonest of its B id, and the sum of the counts. Counts of identity pairs
  and the largest count per B id are vectors of the vocabularies' lengths; the
  irregular pairs that hold at least a ``1 / HOT`` part of all irregular links
  are at most ``HOT``. Both are sent to every task; the remaining pairs are
  rare, so their join and its shuffle are free of hot keys.

A null or empty text, and one whose joined tokens differ from the space and
the text, has no tokens: numbers zero, groups empty. Repeated rows and null
doc_ids are rows like others, extra columns are not read, an empty table gives
an empty result, texts of any length are aligned whole.
"""

from __future__ import annotations

import itertools
import json
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.bpe import byte_characters
from sparkretail.llm.components import stored

#: bound of the pairs sent to every task
HOT = 1 << 17
#: characters of text aligned at once (a longer text alone)
SLICE = 1 << 19
#: chunks that a task remembers before it starts anew; what counts as long there
REMEMBERED, LONG = 150_000, 200


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Tokens:
    """Both tokenizers, the bytes of their tokens and the identity map."""

    #: a run of white space and what follows it; a carriage return does not begin one
    CHUNK = re.compile("[ \t\n\r]+(?:[^ \t\n\r]+(?:\r[ \t\n\r]*[^ \t\n\r]+)*)?(?:\r[ \t\n\r]*\\Z)?")

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        from sparkretail.llm.packing import TokenBytes

        self.path_a, self.whole_a = path_a, None
        self.plain = TokenBytes(path_a)
        spec = json.loads(Path(path_a).read_text("utf-8"))
        byte = {c: b for b, c in enumerate(byte_characters())}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        a = {i: bytes(byte[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in special}
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        b, pieces = {}, []
        for i in range(self.b.get_piece_size()):
            if self.b.is_byte(i):
                b[i] = bytes([int(self.b.id_to_piece(i)[3:5], 16)])
            elif not (self.b.is_control(i) or self.b.is_unknown(i)):
                pieces.append(self.b.id_to_piece(i))
                b[i] = pieces[-1].replace("▁", " ").encode()
        self.size_a, self.size_b = max(a) + 1, self.b.get_piece_size()
        self.bytes_a = [a.get(i, b"") for i in range(self.size_a)]
        self.bytes_b = [b.get(i, b"") for i in range(self.size_b)]
        self.length_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.length_b = np.array(list(map(len, self.bytes_b)), np.int64)
        # of B tokens of the same bytes the piece comes before the byte
        of_bytes = {x: i for i, x in sorted(b.items(), key=lambda e: self.b.is_byte(e[0]), reverse=True)}
        self.same = np.array([of_bytes.get(x, -1) if x else -1 for x in self.bytes_a], np.int64)
        texts = [str(i).encode() for i in range(max(self.size_a, self.size_b))]
        self.written = [x + end for n, ends in ((self.size_a, (b",", b"|")), (self.size_b, (b",", b";")))
                        for end in ends for x in texts[:n]]
        # neither tokenizer joins what stands before a chunk with the chunk
        no_cut = re.compile("[^▁\\s][▁\t]|\n")
        self.chunked = self.plain.fast is not None and not any(no_cut.search(p) for p in pieces)

    def chunks(self, text: str | None) -> list[str | tuple[str]]:
        """A space and the text in parts that are encoded apart: the chunks of
        a plain text; any other text whole, as a tuple."""
        if not text:
            return []
        if self.chunked and not self.plain.OTHER.search(text):
            return self.CHUNK.findall(" " + text)
        return [(text,)]

    def encode(self, parts: list[str | tuple[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of the parts one after the other, in bytes that add up: ids of
        A, ids of B, and the bytes of each part (none where a tokenizer does
        not give them back). Runs of chunks are encoded in one call each."""
        a, b, size = [], [], []
        runs = itertools.groupby(parts, lambda p: 2 if isinstance(p, tuple) else int(p[-1].isspace()))
        for kind, run in runs:
            run = list(run)
            # what ends in white space would join the next chunk
            for whole in (["".join(run)] if kind == 0 else [p if kind == 1 else p[0] for p in run]):
                if kind < 2:
                    x = self.plain.fast.encode_ordinary(whole)
                    y = self.b.encode("\n" + whole, num_threads=1)[2:]  # the model's own space and the line end
                else:
                    if self.whole_a is None:  # loaded by the first text that needs it
                        from tokenizers import Tokenizer

                        self.whole_a = Tokenizer.from_file(self.path_a)
                        self.whole_a.encode_special_tokens = True
                    y = self.b.encode(whole, num_threads=1)
                    whole = " " + whole
                    x = self.whole_a.encode(whole, add_special_tokens=False).ids
                data = whole.encode()
                kept = b"".join([self.bytes_b[i] for i in y]) == data and b"".join([self.bytes_a[i] for i in x]) == data
                if kept:
                    a.append(x)
                    b.append(y)
                size += [len(p.encode()) for p in run] if kind == 0 and kept else [len(data) * kept] if kind else [0] * len(run)
        ids = [np.fromiter(itertools.chain.from_iterable(v), np.int64, sum(map(len, v))) for v in (a, b)]
        return ids[0], ids[1], np.array(size, np.int64)


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each run one after the other."""
    shift = np.cumsum(counts) - counts
    return np.repeat(starts - shift, counts) + np.arange(counts.sum())


def _counted(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each row with their numbers: offsets, values, numbers."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])]) if len(row) else np.zeros(0, np.int64)
    offsets = np.searchsorted(row[first], np.arange(rows + 1))
    return offsets, value[first], np.diff(np.r_[first, len(row)])


class Aligner:
    """Alignments of chunks, remembered up to a bound, and of texts, put
    together from those of their chunks."""

    NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "bad")
    LISTS = ("same", "pairs")

    def __init__(self, tokens: Tokens):
        self.tokens = tokens
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str | tuple[str], int] = {}
        self.groups: list[bytes] = []
        self.numbers = {c: np.zeros(0, np.int64) for c in self.NUMBERS}
        self.ends = {c: np.zeros(1, np.int64) for c in self.LISTS}  # offsets of each chunk's list
        self.lists = {c: np.zeros(0, np.int64) for c in self.LISTS}

    def _learn(self, parts: list[str | tuple[str]]) -> None:
        """Align parts that are new, all at once. Byte offsets run on over
        them: parts begin and end together in both tokenizations."""
        t, n = self.tokens, len(parts)
        a, b, size = t.encode(parts)
        end_a, end_b = np.cumsum(t.length_a[a]), np.cumsum(t.length_b[b])
        part_end = np.cumsum(size)
        marks = np.zeros((2, (int(end_a[-1]) if len(end_a) else 0) + 1), bool)
        marks[0, end_a], marks[1, end_b] = True, True
        before = np.cumsum(marks, axis=1)  # tokens that end at or before an offset
        ends, stretch = np.flatnonzero(marks[0] & marks[1]), np.flatnonzero(marks[0] | marks[1])
        cut_a, cut_b = before[0, ends] - 1, before[1, ends] - 1
        n_a, n_b = (np.diff(np.concatenate([[0], before[k, part_end]])) for k in (0, 1))
        part_a = np.repeat(np.arange(n), n_a)
        size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        group_a, group_b = np.repeat(np.arange(len(ends)), size_a), np.repeat(np.arange(len(ends)), size_b)
        identity = (size_a == 1) & (size_b == 1)
        identity[identity] = t.same[a[cut_a[identity]]] == b[cut_b[identity]]
        # every stretch between neighbouring ends is the overlap of one A and one B token
        link_a, link_b = before[0, stretch - 1], before[1, stretch - 1]
        odd = ~identity[group_a[link_a]]
        found = {"same": (part_a[cut_a[identity]], a[cut_a[identity]]),
                 "pairs": (part_a[link_a[odd]], (a[link_a[odd]] << 32) | b[link_b[odd]])}
        new = {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(part_a[cut_a], minlength=n),
               "n_links": np.bincount(part_a[link_a], minlength=n), "bad": size == 0}
        for c, v in new.items():
            self.numbers[c] = np.concatenate([self.numbers[c], v])
        for c, (part, v) in found.items():
            self.ends[c] = np.concatenate([self.ends[c], self.ends[c][-1] + np.cumsum(np.bincount(part, minlength=n))])
            self.lists[c] = np.concatenate([self.lists[c], v])
        # written group by group: the A tokens, then the B tokens
        place_a = np.arange(len(a)) + np.concatenate([[0], cut_b + 1])[group_a]
        place_b = np.arange(len(b)) + (cut_a + 1)[group_b]
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[cut_a], last_b[cut_b] = True, True
        mark = np.empty(len(a) + len(b), np.int64)
        mark[place_a] = a + last_a * t.size_a
        mark[place_b] = b + 2 * t.size_a + last_b * t.size_b
        tokens = [t.written[i] for i in mark.tolist()]
        at = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        self.groups += [b"".join(tokens[x:y]) for x, y in zip(at, at[1:])]

    def align(self, texts: list[str | None]) -> dict[str, list | np.ndarray | tuple]:
        """Groups and links of some texts, row by row. ``same`` are identity
        tokens as A ids, ``pairs`` irregular links as ``A id << 32 | B id``."""
        if len(self.number) > REMEMBERED:
            self._forget()
        rows = len(texts)
        parts = [self.tokens.chunks(x) for x in texts]
        number, new = self.number, {}
        for p in dict.fromkeys(itertools.chain.from_iterable(parts)):
            if p not in number:
                new[p] = len(number) + len(new)
        if new:
            self._learn(list(new))
            number |= new
        n_parts = np.array(list(map(len, parts)), np.int64)
        at = np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(parts)), np.int64, n_parts.sum())
        row = np.repeat(np.arange(rows), n_parts)
        whole = np.bincount(row, self.numbers["bad"][at], minlength=rows) == 0
        keep = whole[row]
        at, row = at[keep], row[keep]
        out: dict = {c: np.bincount(row, self.numbers[c][at], minlength=rows).astype(np.int64) for c in self.NUMBERS[:-1]}
        for c in self.LISTS:
            start, count = self.ends[c][at], self.ends[c][at + 1] - self.ends[c][at]
            out[c] = _counted(np.repeat(row, count), self.lists[c][_ragged(start, count)], rows)
        written = [self.groups[i] for i in at.tolist()]
        cuts = np.searchsorted(row, np.arange(rows + 1)).tolist()
        out["groups"] = [b"".join(written[x:y])[:-1].decode() for x, y in zip(cuts, cuts[1:])]
        if sum(len(p) for p in map("".join, new) if len(p) > LONG) > SLICE // 4:
            self._forget()  # long texts are not worth their memory
        return out


_ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
            "same array<int>, same_n array<int>, pairs array<long>, pairs_n array<int>")


def align(docs: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """Per row: ``row`` (its own number), ``doc_id``, ``n_a, n_b, n_groups,
    n_links``, ``groups`` (``a1,a2|b1;a3|b2,b3``: ids in order), and its
    distinct identity A ids ``same`` and irregular ``pairs`` (A id << 32 | B id)
    with their numbers."""
    paths = tokenizers or default_tokenizers()

    def run(batches):
        aligner = Aligner(Tokens(*paths))

        def lists(counted, kind):
            offsets, values, n = counted
            offsets = pa.array(offsets, pa.int32())
            return (pa.ListArray.from_arrays(offsets, pa.array(values, kind)),
                    pa.ListArray.from_arrays(offsets, pa.array(n, pa.int32())))

        for t in batches:
            texts = t.column("text").to_pylist()
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size + len(texts[b] or "") <= SLICE):
                    size += len(texts[b] or "")
                    b += 1
                got = aligner.align(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [t.column("row")[a:b], t.column("doc_id")[a:b],
                     *(pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                     pa.array(got["groups"], pa.string()), *lists(got["same"], pa.int32()), *lists(got["pairs"], pa.int64())],
                    names=[c.split()[0] for c in _ALIGNED.split(", ")])
                a = b

    return (docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, _ALIGNED))


def _flat(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """All elements of a list column."""
    return column.flatten().to_numpy(zero_copy_only=False)


def pair_counts(aligned: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """``pair, n, irregular``: links of all documents that hold the pair, and
    those of them in irregular groups. Identity pairs are counted in a vector
    of the vocabulary's length per task, irregular ones batch by batch."""
    paths = tokenizers or default_tokenizers()

    def run(batches):
        tokens = Tokens(*paths)
        same = np.zeros(tokens.size_a, np.int64)

        def rows(pair, n, irregular):
            return pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64()), pa.array(irregular, pa.int64())],
                                              names=["pair", "n", "irregular"])

        for t in batches:
            same += np.bincount(_flat(t.column("same")), _flat(t.column("same_n")), minlength=len(same)).astype(np.int64)
            pair, at = np.unique(_flat(t.column("pairs")), return_inverse=True)
            n = np.bincount(at, _flat(t.column("pairs_n")), minlength=len(pair)).astype(np.int64)
            yield rows(pair, n, n)
        ids = np.flatnonzero(same)
        yield rows((ids << 32) | tokens.same[ids], same[ids], np.zeros(len(ids), np.int64))

    return (aligned.select("same", "same_n", "pairs", "pairs_n").mapInArrow(run, "pair long, n long, irregular long")
            .groupBy("pair").agg(F.sum("n").alias("n"), F.sum("irregular").alias("irregular")))


def link_scores(aligned: DataFrame, counts: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """``row, n_best, count_sum`` of every row; ``aligned`` and ``counts`` are
    stored tables."""
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    top = {int(r.b): r.n for r in counts.groupBy(b.alias("b")).agg(F.max("n").alias("n")).collect()}  # B's vocabulary
    irregular = counts.agg(F.sum("irregular")).first()[0] or 0
    is_hot = F.col("irregular") * HOT >= F.lit(irregular)
    hot = counts.where(is_hot & (F.col("irregular") > 0)).select("pair", "n").toArrow()  # HOT at most
    same_of = _identity(tokenizers)
    same_pairs = counts.sparkSession.createDataFrame([(int(p),) for p in same_of], "pair long")
    same = counts.join(F.broadcast(same_pairs), "pair").select(a.alias("a"), "n").toArrow()  # A's vocabulary
    same_n = np.zeros(int(max(same_of, default=0) >> 32) + 1, np.int64)
    same_n[same.column("a").to_numpy()] = same.column("n").to_numpy()
    top_n = np.zeros(max(top, default=0) + 1, np.int64)
    top_n[list(top)] = list(top.values())
    order = np.argsort(hot.column("pair").to_numpy())
    hot_pair, hot_n = hot.column("pair").to_numpy()[order], hot.column("n").to_numpy()[order]
    best_of = np.full(len(same_n), -1, np.int64)
    ids = np.array(sorted(same_of), np.int64)
    best_of[ids >> 32] = ids & 0xFFFFFFFF

    def is_hot_pair(pair):
        at = np.minimum(np.searchsorted(hot_pair, pair), max(0, len(hot_pair) - 1))
        return at, (hot_pair[at] == pair if len(hot_pair) else np.zeros(len(pair), bool))

    def known(batches):
        for t in batches:
            n_rows, sums, best = t.num_rows, np.zeros(t.num_rows, np.int64), np.zeros(t.num_rows, np.int64)

            def add(rows, count, n, b_id):
                np.add.at(sums, rows, count * n)
                np.add.at(best, rows, n * (count == top_n[b_id]))

            ids, n = _flat(t.column("same")), _flat(t.column("same_n")).astype(np.int64)
            rows = np.repeat(np.arange(n_rows), t.column("same").value_lengths().to_numpy())
            add(rows, same_n[ids], n, best_of[ids])
            pair, n = _flat(t.column("pairs")), _flat(t.column("pairs_n")).astype(np.int64)
            rows = np.repeat(np.arange(n_rows), t.column("pairs").value_lengths().to_numpy())
            at, hits = is_hot_pair(pair)
            add(rows[hits], hot_n[at[hits]], n[hits], pair[hits] & 0xFFFFFFFF)
            yield pa.RecordBatch.from_arrays([t.column("row"), pa.array(best), pa.array(sums)], names=["row", "n_best", "count_sum"])

    def rare(batches):
        for t in batches:
            pair = _flat(t.column("pairs"))
            rows = np.repeat(t.column("row").to_numpy(), t.column("pairs").value_lengths().to_numpy())
            left = ~is_hot_pair(pair)[1]
            yield pa.RecordBatch.from_arrays([pa.array(rows[left]), pa.array(pair[left]), pa.array(_flat(t.column("pairs_n"))[left])],
                                             names=["row", "pair", "times"])

    # rare pairs are joined to their count and their B id's largest one
    rare_counts = (counts.where(~is_hot & (F.col("irregular") > 0))
                   .join(F.broadcast(counts.sparkSession.createDataFrame(
                       [(i, int(n)) for i, n in top.items()], "b long, top long")), b == F.col("b"))
                   .select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("is_best")))
    part = (aligned.select("row", "pairs", "pairs_n").mapInArrow(rare, "row long, pair long, times int")
            .join(rare_counts, "pair")
            .select("row", (F.col("times") * F.col("is_best")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")))
    whole = aligned.select("row", "same", "same_n", "pairs", "pairs_n").mapInArrow(known, "row long, n_best long, count_sum long")
    return whole.unionByName(part).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def _identity(tokenizers: tuple[str, str] | None) -> list[int]:
    """The identity pairs of the vocabularies, packed."""
    tokens = Tokens(*(tokenizers or default_tokenizers()))
    ids = np.flatnonzero(tokens.same >= 0)
    return ((ids << 32) | tokens.same[ids]).tolist()


def token_alignment(docs: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` of every row. Groups are hashed on the fly; what is stored
    per row are its distinct identity tokens and irregular pairs."""
    hashed = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = stored(align(docs, tokenizers).withColumn("groups_sha256", hashed).drop("groups"), "aligned")
    counts = stored(pair_counts(aligned, tokenizers), "pair-counts")
    scores = link_scores(aligned, counts, tokenizers)
    return (aligned.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(scores, "row")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
