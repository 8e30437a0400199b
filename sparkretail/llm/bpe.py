"""Byte-pair encoding and decoding with a public vocabulary file.

``WordBpe`` reads a ``tokenizers`` BPE file with a word-end suffix and gives
the ids that the library gives with ``add_special_tokens=False`` and neither
truncation nor padding. Each word keeps a contiguous array of part boundaries
(the ids of its parts) and one of the ranks of adjacent parts; the smallest
rank is found by scanning, its right boundary is deleted and the two
neighbouring ranks are looked up anew. Scanning is quadratic, so words of more
than ``SCAN`` bytes keep the same ranks in a heap over linked parts.

Special tokens in a text are single ids, as in the library. Texts of plain
Latin characters are split into words by one pattern; for all others the
library's own normaliser and pre-tokeniser give the words. Words are merged
once per task and remembered up to a bound.

``encode_decode(docs)``: one row per row of ``docs`` (repeated rows and null
doc_ids included, an empty table gives none), whole texts of any length. A null
text counts as empty: no ids, decoded text empty. Extra columns are not read,
whatever their names. Nothing is shuffled.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: words of at most so many bytes are merged by scanning
SCAN = 96
#: distinct words that a task remembers before it starts anew
REMEMBERED = 300_000
NO_RANK = 1 << 30


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, others = [], 0
    for b in range(256):
        out.append(chr(b) if b in shown else chr(256 + others))
        others += b not in shown
    return out


class WordBpe:
    #: characters beyond these need the library's Unicode tables
    OTHER = re.compile("[^\t\n\r -~À-įı-ɏ–—‘-”]")
    #: the words of a plain lower-case text
    WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ɏß]+|[0-9]|[^\\sa-zà-öø-ɏß0-9]+")

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text("utf-8"))
        model = spec["model"]
        self.path, self.whole = path, None
        self.suffix = model.get("end_of_word_suffix") or ""
        vocabulary = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.special.items()}
        shown = byte_characters()
        self.inner = [vocabulary[c] for c in shown]
        self.last = [vocabulary[c + self.suffix] for c in shown]
        self.byte = {c: b for b, c in enumerate(shown)}
        self.rank, self.merged = {}, {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            pair = vocabulary[a], vocabulary[b]
            self.rank[pair], self.merged[pair] = r, vocabulary[a + b]
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word."""
        parts = [*(self.inner[b] for b in word[:-1]), self.last[word[-1]]]
        if len(parts) > SCAN:
            return self._merge_long(parts)
        rank, merged = self.rank, self.merged
        ranks = [rank.get(p, NO_RANK) for p in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            i = ranks.index(least)
            parts[i] = merged[parts[i], parts[i + 1]]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank.get((parts[i - 1], parts[i]), NO_RANK)
            if i < len(ranks):
                ranks[i] = rank.get((parts[i], parts[i + 1]), NO_RANK)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        rank, merged, n = self.rank, self.merged, len(parts)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j == n or rank.get((parts[i], parts[j])) != r:
                continue  # one of its parts has changed since
            parts[i], parts[j] = merged[parts[i], parts[j]], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n:
                    r = rank.get((parts[x], parts[after[x]]))
                    if r is not None:
                        heapq.heappush(heap, (r, x))
        return [p for p in parts if p >= 0]

    def _words(self, text: str) -> list[str]:
        """The words of a text without special tokens, in plain characters."""
        if not self.OTHER.search(text):
            return self.WORD.findall(text.lower())
        if self.whole is None:  # loaded by the first text that needs it
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        shown = self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(text))
        return [bytes(map(self.byte.__getitem__, w)).decode() for w, _ in shown]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.cut is not None and "<|" in text:
            out = []
            for k, part in enumerate(self.cut.split(text)):
                out.append(struct.pack("<I", self.special[part]) if k % 2 else self._encode(part))
            return b"".join(out)
        return self._encode(text)

    def _encode(self, text: str) -> bytes:
        known, out = self.known, []
        for w in self._words(text):
            ids = known.get(w)
            if ids is None:
                parts = self.merge(w.encode())
                ids = struct.pack(f"<{len(parts)}I", *parts)
                if len(ids) <= 4 * SCAN:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[w] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens of packed ids, special ones included, joined by spaces
        (the file has no decoder); unknown ids give nothing."""
        found = map(self.tokens.get, struct.unpack(f"<{len(ids) // 4}I", ids))
        return " ".join([t for t in found if t is not None])


def encode_decode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: ids packed as little-endian unsigned 32-bit
    integers, and the text that they decode to."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        codec = WordBpe(path)
        for t in batches:
            doc, texts = t.column("doc_id"), t.column("text")
            for a in range(0, len(texts), 200):
                ids = [codec.encode(x or "") for x in texts[a:a + 200].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [doc[a:a + 200], pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.string())],
                    names=["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary, decoded string")
