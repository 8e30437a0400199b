"""Language identification by compression.

Each language has a raw-content zstandard dictionary: pieces of the texts of a
bounded sample of its documents. A text is cut into blocks, every block is
compressed with every dictionary, and the language of the smallest total wins.
The margin is how much smaller the winner is than the runner-up; below
``min_margin`` the text is rejected (its guess stays in ``lang``). Null texts
and texts without a letter are ``und`` with score 0.

Every row gives one, whole texts of any length, repeated rows and null doc_ids
included; an empty table gives none; extra columns are not read. Without a row
to learn from there is no language, and every text is ``und``.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
#: word characters beyond digits; letters are those of them that ``isalpha``
_LETTER = re.compile(r"[^\W\d_]+")
_DROP = bytes(i for i in range(33, 127) if not chr(i).isalpha())
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("margin", T.DoubleType()),
    T.StructField("accepted", T.BooleanType()),
])


def has_letter(text: str) -> bool:
    """Whether a letter occurs; numerals such as one half or a Roman eight are none."""
    return any(any(map(str.isalpha, m[0])) for m in _LETTER.finditer(text))


def plain(text: str) -> bytes:
    """Lower case without ASCII digits and signs: they say nothing of the language."""
    return text.lower().encode().translate(None, _DROP)


@dataclass
class LanguageModel:
    dictionaries: dict[str, bytes]  # most frequent language first: it wins ties
    level: int = 6
    block: int = 2048
    min_margin: float = 0.01
    scale: float = 0.05


class Classifier:
    """Compressors of one task, a dictionary each."""

    def __init__(self, model: LanguageModel):
        self.model, self.names, self.press = model, list(model.dictionaries), []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(model.dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=model.level)
            self.press.append(zstandard.ZstdCompressor(
                level=model.level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def classify(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score, margin and whether the margin is wide enough."""
        if text is None or not self.names or not has_letter(text):
            return UNKNOWN, 0.0, 0.0, False
        data = plain(text)
        size = [0] * len(self.names)
        for a in range(0, len(data), self.model.block):
            part = data[a:a + self.model.block]
            for i, c in enumerate(self.press):
                size[i] += len(c.compress(part))
        order = sorted(range(len(size)), key=lambda i: (size[i], i))
        best = order[0]
        if len(order) == 1 or size[order[1]] == 0:
            return self.names[best], float(len(order) == 1), float(len(order) == 1), len(order) == 1
        margin = 1 - size[best] / size[order[1]]
        return self.names[best], 1 - math.exp(-margin / self.model.scale), margin, margin >= self.model.min_margin


def fit(docs: DataFrame, learn=None, dictionary_bytes: int = 100_000, piece_chars: int = 1000,
        docs_per_lang: int = 150, **kw) -> LanguageModel:
    """Dictionaries from at most ``docs_per_lang`` documents of each language
    (smallest id hashes among those that ``learn`` admits), ``piece_chars``
    from the middle of each, ``dictionary_bytes`` in all."""
    from pyspark.sql import Window as W

    known = docs.select("doc_id", "lang", "text").where("lang is not null and text is not null and doc_id is not null")
    if learn is not None:
        known = known.where(learn)
    n = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not n:
        return LanguageModel({}, **kw)
    # a share of each language by hash first, so that no window holds a language
    share = F.create_map(*[F.lit(x) for k, v in n.items() for x in (k, min(1.0, 4 * docs_per_lang / v))])
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    some = (known.where(chance < share[F.col("lang")])
            .withColumn("x", F.greatest(F.lit(1), ((F.length("text") - piece_chars) / 2 + 1).cast("int")))
            .select("lang", "doc_id", F.lower(F.substring("text", F.col("x"), F.lit(piece_chars))).alias("piece")))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "piece"))
    got: dict[str, list[str]] = {}
    for r in some.withColumn("r", rank).where(F.col("r") <= docs_per_lang).orderBy("lang", "r").collect():
        got.setdefault(r.lang, []).append(r.piece)
    return LanguageModel({k: plain("\n".join(got[k]))[-dictionary_bytes:]
                          for k in sorted(got, key=lambda k: (-n[k], k))}, **kw)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang, score, margin, accepted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        c = Classifier(shared.value)
        for t in batches:
            lang, score, margin, ok = zip(*map(c.classify, t.column(1).to_pylist())) if t.num_rows else ([],) * 4
            yield pa.RecordBatch.from_arrays(
                [t.column(0), pa.array(lang, pa.string()), pa.array(np.array(score, float)),
                 pa.array(np.array(margin, float)), pa.array(ok, pa.bool_())], names=SCHEMA.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
