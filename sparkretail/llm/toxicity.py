"""Toxicity scores from character n-grams: a linear classifier over presence
features scaled by their naive Bayes log-count ratios.

Fit: on a bounded labelled sample (``most`` per class). Spark counts in how
many toxic and clean sampled documents each hashed n-gram occurs; the
``features`` with the strongest log-count ratios stay; logistic regression
with L2 penalty is fitted to the presence features times these ratios, each
document scaled by a power of its number of features. Score: one pass over
whole texts, no shuffle. Null and empty texts have no feature; they get the
score of the intercept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.samples import labelled_sample
from sparkretail.llm.textops import mix64, slices

_U = np.uint64
_FOLD = np.arange(0x250, dtype=np.uint32)
for _i in range(0x250):
    if len(chr(_i).lower()) == 1:
        _FOLD[_i] = ord(chr(_i).lower())


def characters(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of a slice and the first one of each text."""
    c = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[off] if len(data) else np.zeros(len(off), np.int64)
    return np.where(c < 0x250, _FOLD[np.minimum(c, 0x24F)], c), first


def gram_buckets(c: np.ndarray, sizes: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """Bucket of the n-gram that starts at each character, for each size."""
    out, h = [], np.zeros(len(c), np.uint64)
    v = mix64(c.astype(np.uint64) + _U(0x9E3779B97F4A7C15))
    for n in range(1, max(sizes) + 1):
        m = len(c) - n + 1
        if m <= 0:
            out += [np.zeros(0, np.int32)] * (n in sizes)
            continue
        h = h[:m] * _U(0xD1342543DE82EF95) + v[n - 1:]
        if n in sizes:
            out.append((mix64(h + _U(n)) >> _U(64 - bits)).astype(np.int32))
    return out


class Presence:
    """Distinct n-gram buckets of texts."""

    def __init__(self, sizes: tuple[int, ...], bits: int):
        self.sizes, self.bits = sizes, bits
        self.mark = np.zeros(1 << bits, np.int32)

    def rows(self, arr: pa.Array, keep: np.ndarray | None = None):
        """Buckets of each text in turn; with ``keep`` (feature number of each
        bucket or -1) the features, and nothing of other buckets."""
        for _, _, data, off in slices(arr):
            c, first = characters(data, off)
            grams = gram_buckets(c, self.sizes, self.bits)
            for d in range(len(off) - 1):
                a, b = first[d], first[d + 1]
                x = np.concatenate([g[a:max(a, b - n + 1)] for n, g in zip(self.sizes, grams)])
                if keep is not None:
                    x = keep[x]
                    x = x[x >= 0]
                at = np.arange(len(x), dtype=np.int32)
                self.mark[x] = at
                yield x[self.mark[x] == at]


@dataclass
class ToxicityModel:
    feature: np.ndarray  # feature number of each bucket, -1 if none
    value: np.ndarray  # log-count ratio times learned weight
    ratio: np.ndarray  # log-count ratio
    intercept: float
    sizes: tuple[int, ...]
    bits: int
    power: float

    def score(self, arr: pa.Array) -> np.ndarray:
        out = np.zeros(len(arr))
        for i, x in enumerate(Presence(self.sizes, self.bits).rows(arr, self.feature)):
            z = self.intercept + self.value[x].sum() / max(1, len(x)) ** self.power
            out[i] = 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))
        return out


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, ratio: np.ndarray, power: float,
                 penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights over presence features times ``ratio`` (Nesterov steps on the
    whole sample)."""
    wt = weight / weight.sum()
    scale = 1 / np.maximum(1, np.array([len(r) for r in rows])) ** power
    blocks, a = [], 0  # some documents each: no array of the whole sample besides its rows
    while a < len(rows):
        e, size = a, 0
        while e < len(rows) and (e == a or size + len(rows[e]) <= 400_000):
            size += len(rows[e])
            e += 1
        blocks.append((a, e))
        a = e

    def entries():
        for a, e in blocks:
            col = np.concatenate(rows[a:e])
            yield slice(a, e), col, np.repeat(np.arange(e - a, dtype=np.int32), [len(r) for r in rows[a:e]])

    w = np.zeros(len(ratio))
    pos = float((wt * y).sum())
    b = math.log(max(pos, 1e-6) / max(1 - pos, 1e-6))
    # step from a bound of the curvature: largest row norm
    norm = [float((scale[at]**2 * np.bincount(o, ratio[c]**2, minlength=at.stop - at.start)).max()) for at, c, o in entries()]
    lip = 0.25 * max(norm, default=1.0) + 0.25 + penalty
    pw, pb, t = w.copy(), b, 1.0
    for _ in range(rounds):
        gw, gb = penalty * w, 0.0
        wr = w * ratio
        for at, col, owner in entries():
            z = scale[at] * np.bincount(owner, wr[col], minlength=at.stop - at.start) + b
            g = wt[at] * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y[at])
            gw = gw + ratio * np.bincount(col, (scale[at] * g)[owner], minlength=len(ratio))
            gb += g.sum()
        nw, nb = w - gw / lip, b - gb / lip
        s = (1 + math.sqrt(1 + 4 * t * t)) / 2
        w, b = nw + (t - 1) / s * (nw - pw), nb + (t - 1) / s * (nb - pb)
        pw, pb, t = nw, nb, s
    return pw, pb


def fit(docs: DataFrame, labels: DataFrame, learn=None, label: str = "toxic", most: int = 4000,
        sizes: tuple[int, ...] = (3, 4, 5), bits: int = 18, features: int = 30000, smoothing: float = 1.0,
        power: float = 0.25, penalty: float = 1e-4) -> ToxicityModel:
    """The model from at most ``most`` labelled documents of each class; both
    classes weigh alike, so 0.5 is where either is as likely per class."""
    sample = labelled_sample(docs, labels, label, most, F.lit(True) if learn is None else learn)

    def count(batches):
        p, total = Presence(sizes, bits), np.zeros((2, 1 << bits), np.int64)
        for t in batches:
            for y, x in zip(t.column("y").to_pylist(), p.rows(t.column("text"))):
                total[y, x] += 1
        at = np.flatnonzero(total.any(axis=0))
        for a in range(0, len(at), 65536):
            k = at[a:a + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(total[0, k]), pa.array(total[1, k])],
                                             names=["bucket", "n0", "n1"])

    size = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    a = F.lit(smoothing)
    counts = (sample.select("y", "text").mapInArrow(count, "bucket int, n0 long, n1 long")
              .groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("n0 + n1 >= 2")
              .withColumn("ratio", F.log((F.col("n1") + a) / (n1 + 2 * smoothing)) - F.log((F.col("n0") + a) / (n0 + 2 * smoothing)))
              .orderBy((F.abs("ratio") * F.sqrt(F.col("n0") + F.col("n1"))).desc(), "bucket").limit(features)
              .select("bucket", "ratio").orderBy("bucket").toPandas())
    feature = np.full(1 << bits, -1, np.int32)
    feature[counts["bucket"].to_numpy()] = np.arange(len(counts), dtype=np.int32)
    ratio = counts["ratio"].to_numpy(dtype=float)
    short = np.uint16 if len(counts) <= 1 << 16 else np.int32

    def select(batches):
        p = Presence(sizes, bits)
        for t in batches:
            yield pa.RecordBatch.from_arrays(
                [t.column("doc_id"), t.column("y"),
                 pa.array([x.astype(short).tobytes() for x in p.rows(t.column("text"), feature)], pa.binary())],
                names=["doc_id", "y", "x"])

    # two bytes a feature where they do, and no copy of them in Python objects
    rows = (sample.select("doc_id", "y", "text").mapInArrow(select, "doc_id long, y int, x binary").toArrow()
            .combine_chunks().sort_by([("doc_id", "ascending"), ("y", "ascending")]))
    x = [np.frombuffer(b.as_buffer(), short) for b in rows.column("x")]
    y = rows.column("y").to_numpy().astype(float)
    even = np.where(y == 1, 1 / max(1, n1), 1 / max(1, n0))
    w, b = fit_logistic(x, y, even, ratio, power, penalty) if rows.num_rows else (np.zeros(len(ratio)), -2.0)
    return ToxicityModel(feature, ratio * w, ratio, b, sizes, bits, power)


def score(docs: DataFrame, model: ToxicityModel, column: str = "score") -> DataFrame:
    """``doc_id`` and the probability of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for t in batches:
            yield pa.RecordBatch.from_arrays([t.column(0), pa.array(m.score(t.column(1)))], names=["doc_id", column])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, {column} double")


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, n_chars) without the rows scored
    at or above the threshold, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cols = ["doc_id", "text", "lang", "source", "n_chars"]

    def run(batches):
        m = shared.value
        for t in batches:
            yield t.filter(pa.array(m.score(t.column("text")) < threshold))

    out = docs.select(*cols)
    return out.mapInArrow(run, out.schema)
