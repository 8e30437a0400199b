"""Quality scores from random-indexing word vectors and a small network.

Words are runs of letters, of digits or of one kind of sign, hashed to
``2 ** bits`` rows. Every row has a sparse ternary index vector; its context
vector is the sum of the index vectors of its neighbours within ``window``
words over all documents (one pass; each task adds up its own part, Spark adds
up the parts per row). A document is pooled to mean, deviation and mean step of
its unit word vectors. A two-layer network is fitted in numpy on a bounded
labelled sample and its logits are divided by a temperature fitted on a part
held back. Empty texts pool to zeros.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.samples import labelled_sample
from sparkretail.llm.textops import SEPARATOR, mix64, slices, span_hashes

_U = np.uint64
_KIND = np.full(256, 3, np.uint8)  # signs
_KIND[SEPARATOR] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1
_KIND[128:] = 1


def tokens(data: np.ndarray, off: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row of each word and the first word of each document."""
    if len(data) == 0:
        return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
    kind = _KIND[data]
    # a sign goes on only while it repeats
    change = np.ones(len(data), bool)
    change[1:] = (kind[1:] != kind[:-1]) | ((kind[1:] == 3) & (data[1:] != data[:-1]))
    change[off[:-1][off[:-1] < len(data)]] = True
    begin = np.flatnonzero(change)
    end = np.append(begin[1:], len(data))
    real = kind[begin] != 0
    begin, end = begin[real], end[real]
    rows = (span_hashes(data, begin, end) >> _U(64 - bits)).astype(np.int32)
    return rows, np.searchsorted(begin, off)


def index_vectors(bits: int, dim: int, nonzero: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every row's index vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, dim, (1 << bits, nonzero)).astype(np.int32), \
        rng.choice(np.array([-1.0, 1.0]), (1 << bits, nonzero))


@dataclass
class WordVectors:
    vectors: np.ndarray  # float32, one unit vector per row
    bits: int

    def pool(self, arr: pa.Array) -> np.ndarray:
        dim = self.vectors.shape[1]
        out = np.zeros((len(arr), 3 * dim), np.float32)
        for a, _, data, off in slices(arr, 1 << 20):
            rows, first = tokens(data, off, self.bits)
            for d in np.flatnonzero(np.diff(first)):
                v = self.vectors[rows[first[d]:first[d + 1]]]
                out[a + d, :dim] = v.mean(axis=0)
                out[a + d, dim:2 * dim] = v.std(axis=0)
                if len(v) > 1:
                    out[a + d, 2 * dim:] = np.abs(v[1:] - v[:-1]).mean(axis=0)
        return out


def word_vectors(docs: DataFrame, bits: int = 13, dim: int = 32, nonzero: int = 4, window: int = 2,
                 seed: int = 5) -> WordVectors:
    """Context vectors over all documents. What each task sends on and what
    the driver gets is bounded by ``2 ** bits`` rows."""
    def run(batches):
        place, sign = index_vectors(bits, dim, nonzero, seed)
        total = np.zeros((1 << bits) * dim)
        for t in batches:
            for _, _, data, off in slices(t.column(0), 1 << 20):
                rows, first = tokens(data, off, bits)
                doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
                for step in range(1, window + 1):
                    same = doc[step:] == doc[:-step]
                    x, y = rows[:-step][same].astype(np.int64), rows[step:][same].astype(np.int64)
                    for to, of in ((x, y), (y, x)):
                        for j in range(nonzero):
                            total += np.bincount(to * dim + place[of, j], sign[of, j], minlength=len(total))
        total = total.reshape(1 << bits, dim)
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)),
                                          pa.array(list(total[at].astype(np.int64)), pa.list_(pa.int64()))],
                                         names=["row", "v"])

    parts = docs.select("text").where("text is not null").mapInArrow(run, "row int, v array<long>")
    sums = parts.groupBy("row").agg(F.array(*[F.sum(F.col("v")[j]) for j in range(dim)]).alias("v")).toPandas()
    c = np.zeros((1 << bits, dim))
    if len(sums):
        c[sums["row"].to_numpy()] = np.stack(sums["v"].to_numpy())
    c = np.sign(c) * np.sqrt(np.abs(c))  # frequent neighbours count less
    c /= np.maximum(1e-9, np.linalg.norm(c, axis=1, keepdims=True))
    return WordVectors(c.astype(np.float32), bits)


@dataclass
class Network:
    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.spread) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def fit_network(x: np.ndarray, y: np.ndarray, weight: np.ndarray, hidden: int = 32, epochs: int = 60,
                rate: float = 3e-3, penalty: float = 1e-4, batch: int = 64, seed: int = 3) -> Network:
    """Adam on all rows but each fifth; the temperature on those."""
    rng = np.random.default_rng(seed)
    back = np.arange(len(y)) % 5 == 4
    net = Network(x.mean(axis=0) if len(x) else np.zeros(x.shape[1]), (x.std(axis=0) if len(x) else np.zeros(x.shape[1])) + 1e-4,
                  rng.normal(0, 1 / np.sqrt(max(1, x.shape[1])), (x.shape[1], hidden)), np.zeros(hidden),
                  rng.normal(0, 1 / np.sqrt(hidden), hidden), 0.0)
    if len(y) == 0:  # nothing to learn from: one half for every text
        net.w2 = np.zeros(hidden)
        return net
    train = np.flatnonzero(~back) if (~back).any() else np.arange(len(y))
    z = (x - net.mean) / net.spread
    p = [net.w1, net.b1, net.w2, np.array([net.b2])]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    weight = weight / weight.mean()
    for epoch in range(epochs):
        order = rng.permutation(train)
        step = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for a in range(0, len(order), batch):
            i = order[a:a + batch]
            h = np.tanh(z[i] @ p[0] + p[1])
            g = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -500, 500))) - y[i]) * weight[i] / len(i)
            gh = np.outer(g, p[2]) * (1 - h * h)
            grad = [z[i].T @ gh + penalty * p[0], gh.sum(axis=0), h.T @ g + penalty * p[2], g.sum(keepdims=True)]
            t += 1
            for k, d in enumerate(grad):
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                p[k] = p[k] - step * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = p[0], p[1], p[2], float(p[3][0])
    if back.any():
        s, yb, wb = net.logits(x[back]), y[back], weight[back]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [float((wb * np.logaddexp(0, np.where(yb == 1, -s, s) / k)).sum()) for k in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def fit(docs: DataFrame, labels: DataFrame, learn=None, label: str = "quality", most: int = 6000,
        vectors: WordVectors | None = None) -> tuple[WordVectors, Network]:
    """Word vectors over all of ``docs`` and the network from at most ``most``
    labelled documents of each class, weighted to the classes' shares."""
    vectors = vectors or word_vectors(docs)
    sample = labelled_sample(docs, labels, label, most, F.lit(True) if learn is None else learn)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches):
        for t in batches:
            x = shared.value.pool(t.column("text"))
            yield pa.RecordBatch.from_arrays([t.column("doc_id"), t.column("y"), t.column("weight"),
                                              pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["doc_id", "y", "weight", "x"])

    rows = (sample.select("doc_id", "y", "weight", "text")
            .mapInArrow(run, "doc_id long, y int, weight double, x binary").toPandas()
            .assign(o=lambda d: mix64(d["doc_id"].to_numpy().astype(np.uint64))).sort_values(["o", "y"]))
    x = np.stack([np.frombuffer(b, np.float32) for b in rows["x"]]).astype(float) if len(rows) \
        else np.zeros((0, 3 * vectors.vectors.shape[1]))
    return vectors, fit_network(x, rows["y"].to_numpy(dtype=float), rows["weight"].to_numpy(dtype=float))


def score(docs: DataFrame, vectors: WordVectors, network: Network, column: str = "score") -> DataFrame:
    """``doc_id`` and the calibrated probability of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches):
        wv, net = shared.value
        for t in batches:
            yield pa.RecordBatch.from_arrays([t.column(0), pa.array(net.probability(wv.pool(t.column(1)).astype(float)))],
                                             names=["doc_id", column])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, {column} double")
