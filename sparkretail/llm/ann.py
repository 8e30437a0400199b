"""Approximate nearest neighbours by largest inner product: a hierarchical
k-means tree searched best bin first.

Inner products become distances by one more component: with M the largest
norm, rows get sqrt(M^2 - |x|^2), queries 0, and the nearest row is the one of
the largest inner product. The tree is fitted on a bounded sample; every row is
assigned to a leaf. A query walks the tree with a priority queue of nodes by
distance to their centre and visits leaves in that order; how many is
calibrated on the sample (leaf visits widen until ``recall`` of its exact
neighbours is reached) and further widened until the leaves hold ``k``
candidates. Spark joins queries and rows by bin: some neighbouring leaves, or a
part of a large one, of ``part_rows`` rows at most, so a hot vector is spread.
The queries that visit a bin are dealt by hash into blocks of about
``block_queries``, each with the bin's rows, so neither side of a group grows
with the table.

Vectors that are null, zero or hold a null or non-finite component take no
part. Scores are inner products in double precision of the original vectors.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparkretail.llm.components import stored
from sparkretail.llm.textops import mix64


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


@dataclass
class Tree:
    """Nodes of the hierarchical k-means tree; leaves are numbered in order."""

    top: float  # largest norm
    center: np.ndarray  # one row per node, augmented
    children: list[np.ndarray] = field(default_factory=list)  # empty for a leaf
    leaf: np.ndarray = None  # leaf number of each node or -1
    visits: int = 1

    @property
    def leaves(self) -> int:
        return int((self.leaf >= 0).sum())

    def augment(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, self.top**2 - (x * x).sum(axis=1)))
        return np.hstack([x, rest[:, None]])

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: the nearest child at every level."""
        a, out = self.augment(x), np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if len(rows) == 0:
                continue
            kids = self.children[node]
            if len(kids) == 0:
                out[rows] = self.leaf[node]
                continue
            best = distances(a[rows], self.center[kids]).argmin(axis=1)
            todo += [(kid, rows[best == i]) for i, kid in enumerate(kids)]
        return out

    def order(self, q: np.ndarray):
        """Leaves in best-bin-first order for one query."""
        a = np.append(q, 0.0)
        queue, push = [(0.0, 0)], heapq.heappush
        while queue:
            _, node = heapq.heappop(queue)
            while len(self.children[node]):
                kids = self.children[node]
                d = ((self.center[kids] - a) ** 2).sum(axis=1)
                near = int(d.argmin())
                for i, kid in enumerate(kids):
                    if i != near:
                        push(queue, (float(d[i]), int(kid)))
                node = int(kids[near])
            yield int(self.leaf[node])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (b * b).sum(axis=1) - 2 * a @ b.T


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 8) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = distances(x, c).argmin(axis=1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(1, n)[:, None], c)
    return c


def fit_tree(x: np.ndarray, top: float, branch: int = 8, leaf_rows: int = 48, seed: int = 11) -> Tree:
    rng = np.random.default_rng(seed)
    t = Tree(top, np.zeros((0, x.shape[1] + 1)))
    a = t.augment(x)
    centers = [a.mean(axis=0) if len(a) else np.zeros(x.shape[1] + 1)]
    t.children, todo = [np.zeros(0, np.int64)], [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop(0)
        k = min(branch, -(-len(rows) // leaf_rows))
        if k < 2:
            continue
        c = _kmeans(a[rows], k, rng)
        near = distances(a[rows], c).argmin(axis=1)
        used = np.unique(near)
        if len(used) < 2:  # equal rows
            continue
        first = len(centers)
        for u in used:
            centers.append(c[u])
            t.children.append(np.zeros(0, np.int64))
            todo.append((len(centers) - 1, rows[near == u]))
        t.children[node] = np.arange(first, first + len(used))
    t.center = np.stack(centers)
    is_leaf = np.array([len(c) == 0 for c in t.children])
    t.leaf = np.where(is_leaf, np.cumsum(is_leaf) - 1, -1)
    return t


def calibrate(t: Tree, x: np.ndarray, k: int, recall: float, queries: int = 300, seed: int = 13) -> int:
    """Leaf visits that reach the recall on queries from the sample. The
    sample is thinner than the table, so its neighbours lie in more leaves."""
    if len(x) < 2:
        return 1
    pick = np.random.default_rng(seed).choice(len(x), min(queries, len(x)), replace=False)
    leaf = t.assign(x)
    need = []
    for i in pick:
        s = x @ x[i]
        s[i] = -np.inf
        near = np.argsort(-s, kind="stable")[:min(k, len(x) - 1)]
        at = np.empty(t.leaves, np.int64)
        at[list(t.order(x[i]))] = np.arange(t.leaves)
        need.append(at[leaf[near]] + 1)
    need = np.sort(np.concatenate(need))
    return int(need[min(len(need) - 1, int(np.ceil(recall * len(need))) - 1)])


def bins(size: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First bin and number of bins of each leaf: leaves in a row share a bin
    of ``most`` rows, a larger leaf is dealt over several."""
    first, parts, at, held = np.zeros(len(size), np.int64), np.ones(len(size), np.int64), 0, 0
    for i, n in enumerate(size.tolist()):
        if n > most:
            at += held > 0
            first[i], parts[i] = at, -(-n // most)
            at, held = at + int(parts[i]), 0
            continue
        if held + n > most:
            at, held = at + 1, 0
        first[i] = at
        held += n
    return first, parts


def best(q: np.ndarray, x: np.ndarray, ids: np.ndarray, own: int, k: int, rough: np.ndarray,
         at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k largest inner products of one query with the rows ``at``, ties to
    the smaller id. The rough products choose; those kept are summed again in
    one order, so equal vectors tie."""
    keep = at[ids[at] != own]
    if len(keep) > k:
        r = rough[keep]
        cut = np.partition(r, len(r) - k)[len(r) - k]
        keep = keep[r >= cut - 1e-9 * max(1.0, abs(cut))]
    s = (x[keep] * q).sum(axis=1)
    order = np.lexsort((ids[keep], -s))[:k]
    return ids[keep][order], s[order]


def _matrix(col) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    n = len(col)
    return np.asarray(col.flatten(), np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def fit(rows: DataFrame, k: int = 20, sample: int = 20000, recall: float = 0.94, **kw) -> Tree | None:
    """Tree and visits from the ``sample`` rows of the smallest id hashes of
    ``rows`` (vec_id, vector); None without rows."""
    top = rows.agg(F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))).first()[0]
    if top is None:
        return None
    got = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    x = _matrix(got.column("vector"))
    t = fit_tree(x, top, **kw)
    t.visits = calibrate(t, x, k, recall)
    return t


def search(rows: DataFrame, is_query: Column, tree: Tree, k: int = 20, part_rows: int = 16384,
           block_queries: int = 16384) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every query
    row among all ``rows`` (vec_id, vector) but itself."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(tree)

    def assign(batches):
        for t in batches:
            leaf = shared.value.assign(_matrix(t.column("vector"))) if t.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([t.column("vec_id"), t.column("vector"), pa.array(leaf, pa.int32())],
                                             names=["vec_id", "vector", "leaf"])

    vectors = rows.select("vec_id", "vector")
    placed = stored(vectors.mapInArrow(assign, "vec_id long, vector array<float>, leaf int"), "leaves")
    # bounded by the leaves of the sample's tree: neighbouring leaves share a bin, a large one has bins of its own
    size = np.zeros(tree.leaves, np.int64)
    for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect():
        size[r.leaf] = r.n
    wide = spark.sparkContext.broadcast((size, *bins(size, part_rows)))

    def visit(batches):
        t, n = shared.value, wide.value[0]
        for b in batches:
            x, seen = _matrix(b.column("vector")), []
            for q in x:
                held, some = 0, []
                for v, leaf in enumerate(t.order(q)):
                    if v >= t.visits and held > k:
                        break
                    held += n[leaf]
                    if n[leaf]:
                        some.append(leaf)
                seen.append(np.array(some, np.int32))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vector"), pa.array(seen, pa.list_(pa.int32()))],
                                             names=["query_id", "query", "leaves"])

    # one row a query, stored: visits are found once, counted by bin, then dealt
    visits = stored(vectors.where(is_query).repartition(3 * spark.sparkContext.defaultParallelism, "vec_id")
                    .mapInArrow(visit, "query_id long, query array<float>, leaves array<int>"), "visits")

    def bins_of(leaves) -> dict[int, list[int]]:
        _, first, parts = wide.value
        to: dict[int, list[int]] = {}
        for leaf in leaves:
            for part in range(parts[leaf]):
                to.setdefault(int(first[leaf]) + part, []).append(leaf)
        return to

    def count(batches):
        n = np.zeros(total, np.int64)
        for b in batches:
            for leaves in b.column("leaves"):
                n[list(bins_of(leaves.as_py()))] += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], names=["bin", "n"])

    total = int((wide.value[1] + wide.value[2]).max(initial=0))
    blocks = np.ones(total, np.int64)
    for r in visits.select("leaves").mapInArrow(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        blocks[r.bin] = -(-r.n // block_queries)
    dealt = spark.sparkContext.broadcast(blocks)

    def deal(batches):
        for b in batches:
            ids = b.column("query_id").to_numpy()
            spread = mix64(mix64(ids.astype(np.uint64)) + np.uint64(1))
            for a in range(0, len(ids), 500):
                at, where, block, seen = [], [], [], []
                for i in range(a, min(a + 500, len(ids))):
                    for bin_, some in bins_of(b.column("leaves")[i].as_py()).items():
                        at.append(i)
                        where.append(bin_)
                        block.append(int(spread[i]) % int(dealt.value[bin_]))
                        seen.append(some)
                at = np.array(at, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), b.column("query").take(pa.array(at)), pa.array(where, pa.int32()),
                     pa.array(block, pa.int32()), pa.array(seen, pa.list_(pa.int32()))],
                    names=["query_id", "query", "bin", "block", "leaves"])

    queries = visits.mapInArrow(deal, "query_id long, query array<float>, bin int, block int, leaves array<int>")

    def bin_of(leaf: pd.Series, vec: pd.Series) -> pd.Series:
        _, first, parts = wide.value
        at = leaf.to_numpy()
        return pd.Series((first[at] + (mix64(vec.to_numpy().astype(np.uint64)) % parts[at].astype(np.uint64))
                          .astype(np.int64)).astype(np.int32))

    def blocks_of(bin_: pd.Series) -> pd.Series:
        return pd.Series(dealt.value[bin_.to_numpy()].astype(np.int32))

    data = (placed.withColumn("bin", F.pandas_udf(bin_of, "int")("leaf", "vec_id"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.pandas_udf(blocks_of, "int")("bin") - 1))))

    leaves = tree.leaves

    def compare(q: pa.Table, d: pa.Table) -> pa.Table:
        qi, di = q.column("query_id").to_numpy(), d.column("vec_id").to_numpy()
        found: list[list] = [[], [], []]
        if len(qi) and len(di):
            qx, x, leaf = _matrix(q.column("query")), _matrix(d.column("vector")), d.column("leaf").to_numpy()
            lists = q.column("leaves").combine_chunks()
            visited, upto = lists.flatten().to_numpy(), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
            for a in range(0, len(qi), 64):
                rough = qx[a:a + 64] @ x.T
                for i in range(a, min(a + 64, len(qi))):
                    open_ = np.zeros(leaves, bool)
                    open_[visited[upto[i]:upto[i + 1]]] = True
                    near, s = best(qx[i], x, di, qi[i], k, rough[i - a], np.flatnonzero(open_[leaf]))
                    for c, v in zip(found, (np.full(len(near), qi[i]), near, s)):
                        c.append(v)
        ids = [np.concatenate([np.zeros(0, np.int64), *c]) for c in found[:2]]
        return pa.table({"query_id": pa.array(ids[0], pa.int64()), "vec_id": pa.array(ids[1], pa.int64()),
                         "score": pa.array(np.concatenate([np.zeros(0), *found[2]]))})

    near = (queries.groupBy("bin", "block").cogroup(data.groupBy("bin", "block"))
            .applyInArrow(compare, "query_id long, vec_id long, score double"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, is_query: Column, k: int = 20, sample: int = 20000, recall: float = 0.94,
            vector: str = "embedding", **kw) -> DataFrame:
    """Index every usable row of ``embeddings`` (vec_id, ``vector``) and
    search it with the rows that ``is_query`` admits. Rows take part if they have
    an id and a vector of the commonest length (of the shortest one, if several
    are) that ``usable`` admits. Rows that repeat a vec_id are candidates each,
    of all queries but those of the same id; extra columns are not read; without
    rows there is no result."""
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col(vector).cast("array<float>").alias("vector")) \
        .where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows"))
    common = lengths.orderBy(F.desc("rows"), "n").limit(1).collect()
    if common:
        rows = rows.where(F.size("vector") == common[0].n)
    tree = fit(rows, k, sample, recall, **kw)
    if tree is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(rows, is_query, tree, k)
