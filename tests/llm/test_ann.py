import numpy as np
from pyspark.sql import functions as F

from sparkretail.llm import ann, tables
from sparkretail.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, leaf int"


def exact(x, ids, i, k):
    s = (x * x[i]).sum(axis=1)
    o = np.lexsort((ids, -s))
    return [(int(ids[j]), float(s[j])) for j in o[o != i][:k]]


def test_recall_on_the_table(spark, sf_small):
    rows = tables.embeddings(spark, sf_small).collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], np.float32).astype(float)
    got: dict = {}
    for r in QUERIES["op6_kmeans_tree_ann"](spark, sf_small).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        want = exact(x, ids, int(np.flatnonzero(ids == q)[0]), 20)
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        score = dict(zip(ids.tolist(), (x * x[ids == q][0]).sum(axis=1).tolist()))
        assert all(abs(score[v] - s) < 1e-12 for _, v, s in found)
        hits += len({v for _, v, _ in found} & {v for v, _ in want})
    assert hits / (20 * len(got)) >= 0.9


def test_bad_vectors_ties_and_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (7, []), (8, [float("inf"), 1.0]), (9, [1.0, 0.0]), (20, [3.0, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = [(r.query_id, r["rank"], r.vec_id, r.score)
           for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 3.0), (0, 2, 1, 1.0), (0, 3, 9, 1.0), (20, 1, 0, 3.0), (20, 2, 1, 3.0), (20, 3, 9, 3.0)]
    assert ann.nearest(df.where("vec_id in (3, 4)"), F.lit(True)).count() == 0
    assert ann.nearest(df.where("vec_id = 0"), F.lit(True)).count() == 0


def test_clustered_data_and_a_hot_vector(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(40, 16))
    x = np.concatenate([centers[rng.integers(40, size=2000)] + 0.1 * rng.normal(size=(2000, 16)),
                        np.repeat(centers[:1], 1000, axis=0)]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    rows = df.select("vec_id", F.col("embedding").alias("vector"))
    tree = ann.fit(rows, k=10, leaf_rows=40)
    assert tree.visits < tree.leaves / 2
    got: dict = {}
    for r in ann.search(rows, F.col("vec_id") % 50 == 0, tree, k=10, part_rows=300).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    y, ids = x.astype(float), np.arange(len(x))
    hits = 0
    for q, f in got.items():
        want = [v for v, _ in exact(y, ids, q, 10)]
        hits += len(set(want) & {v for _, v in f})
        if q >= 2000:  # equal vectors: the smallest ids, in order
            assert [v for _, v in sorted(f)] == want
    assert hits / (10 * len(got)) >= 0.9


def test_queries_of_a_bin_are_dealt_into_blocks(spark, monkeypatch):
    """No group holds many more queries than the bound; the result is the same."""
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(800, 8)).astype(np.float32))], SCHEMA)
    rows = df.select("vec_id", F.col("embedding").alias("vector"))
    tree = ann.fit(rows, k=5)
    ask = F.col("vec_id") % 2 == 0
    want = sorted(map(tuple, ann.search(rows, ask, tree, k=5).collect()))
    plain, sides = type(rows).groupBy, []

    def spy(self, *cols):
        if cols[0] == "bin" and {"query_id", "vec_id"} & set(self.columns):
            sides.append((self, cols))
        return plain(self, *cols)

    monkeypatch.setattr(type(rows), "groupBy", spy)
    got = ann.search(rows, ask, tree, k=5, part_rows=100, block_queries=50)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 2000
    most = [max(r["count"] for r in plain(d, *cols).count().collect()) for d, cols in sides]
    assert len(most) == 2 and max(most) <= 100


def test_bins_cover_every_leaf():
    size = np.array([10, 5000, 0, 300, 1900, 2, 4001])
    first, parts = ann.bins(size, 2000)
    assert parts.tolist() == [1, 3, 1, 1, 1, 1, 3]
    spans = [set(range(f, f + p)) for f, p in zip(first, parts)]
    assert not (spans[0] & spans[1]) and not (spans[1] & spans[3]) and not (spans[6] & spans[5])


def test_vectors_of_other_lengths_and_repeated_ids(spark):
    rows = [(i, [float(i % 7), 1.0, float(i)]) for i in range(40)] + [(100, [1.0, 2.0]), (101, [1.0]), (102, []), (3, [5.0, 5.0, 5.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, rank int, leaf string")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, k=5).collect()
    assert {r.query_id for r in got} == {0, 20} and not {r.vec_id for r in got} & {100, 101, 102}
    for q in (0, 20):
        v = rows[q][1]
        want = sorted(((-sum(a * b for a, b in zip(v, x)), i) for i, x in rows if i != q and len(x) == 3))[:5]
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == [(i, -s) for s, i in want]
