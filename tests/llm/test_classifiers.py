import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkretail.llm import quality, tables, toxicity
from sparkretail.llm.queries import QUERIES
from tests.llm.conftest import EDGE

SF = "/root/testdata/sf0.01"


def auc(y, s):
    order = np.argsort(np.argsort(s, kind="stable"), kind="stable") + 1
    n1 = y.sum()
    return (order[y].sum() - n1 * (n1 + 1) / 2) / (n1 * (~y).sum())


@pytest.mark.parametrize("name,label,held,least", [
    ("op9_toxicity", "toxic", lambda i: zlib.crc32(str(i).encode()) % 5 == 0, 0.85),
    ("op10_quality", "quality", lambda i: zlib.crc32(str(i).encode()) % 3 == 1, 0.95)])
def test_held_out(spark, name, label, held, least):
    got = {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}
    assert len(got) == tables.documents(spark, SF).count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    lab = [(r.doc_id, r[label]) for r in tables.labels(spark, SF).collect() if r.doc_id in got and held(r.doc_id)]
    y, s = np.array([v == 1 for _, v in lab]), np.array([got[i].score for i, _ in lab])
    assert auc(y, s) >= least
    assert ((s >= 0.5) == y).mean() >= 0.85


def test_labels_of_held_out_rows_change_nothing(spark, docs):
    rows = [(i, ("bad foul words " if i % 3 == 0 else "kind fine words ") * 3 + str(i)) for i in range(60)]
    make = lambda flip: spark.createDataFrame(
        [(i, 1, int(i % 3 == 0) if i % 2 else flip) for i in range(60)], "doc_id long, quality int, toxic int")
    d = docs(rows)
    models = [toxicity.fit(d, make(f), F.col("doc_id") % 2 == 1) for f in (0, 1)]
    assert np.array_equal(models[0].value, models[1].value) and models[0].intercept == models[1].intercept
    scores = {r.doc_id: r.score for r in toxicity.score(d, models[0]).collect()}
    assert all((scores[i] >= 0.5) == (i % 3 == 0) for i in range(60))


def test_ratios_and_scores_against_a_plain_recount(spark, docs):
    """Log-count ratios from sets of n-grams as text, scores from the model's
    weights of these."""
    rng = np.random.default_rng(2)
    words = ["foul", "grim", "kind", "fair", "plain", "Été", "rude"]
    rows = [(i, " ".join(rng.choice(words, 4, p=p).tolist())) for i in range(60)
            for p in [[.3, .3, .05, .05, .1, .1, .1] if i % 3 == 0 else [.05, .05, .3, .3, .1, .1, .1]]]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs(rows), labels, bits=22)
    sets = {i: {t[a:a + n] for n in (3, 4, 5) for a in range(len(t) - n + 1)} for i, t in ((i, t.lower()) for i, t in rows)}
    n1, n0 = 20, 40
    grams = {g: ([i % 3 == 0 for i, s in sets.items() if g in s]) for s in sets.values() for g in s}
    grams = {g: v for g, v in grams.items() if len(v) >= 2}
    bucket = {g: int(next(toxicity.Presence((len(g),), 22).rows(pa.array([g])))[0]) for g in grams}
    assert len(set(bucket.values())) == len(grams) == (model.feature >= 0).sum()
    number = {g: model.feature[b] for g, b in bucket.items()}
    for g, v in grams.items():
        want = np.log((sum(v) + 1) / (n1 + 2)) - np.log((len(v) - sum(v) + 1) / (n0 + 2))
        assert model.ratio[number[g]] == pytest.approx(want, abs=1e-12)
    got = {r.doc_id: r.score for r in toxicity.score(docs(rows), model).collect()}
    for i, s in sets.items():
        x = [model.value[number[g]] for g in s if g in number]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(model.intercept + sum(x) / len(x) ** model.power))), abs=1e-9)


def test_toxicity_keeps_rarer_grams(spark, docs):
    """Evidence beyond the 10,000 strongest n-grams counts."""
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in w) for w in rng.integers(0, 26, (6000, 8))]
    rows = [(i, " ".join(words[j] for j in (np.arange(100) * 30 + 3000 * (i % 2) + i // 2) % 3000 + 3000 * (i % 2)))
            for i in range(120)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(120)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs(rows), labels)
    assert (model.feature >= 0).sum() == 30_000 == len(model.value)
    scores = {r.doc_id: r.score for r in toxicity.score(docs(rows), model).collect()}
    assert all((scores[i] >= 0.5) == (i % 2 == 1) for i in range(120))


def test_toxicity_edge_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs(EDGE), none)
    got = toxicity.score(docs(EDGE), model).collect()
    assert len(got) == len(EDGE) and all(r.score < 0.5 for r in got)
    assert toxicity.keep_clean(docs(EDGE), model).count() == len(EDGE)
    assert toxicity.score(docs([]), model).count() == 0 and toxicity.keep_clean(docs([]), model).count() == 0
    some = spark.createDataFrame([(4, 1, 1), (5, 1, 0), (1, 1, 1), (99, 1, 1), (None, 1, 1), (6, 1, None)],
                                 "doc_id long, quality int, toxic int")
    assert toxicity.score(docs(EDGE), toxicity.fit(docs(EDGE), some)).count() == len(EDGE)


def test_presence_counts_each_gram_once():
    p = toxicity.Presence((3,), 12)
    a, b, c, d = (x.copy() for x in p.rows(pa.array(["abcabcabc", "ABC", None, "ab"])))
    assert len(a) == 3 and len(b) == 1 and len(c) == len(d) == 0 and set(b) <= set(a)


def test_quality_edge_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit(docs(EDGE), none)
    assert {r.score for r in quality.score(docs(EDGE), *model).collect()} == {0.5}
    assert quality.score(docs([]), *model).count() == 0
    vectors = quality.word_vectors(docs([]))
    assert not vectors.vectors.any() and quality.score(docs(EDGE), vectors, model[1]).count() == len(EDGE)


def test_word_vectors_equal_a_plain_count(spark, docs):
    texts = ["one two three two one", "two &&& three", "ONE one", None, ""]
    bits, dim = 10, 8
    got = quality.word_vectors(docs(list(enumerate(texts))).repartition(3), bits=bits, dim=dim, window=2)
    place, sign = quality.index_vectors(bits, dim, 4, 5)
    total = np.zeros((1 << bits, dim))
    for t in texts:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        rows, _ = quality.tokens(raw, np.array([0, len(raw)]), bits)
        for i, x in enumerate(rows):
            for j in range(max(0, i - 2), min(len(rows), i + 3)):
                if j != i:
                    np.add.at(total[x], place[rows[j]], sign[rows[j]])
    want = np.sign(total) * np.sqrt(np.abs(total))
    want /= np.maximum(1e-9, np.linalg.norm(want, axis=1, keepdims=True))
    assert np.allclose(got.vectors, want, atol=1e-6)


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 5))
    p = 1 / (1 + np.exp(-x @ np.array([2.0, -1.0, 0.5, 0.0, 0.0])))
    y = (rng.random(1500) < p).astype(float)
    net = quality.fit_network(x, y, np.ones(1500))
    q = net.probability(x)
    assert 0.25 <= net.temperature <= 8 and abs(q.mean() - y.mean()) < 0.05
    for lo, hi in ((0, 0.3), (0.3, 0.7), (0.7, 1.01)):
        m = (q >= lo) & (q < hi)
        assert abs(q[m].mean() - p[m].mean()) < 0.1
