import duckdb

import __spark_entry__ as entry
import corpus_pipeline
from scripts.oracle_check import TABLES, _digest
from sparkretail.llm import mixing, ngram_join, packing, pii, tables, toxicity
from sparkretail.llm.queries import ORACLES, QUERIES


def test_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "pii", "mixing", "packing"]


def test_oracles(spark, sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_small}/{t}.parquet')")
    for key, sql in ORACLES.items():
        df = QUERIES[key](spark, sf_small)
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        want = [tuple(r[cols.index(c)] for c in df.columns) for r in res.fetchall()]
        got = [tuple(r) for r in df.collect()]
        assert sorted(cols) == sorted(df.columns) and got
        assert _digest(got, df.columns, None)[0] == _digest(want, df.columns, None)[0]


def test_stages_follow_their_operators(spark, sf_small):
    """Every stage against what its operator says of its own input."""
    docs = tables.documents(spark, sf_small)
    model = toxicity.fit(docs, tables.labels(spark, sf_small))
    rows = [r.asDict() for r in docs.collect()]
    steps = []
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_small)
        now = spark.createDataFrame(now.collect(), now.schema)
        steps.append(now)
        if name != "packing":
            assert now.columns == corpus_pipeline.COLUMNS
    toxic = {r.doc_id for r in toxicity.score(docs, model).where("score >= 0.5").collect()}
    kept = {r.doc_id for r in steps[0].collect()}
    assert kept == {r["doc_id"] for r in rows} - toxic
    marked = {r.doc_id for r in tables.labels(spark, sf_small).where("toxic = 1").collect()}
    clean = {r.doc_id for r in tables.labels(spark, sf_small).where("toxic = 0").collect()} & {r["doc_id"] for r in rows}
    assert len(kept & marked) <= 0.2 * len(marked) and len(clean - kept) <= 0.02 * len(clean)
    groups = ngram_join.ngram_jaccard_join(steps[0], 5, 80).collect()
    assert sorted(r.doc_id for r in steps[1].collect()) == sorted({r.component_id for r in groups})
    assert sorted((r.doc_id, r.text) for r in steps[2].collect()) == sorted(
        (r.doc_id, r.text) for r in pii.replace_pii(steps[1]).collect())
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())
    copies = {r.doc_id: r.copies for r in mixing.plan_copies(steps[2]).collect()}
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted(i for i, c in copies.items() for _ in range(c))
    pieces = packing.pieces(steps[3], 2048)
    assert steps[4].count() == pieces.count()


def test_rows_of_one_id_are_documents(spark, docs, sf_small):
    """Only copies go, also where ids repeat or are null."""
    a, b, c = ("alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight", "nothing like the others at all here")
    rows = [(5, a), (5, b), (7, a), (3, b), (None, c), (None, c), (9, a), (8, None), (8, None)]
    near = dict(corpus_pipeline.STAGES)["near_duplicates"]
    got = sorted(((r.doc_id, r.text) for r in near(spark, docs(rows), sf_small).collect()), key=str)
    assert got == sorted([(5, a), (3, b), (None, c), (8, None), (8, None)], key=str)


def test_edge_tables(spark, docs, sf_small, tmp_path):
    from tests.llm.conftest import EDGE

    def run(frame):
        now = frame.select(*corpus_pipeline.COLUMNS)
        out = []
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, sf_small)
            now = spark.createDataFrame(now.collect(), now.schema)
            out.append(now)
        return out

    a = run(docs([*EDGE, (None, "null id here now ok"), (None, None)]))  # of equal texts the smallest id stays
    assert sum(r.doc_id is None for r in a[1].collect()) == 2
    assert sorted(r.doc_id for r in a[1].collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert a[4].count() > 0
    assert [x.count() for x in run(docs([]))] == [0] * 5
