import math

from sparkretail.llm import mixing


def water(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while True:
        rate = left / sum(w[s] for s in open_) if open_ else 0
        over = [s for s in open_ if rate * w[s] > cap * sizes[s]]
        if not over:
            return out | {s: rate * w[s] for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            open_.remove(s)


def test_targets_and_copies(spark, docs):
    rows, i = [], 0
    for s, n in (("a", 300), ("b", 40), ("Z", 90), ("é", 200), (None, 120), ("empty", 2)):
        for j in range(n):
            rows.append((i, "" if s == "empty" else " ".join(["w"] * (1 + (j * 7) % 23 + (200 if j == 0 else 0))), s))
            i += 1
    rows += [(i, None, "a"), (i + 1, "w\x0bw w\x1cx", "a"), (5, rows[5][1], "a")]
    got = mixing.plan_copies(docs(rows)).collect()
    assert len(got) == len(rows) and {r["rank"] for r in got} == {7}
    sizes: dict = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want = water(sizes)
    assert next(r["size"] for r in got if r.doc_id == i + 1) == 3  # U+001C does not separate
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert math.isclose(mine[0].target, want[s], rel_tol=1e-12, abs_tol=1e-9) and mine[0].source_size == sizes[s]
        taken = sum(r["size"] * r.copies for r in mine)
        assert all(0 <= r.copies <= 2 for r in mine)
        assert abs(taken - want[s]) <= max((r["size"] for r in mine), default=0)
    again = mixing.plan_copies(docs(rows).repartition(5)).collect()
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in got)
    mixed = mixing.mix(docs(rows))
    assert mixed.count() == sum(r.copies for r in got) and mixed.columns == docs(rows).columns


def test_clashing_columns_and_long_texts(spark, docs):
    from pyspark.sql import functions as F

    rows = docs([(1, "word " * 200_000, "a"), (2, "x" * 300_000, "b"), (None, "two words", "b"), (2, "x y", "b")])
    for c in ("key_", "salt_", "number_", "first_", "rate_", "start_", "row_", "size", "n", "t", "copies"):
        rows = rows.withColumn(c, F.lit(3))
    got = mixing.plan_copies(rows).collect()
    assert sorted(r["size"] for r in got) == [1, 2, 2, 200_000] and all(r.key_ == r.row_ == r.number_ == 3 for r in got)
    assert mixing.mix(rows).columns == rows.columns and mixing.mix(rows).count() == sum(r.copies for r in got)
    assert mixing.plan_copies(rows, keep=["doc_id"]).columns == ["doc_id", "size", "source_size", "target", "copies"]


def test_many_sources_in_ranges(spark, docs, monkeypatch):
    """More sources than one range holds: the same targets."""
    rows = [(i, "w " * (1 + (i * 37) % 50), f"host{i % 70:02d}" if i % 71 else None) for i in range(400)]
    once = {r.doc_id: (r.target, r.copies) for r in mixing.plan_copies(docs(rows)).collect()}
    monkeypatch.setattr(mixing, "RANGE_SOURCES", 9)
    monkeypatch.setattr(mixing, "NUMBERED_ROWS", 20)
    more = mixing.plan_copies(docs(rows)).collect()
    sizes: dict = {}
    for r in more:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want = water(sizes)
    assert all(math.isclose(r.target, want[r.source], rel_tol=1e-9) and math.isclose(r.target, once[r.doc_id][0], rel_tol=1e-9) for r in more)


def test_empty_table(spark, docs):
    assert mixing.plan_copies(docs([])).count() == 0 and mixing.mix(docs([])).count() == 0
    alone = mixing.plan_copies(docs([(1, None, None), (2, "", None)])).collect()
    assert [(r["size"], r.source_size, r.target, r.copies) for r in alone] == [(0, 0, 0.0, 0)] * 2


def test_no_python_in_the_plan(spark, docs):
    plan = mixing.plan_copies(docs([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
