import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from sparkretail.operators import forecast_table as ft
from sparkretail.operators import quality, serving
from sparkretail.sources import committed

SCHEMA = "k long, v string"
OUT = "store_id long, ds date, yhat double, yhat_lower double, yhat_upper double, model string"


def rows(spark, path, **kw):
    from pyspark.sql.types import StructType
    return sorted(tuple(r) for r in committed.read(spark, path, StructType.fromDDL(SCHEMA), **kw).collect())


def frame(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def test_append_overwrite_and_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert rows(spark, path) == [] and committed.commits(spark, path) == []
    committed.write(frame(spark, (1, "a")), path, "r1")
    committed.write(frame(spark, (2, "b")), path, "r2")
    assert rows(spark, path) == [(1, "a"), (2, "b")]
    committed.write(frame(spark, (3, "c")), path, "r3", "overwrite")
    committed.write(frame(spark, (4, "d")), path, "r4")
    assert rows(spark, path) == [(3, "c"), (4, "d")] and rows(spark, path, version=2) == [(1, "a"), (2, "b")]
    assert [c.rows for c in committed.commits(spark, path)] == [1, 1, 1, 1]


def test_partitioned_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    for i, v in enumerate("ab"):
        committed.write(frame(spark, (i, v), (i + 10, "c")), path, f"r{i}", partition_by=["v"])
    assert rows(spark, path) == [(0, "a"), (1, "b"), (10, "c"), (11, "c")]


def test_a_repeated_run_is_one_run(spark, tmp_path):
    path = str(tmp_path / "t")
    first = committed.write(frame(spark, (1, "a")), path, "r1")
    again = committed.write(frame(spark, (1, "other")), path, "r1")
    assert again == first and rows(spark, path) == [(1, "a")]
    committed.write(frame(spark, (9, "z")), path, "r2", "overwrite")
    committed.write(frame(spark, (1, "a")), path, "r1")  # a late repetition does not come back
    assert rows(spark, path) == [(9, "z")]


def test_a_write_that_breaks_off_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    committed.write(frame(spark, (1, "a")), path, "r1", "overwrite")
    broken = spark.range(8, numPartitions=8).select(F.col("id").alias("k"), F.when(
        F.col("id") == 7, F.raise_error(F.lit("lost")).cast("string")).otherwise("x").alias("v"))
    with pytest.raises(Exception, match="lost"):
        committed.write(broken, path, "r2", "overwrite")
    assert rows(spark, path) == [(1, "a")]
    committed.write(frame(spark, (2, "b")), path, "r2", "overwrite")
    assert rows(spark, path) == [(2, "b")]


def test_checks_gate_the_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    checks = (quality.Check("rows", "min", 2, "rows"), quality.Check("no null v", "max", 0, "nulls", "v"),
              quality.Check("two keys", "min", 2, "distinct", "k"))
    committed.write(frame(spark, (1, "a"), (2, "b")), path, "good", checks=checks)
    with pytest.raises(committed.ChecksFailed, match=r"rows\]: 1 < 2.*no null v\]: 1 > 0.*two keys\]: 1 < 2"):
        committed.write(frame(spark, (3, None)), path, "bad", checks=checks)
    assert rows(spark, path) == [(1, "a"), (2, "b")]
    committed.write(frame(spark, (3, "c"), (4, "d")), path, "bad", checks=checks)
    assert len(rows(spark, path)) == 4


def test_checks_take_no_scan_of_their_own(spark, tmp_path):
    """Input rows are read once, whatever the number of observed checks."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v")).mapInArrow(count, SCHEMA)
    checks = [quality.Check("rows", "exact", 1000, "rows"), quality.Check("nulls", "max", 0, "nulls", "v"),
              quality.Check("null keys", "max", 0, "nulls", "k")]
    done = committed.write(df, str(tmp_path / "t"), "r", checks=checks)
    assert done.rows == 1000 and seen.value == 1000


def test_latest_run_on_a_broken_append(spark, tmp_path):
    """The forecast table after a repeated and a broken run: the latest run
    that readers see is the last committed one."""
    path, d = str(tmp_path / "fc"), dt.date(2024, 1, 7)
    out = ft.with_default_dept(spark.createDataFrame([(1, d, 1.0, 0.9, 1.1, "seasonal")], OUT))
    ft.append_run(ft.stamp(out, "a", dt.datetime(2024, 1, 1)), path, "a")
    ft.append_run(ft.stamp(out, "b", dt.datetime(2024, 1, 2)), path, "b")
    ft.append_run(ft.stamp(out, "b", dt.datetime(2024, 1, 2)), path, "b")
    broken = out.withColumn("yhat", F.when(F.col("store_id") == 1, F.raise_error(F.lit("lost")).cast("double")))
    with pytest.raises(Exception, match="lost"):
        ft.append_run(ft.stamp(broken, "c", dt.datetime(2024, 1, 3)), path, "c")
    table = ft.read_table(spark, path)
    assert table.count() == 2 and [r.run_id for r in serving.latest_runs(table).collect()] == ["b"]
    with pytest.raises(Exception, match="not of run y: x"):
        ft.append_run(ft.stamp(out, "x", dt.datetime(2024, 1, 4)), path, "y")
    assert os.path.isdir(path) and json.dumps([c.version for c in committed.commits(spark, path)]) == "[1, 2]"
