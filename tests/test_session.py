import os
import subprocess
import sys

from pyspark.sql import functions as F

from sparkretail import session


def test_changed_input_is_built_anew(spark, tmp_path):
    folder, built = str(tmp_path / "in"), []

    def build():
        built.append(1)
        return spark.read.parquet(f"{folder}/t").agg(F.sum("id").alias("s"))

    spark.range(10).write.parquet(f"{folder}/t")
    total = lambda **kw: session.stored_once(spark, "sum", folder, build, **kw).first().s
    assert total() == total() == 45 and len(built) == 1
    spark.range(100).write.mode("overwrite").parquet(f"{folder}/t")
    assert total() == total() == 4950 and len(built) == 2
    assert total(refresh=True) == 4950 and len(built) == 3


def test_scratch_is_dropped(tmp_path):
    """In a session of its own: the shared folder is empty afterwards."""
    code = f"""
import os, sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from sparkretail import session
spark = session.get_session("local[1]", conf={{"spark.checkpoint.dir": {str(tmp_path / 'shared')!r}}})
df = session.materialize(spark.range(5), "five")
assert df.count() == 5
path = session._scratch_folder(spark).removeprefix("file:")
assert os.listdir(path)
session.drop_scratch(spark)
assert not os.path.exists(path)
print("dropped")
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, timeout=300)
    assert "dropped" in out.stdout, out.stderr[-2000:]


def test_workers_find_the_package_from_another_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", {str(tmp_path / 'shared')!r}).getOrCreate()
entry.queries()["src_manifest_check"](spark, "/root/testdata/sf0.001")

def use(batches):
    from sparkretail.functions import scalar
    for b in batches:
        assert scalar.MONEY_SCALE == 2
        yield b

print("rows", spark.range(3).mapInArrow(use, "id long").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, timeout=300, env=env)
    assert "rows 3" in out.stdout, out.stderr[-2000:]


def test_temporary_tables_are_deleted(spark):
    kept = session.materialize(spark.range(3), "kept")
    with session.temporary(spark):
        gone = session.scratch_path(spark, "gone")
        spark.range(4).write.parquet(gone)
        with session.temporary(spark):
            inner = session.materialize(spark.range(5), "inner")
            assert inner.count() == 5
        assert spark.read.parquet(gone).count() == 4
    assert kept.count() == 3
    assert not os.path.exists(gone.removeprefix("file:"))
