"""Tables whose readers see committed runs only.

A table is a folder with ``data/attempt=<id>`` folders and a ``commits`` folder
with one small Parquet folder per version. A run writes its rows to a data
folder of its own; only when all its rows are there, and its checks hold, does
it commit: one row (version, run_id, attempt, mode, rows), written as one file
that appears by renaming. So a write that breaks off leaves nothing that readers
see, and a second write of a committed run_id changes nothing.

``append`` adds a run, ``overwrite`` replaces all before it; readers need no
lock: they list the commits, then read the data folders those name. Row counts
and checks are observed while the data is written (``observe``), so they cost no
pass of their own; a check on distinct values, which cannot be observed, reads
its one column of the written data before the commit. One writer at a time per
table, whose runs are all partitioned by the same columns; the number of commits
is that of the runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkretail.operators.quality import Check, passes

_COMMITS = "version long, run_id string, attempt string, mode string, rows long"


@dataclass(frozen=True)
class Commit:
    version: int
    run_id: str
    attempt: str
    mode: str
    rows: int


class ChecksFailed(ValueError):
    """The checks of a run that was written and not committed."""

    def __init__(self, failed: Sequence[tuple[Check, int]]):
        self.failed = list(failed)
        super().__init__("; ".join(f"Check failed [{c.name}]: {seen} {c.sign()} {c.bound}" for c, seen in self.failed))


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """All commits of a table in order of their version; none for a table that
    does not exist."""
    try:
        found = spark.read.schema(_COMMITS).option("recursiveFileLookup", "true").parquet(f"{path}/commits")
    except Exception as e:  # noqa: BLE001 - Spark raises PATH_NOT_FOUND
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []
    return sorted((Commit(*r) for r in found.collect()), key=lambda c: c.version)


def current(history: Sequence[Commit]) -> list[Commit]:
    """The commits that make up the table: the last overwrite and what follows."""
    first = max((i for i, c in enumerate(history) if c.mode == "overwrite"), default=0)
    return list(history[first:])


def write(df: DataFrame, path: str, run_id: str, mode: str = "append", checks: Sequence[Check] = (),
          partition_by: Sequence[str] = ()) -> Commit:
    """Write one run and commit it if its checks hold (``ChecksFailed``
    otherwise). A run_id that is already committed is not written again."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    history = commits(spark, path)
    done = next((c for c in history if c.run_id == run_id), None)
    if done:
        return done
    attempt = f"{run_id}-{uuid.uuid4().hex[:12]}"
    data = f"{path}/data/attempt={attempt}"
    observed = [(i, c) for i, c in enumerate(checks) if c.metric != "distinct"]
    seen = Observation(f"write-{attempt}")
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.expr().alias(f"c{i}") for i, c in observed]).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(data)
    got = {i: seen.get[f"c{i}"] for i, _ in observed}
    distinct = [(i, c) for i, c in enumerate(checks) if c.metric == "distinct"]
    if distinct:
        row = spark.read.schema(df.schema).parquet(data).agg(*[c.expr().alias(f"c{i}") for i, c in distinct]).first()
        got |= {i: row[f"c{i}"] for i, _ in distinct}
    failed = [(c, got[i]) for i, c in enumerate(checks) if not passes(c, got[i])]
    if failed:
        raise ChecksFailed(failed)
    commit = Commit(history[-1].version + 1 if history else 1, run_id, attempt, mode, seen.get["rows"])
    row = (commit.version, commit.run_id, commit.attempt, commit.mode, commit.rows)
    spark.createDataFrame([row], _COMMITS).coalesce(1).write.mode("errorifexists").parquet(
        f"{path}/commits/{commit.version:012d}")
    return commit


def read(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The committed rows, of the whole table or as of a version. A table
    without commits is empty."""
    history = [c for c in commits(spark, path) if version is None or c.version <= version]
    folders = [f"{path}/data/attempt={c.attempt}" for c in current(history)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.fieldNames())
