"""The append-only forecast table.

Model outputs are unioned by column name, store-level outputs get
``dept_id = -1``, every row of one run carries the same ``run_id`` /
``run_ts`` (computed once on the driver, injectable for tests), values are
cast and rounded to the declared 9-column schema, and runs are appended.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkretail.functions.scalar import round_half_away
from sparkretail.sources import committed

STORE_LEVEL_DEPT = -1

FORECAST_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_ts", T.TimestampNTZType()),  # UTC wall-clock time
    T.StructField("store_id", T.LongType()),
    T.StructField("dept_id", T.LongType()),
    T.StructField("ds", T.DateType()),
    T.StructField("yhat", T.DoubleType()),
    T.StructField("yhat_lower", T.DoubleType()),
    T.StructField("yhat_upper", T.DoubleType()),
    T.StructField("model", T.StringType()),
])


def with_default_dept(df: DataFrame) -> DataFrame:
    """Add ``dept_id = -1`` when the output is store level (no dept_id)."""
    if "dept_id" in df.columns:
        return df
    return df.withColumn("dept_id", F.lit(STORE_LEVEL_DEPT).cast("bigint"))


def union_models(outputs: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name of the available model outputs; raises when
    there is none."""
    if not outputs:
        raise FileNotFoundError("No forecast outputs found.")
    frames = [with_default_dept(o) for o in outputs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def new_run_stamp() -> tuple[str, datetime]:
    return uuid.uuid4().hex[:8], datetime.now(timezone.utc).replace(tzinfo=None)


def _stamped(df: DataFrame, run_id: F.Column, run_ts: F.Column) -> DataFrame:
    return df.select(
        run_id.cast("string").alias("run_id"),
        run_ts.cast("timestamp_ntz").alias("run_ts"),
        F.col("store_id").cast("bigint").alias("store_id"),
        F.col("dept_id").cast("bigint").alias("dept_id"),
        F.col("ds").cast("date").alias("ds"),
        round_half_away(F.col("yhat").cast("double"), 2).alias("yhat"),
        round_half_away(F.col("yhat_lower").cast("double"), 2).alias("yhat_lower"),
        round_half_away(F.col("yhat_upper").cast("double"), 2).alias("yhat_upper"),
        F.col("model").cast("string").alias("model"))


def stamp(df: DataFrame, run_id: str | None = None, run_ts: datetime | None = None) -> DataFrame:
    """Cast, round (2 places) and stamp one run; one value per run, so every
    row agrees (never a per-row ``uuid()``)."""
    if run_id is None or run_ts is None:
        rid, rts = new_run_stamp()
        run_id = run_id or rid
        run_ts = run_ts or rts
    return _stamped(df, F.lit(run_id), F.lit(run_ts))


def stamp_runs(df: DataFrame, runs: list[tuple[str, datetime]]) -> DataFrame:
    """The union of ``stamp(df, run_id, run_ts)`` over ``runs`` in one pass
    over ``df`` (each row is emitted once per run)."""
    stamps = F.array(*[F.struct(F.lit(r).alias("_rid"), F.lit(t).alias("_rts")) for r, t in runs])
    return _stamped(df.select("*", F.inline(stamps)), F.col("_rid"), F.col("_rts"))


def append_run(df: DataFrame, path: str, run_id: str) -> committed.Commit:
    """Append one stamped run to the table as one commit (partitioned by model,
    so readers of one model prune the others). A run that is already in the
    table is not written again; rows of another run fail the write."""
    other = F.raise_error(F.concat(F.lit(f"not of run {run_id}: "), F.col("run_id"))).cast("string")
    same = F.when(F.col("run_id") == run_id, F.col("run_id")).otherwise(other)
    return committed.write(df.withColumn("run_id", same), path, run_id, partition_by=["model"])


def read_table(spark, path: str) -> DataFrame:
    """The committed runs."""
    return committed.read(spark, path, FORECAST_SCHEMA)
