"""Join helpers.

``join_dimension`` is a plain N:1 join without hints: Spark broadcasts a side
only under ``autoBroadcastJoinThreshold`` by its size estimate, and adaptive
execution re-plans on the measured shuffle sizes and splits skewed keys. No
job runs while the plan is built, and no side that grows with the data is
shipped whole to every executor.

``unique_dimension`` makes a repeated key fail the query instead of fanning
out the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unique_dimension(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dim`` guarded by its key: a second row of one key raises when it is
    read. The window has the join's partitioning, so a shuffle join adds none."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])
    first = keys[0]
    return (dim.withColumn("_rows", n)
            .withColumn(first, F.when(known & (F.col("_rows") > 1),
                                      F.raise_error(F.concat(F.lit("duplicate dimension key: "), shown)))
                        .otherwise(F.col(first)))
            .drop("_rows"))


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column,
                   how: str = "left") -> DataFrame:
    """N:1 join of a fact to a dimension; see the module note."""
    return fact.join(dim, on, how)
