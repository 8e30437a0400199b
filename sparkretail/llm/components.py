"""Connected components of an edge table as Spark jobs.

Alternating large-star and small-star steps: each groups the edges by one end
(partial aggregates, no group is gathered) and joins the minimum back, so a
node with many edges is only a skewed join key. Every step is written to the
shared folder, which also cuts the lineage. Stars need no further step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.session import parts_for, scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    return (e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .union(low.select("u", F.col("m").alias("v"))).distinct())


def _not_yet_stars(e: DataFrame) -> tuple[int, int]:
    """Ends of all edges, and the nodes that hang on several smaller ones or on
    one that hangs on another: without such nodes the edges are stars."""
    ends = e.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("up")),
                                      F.struct(F.col("v").alias("node"), F.lit(None).cast(e.schema["v"].dataType).alias("up"))))
                    .alias("x")).select("x.*")
    nodes = ends.groupBy("node").agg(F.count("*").alias("n"), F.min("up").alias("low"), F.max("up").alias("high"),
                                     F.max(F.col("up").isNull()).alias("carries"))
    return tuple(nodes.agg(F.coalesce(F.sum("n"), F.lit(0)),
                           F.count_if(F.expr("low < high or (low is not null and carries)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node that has an edge to another one;
    the component is its smallest node."""
    x, y = F.col(a), F.col(b)
    e = stored(edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "edges")
    ends, left = _not_yet_stars(e)
    while left:  # a step leaves no more edges than there were ends: as many files as those need
        e = stored(_small_star(_large_star(e)).coalesce(parts_for(e.sparkSession, ends)), "edges")
        ends, left = _not_yet_stars(e)
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
