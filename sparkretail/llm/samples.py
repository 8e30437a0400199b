"""Bounded, reproducible samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.components import stored


def fold_of(folds: int) -> Column:
    """crc32 of the doc_id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, learn: Column) -> DataFrame:
    """``doc_id, text, y, weight``: at most ``most`` labelled documents of each
    class among those that ``learn`` admits, the ones of the smallest id
    hashes; ``weight`` restores the class's share among all labelled rows. The
    sampled ids are bounded by ``2 * most`` and joined by broadcast, so the
    texts are not shuffled. Null labels and ids are left out."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & learn)
             .select("doc_id", F.col(label).cast("int").alias("y")))
    totals = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    ids = None
    for y, n in sorted(totals.items()):
        one = (known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
               .withColumn("weight", F.lit(n / min(n, most))))
        ids = one if ids is None else ids.union(one)
    if ids is None:
        ids = known.withColumn("weight", F.lit(1.0))
    return stored(docs.select("doc_id", "text").where("text is not null")
                  .join(F.broadcast(ids.dropDuplicates(["doc_id", "y"])), "doc_id"), "labelled")
