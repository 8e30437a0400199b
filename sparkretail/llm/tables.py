"""Readers of the tables that the queries use: declared columns, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("doc_id long, text string, lang string, source string, n_chars long").parquet(
        f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("doc_id long, quality int, toxic int").parquet(f"{sf_dir}/labels.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("vec_id long, embedding array<float>, label int").parquet(f"{sf_dir}/embeddings.parquet")
