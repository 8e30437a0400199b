"""Corpus pipeline: documents in, packed training sequences out.

``STAGES`` are (name, function) pairs; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame. ``run`` writes every stage's result as
Parquet in the shared folder and rereads it as the next one's documents, so a
lost executor costs one stage at most. All but the last return the columns of
documents.

1. toxicity: documents scored 0.5 or more go.
2. near_duplicates: n-gram Jaccard join on five-word shingles at 0.8 or more;
   the smallest doc_id of each group of linked documents stays. Documents
   without words link with nothing and stay. Every row is a document: of the
   rows that share a doc_id those with other texts stay.
3. pii: surrogates replace detected entities; n_chars follows the new text.
4. mixing: sources are mixed to their target weights; a document is repeated
   as often as the mix takes it.
5. packing: the pieces of every row in sequences of at most 2048 tokens.

Rows with a null doc_id or a null text are rows like any other (null text: no
words, no entity); mixing takes no copies of documents without
words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.llm import mixing, ngram_join, packing, pii, tables, toxicity
from sparkretail.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(tables.documents(spark, sf_dir), tables.labels(spark, sf_dir))
    return toxicity.keep_clean(docs, model, 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each_group(docs.select(*COLUMNS), k=5, threshold_pct=80)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return (pii.replace_pii(docs.select(*COLUMNS))
            .withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", replace_pii),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL cannot express the classifier and the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
