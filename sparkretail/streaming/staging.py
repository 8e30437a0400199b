"""Weekly staging over a stream of raw sales files.

The staging model is a projection plus stream-static LEFT joins to the store
and feature dimensions, so the same operator accepts a streaming DataFrame;
no state is kept (SURVEY §2.12: nothing more is owed). ``run_available``
drains the files present now into a parquet sink with a checkpoint under the
shared checkpoint folder, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkretail.operators.staging import stg_weekly_sales
from sparkretail.sources.files import WEEKLY_TRAIN


def stream_weekly_staging(spark: SparkSession, train_dir: str, stores: DataFrame,
                          features: DataFrame, file_format: str = "parquet",
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``stg_weekly_sales``: raw weekly files arriving in
    ``train_dir`` joined to static stores and features."""
    reader = spark.readStream.schema(WEEKLY_TRAIN).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_format == "csv":
        reader = reader.option("header", "true")
    return stg_weekly_sales(reader.load(train_dir), stores, features)


def run_available(stream: DataFrame, sink_path: str, checkpoint: str) -> None:
    """Process every file available now (append mode), then stop."""
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(sink_path))
    q.awaitTermination()
