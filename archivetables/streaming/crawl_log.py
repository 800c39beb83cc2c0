from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivetables.operators.crawl_log import raise_if_fatal


def read_crawl_log_stream(
    spark: SparkSession, folder: str, max_files_per_trigger: int = 1000
) -> DataFrame:
    """Lines of the files added to a folder: ``path, line_no, line``.

    A stream of text has no line numbers, so ``line_no`` is null.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(folder)
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.lit(None).cast("bigint").alias("line_no"),
        F.col("value").alias("line"),
    )


def stop_on_fatal(batch: DataFrame, batch_id: int) -> None:
    """For ``writeStream.foreachBatch`` on log lines: a fatal line fails the stream."""
    raise_if_fatal(batch)
