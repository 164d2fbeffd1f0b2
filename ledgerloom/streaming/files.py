"""Filings as a stream of files, one document a file: work on whole documents in every micro-batch.

A document arrives whole, so sections need no state, nor does any other work
per document, such as the whole pipeline with its names resolved inside the
batch. A batch is written under its own folder and overwritten when it is
repeated, so a restart neither loses nor doubles a document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators import sections
from ledgerloom.sources.documents import _described, decoded, local_path

_BINARY = "path string, modificationTime timestamp, length bigint, content binary"
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def stream_documents(spark: SparkSession, folder: str, files_per_batch: int = 1_000) -> DataFrame:
    """A stream of the documents of new .txt files."""
    files = spark.readStream.format("binaryFile").schema(_BINARY).option("pathGlobFilter", "*.[tT][xX][tT]").option("maxFilesPerTrigger", files_per_batch).load(folder)
    return _described(files.select(local_path(F.col("path")).alias("source_path"), decoded(F.col("content")).alias("raw_text")))


def stream_sections(documents: DataFrame) -> DataFrame:
    """The sections of a stream of documents."""
    return sections.parse_sections(documents)


def start_documents(spark: SparkSession, folder: str, out: str, checkpoint: str, work: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """What `work` makes of the documents of all files there are and that come, to Parquet, each file once."""

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = stream_documents(spark, folder).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    # The files of a batch are listed by as many tasks as there are cores, not one each; the stream keeps the setting of its start.
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(spark.sparkContext.defaultParallelism))
    try:
        return stream.start()
    finally:
        spark.conf.set(_LISTING, before)


def start_sections(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Sections of all files there are and that come, to Parquet, each file once."""
    return start_documents(spark, folder, out, checkpoint, stream_sections)


def event_windows(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums per window and type; what comes later than `late` is left out of closed windows."""
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", width).alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("starts"), "event_type", "n", "total")
    )
