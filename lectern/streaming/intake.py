"""Incremental intake as a stream: new files, each content once, handed to a batch operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_files(spark: SparkSession, root: str) -> DataFrame:
    """Files below root as a stream: path, content, modificationTime, sha256."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", True).load(root)
    return files.select("path", "content", "modificationTime", F.sha2("content", 256).alias("sha256"))


def first_copies(files: DataFrame, delay: str | None = None) -> DataFrame:
    """The first of each content. With a delay, a content is remembered only so long after the latest modification time, so the state stays
    bounded; without, for ever, as the intake rule asks."""
    if delay is None:
        return files.dropDuplicates(["sha256"])
    return files.withWatermark("modificationTime", delay).dropDuplicatesWithinWatermark(["sha256"])


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what is there and stop; files that a checkpoint knows are not taken again."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
