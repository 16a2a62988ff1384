"""Streaming readers: one operator for message topics and for watched files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_topics(
    spark: SparkSession,
    topics: list[str],
    servers: str,
    starting: str = "latest",
    min_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """Messages of several Kafka topics as ``topic``, ``value`` and ``timestamp``."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .options(**options)
    )
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load().select("topic", F.col("value").cast("string").alias("value"), "timestamp")


def watch_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def union_topics(streams: dict[str, DataFrame]) -> DataFrame:
    """Several streams as one, each row with its ``topic``."""
    named = [df.withColumn("topic", F.lit(topic)) for topic, df in streams.items()]
    return reduce(DataFrame.unionByName, named)
