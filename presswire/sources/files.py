"""Text, tagged, XML and JSON record files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswire.functions.text import jtrim
from presswire.operators.docparse import DOC_XML_SCHEMA


def lines_from(spark: SparkSession, values: Iterable[str]) -> DataFrame:
    """A small in-memory list as lines."""
    return spark.createDataFrame([(v,) for v in values], "value string")


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    recursive: bool = False,
    min_partitions: int | None = None,
) -> DataFrame:
    """``value`` per line, with ``file_path``. Splits follow
    ``spark.sql.files.maxPartitionBytes``; ``min_partitions`` only adds a
    shuffle when the scan has fewer."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("file_path"))
    return at_least(lines, min_partitions) if min_partitions else lines


def at_least(df: DataFrame, partitions: int) -> DataFrame:
    """Spread a scan of few splits before costly column work; a scan that already
    has enough splits is left as it is, without a shuffle."""
    return df if df.rdd.getNumPartitions() >= partitions else df.repartition(partitions)


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Files below a folder (never directories): path, length, modification time."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def first_file(listing: DataFrame) -> DataFrame:
    """The first file by path."""
    return listing.orderBy("path").limit(1)


def read_tagged(spark: SparkSession, path: str | list[str], begin: str, end: str) -> DataFrame:
    """Records cut on a begin and an end tag, one per row, in ``value``.

    The end tag is the record separator, so one huge file still splits over
    many tasks. Text before the begin tag goes; a record without one is dropped.
    """
    raw = spark.read.option("lineSep", end).text(path)
    at = F.instr("value", begin)
    return raw.filter(at > 0).select(
        F.concat(F.col("value").substr(at, F.length("value")), F.lit(end)).alias("value"),
        F.col("_metadata.file_path").alias("file_path"),
    )


def read_doc_xml(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Corpus files holding many ``<DOC>`` elements: one raw element per row."""
    return read_tagged(spark, path, "<DOC ", "</DOC>")


def read_doc_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The same through the built-in XML source, already typed."""
    return (
        spark.read.format("xml")
        .option("rowTag", "DOC")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .schema(DOC_XML_SCHEMA)
        .load(path)
    )


def json_documents(df: DataFrame, column: str = "value") -> DataFrame:
    """Documents given as JSON, with the language that routes them."""
    schema = (
        "doc_id string, type string, head_line string, date_line string, "
        "language string, text string"
    )
    parsed = F.from_json(column, schema)
    others = [c for c in df.columns if c != column]
    return (
        df.select(*others, column, parsed.alias("_j"))
        .select(*others, column, "_j.*")
        .withColumn(
            "reason",
            F.when(F.coalesce(F.col("doc_id"), F.lit("")) == "", "no_id")
            .when(F.col("text").isNull(), "no_text")
            .when(~F.coalesce(F.col("language").isin("ENG", "ESP", "ARA"), F.lit(False)), "bad_lang"),
        )
        .withColumnRenamed("text", "body")
    )


def user_records(df: DataFrame, column: str = "value") -> DataFrame:
    """XML user records as typed columns; a bad number becomes null."""
    parsed = F.from_xml(F.col(column), "account string, name string, number string")
    return df.select(parsed.alias("_u")).select(
        jtrim("_u.account").alias("account"),
        jtrim("_u.name").alias("name"),
        F.col("_u.number").try_cast("int").alias("number"),
    )
