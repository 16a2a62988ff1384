"""End-to-end jobs, composed from the operators."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from presswire.operators.assemble import Resources, annotate_documents, to_documents
from presswire.operators.docparse import (
    accepted,
    dead_letters,
    nonblank,
    parse_docs,
    parse_docs_xml,
    split_docs,
)
from presswire.operators.planner import Wanted
from presswire.operators.tables import TableResources
from presswire.operators.wordcount import count_as_text, word_count
from presswire.session import scratch_path
from presswire.sinks.store import append, latest, upsert_batch
from presswire.sources.files import read_doc_xml, read_lines
from presswire.streaming.run import ANNOTATE_INTERVAL, publish_messages, start


def metrics(parsed: DataFrame) -> tuple[DataFrame, Observation]:
    """Counts good, dropped and failed rows while the job runs, without a second pass."""
    seen = Observation()
    dropped = F.col("reason").isin("blank", "not_story")
    return (
        parsed.observe(
            seen,
            F.count(F.lit(1)).alias("records"),
            F.count_if(F.col("reason").isNull()).alias("good"),
            F.count_if(dropped).alias("dropped"),
            F.count_if(F.col("reason").isNotNull() & ~dropped).alias("failed"),
        ),
        seen,
    )


def annotate_corpus(
    spark: SparkSession,
    source: str,
    target: str,
    res: Resources | TableResources,
    language: str = "ENG",
    parser: str = "fast",
    failures: str | None = None,
    require_id: bool = False,
    wanted: Wanted | None = None,
) -> dict[str, float]:
    """Lines of ``<DOC>`` records to annotated documents appended at ``target``.

    One narrow stage from scan to write. With ``failures`` the records are parsed into a
    scratch table first, once for both: documents, and failed records with their reason. A
    document without id keeps an empty one, unless an id is required.
    """
    began = time.monotonic()
    parsed, seen = metrics(parse_docs(split_docs(nonblank(read_lines(spark, source))), language, require_id=require_id))
    if failures:
        path = scratch_path(spark, "parsed")
        parsed.write.parquet(path)
        parsed = spark.read.parquet(path)
        append(dead_letters(parsed), failures)
    append(to_documents(annotate_documents(accepted(parsed), res, parser, wanted=wanted)), target)
    return {**seen.get, "seconds": time.monotonic() - began}


def count_words(spark: SparkSession, source: str, target: str) -> None:
    append(count_as_text(word_count(read_lines(spark, source))), target)


def upsert_corpus(
    spark: SparkSession,
    source: str,
    store: str,
    batch_id: int,
    res: Resources,
    language: str = "ENG",
    parser: str = "default",
) -> DataFrame:
    """XML corpus files into the keyed store; returns the latest view.

    ``seq`` follows file and position, so a later copy of a document wins.
    """
    docs = parse_docs_xml(read_doc_xml(spark, source), language)
    rows = to_documents(annotate_documents(accepted(docs), res, parser), keep=("file_path",))
    upsert_batch(
        rows.withColumn("seq", F.struct("file_path", F.monotonically_increasing_id())).drop("file_path"),
        store,
        batch_id,
    )
    return latest(spark, store)


def annotate_messages(
    messages: DataFrame,
    checkpoint: str,
    res: Resources | TableResources,
    language: str = "ENG",
    fmt: str = "kafka",
    interval: str | None = ANNOTATE_INTERVAL,
    path: str | None = None,
    failures: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Message stream to JSON documents on an output topic; messages that fail are stored
    with their reason at ``failures``, or beside the checkpoint."""
    writer = publish_messages(messages, res, failures or f"{checkpoint}-failed", fmt, path, language=language, **options)
    return start(writer, checkpoint, interval)
