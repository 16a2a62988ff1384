"""Start, drain and await streaming queries; stateless document streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from presswire.operators.assemble import Resources, annotate_documents, to_documents
from presswire.operators.docparse import PARSED, accepted, dead_letters, envelope, nonblank, parse_docs, split_docs
from presswire.operators.tables import TableResources
from presswire.operators.wordcount import windowed_word_count, word_count
from presswire.sinks.publish import publish
from presswire.sinks.store import DEFAULT_RUN, append_batch

# Fixed values.
ANNOTATE_INTERVAL = "300 seconds"
WORD_COUNT_INTERVAL = "30 seconds"


def start(writer: DataStreamWriter, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Start with a checkpoint; without an interval, drain what is there and stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def wait(query: StreamingQuery, timeout: int | None = None) -> bool:
    """Run until stopped, or for ``timeout`` seconds; true when it ended."""
    if timeout is None:
        query.awaitTermination()
        return True
    return query.awaitTermination(timeout)


def per_batch(
    df: DataFrame, write: Callable[[DataFrame, int], None], mode: str = "append"
) -> DataStreamWriter:
    """Arbitrary code per micro-batch."""
    return df.writeStream.outputMode(mode).foreachBatch(write)


def parse_messages(messages: DataFrame, language: str = "ENG") -> DataFrame:
    """Every document of every message, parsed; a message may hold several, and an
    id is not asked for."""
    return parse_docs(split_docs(envelope(nonblank(messages))), language, require_id=False)


def _split_batches(
    messages: DataFrame,
    res: Resources | TableResources,
    keep_good: Callable[[DataFrame, int], None],
    failed: str,
    run: str,
    language: str,
    spread: Callable[[DataFrame], DataFrame],
) -> DataStreamWriter:
    """Each batch parsed once: annotated documents go to ``keep_good``, dead letters to ``failed``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        whole = parse_messages(spread(batch), language)
        # What is kept of a batch holds its text once: the body of a good document, the record of another.
        raw = F.when(F.col("reason").isNotNull(), F.col("value")).alias("value")
        parsed = whole.select("mongo_id", "doc_pos", raw, *[c for c in PARSED if c != "paragraphs"]).persist()
        try:
            keep_good(to_documents(annotate_documents(accepted(parsed), res, "fast"), keep=("mongo_id", "doc_pos")), batch_id)
            letters = dead_letters(parsed.withColumn("value", F.struct("mongo_id", "value")))
            append_batch(letters.select("raw.mongo_id", "reason", F.col("raw.value").alias("raw")), failed, batch_id, run)
        finally:
            parsed.unpersist()

    return per_batch(messages, write)


def _as_it_is(batch: DataFrame) -> DataFrame:
    return batch


def store_messages(
    messages: DataFrame,
    res: Resources | TableResources,
    path: str,
    failed: str,
    run: str = DEFAULT_RUN,
    language: str = "ENG",
    spread: Callable[[DataFrame], DataFrame] = _as_it_is,
) -> DataStreamWriter:
    """Annotated documents to ``path`` and dead letters with their reason to ``failed``,
    both of the same parsed batch and below the same run and batch."""
    return _split_batches(messages, res, lambda good, n: append_batch(good, path, n, run), failed, run, language, spread)


def publish_messages(
    messages: DataFrame,
    res: Resources | TableResources,
    failed: str,
    fmt: str = "kafka",
    path: str | None = None,
    run: str = DEFAULT_RUN,
    language: str = "ENG",
    spread: Callable[[DataFrame], DataFrame] = _as_it_is,
    **options: str,
) -> DataStreamWriter:
    """Annotated documents as JSON to a topic, or to files below ``path``, and dead letters
    with their reason to ``failed``.

    A replayed batch rewrites its own files; a topic gets its documents again.
    """

    def send(good: DataFrame, batch_id: int) -> None:
        target = f"{path}/run={run}/batch_id={batch_id}" if path else None
        publish(good.drop("doc_pos"), fmt, target, mode="overwrite", **options)

    return _split_batches(messages, res, send, failed, run, language, spread)


def annotate_stream(
    messages: DataFrame, res: Resources, language: str = "ENG", parser: str = "fast", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Envelope, parse, annotate: message rows to document rows with ``mongo_id``.

    Stateless column work, so the same function serves batches. Failed rows are
    left to ``store_messages`` and ``publish_messages``, which keep them.
    """
    parsed = accepted(parse_messages(messages, language))
    return to_documents(annotate_documents(parsed, res, parser), keep=("mongo_id", *keep))


def window_count_per_batch(
    df: DataFrame, path: str, column: str, ts: str, window: str = "30 seconds", run: str = DEFAULT_RUN
) -> DataStreamWriter:
    """Partial counts per event-time window of each micro-batch; ``window_totals`` adds
    them up. No row comes too late, and nothing is held as state."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(windowed_word_count(batch, column, ts, window), path, batch_id, run)

    return per_batch(df, write)


def window_totals(partials: DataFrame) -> DataFrame:
    return partials.groupBy("window_start", "word").agg(F.sum("count").alias("count"))


def word_count_per_batch(df: DataFrame, path: str, column: str = "value", run: str = DEFAULT_RUN) -> DataStreamWriter:
    """Word counts of each micro-batch on its own, nothing carried over; replay-safe."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(word_count(batch, column), path, batch_id, run)

    return per_batch(df, write)
