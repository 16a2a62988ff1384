"""Word counts in event-time windows that close, with late rows kept beside them.

The watermark is the latest event time of all earlier batches, less the lateness allowed.
A row whose window has ended by then is late, and goes to a table of its own; all
others add to partial counts. When a batch is in, the windows that the new watermark
has passed are closed: their partial counts are added up and emitted, once. What
each batch decides rests on files of earlier batches alone, so a batch that is run again,
also after a restart, decides the same and rewrites its own partitions.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from presswire.operators.wordcount import windowed_word_count
from presswire.sinks.store import DEFAULT_RUN, append_batch
from presswire.streaming.run import per_batch

PARTIAL, EMITTED, LATE, MARKS = "partial", "emitted", "late", "marks"
_MARK = "mark long"  # microseconds; the watermark once the batch is in
_COUNTS = "window_start timestamp, word string, count long"


def _watermark(spark: SparkSession, path: str, run: str, batch_id: int) -> int | None:
    """The watermark once batch ``batch_id`` was in."""
    try:
        row = spark.read.schema(_MARK).parquet(f"{path}/{MARKS}/run={run}/batch_id={batch_id}").first()
    except AnalysisException:
        return None
    return row["mark"] if row else None


def _end(start: Column, window: str) -> Column:
    return start + F.expr(f"INTERVAL {window}")


def _partials(spark: SparkSession, path: str, run: str) -> DataFrame:
    rows = spark.read.schema(f"{_COUNTS}, ends long, day date, run string, batch_id long").parquet(f"{path}/{PARTIAL}")
    return rows.filter(F.col("run") == run)


def _day(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros)).cast("date")


def count_windows(
    df: DataFrame,
    path: str,
    column: str,
    ts: str,
    window: str = "30 seconds",
    lateness: str = "0 seconds",
    run: str = DEFAULT_RUN,
) -> DataStreamWriter:
    """Counts of the words of ``column`` per event-time window, below ``path``.

    ``emitted`` holds each closed window once, ``late_rows`` the rows that came after their
    window had closed, as they came, and those without a time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _watermark(spark, path, run, batch_id - 1)
        batch = batch.persist()
        try:
            latest = batch.agg(F.unix_micros(F.max(F.col(ts).cast("timestamp")) - F.expr(f"INTERVAL {lateness}"))).first()[0]
            after = max((m for m in (before, latest) if m is not None), default=None)
            start = F.window(F.col(ts).cast("timestamp"), window)["end"]
            timed = batch.filter(F.col(ts).isNotNull()).withColumn("_ends", F.unix_micros(start))
            late = F.lit(False) if before is None else F.col("_ends") <= before
            append_batch(
                timed.filter(late).drop("_ends").withColumn("reason", F.lit("late"))
                .unionAll(batch.filter(F.col(ts).isNull()).withColumn("reason", F.lit("no_time"))),
                f"{path}/{LATE}", batch_id, run,
            )
            counts = windowed_word_count(timed.filter(~late), column, ts, window)
            ends = _end(F.col("window_start"), window)
            partial = counts.select("window_start", "word", "count", F.unix_micros(ends).alias("ends"), ends.cast("date").alias("day"), F.lit(run).alias("run"), F.lit(batch_id).cast("long").alias("batch_id"))
            # By day, so that closing windows reads the days they end on.
            partial.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "run", "batch_id").parquet(f"{path}/{PARTIAL}")
        finally:
            batch.unpersist()
        if after is not None and after != before:
            closed = _between(_partials(spark, path, run), before, after).filter(F.col("batch_id") <= batch_id)
            append_batch(closed.groupBy("window_start", "word").agg(F.sum("count").alias("count")), f"{path}/{EMITTED}", batch_id, run)
        append_batch(spark.createDataFrame([(after,)], _MARK).coalesce(1), f"{path}/{MARKS}", batch_id, run)

    return per_batch(df, write)


def _between(partials: DataFrame, before: int | None, after: int) -> DataFrame:
    """Partial counts of windows that ended after ``before`` and up to ``after``."""
    rows = partials.filter((F.col("day") <= _day(after)) & (F.col("ends") <= after))
    return rows if before is None else rows.filter((F.col("day") >= _day(before)) & (F.col("ends") > before))


def emitted(spark: SparkSession, path: str) -> DataFrame:
    """``(window_start, word, count, run, batch_id)`` of closed windows."""
    return _kept(spark, f"{path}/{EMITTED}", f"{_COUNTS}, run string, batch_id long")


def late_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Late rows with their ``reason``; ``schema`` is that of the stream."""
    return _kept(spark, f"{path}/{LATE}", f"{schema}, reason string, run string, batch_id long")


def _kept(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException:  # nothing was written yet
        return spark.createDataFrame([], schema)


def open_windows(spark: SparkSession, path: str, run: str = DEFAULT_RUN) -> DataFrame:
    """Counts so far of the windows that have not closed."""
    marks = _kept(spark, f"{path}/{MARKS}", f"{_MARK}, run string, batch_id long")
    last = marks.filter(F.col("run") == run).agg(F.max("mark")).first()[0]
    rows = _partials(spark, path, run)
    if last is not None:
        rows = rows.filter((F.col("day") >= _day(last)) & (F.col("ends") > last))
    return rows.groupBy("window_start", "word").agg(F.sum("count").alias("count"))
