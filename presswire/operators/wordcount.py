"""Word counts: batch, per micro-batch, per event-time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswire.functions.text import jsplit
from presswire.operators.rows import unnest


def words(df: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    return unnest(df, list(keep), jsplit(column), "word").drop("_pos")


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """Counts per word; partial counts are made before the shuffle, so frequent
    words send one row per task."""
    return words(df, column).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def count_as_text(counts: DataFrame) -> DataFrame:
    """The stored form: count as a string."""
    return counts.select("word", F.col("count").cast("string").alias("count"))


def top_words(counts: DataFrame, n: int = 10) -> DataFrame:
    return counts.orderBy(F.desc("count"), "word").limit(n)


def windowed_word_count(
    df: DataFrame, column: str, ts: str, window: str = "30 seconds", lateness: str | None = None
) -> DataFrame:
    """Counts per tumbling event-time window; ``lateness`` sets the stream's watermark."""
    if lateness:
        df = df.withWatermark(ts, lateness)
    return (
        words(df, column, keep=(ts,))
        .groupBy(F.window(ts, window), "word")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("window.start").alias("window_start"), "word", "count")
    )
