"""Messages out: JSON values to a topic or to files, and console previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from presswire.operators.assemble import to_json_rows


def publish(df: DataFrame, fmt: str = "kafka", path: str | None = None, key: str | None = None, mode: str = "append", **options: str) -> None:
    """Batch publication; ``fmt`` is ``kafka`` (option ``topic``) or ``text`` with a path."""
    writer = to_json_rows(df, key).write.format(fmt).options(**options)
    if path:
        writer.mode(mode).save(path)
    else:
        writer.save()


def publish_stream(df: DataFrame, fmt: str = "kafka", path: str | None = None, key: str | None = None, **options: str) -> DataStreamWriter:
    """Streaming publication, to be started by ``streaming.run``."""
    writer = to_json_rows(df, key).writeStream.format(fmt).options(**options).outputMode("append")
    return writer.option("path", path) if path else writer


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """First rows of a result."""
    return df.limit(rows)


def preview_stream(df: DataFrame, rows: int = 10, mode: str = "append") -> DataStreamWriter:
    """First rows of every micro-batch on the console."""
    return df.writeStream.format("console").option("numRows", str(rows)).outputMode(mode)
