"""Sentence rows and token rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswire.functions.segment import sentences_of, tokens_of
from presswire.operators.rows import unnest

MAX_PARSE_TOKENS = 140  # fixed value: longest sentence the parser column accepts


def with_record_id(df: DataFrame) -> DataFrame:
    """Adds ``rec_id``, unique per record: the identity to group rows of one document
    by, since copies may repeat a ``doc_id``. Use it straight on a file scan, whose
    row order is fixed, so that a task run again gives the same numbers."""
    return df.withColumn("rec_id", F.monotonically_increasing_id())


def _language(df: DataFrame, language: Column | str | None) -> Column:
    if language is None:
        return F.col("language")
    return F.lit(language) if isinstance(language, str) else language


def explode_sentences(
    df: DataFrame, keys: list[str], body: str = "body", language: Column | str | None = None
) -> DataFrame:
    """One row per non-empty sentence, ``sentence_id`` from 1; no shuffle."""
    pieces = sentences_of(body, _language(df, language))
    return unnest(df, keys, pieces, "sentence", "sentence_id")


def first_sentences(
    df: DataFrame, keys: list[str], body: str = "body", language: Column | str | None = None
) -> DataFrame:
    return df.select(
        *keys, F.get(sentences_of(body, _language(df, language)), F.lit(0)).alias("sentence")
    )


def with_tokens(df: DataFrame, language: Column | str | None = None) -> DataFrame:
    """Adds the ``token`` array of ``sentence``."""
    return df.withColumn("token", tokens_of("sentence", _language(df, language)))


def explode_tokens(df: DataFrame, keys: list[str], arrays: tuple[str, ...] = ("token",)) -> DataFrame:
    """Token rows of parallel arrays, ``idx`` from 1."""
    if len(arrays) == 1:
        return unnest(df, keys, arrays[0], arrays[0], "idx")
    rows = unnest(df, keys, F.arrays_zip(*arrays), "_z", "idx")
    return rows.select(*keys, "idx", *[F.col("_z")[a].alias(a) for a in arrays])


def mark_long(df: DataFrame, limit: int = MAX_PARSE_TOKENS) -> DataFrame:
    """Flags sentences over the parser's limit; they keep their row."""
    return df.withColumn("too_long", F.size("token") > limit)
