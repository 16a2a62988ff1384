"""Sentence and token arrays of a text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswire.functions.arabic import escape_brackets, normalize_arabic
from presswire.functions.text import col, jtrim_element

# Fixed values.
SENTENCE_END = r"([.!?][\"')\]]*)\s+"
MARK = "\u0001"
TOKEN = r"[\p{L}\p{N}]+(?:['.,-][\p{L}\p{N}]+)*|[^\s\p{L}\p{N}]"


def _trimmed(pieces: Column) -> Column:
    return F.filter(F.transform(pieces, jtrim_element), lambda s: s != "")


def segment(c: Column | str) -> Column:
    """Sentences end at ``.``, ``!`` or ``?`` followed by white space, so ``2.5`` holds."""
    return _trimmed(F.split(F.regexp_replace(col(c), SENTENCE_END, "$1" + MARK), MARK, -1))


def segment_periods(c: Column | str) -> Column:
    """Cut at every period (the Arabic route)."""
    return _trimmed(F.split(col(c), "[.]", -1))


def sentences_of(c: Column | str, language: Column) -> Column:
    return F.when(language == "ARA", segment_periods(c)).otherwise(segment(c))


def tokenize(c: Column | str) -> Column:
    return F.regexp_extract_all(col(c), F.lit(TOKEN), F.lit(0))


def tokenize_arabic(c: Column | str) -> Column:
    return escape_brackets(tokenize(normalize_arabic(c)))


def tokens_of(c: Column | str, language: Column) -> Column:
    return F.when(language == "ARA", tokenize_arabic(c)).otherwise(tokenize(c))


def grams(tokens: Column, longest: int) -> Column:
    """Runs of 1 to ``longest`` neighbouring tokens as ``array<struct<at, k, text>>``; ``at`` counts from 1."""

    def of_size(k: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1)))
        whole = F.slice(starts, F.lit(1), F.greatest(F.size(tokens) - k + 1, F.lit(0)))
        return F.transform(
            whole, lambda at: F.struct(at.alias("at"), k.alias("k"), F.array_join(F.slice(tokens, at, k), " ").alias("text"))
        )

    return F.flatten(F.transform(F.sequence(F.lit(1), F.lit(longest)), of_size))
