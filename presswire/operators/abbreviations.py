"""Abbreviations learned from a corpus, and sentences that do not end at them.

A word type that nearly always carries a period is likely an abbreviation. How likely
is told by a log-likelihood ratio: its counts with and without a period under the
corpus's share of periods, against a share of 99 in 100. Short types and types with inner
periods weigh more, each occurrence without a period weighs against. The counts are one
aggregation over the corpus; the list is small, since long types never reach the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswire.functions.lexicon import InlineLexicon
from presswire.functions.segment import MARK
from presswire.functions.text import col, jtrim_element, let
from presswire.operators.rows import pin
from presswire.session import scratch_path

# The test's share of periods and its limit, and the edges a word loses.
SHARE = 0.99
LIMIT = 0.3
OPENERS = r"""^["'(\[]+"""
CLOSERS = r"""["')\],;:!?]+$"""
TYPE = r"^\p{L}[\p{L}.'-]*$"
CANDIDATE = r"([.!?][\"')\]]*)(\s+)"
LAST_WORD = r"""(?:^|\s)["'(\[]*([^\s"'(\[]\S*)\.$"""


def period_types(df: DataFrame, text: str = "body") -> DataFrame:
    """``(word, dotted, plain)``: how often each lower-case type has a period at its end, and how often none.

    Words are counted as they stand; the patterns run once for each that differs."""
    words = df.select(F.explode(F.split(F.coalesce(text, F.lit("")), r"\s+")).alias("w"))
    counted = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    bare = pin(counted.select(F.regexp_replace(F.regexp_replace("w", OPENERS, ""), CLOSERS, "").alias("w"), "n"), "w")
    ends = F.col("w").endswith(".")
    word = F.lower(F.when(ends, F.left("w", F.length("w") - 1)).otherwise(F.col("w")))
    typed = pin(bare.select(word.alias("word"), ends.alias("ends"), "n"), "word").filter(F.col("word").rlike(TYPE))
    total = lambda of: F.coalesce(F.sum(F.when(of, F.col("n"))), F.lit(0))
    return typed.groupBy("word").agg(total(F.col("ends")).alias("dotted"), total(~F.col("ends")).alias("plain"))


def scores(types: DataFrame, dotted: int, words: int, share: float = SHARE) -> DataFrame:
    """Adds ``score`` to types; ``dotted`` of the corpus's ``words`` carry a period."""
    if not words or dotted in (0, words):
        return types.withColumn("score", F.lit(0.0))
    base = dotted / words

    def likelihood(p: float) -> Column:
        return F.col("dotted") * F.log(F.lit(p)) + F.col("plain") * F.log(F.lit(1 - p))

    ratio = -2.0 * (likelihood(base) - likelihood(share))
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    inner = F.length("word") - letters + 1
    weight = F.exp(-letters.cast("double")) * inner * F.pow(letters.cast("double"), -F.col("plain").cast("double"))
    return types.withColumn("score", ratio * weight)


def learn_abbreviations(df: DataFrame, text: str = "body", limit: float = LIMIT) -> DataFrame:
    """``(word, dotted, plain, score)`` of the types a corpus writes with a period."""
    path = scratch_path(df.sparkSession, "types")
    period_types(df, text).write.parquet(path)  # read twice, for its sums and its rows
    types = df.sparkSession.read.parquet(path)
    dotted, words = types.agg(F.sum("dotted"), F.sum(F.col("dotted") + F.col("plain"))).first()
    return scores(types, dotted or 0, words or 0).filter((F.col("score") >= limit) & (F.col("dotted") > 0))


class Abbreviations:
    """A learned list as a column function; lists of the size of an inline lexicon."""

    def __init__(self, learned: DataFrame):
        self.known = InlineLexicon.from_frame(learned.select(F.lit("").alias("l"), "word", F.lit("a").alias("v")))

    def segment(self, c: Column | str) -> Column:
        """Sentences as ``segment`` gives them, but none ends at the period of a known type."""
        pieces = F.split(F.regexp_replace(col(c), CANDIDATE, "$1" + MARK + "$2"), MARK, -1)

        def closed(piece: Column) -> Column:
            word = F.regexp_extract(piece, LAST_WORD, 1)
            goes_on = F.get(self.known.lookup(F.array(word), F.lit("")), F.lit(0)).isNotNull()
            return F.when(goes_on, piece).otherwise(F.concat(piece, F.lit(MARK)))

        joined = F.array_join(F.transform(pieces, closed), "")
        return let(joined, lambda t: F.filter(F.transform(F.split(t, MARK, -1), jtrim_element), lambda s: s != ""))
