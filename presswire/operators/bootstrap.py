"""Relations learned from a few known pairs: patterns from pairs, pairs from patterns, in rounds.

A pattern is what stands between two mentions, with their types. It is trusted as far as the
pairs it joins are known already; a pair is believed as far as the patterns that join it
are trusted. Each round is two joins and two aggregations over the distinct facts of the corpus,
and its pairs are written down before the next begins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswire.operators.lookup import keyed_join
from presswire.session import scratch_path

PATTERN = ["type1", "connector", "type2"]
PAIR = ["mention1", "mention2"]


def pair_facts(pairs: DataFrame) -> DataFrame:
    """Distinct ``(type1, connector, type2, mention1, mention2)`` with how often each occurs, from ``neighbour_pairs`` rows."""
    return pairs.groupBy(*PATTERN, *PAIR).agg(F.count(F.lit(1)).alias("n"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def score_patterns(facts: DataFrame, known: DataFrame, support: int, trust: float) -> DataFrame:
    """``(*PATTERN, known, pairs, confidence)`` of the patterns to trust: the share of their pairs that is known."""
    marked = keyed_join(facts, known.select(*PAIR, F.lit(1).alias("_k")), PAIR, "left")
    counts = marked.groupBy(*PATTERN).agg(F.count("_k").alias("known"), F.count(F.lit(1)).alias("pairs"))
    scored = counts.withColumn("confidence", F.col("known") / F.col("pairs"))
    return scored.filter((F.col("known") >= support) & (F.col("confidence") >= trust))


def score_pairs(facts: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(*PAIR, score)``: one less the chance that every trusted pattern that joins the pair errs."""
    met = keyed_join(facts.select(*PATTERN, *PAIR), patterns.select(*PATTERN, "confidence"), PATTERN, "inner")
    return met.groupBy(*PAIR).agg((1 - F.product(1 - F.col("confidence"))).alias("score"))


def bootstrap(
    facts: DataFrame, seeds: DataFrame, rounds: int = 2, support: int = 2, trust: float = 0.5, belief: float = 0.75
) -> tuple[DataFrame, DataFrame]:
    """Patterns of the last round, and pairs ``(*PAIR, score, round)``.

    ``seeds`` are ``PAIR`` rows and stay believed, with score 1 and round 0; ``round`` is the
    first in which a pair was believed, ``score`` that of the last. Rounds end early when one
    adds no pair. ``facts`` is read twice a round: hand in a stored table.
    """
    known = _stored(seeds.select(*PAIR).distinct().select(*PAIR, F.lit(1.0).alias("score"), F.lit(0).alias("round")), "pairs")
    patterns, size = None, known.count()
    for n in range(1, rounds + 1):
        patterns = _stored(score_patterns(facts, known, support, trust), "patterns")
        believed = score_pairs(facts, patterns).filter(F.col("score") >= belief)
        # A pair once believed stays; seeds keep their score.
        both = known.select(*PAIR, "round", F.when(F.col("round") == 0, F.col("score")).alias("fixed"), F.col("score").alias("before"), F.lit(None).cast("double").alias("now")).unionAll(
            believed.select(*PAIR, F.lit(n).alias("round"), F.lit(None).cast("double").alias("fixed"), F.lit(None).cast("double").alias("before"), F.col("score").alias("now"))
        )
        merged = both.groupBy(*PAIR).agg(F.coalesce(F.max("fixed"), F.max("now"), F.max("before")).alias("score"), F.min("round").alias("round"))
        known = _stored(merged.select(*PAIR, "score", "round"), "pairs")
        if (grown := known.count()) == size:
            break
        size = grown
    return patterns, known
