"""Entity operators over token rows and mention rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswire.functions.spans import OUTSIDE
from presswire.functions.segment import grams  # noqa: F401  callers name it as of this module
from presswire.operators.blocks import Phrases, Words, blocked, listed, looked_up, offered, stored, summed, taken
from presswire.operators.keyfilter import phrase_filter
from presswire.operators.lookup import fits_broadcast, keyed_join
from presswire.operators.rows import unnest


def merge_spans(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of equal adjacent tags, from token rows ``(keys, idx, token, ner)``.

    ``keys`` names one sentence. Untagged tokens may be absent: they drop out
    before the one shuffle, and a run is a stretch of consecutive ``idx`` of one
    tag. Same result as ``spans.merge_runs``.
    """
    order = Window.partitionBy(*keys, "ner").orderBy("idx")
    word = F.replace(F.col("token"), F.lit(","), F.lit(""))
    return (
        tokens.filter(F.col("ner") != OUTSIDE)
        .withColumn("_island", F.col("idx") - F.row_number().over(order))
        .groupBy(*keys, "ner", "_island")
        .agg(
            F.min("idx").alias("first"),
            F.max("idx").alias("last"),
            F.array_sort(F.collect_list(F.when(word != "", F.struct("idx", word.alias("w"))))).alias("_words"),
        )
        .withColumn("mention", F.array_join(F.transform("_words", lambda x: x["w"]), " "))
        .filter(F.col("mention") != "")
        .drop("_island", "_words")
    )


def group_mentions(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Mentions of a sentence by type, ``|``-joined in sentence order."""
    return (
        spans.groupBy(*keys, "ner")
        .agg(F.array_sort(F.collect_list(F.struct("first", "mention"))).alias("_m"))
        .select(*keys, "ner", F.array_join(F.transform("_m", lambda x: x["mention"]), "|").alias("mentions"))
    )


def tag_by_gazetteer(
    sentences: DataFrame, gazetteer: DataFrame, keys: list[str], longest: int, **limits: int
) -> DataFrame:
    """Tagged tokens ``(keys, idx, token, ner)`` against a gazetteer table
    ``(language, phrase, ner)`` of any size; tokens without a row are ``O``.

    ``sentences`` holds ``keys``, which name one sentence, ``language`` and ``token``; ``longest``
    is the most words a phrase has. Every block of sentences names its distinct
    1..longest-grams once; a bitmap of the gazetteer's
    phrases lets only grams move that may be among them, and what is found goes back to the block.
    The longest match covering a token wins, then the leftmost.
    """
    on = ["by", "phrase"]
    folded = gazetteer.groupBy(F.col("language").alias("by"), F.lower("phrase").alias("phrase")).agg(F.min("ner").alias("value"))
    known = stored(folded, "gazetteer")
    rows = blocked(sentences, list(dict.fromkeys([*keys, "language"])))
    named = offered(rows, longest, "language", phrase_filter(known, *on))
    small = fits_broadcast(known, **{name: n for name, n in limits.items() if name != "salts"})
    found = named.join(F.broadcast(known) if small else known, on)

    def tags(words: Words, low: Words, entries: pa.Table) -> list[pa.Array]:
        row = Phrases(entries.column("phrase"), longest).cover(low)
        at = np.flatnonzero(row >= 0)
        place = np.arange(len(row)) - np.repeat(np.cumsum(words.sizes) - words.sizes, words.sizes) + 1
        parts = [pa.array(place[at], pa.int32()), words.words.take(pa.array(at)), taken(entries.column("value"), row[at])]
        return [listed(pa.StructArray.from_arrays(parts, ["idx", "token", "ner"]), summed(row >= 0, words.sizes))]

    tagged = looked_up(rows, found, keys, tags, "_tagged array<struct<idx: int, token: string, ner: string>>", "language")
    return tagged.select(*keys, F.inline("_tagged"))


def link_aliases(mentions: DataFrame, keys: list[str]) -> DataFrame:
    """Links each mention of a document to the longest mention of its type that
    ends in it, word by word; ties go to the earliest, then the greatest text.

    ``mentions`` holds ``keys``, ``ner``, ``mention`` and ``position``. Every
    distinct mention offers its word suffixes and the suffixes are grouped: no
    pairs of mentions are formed, and one grouping answers both sides.
    """
    words = F.split("mention", " ")
    distinct = mentions.groupBy(*keys, "ner", "mention").agg(F.min("position").alias("position"))
    rank = F.struct(F.length("mention").alias("n"), (-F.col("position")).alias("early"), "mention")
    endings = F.transform(
        F.sequence(F.lit(1), F.size(words)),
        lambda i: F.array_join(F.slice(words, i, F.size(words)), " "),
    )
    suffixes = unnest(
        distinct.withColumn("rank", rank), [*keys, "ner", "mention", "rank"], endings, "suffix", "cut"
    )
    return (
        suffixes.groupBy(*keys, "ner", "suffix")
        .agg(F.max_by("mention", "rank").alias("canonical"), F.min("cut").alias("cut"))
        .filter(F.col("cut") == 1)
        .select(*keys, "ner", F.col("suffix").alias("mention"), "canonical")
    )


def count_relations(pairs: DataFrame) -> DataFrame:
    """How often two types meet around a connector, from ``neighbour_pairs`` rows."""
    return pairs.groupBy("type1", "connector", "type2").agg(F.count(F.lit(1)).alias("n"))


def casing_model(tokens: DataFrame, token: str = "token") -> DataFrame:
    """Most frequent casing per lower-case word; ties go to the greatest string.

    ``casings`` tells how many a word has. On the corpus the model was made from,
    words with one casing need no entry.
    """
    counts = tokens.groupBy(F.lower(token).alias("word"), F.col(token).alias("cased")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.groupBy("word").agg(
        F.max_by("cased", F.struct("n", "cased")).alias("cased"),
        F.max("n").alias("n"),
        F.count(F.lit(1)).alias("casings"),
    )


def truecase(tokens: DataFrame, model: DataFrame, spread: list[str], token: str = "token", **limits: int) -> DataFrame:
    """Adds ``truecase``, the usual casing of each token."""
    keyed = tokens.withColumn("word", F.lower(token))
    return (
        keyed_join(keyed, model.select("word", "cased"), ["word"], "left", spread, **limits)
        .withColumn("truecase", F.coalesce("cased", F.col(token)))
        .drop("word", "cased")
    )


def truecase_changes(rows: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, n_tokens, n_changed)`` of every sentence: its tokens, and those not in their usual casing.

    ``rows`` are made by ``blocks.blocked``. The casings of a block's words come to the
    block: a frequent word is one row a block of the join, however large the model is.
    """
    cased = model.select(F.col("word").alias("phrase"), F.col("cased").alias("value"))
    found = offered(rows).join(cased, "phrase")

    def count(words: Words, low: Words, entries: pa.Table) -> list[pa.Array]:
        _, row = Phrases(entries.column("phrase"), 1).words(low)
        other = pc.fill_null(pc.not_equal(taken(entries.column("value"), row), words.words), True).to_numpy(zero_copy_only=False)
        return [pa.array(words.sizes, pa.int32()), pa.array(summed((row >= 0) & other, words.sizes), pa.int32())]

    return looked_up(rows, found, keys, count, "n_tokens int, n_changed int")
