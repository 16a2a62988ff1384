"""Lexicons of any size for the annotation: cards brought to blocks of documents.

Documents are stored with the words of their sentences, in blocks of consecutive rows (``blocks``). Each
block names its distinct words (and phrases, if a gazetteer is read) once; those a bitmap says may be known are
joined to the cards, which are partitioned by their key, and what is found
goes back to the block. There all words of the block are looked up at once, by array operations; phrases are
found by the numbers of their words, so a word that starts many costs no more than another. A frequent word costs one row a
block, whatever its count; a phrase comes along only where it occurs. Columns of the documents that the
caller does not need are best dropped before: all are stored and shuffled once.

This takes shuffles, so a stream annotates batch by batch.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswire.functions.segment import sentences_of, tokens_of
from presswire.functions.spans import OUTSIDE
from presswire.operators.assemble import Found
from presswire.operators.blocks import BLOCK_BYTES, Phrases, Words, listed, looked_up, numbered, offered, taken
from presswire.operators.keyfilter import phrase_filter
from presswire.session import scratch_path

VALUES_OF = {"phrases": "tag"}  # the column that gives a field of a card, if it has another name
VALUES = {"lemma": "string", "pos": "string", "weight": "int", "tag": "string"}


def card_table(lemma: DataFrame | None, pos: DataFrame | None, gazetteer: DataFrame | None, polarity: DataFrame | None) -> DataFrame:
    """``(language, key, lemma, pos, weight, tag)``, one row a word or phrase; of several values the least is kept."""
    sources = {"lemma": lemma, "pos": pos, "weight": polarity, "tag": gazetteer}
    parts = []
    for name, frame in sources.items():
        if frame is not None:
            language, key, value = (F.col(c) for c in frame.columns[:3])
            values = [(value.cast(kind) if v == name else F.lit(None).cast(kind)).alias(v) for v, kind in VALUES.items()]
            parts.append(frame.select(language.alias("language"), F.lower(key).alias("key"), *values))
    if not parts:
        raise ValueError("no lexicon is given")
    return reduce(DataFrame.unionAll, parts).groupBy("language", "key").agg(*[F.min(v).alias(v) for v in VALUES])


class TableResources:
    """Lexicons as tables ``(language, word or phrase, value)``, for ``annotate_documents`` in place of ``Resources``.

    The cards are folded once, when this is made, and stored below the session's
    shared folder; every batch reads them from there. A block has about ``block_bytes`` of text;
    ``blocks`` is the most there may be, else any number.
    """

    def __init__(
        self,
        lemma: DataFrame | None = None,
        pos: DataFrame | None = None,
        gazetteer: DataFrame | None = None,
        polarity: DataFrame | None = None,
        rules: Iterable[tuple[str, str]] = (),
        blocks: int | None = None,
        slots: int | None = None,  # noqa: ARG002  of the former arrays of slots; kept for its callers
        block_bytes: int = BLOCK_BYTES,
    ):
        self.rules = tuple(rules)
        self.blocks, self.block_bytes = blocks, block_bytes
        folded = card_table(lemma, pos, gazetteer, polarity)
        spark = folded.sparkSession
        path = scratch_path(spark, "cards")
        folded.write.parquet(path)
        self.table = spark.read.schema(folded.schema).parquet(path)
        words = F.when(F.col("tag").isNotNull(), F.size(F.split("key", " ")))
        self.longest = self.table.agg(F.max(words)).first()[0] or 1
        self.filter = phrase_filter(self.table, "language", "key")

    def attach(self, df: DataFrame, fields: tuple[str, ...], body: str) -> tuple[DataFrame, Found]:
        """``df``, stored, with what its block knows of its words; and how a sentence reads it."""
        if df.isStreaming:
            raise ValueError("lexicon tables are joined batch by batch: use store_messages or foreachBatch")
        longest = self.longest if "phrases" in fields else 1
        language = F.col("language")
        text = F.array_join(F.transform(sentences_of(body, language), lambda s: F.array_join(tokens_of(s, language), " ")), "\n")
        rows = numbered(df.withColumn("_text", text), self.block_bytes)
        if self.blocks is not None:
            rows = rows.withColumn("_block", F.pmod("_block", F.lit(self.blocks)))
        given = [VALUES_OF.get(f, f) for f in fields]
        known = self.table.filter(F.coalesce(*[F.col(v).cast("string") for v in given]).isNotNull())
        asked = offered(rows, longest, "language", self.filter).select("_block", F.col("by").alias("language"), F.col("phrase").alias("key"))
        found = asked.join(known.select("language", "key", *given), ["language", "key"])
        found = found.select("_block", F.col("language").alias("by"), F.col("key").alias("phrase"), *given)

        def cards(words: Words, low: Words, entries: pa.Table) -> list[pa.Array]:
            _, row = Phrases(entries.column("phrase"), 1).words(low)
            per_line = {"token": listed(words.words, words.sizes)}
            if "lemma" in given:
                per_line["lemma"] = listed(pc.coalesce(taken(entries.column("lemma"), row), low.words), words.sizes)
            if "pos" in given:
                per_line["pos"] = listed(taken(entries.column("pos"), row), words.sizes)
            if "weight" in given:
                weight = pc.fill_null(taken(entries.column("weight"), row), 0).to_numpy(zero_copy_only=False)
                per_line["weight"] = listed(pa.array(weight, pa.int32()), words.sizes)
            if "tag" in given:
                tagged = entries.filter(pc.is_valid(entries.column("tag")))
                marks = taken(tagged.column("tag"), Phrases(tagged.column("phrase"), longest).cover(low))
                per_line["tag"] = listed(pc.fill_null(marks, OUTSIDE), words.sizes)
            return [listed(pa.StructArray.from_arrays([per_line[f] for f in ("token", *given)], ["token", *given]), words.lines)]

        shape = ", ".join(f"{f}: array<{VALUES.get(f, 'string')}>" for f in ("token", *given))
        held = looked_up(rows, found, df.columns, cards, f"_cards array<struct<{shape}>>", "language")
        return held, Found(
            tokens=lambda sentence, language, number: F.get(F.col("_cards"), number - 1)["token"],
            cards=lambda tokens, language, number: F.get(F.col("_cards"), number - 1),
            lemmas=lambda tokens, cards: cards["lemma"],
            field=lambda cards, name: cards[name],
            marks=lambda tokens, cards: cards["tag"],
        )
