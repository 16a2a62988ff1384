"""Token counts by a unigram vocabulary without building the tokens.

A text is cut before every run of spaces, where no piece of the vocabulary can
cross. An Aho-Corasick automaton lists the pieces that end at each character of a
new word; a pass over the ends carries the best score and its number of pieces. A
later candidate must be better than the kept one, so on a tie the piece that begins
first stays, as in the unigram tokenizers themselves; a character that no piece
covers costs ten less than the least score and counts as its UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswire.llm.common import table, text_slices, texts_of

SPACE = "▁"
PENALTY = 10.0
KEPT = 600_000  # words a worker remembers; a cache, it changes no result
TURN = 4 << 20
_WORD = re.compile(" *[^ \n]+| +|\n")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def pieces(path: str) -> list[tuple[str, float]]:
    """Ordinary pieces of a vocabulary file and their scores."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    odd = (model.is_control, model.is_unknown, model.is_unused, model.is_byte)
    return [(model.id_to_piece(k), model.get_score(k)) for k in range(model.vocab_size()) if not any(f(k) for f in odd)]


class Counter:
    """Piece counts of texts by one vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        self.trie = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if SPACE in piece.lstrip(SPACE) or "\n" in piece:
                raise ValueError(f"piece {piece!r} crosses words")
            self.trie.add_word(piece, (len(piece), float(score)))
        self.trie.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - PENALTY
        self.memo: dict[str, tuple[int, float]] = {}

    def best(self, word: str) -> tuple[int, float]:
        """Number of pieces of the best segmentation, and its score."""
        n = len(word)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, found in self.trie.iter(word):
            ends[end].append(found)
        for e in range(n):
            best, kept, single = None, 0, False
            for size, s in sorted(ends[e], reverse=True):  # the longest begins first
                single |= size == 1
                c = score[e + 1 - size] + s
                if best is None or c > best:
                    best, kept = c, count[e + 1 - size] + 1
            if not single:
                c = score[e] + self.unknown
                if best is None or c > best:
                    best, kept = c, count[e] + len(word[e].encode("utf-8", "replace"))
            score[e + 1], count[e + 1] = best, kept
        return count[n], score[n]

    def words(self, text: str) -> list[str]:
        """Parts of a text that are segmented apart; a space stands before the text."""
        if not text:
            return []
        if "  " not in text and "\n" not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        # A part written with its spaces; a single one before a word is left out.
        return [p[1:] if p[0] == " " and p[1:2] not in ("", " ") else "\n" + p for p in _WORD.findall(" " + text)]

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self.words(t) for t in texts]
        new = {w for c in cut for w in c}.difference(self.memo)
        if len(self.memo) + len(new) > KEPT:
            self.memo.clear()
            new = {w for c in cut for w in c}
        for w in new:
            # "\n" marks a part that does not begin with just one space.
            self.memo[w] = self.best((w[1:] if w[0] == "\n" else " " + w).replace(" ", SPACE))
        found = [[self.memo[w] for w in c] for c in cut]
        return np.array([sum(n for n, _ in f) for f in found], dtype=np.int64), np.array([sum(s for _, s in f) for f in found], dtype=np.float64)


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(pieces(path))


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``docs`` plus n_tokens and score, counted over whole texts.

    Null and empty texts have no token and score 0. Equal texts count alike; columns
    of the new names are replaced, others pass through.
    """
    path = vocabulary or default_vocabulary()
    docs = docs.drop("n_tokens", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = counter(path)
        for batch in text_slices(batches, TURN):
            n, score = by.count(texts_of(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n), pa.array(score)], [*batch.schema.names, "n_tokens", "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())]))


def op8_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all ``documents``."""
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", F.col("score"))
