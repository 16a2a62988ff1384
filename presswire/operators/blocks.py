"""Lookups of words and phrases by blocks of texts, so that a frequent word costs one row a block.

Texts (sentences, or whole documents with a line a sentence) are stored once, their tokens joined by
blanks, with the number of their block: consecutive rows of about ``BLOCK_BYTES`` of text. A block names its distinct
words or phrases once; those that are known come back to it, and a task looks its
texts up in its blocks' own tables. What moves is the text, once, and the
distinct phrases of the blocks; no task meets all rows of a word. Words and phrases are numbers
within a block: its texts are taken as arrays, never word by word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from presswire.operators.keyfilter import PhraseFilter, joined_hashes, word_hashes
from presswire.session import scratch_path

BLOCK_BYTES = 4 << 20  # text of a block; a single text may be larger
TASK_BYTES = 16 << 20  # text of the blocks of a task, in the mean


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, each: int = BLOCK_BYTES) -> DataFrame:
    """``rows``, which have their tokens in ``_text``, with ``_block`` and stored.

    Blocks are numbered by task and within it.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n_bytes = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False)
            upto = n_bytes + np.cumsum(sizes, dtype=np.int64)
            if len(batch):
                n_bytes = int(upto[-1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first + upto // each)], [*batch.schema.names, "_block"])

    return stored(rows.mapInArrow(number, StructType([*rows.schema.fields]).add("_block", "long")), "blocked")


def blocked(sentences: DataFrame, keep: list[str], each: int = BLOCK_BYTES) -> DataFrame:
    """``(keep, _text, _block)`` of the sentences ``(keep, token)`` that have tokens, stored.

    Tokens hold no blanks and no line ends.
    """
    rows = sentences.filter(F.size("token") > 0).select(*keep, F.array_join("token", " ").alias("_text"))
    return numbered(rows, each)


def _equal(column: pa.Array | pa.ChunkedArray, value: str | None) -> pa.Array | pa.ChunkedArray:
    return pc.is_null(column) if value is None else pc.equal(column, value)


def _whole(array: pa.Array | pa.ChunkedArray) -> pa.Array:
    return array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array


@dataclass
class Words:
    """The words of texts as one run: how many each line has, and how many lines each text."""

    words: pa.Array
    sizes: np.ndarray
    lines: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array | pa.ChunkedArray) -> Words:
        cut = pc.split_pattern(pc.fill_null(_whole(texts), ""), "\n")
        each = cut.flatten()
        parts = pc.split_pattern(each, " ")
        sizes = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        words = parts.flatten()
        empty = pc.equal(pc.binary_length(each), 0).to_numpy(zero_copy_only=False).astype(bool)
        if empty.any():  # a line without words, not one with an empty word
            words = words.filter(pc.greater(pc.binary_length(words), 0))
            sizes[empty] = 0
        return cls(words, sizes, cut.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))

    @property
    def room(self) -> np.ndarray:
        """Words from each one to the end of its line."""
        return np.repeat(np.cumsum(self.sizes), self.sizes) - np.arange(len(self.words))


def _grams(texts: pa.ChunkedArray, longest: int, by: str | None, known: PhraseFilter | None) -> list[pa.Array]:
    """The distinct runs of up to ``longest`` words of the lines of texts, those that ``known`` admits."""
    found = Words.of(texts)
    coded = found.words.dictionary_encode()
    vocabulary, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(len(vocabulary), 1)
    grams, node = [], code
    # Of each number of words so far: the run's words by their numbers, and its hash.
    runs, own = np.arange(len(vocabulary))[:, None], None
    if known:
        own = word_hashes(vocabulary)
        hashes = joined_hashes(known.starts(by), own)
    room = found.room if longest > 1 else None
    for k in range(1, longest + 1):
        if k > 1:
            at = np.flatnonzero(room >= k)
            pairs = pa.array(node[at] * size + code[at + k - 1]).dictionary_encode()
            head, last = np.divmod(pairs.dictionary.to_numpy(), size)
            runs = np.hstack([runs[head], last[:, None]])
            if known:
                hashes = joined_hashes(hashes[head], own[last])
            node = np.zeros(len(code), dtype=np.int64)
            node[at] = pairs.indices.to_numpy(zero_copy_only=False)
        kept = runs[known.admits(hashes)] if known else runs
        words = [vocabulary.take(pa.array(kept[:, j])) for j in range(k)]
        grams.append(pc.binary_join_element_wise(*words, " ") if k > 1 else words[0])
    return grams


class Phrases:
    """Phrases of up to ``longest`` words, found in runs of words by their words' numbers."""

    def __init__(self, phrases: pa.Array, longest: int):
        phrases = _whole(phrases)
        parts = pc.split_pattern(phrases, " ")
        size = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        self.vocabulary = coded.dictionary
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.cumsum(size) - size
        rows = np.arange(len(phrases))
        self.single = np.full(len(self.vocabulary) + 1, -1, dtype=np.int64)  # a row of each word, the last of the unknown one
        self.single[code[begins[size == 1]]] = rows[size == 1]
        self.levels: list[tuple[pa.Array, np.ndarray]] = []  # the known pairs of the words so far and the next one, and their rows
        node = code[begins] if len(phrases) else begins
        for k in range(2, longest + 1):
            some = size >= k
            rows, begins, size, node = rows[some], begins[some], size[some], node[some]
            pairs = pa.array(node * len(self.vocabulary) + code[begins + k - 1], pa.int64()).dictionary_encode()
            node = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            given = np.full(len(pairs.dictionary), -1, dtype=np.int64)
            given[node[size == k]] = rows[size == k]
            self.levels.append((pairs.dictionary, given))

    def words(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word, -1 for unknown ones, and the row of the phrase that it is, or -1."""
        code = pc.fill_null(pc.index_in(found.words, self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        return code, self.single[code]

    def cover(self, found: Words) -> np.ndarray:
        """The row of the phrase that covers each word, -1 where none does: the longest, of equally long ones the leftmost."""
        code, best = self.words(found)
        best, node, room = best.copy(), code, found.room
        for k, (pairs, given) in enumerate(self.levels, 2):
            at = np.flatnonzero((node >= 0) & (room >= k))
            at = at[code[at + k - 1] >= 0]
            met = pa.array(node[at] * len(self.vocabulary) + code[at + k - 1], pa.int64())
            place = pc.fill_null(pc.index_in(met, pairs), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            node = np.full(len(code), -1, dtype=np.int64)
            node[at] = place
            at, place = at[place >= 0], place[place >= 0]
            row = given[place]
            at, row = at[row >= 0], row[row >= 0]
            for back in range(k):  # of two over one word the one that begins earlier is written last
                best[at + back] = row
        return best


def taken(values: pa.Array | pa.ChunkedArray, rows: np.ndarray) -> pa.Array:
    """The values of rows, null for -1."""
    return _whole(values).take(pa.array(rows, pa.int64(), mask=rows < 0))


def listed(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    """A run of values as lists of these sizes."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def summed(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sums of a run of values over stretches of these sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def offered(rows: DataFrame, longest: int = 1, by: str | None = None, known: PhraseFilter | None = None) -> DataFrame:
    """``(_block, by, phrase)``: the distinct lower-case phrases of up to ``longest`` words of every block, those that ``known`` admits.

    A block that is read by two tasks may name a phrase twice.
    """
    lowered = rows.select("_block", (F.col(by) if by else F.lit("")).alias("by"), F.lower("_text").alias("low"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, met = None, {}

        def emit() -> Iterator[pa.RecordBatch]:
            for value, texts in met.items():
                for grams in _grams(pa.chunked_array(texts), longest, value, known):
                    n = len(grams)
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(block, pa.int64()), n), pa.repeat(pa.scalar(value, pa.string()), n), grams.cast(pa.string())], ["_block", "by", "phrase"])

        for batch in batches:
            blocks = batch.column("_block").to_numpy(zero_copy_only=False)
            borders = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for at, to in zip(borders, borders[1:], strict=False):
                if at == to:
                    continue
                if blocks[at] != block:
                    yield from emit()
                    block, met = int(blocks[at]), {}
                part = batch.slice(at, to - at)
                for value in pc.unique(part.column("by")).to_pylist():
                    met.setdefault(value, []).append(part.column("low").filter(_equal(part.column("by"), value)))
        yield from emit()

    return lowered.mapInArrow(run, "_block bigint, by string, phrase string")


def looked_up(
    rows: DataFrame, found: DataFrame, keep: list[str], value: Callable[[Words, Words, pa.Table], list[pa.Array]], returns: str, by: str | None = None,
) -> DataFrame:
    """``(keep, returns)``: the columns that ``value(words, lower words, known)`` gives for texts of a block and one ``by``.

    ``found`` holds ``(_block, by, phrase, ...)``; ``known`` is what the block has of it.
    """
    n_bytes = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, n_bytes // TASK_BYTES + 1)
    # Lowered behind the shuffle, so that the text moves once.
    left = rows.select("_block", (F.col(by) if by else F.lit("")).alias("_by"), *[F.col(c).alias(f"_kept{n}") for n, c in enumerate(keep)], "_text").repartition(tasks, "_block").withColumn("_low", F.lower("_text"))
    added = StructType.fromDDL(returns)
    kinds = to_arrow_schema(added)
    kept = [f"_kept{n}" for n in range(len(keep))]

    def run(key: tuple, texts: pa.Table, table: pa.Table) -> pa.Table:  # noqa: ARG001
        parts = []
        for b in pc.unique(texts.column("_by")).to_pylist():
            own = texts.filter(_equal(texts.column("_by"), b))
            known = table.filter(pc.equal(table.column("by"), pa.scalar(b, pa.string())))
            columns = value(Words.of(own.column("_text")), Words.of(own.column("_low")), known)
            parts.append(pa.table([*(own.column(c) for c in kept), *(c.cast(f.type) for c, f in zip(columns, kinds, strict=True))], names=[*kept, *kinds.names]))
        return pa.concat_tables(parts) if parts else pa.table([texts.column(c) for c in kept] + [pa.array([], f.type) for f in kinds], names=[*kept, *kinds.names])

    schema = StructType([*left.select(*kept).schema.fields, *added.fields])
    done = left.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(run, schema)
    return done.select(*[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)], *added.names)
