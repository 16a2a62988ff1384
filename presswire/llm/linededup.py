"""Line dedup: hashes in ranges, sorted by document and position, answers as bitmaps.

Every line that is long enough becomes one narrow row: hash, document, position. The
rows are dealt over ranges of (hash, document, position), so that the occurrences of
one line follow each other, the largest document first, and a line that holds a
third of all rows is cut over many tasks. Each task streams through its range and
keeps no more than the documents below the limit of one line. Only the line at the
begin of a range may reach into the one before; a few witnesses a range settle it.
A document gets back the positions it loses as a compressed bitmap; texts do not travel
with the lines.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswire.llm.common import partitions_for, saved, table, text_slices

LEAST_CHARS = 40
LEAST_DOCS = 5
RANGE = 48 << 20  # bytes of line rows in a range
TURN = 4 << 20  # bytes of text rejoined at once
_ROW = 40  # bytes of a line row
_BLANK = "".join(map(chr, (0x20, *range(0x09, 0x0E))))
_UPPER, _LOWER = (bytes(range(a, a + 26)).decode() for a in (ord("A"), ord("a")))
_NO_ID = -(1 << 63)  # stands for a null doc_id

_DROP, _EDGE, _WITNESS = 0, 1, 2
_NAMES = ("h", "c", "id", "mark", "pos")
_TYPES = {"h": pa.int64(), "c": pa.int64(), "id": pa.int64(), "mark": pa.int64(), "pos": pa.int32()}


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(_BLANK))
    plain = F.octet_length(bare) == F.char_length(bare)  # lower() of ASCII text changes A-Z alone
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _keyed(docs: DataFrame) -> DataFrame:
    """Document rows with the id and the hash of the text that name their bitmap."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def line_rows(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``(h, c, id, mark, pos)`` of every line whose key has ``least_chars`` code points; keys are told apart by 96 bits."""
    lines = _keyed(docs).select("id", "mark", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    long = lines.filter(F.char_length(F.btrim("line", F.lit(_BLANK))) >= least_chars).withColumn("key", line_key(F.col("line")))
    return long.select(F.xxhash64("key").alias("h"), F.crc32(F.col("key").cast("binary")).alias("c"), "id", "mark", "pos")


class Stream:
    """One range of line rows, sorted by line, then by document from the largest, then by position.

    ``feed`` takes the next rows and gives those whose fate is known, each with its
    kind: dropped; on the edge, for the line at the begin of the range and for a last
    line with too few documents so far; or a witness of the last line.
    """

    def __init__(self, least_docs: int) -> None:
        self.least = least_docs
        self.begin = True  # the line at hand is the first of the range
        self.held: list[np.ndarray] | None = None
        self.done = np.empty(0, bool)  # held rows that were given out

    def feed(self, rows: list[np.ndarray]) -> list[tuple[int, list[np.ndarray]]]:
        done = np.zeros(len(rows[0]), dtype=bool)
        if self.held is not None:
            rows = [np.concatenate([a, b]) for a, b in zip(self.held, rows, strict=True)]
            done = np.concatenate([self.done, done])
        h, c, ids = rows[:3]
        line = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        first = np.concatenate([[0], np.flatnonzero(line) + 1])
        new_doc = np.concatenate([[True], line | (ids[1:] != ids[:-1])])
        size = np.diff(first, append=len(h))
        n_docs = np.add.reduceat(new_doc.astype(np.int64), first)
        dropped = np.repeat(n_docs >= self.least, size) & (ids != np.repeat(ids[first], size)) & ~done
        last = int(first[-1])
        edge = np.zeros(len(h), dtype=bool)
        if self.begin:  # its documents in the range before are not known here
            stop = int(first[1]) if len(first) > 1 else len(h)
            dropped[:stop] = False
            edge[:stop] = ~done[:stop]
            self.begin = len(first) == 1
        out = [(_DROP, [a[dropped] for a in rows]), (_EDGE, [a[edge] for a in rows])]
        # Of the line that may go on only what later rows need is held.
        if self.begin or n_docs[-1] >= self.least:
            keep = last + np.flatnonzero(new_doc[last:])[: self.least]
            self.done = np.ones(len(keep), dtype=bool)
        else:
            keep = np.arange(last, len(h))
            self.done = done[last:]
        self.held = [a[keep] for a in rows]
        return out

    def finish(self) -> list[tuple[int, list[np.ndarray]]]:
        """What the last line leaves to the next range."""
        if self.held is None or self.begin:
            return []
        return [(_WITNESS, [a[self.done] for a in self.held]), (_EDGE, [a[~self.done] for a in self.held])]


def _streamed(rows: DataFrame, least_docs: int) -> DataFrame:
    """Line rows with their kind, range by range; lines that stay are left out."""
    names = ["kind", *_NAMES]

    def batch_of(kind: int, found: list[np.ndarray]) -> pa.RecordBatch:
        cols = [pa.array(a, t) for a, t in zip(found, _TYPES.values(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(found[0]), kind, np.int32)), *cols], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(least_docs)
        for batch in batches:
            if len(batch):
                for kind, found in stream.feed([batch.column(n).to_numpy() for n in _NAMES]):
                    if len(found[0]):
                        yield batch_of(kind, found)
        for kind, found in stream.finish():
            if len(found[0]):
                yield batch_of(kind, found)

    n = rows.count()
    order = [F.col("h"), F.col("c"), F.col("id").desc(), F.col("pos")]
    ranges = partitions_for(rows.sparkSession, n * _ROW, RANGE)
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "kind int, h long, c long, id long, mark long, pos int")


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``(id, mark, pos)`` of every line to drop; rows that repeat a document repeat its lines."""
    found = saved(_streamed(saved(line_rows(docs, least_chars), "lines"), least_docs), "streamed")
    edges = found.filter(F.col("kind") > _DROP)
    # Two lines a range at most, so small enough to be sent to every task.
    lines = edges.select("h", "c", "id").distinct().groupBy("h", "c").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("top"))
    settled = edges.filter(F.col("kind") == _EDGE).join(F.broadcast(lines.filter(F.col("docs") >= least_docs).drop("docs")), ["h", "c"])
    return found.filter(F.col("kind") == _DROP).select("id", "mark", "pos").union(settled.filter("id <> top").select("id", "mark", "pos"))


def pack_keep(dropped: np.ndarray) -> bytes:
    """A compressed bitmap, one bit a line, set where it stays; lines behind its end stay."""
    keep = np.ones((int(dropped.max()) // 8 + 1) * 8, dtype=bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def unpack_keep(packed: bytes, n_lines: int) -> np.ndarray:
    """Which of ``n_lines`` lines stay."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))[:n_lines].astype(bool)
    return np.concatenate([bits, np.ones(n_lines - len(bits), dtype=bool)])


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``(id, mark, n_dropped, keep)``, one row for each distinct document with a line to drop.

    ``id`` is doc_id, the least long for null; ``mark`` is the xxhash64 of the text.
    Keys of at least ``least_chars`` code points found in ``least_docs`` documents
    lose all lines but those in the largest doc_id. Documents are told apart by doc_id:
    rows that share one count once, and all of them keep the line if it is the largest;
    rows without doc_id count as one document, the smallest. Null text is one empty line;
    an empty table gives no rows; other columns are ignored, whatever their names.
    """
    lost = dropped_lines(docs, least_chars, least_docs).groupBy("id", "mark").agg(F.collect_set("pos").alias("lost"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("lost")
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            parts = [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            keep = pa.array([pack_keep(p) for p in parts], pa.binary())
            sizes = pa.array([len(p) for p in parts], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), sizes, keep], ["id", "mark", "n_dropped", "keep"])

    return lost.mapInArrow(run, "id long, mark long, n_dropped int, keep binary")


def kept_texts(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, text)``: every document with the lines that stay, one row per row of ``docs``.

    Cases are those of ``keep_bitmaps``.
    """
    maps = keep_bitmaps(docs, least_chars, least_docs)
    rows = _keyed(docs).join(maps, ["id", "mark"], "left").select("id", F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), "text", "keep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for batch in text_slices([part], TURN):
                texts = batch.column("text").to_pylist()
                n_lines = [t.count("\n") + 1 for t in texts]
                for k, keep in enumerate(batch.column("keep").to_pylist()):
                    if keep is not None:
                        lines = texts[k].split("\n")
                        texts[k] = "\n".join([lines[i] for i in np.flatnonzero(unpack_keep(keep, n_lines[k])).tolist()])
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_lines, pa.int64()), batch.column("n_dropped"), pa.array(texts, pa.string())], ["id", "n_lines", "n_dropped", "text"])

    out = rows.mapInArrow(run, "id long, n_lines long, n_dropped int, text string")
    return out.select(F.nullif("id", F.lit(_NO_ID)).alias("doc_id"), "n_lines", "n_dropped", "text")


def op13_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines dropped from every whole text of ``documents``."""
    out = kept_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", F.col("n_dropped").cast("long").alias("n_dropped"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


_BLANK_SQL = " || ".join(f"chr({ord(x)})" for x in _BLANK)
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, {_BLANK_SQL}), '{_UPPER}', '{_LOWER}') AS k FROM lines
), common AS (
  SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= {LEAST_CHARS}
  GROUP BY k HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}
), judged AS (
  SELECT keyed.*, coalesce(doc_id <> top, false) AS gone FROM keyed LEFT JOIN common USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
