"""Token ids of documents in files of independent rANS blocks, and the way back.

A folder is divided by ``bucket``: ascending ranges of doc_id. A row of a file is a
segment: whole documents in ascending doc_id, one table of frequencies, and the
blocks that share it. The Parquet rows are written by Spark, whose commit keeps one
copy of what a task wrote, however often it ran.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from presswire.llm import rans
from presswire.llm.common import table, text_slices, texts_of
from presswire.llm.pieces import encoder
from presswire.session import scratch_path

END = 2
BLOCK_IDS = 1 << 18  # ids of a block
SEGMENT_IDS = 1 << 22  # ids after which a segment is closed; documents are whole in theirs
BUCKET_BYTES = 16 << 20  # text of a bucket
BUCKETS = 20_000
TURN = 2 << 20  # bytes of text encoded at once


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_documents(docs: DataFrame, vocabulary: str, end: int = END) -> DataFrame:
    """``(bucket, doc_id, ids)``: little-endian ids of every whole text and the end id, sorted by bucket and doc_id.

    Null text is empty. Bucket limits are quantiles of doc_id, so the shuffle that
    orders the ids is the only one. Null doc_id comes first.
    """
    n_bytes, n = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    buckets = int(min(BUCKETS, max(1, (n_bytes or 0) // BUCKET_BYTES)))
    at = [k / buckets for k in range(1, buckets)]
    limits = docs.agg(F.percentile_approx("doc_id", at, 10 * max(buckets, 1000))).first()[0] if at and n else None
    edges = np.unique(np.array(limits or [], dtype=np.int64))
    kind = encoder(vocabulary).kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        tail = np.array([end], dtype=kind).tobytes()
        for batch in text_slices(batches, TURN):
            ids = [b + tail for b in coder.encode(texts_of(batch))]
            key = batch.column("doc_id")
            bucket = np.searchsorted(edges, key.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), side="left")
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), key, pa.array(ids, pa.binary())], ["bucket", "doc_id", "ids"])

    coded = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "bucket int, doc_id long, ids binary")
    # More partitions than buckets, so that few partitions get two of them.
    return coded.repartition(4 * buckets, "bucket").sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first())


SEGMENT = "bucket int, segment long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, freq binary, blocks array<binary>"


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = END) -> None:
    """Encode every document of ``docs (doc_id, text)`` into the files below ``path``."""
    vocabulary = vocabulary or default_vocabulary()
    coded = encode_documents(docs, vocabulary, end)
    kind, size = encoder(vocabulary).kind, encoder(vocabulary).size

    def segment(bucket: int, number: int, docs_: list, ids: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate(ids)
        freq = rans.Frequencies.of_counts(np.bincount(flat, minlength=size))
        blocks = [rans.encode(flat[k : k + BLOCK_IDS], freq) for k in range(0, len(flat), BLOCK_IDS)]
        values = {"bucket": bucket, "segment": number, "n_ids": len(flat), "doc_ids": docs_, "lengths": [len(i) for i in ids], "freq": freq.pack(), "blocks": blocks}
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values.values(), kinds, strict=True)], list(values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, docs_, ids, held, bucket = TaskContext.get().partitionId(), 0, [], [], 0, None
        for batch in batches:
            for b, d, i in zip(batch.column("bucket").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                if ids and (b != bucket or held >= SEGMENT_IDS):
                    yield segment(bucket, part << 32 | seq, docs_, ids)
                    seq, docs_, ids, held = seq + 1, [], [], 0
                bucket = b
                docs_.append(d)
                ids.append(np.frombuffer(i.as_py(), dtype=kind))
                held += len(ids[-1])
        if ids:
            yield segment(bucket, part << 32 | seq, docs_, ids)

    coded.mapInArrow(run, SEGMENT).write.option("compression", "uncompressed").partitionBy("bucket").parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` decoded from the files.

    ``start`` is the number of ids before the document; ids come as an array of int.
    The crc is of the ids as little-endian unsigned 32-bit integers.
    """
    segments = spark.read.schema(SEGMENT).parquet(path)
    # Offsets come from narrow columns alone: first of buckets, then of segments in a bucket.
    heads = segments.select("bucket", "segment", "n_ids", F.col("doc_ids")[0].alias("first"))
    earlier = (Window.unboundedPreceding, -1)
    sums = heads.groupBy("bucket").agg(F.sum("n_ids").alias("n"))
    sums = sums.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(*earlier)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket").orderBy(F.col("first").asc_nulls_first(), "segment").rowsBetween(*earlier)
    offsets = heads.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(sums, "bucket")
    offsets = offsets.select("segment", (F.col("before") + F.col("inside")).alias("begin"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids_of, lens, packed, blocks in zip(*(batch.column(c) for c in ("segment", "doc_ids", "lengths", "freq", "blocks")), strict=True):
                freq = rans.Frequencies.unpack(packed.as_py())
                ids = np.concatenate([rans.decode(b, freq) for b in blocks.as_py()])
                n = lens.values.to_numpy()
                ends = np.cumsum(n)
                wide = ids.astype("<u4")
                crc = [zlib.crc32(wide[e - k : e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
                cols = [pa.array(np.full(len(n), number.as_py())), ids_of.values, pa.array(ends - n), pa.array(n), pa.array(crc, pa.int64())]
                names = ["segment", "doc_id", "offset", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    shape = "segment long, doc_id long, offset long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    found = segments.select("segment", "doc_ids", "lengths", "freq", "blocks").mapInArrow(run, shape)
    out = found.join(offsets, "segment")
    return out.select("doc_id", (F.col("begin") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op7_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` written as token files and read back.

    Null text gives the end id alone; equal documents are encoded each; an empty
    table gives no rows; other columns are ignored.
    """
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return read_tokens(spark, path)
