"""Blocks of documents that ask each other about 64-bit keys.

A block packs the sorted keys of its documents; ranges of keys (buckets) meet, one
bucket to a group, and an answer goes back to each block in the order of its own
keys. Texts never travel with the keys: keys are cut to the bits needed and packed
by Elias-Fano coding, about two bytes each.

Blocks are cut from the partitions of a table scan, which Spark reads alike each
time; a block's checksum travels with its keys, and a later pass that meets another
block under the same number stops.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswire.llm.common import text_slices

BLOCK = 6 << 20  # bytes of text of a block
BUCKET = 3_000_000  # keys of a bucket, in the mean


def zipped(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a).tobytes(), codec="zstd", asbytes=True) if a.size else b""


def unzipped(b: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(b, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True) if n else b"", dtype=kind)


def pack_sorted(v: np.ndarray, width: int) -> bytes:
    """Elias-Fano code of ascending distinct integers below ``2**width``; the low parts are whole bytes."""
    n = len(v)
    if not n:
        return b""
    low = min(range(0, min(width, 56) + 1, 8), key=lambda k: k * n + (1 << max(0, width - k)) + n)
    high = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
    marks = np.zeros(int(high[-1]) + 1, dtype=bool)
    marks[high] = True
    tail = v.astype("<u8").view(np.uint8).reshape(n, 8)[:, : low // 8].tobytes()
    return bytes([low]) + tail + np.packbits(marks).tobytes()


def unpack_sorted(b: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.uint64)
    low = b[0] // 8
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, :low] = np.frombuffer(b, np.uint8, n * low, 1).reshape(n, low)
    marks = np.unpackbits(np.frombuffer(b, np.uint8, offset=1 + n * low))
    high = (np.flatnonzero(marks)[:n] - np.arange(n)).astype(np.uint64) << np.uint64(8 * low)
    return high | wide.view("<u8").ravel()


class Block:
    """Documents of one block: ids, whole texts as bytes, and where each begins in ``raw``."""

    def __init__(self, number: int, ids: list, texts: list[bytes]) -> None:
        self.number, self.ids, self.texts = number, ids, texts
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)

    @property
    def mark(self) -> int:
        return zlib.crc32(self.sizes.tobytes(), zlib.crc32(repr(self.ids).encode()))

    def row(self) -> dict:
        return {"block": self.number, "mark": self.mark, "doc_ids": self.ids, "sizes": self.sizes.astype("<i8").tobytes(), "texts": pa.compress(b"".join(self.texts), codec="zstd", asbytes=True) if self.sizes.sum() else b""}

    @classmethod
    def of_row(cls, row: dict) -> Block:
        sizes = np.frombuffer(row["sizes"], "<i8")
        total = int(sizes.sum())
        raw = pa.decompress(row["texts"], total, codec="zstd", asbytes=True) if total else b""
        ends = np.cumsum(sizes).tolist()
        return cls(row["block"], row["doc_ids"], [raw[e - s : e] for s, e in zip(sizes.tolist(), ends, strict=True)])


BLOCK_ROW = "block long, mark long, doc_ids array<long>, sizes binary, texts binary"
_BLOCK_TYPES = {"block": pa.int64(), "mark": pa.int64(), "doc_ids": pa.list_(pa.int64()), "sizes": pa.binary(), "texts": pa.binary()}


def cut(batches: Iterator[pa.RecordBatch], each: int = BLOCK) -> Iterator[Block]:
    """The blocks of a partition of ``(doc_id, text)``; null text is empty."""
    number = TaskContext.get().partitionId() << 20
    for batch in text_slices(batches, each):
        texts = [b"" if t is None else t for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield Block(number, batch.column("doc_id").to_pylist(), texts)
        number += 1


def one_row(values: dict, types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(n)], t) for n, t in types.items()], list(types))


def blocks_of(docs: DataFrame, each: int = BLOCK) -> DataFrame:
    """``docs (doc_id, text)`` as rows of whole blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in cut(batches, each):
            yield one_row(block.row(), _BLOCK_TYPES)

    return docs.mapInArrow(run, BLOCK_ROW)


_PART = {"bucket": pa.int32(), "block": pa.int64(), "mark": pa.int64(), "n": pa.int64(), "keys": pa.binary(), "values": pa.binary(), "owners": pa.binary()}
PART_ROW = "bucket int, block long, mark long, n long, keys binary, values binary, owners binary"


def parts(number: int, mark: int, keys: np.ndarray, values: np.ndarray, width: int, buckets: int, owners: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of a block's ascending distinct keys, one a bucket; ``values`` go along (or index ``owners``)."""
    span = -(-(1 << width) // buckets)
    edges = np.searchsorted(keys, np.array([min(b * span, (1 << 64) - 1) for b in range(buckets)] , dtype=np.uint64))
    edges = np.append(edges, len(keys))
    inner = max(1, (span - 1).bit_length())
    for b in np.flatnonzero(np.diff(edges)).tolist():
        at = slice(int(edges[b]), int(edges[b + 1]))
        row = {"bucket": b, "block": number, "mark": mark, "n": at.stop - at.start, "keys": pack_sorted(keys[at] - np.uint64(b * span), inner), "values": zipped(values[at])}
        if owners is not None:
            row["owners"] = zipped(owners.astype("<i8")) + len(owners).to_bytes(4, "little")
        yield one_row(row, _PART)


ANSWER_ROW = "block long, bucket int, mark long, n long, answer binary"


def met(rows: DataFrame, answer: Callable[[np.ndarray, list[np.ndarray]], np.ndarray], kind: str, with_owners: bool = False) -> DataFrame:
    """Answers to part rows, a bucket at a time: ``answer(keys, values)`` gives a byte per key in the given order.

    ``values`` are the blocks' values in one array, owners looked up where they have
    any. Keys are relative to the bucket.
    """

    def run(t: pa.Table) -> pa.Table:
        n = t.column("n").to_pylist()
        keys = np.concatenate([unpack_sorted(b, k) for b, k in zip(t.column("keys").to_pylist(), n, strict=True)])
        values = [unzipped(b, kind, k) for b, k in zip(t.column("values").to_pylist(), n, strict=True)]
        if with_owners:
            tables = [unzipped(b[:-4], "<i8", int.from_bytes(b[-4:], "little")) for b in t.column("owners").to_pylist()]
            values = [o[v] for o, v in zip(tables, values, strict=True)]
        said = answer(keys, np.concatenate(values))
        back = np.split(said, np.cumsum(n)[:-1])
        return pa.table({"block": t.column("block"), "bucket": t.column("bucket"), "mark": t.column("mark"), "n": t.column("n"), "answer": pa.array([zipped(a) for a in back], pa.binary())})

    return rows.groupBy("bucket").applyInArrow(run, ANSWER_ROW)


def answers_of(block: Block, table: pa.Table) -> np.ndarray:
    """A block's answers in the order of its keys."""
    if not len(table):
        return np.empty(0, np.uint8)
    if set(table.column("mark").to_pylist()) != {block.mark}:
        raise RuntimeError("the scan gave other blocks than before; pass a table scan")
    order = np.argsort(table.column("bucket").to_numpy())
    got = [unzipped(table.column("answer")[int(k)].as_py(), "u1", table.column("n")[int(k)].as_py()) for k in order]
    return np.concatenate(got)


def block_of(table: pa.Table) -> Block:
    return Block.of_row({c: table.column(c)[0].as_py() for c in ("block", "doc_ids", "sizes", "texts")})


def counted(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Summed counts of equal keys, 255 at most, for every key."""
    order = np.argsort(keys)
    k = keys[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    total = np.minimum(np.add.reduceat(counts[order].astype(np.int64), first), 255).astype(np.uint8)
    out = np.empty(len(keys), dtype=np.uint8)
    out[order] = np.repeat(total, np.diff(first, append=len(k)))
    return out


def preceded(keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """1 where an equal key has a smaller owner."""
    order = np.argsort(keys)
    k, o = keys[order], owners[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    least = np.repeat(np.minimum.reduceat(o, first), np.diff(first, append=len(k)))
    out = np.empty(len(keys), dtype=np.uint8)
    out[order] = least < o
    return out


def bytes_of(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
