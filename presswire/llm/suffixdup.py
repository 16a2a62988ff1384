"""Substrings that an earlier document has: difference-cover blockwise suffix comparison.

The suffixes of the corpus are compared to a depth of ``length`` bytes, one bucket of
them at a time, and only suffixes that a sample could not clear travel:

1. The sample is a difference cover: places whose distance from their document's
   start is, modulo v, in a set that holds every difference. Two equal strings of
   ``length`` bytes, wherever they begin, have sample places at one common distance
   below v, so samples alike in their first ``length - v + 1`` bytes. Samples are
   ranked into classes by those bytes; a suffix without a sample of a repeated class
   within its first v bytes ties with no other and is done.
2. The others go to buckets by the least fingerprint of the sample-deep strings they
   begin with, which equal suffixes share. Neighbours mostly have the same one and
   travel together as one piece of text; equal pieces of a block travel once, for
   their smallest document.
3. A bucket is sorted for itself, and of each group of equal suffixes the smallest
   document decides. Answers go back in the order of the pieces.

Suffixes are ordered by a 64-bit fingerprint of the compared bytes, as only equality
at that depth matters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswire.llm import exchange as X
from presswire.llm.common import saved, table
from presswire.llm.wordhash import mix

LENGTH = 50
# Perfect difference covers, period and residues.
COVERS = {7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27), 57: (0, 1, 6, 15, 22, 26, 45, 55), 73: (0, 1, 12, 20, 26, 30, 33, 35, 57)}
LANE = 4 << 20  # bytes of corpus text to a bucket of suffixes, in the mean
BLOCK = 3 << 20  # bytes of text of a block
CHUNK = 1 << 18  # bytes whose prefix sums are held at once
_LAST = np.int64(np.iinfo(np.int64).max)  # stands for a null id, after all others

_rng = np.random.default_rng(31337)
_CODE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


class Hasher:
    """64-bit fingerprints of substrings, through prefix sums."""

    def __init__(self, reach: int) -> None:
        self.reach = reach
        self.up = _powers(_BASE, CHUNK + 2 * reach)
        self.down = _powers(pow(_BASE, -1, 1 << 64), CHUNK + 2 * reach)

    def at(self, raw: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
        """Fingerprints of ``raw[p : p + size]`` for ascending places."""
        out = np.empty(len(places), dtype=np.uint64)
        cuts = np.searchsorted(places, np.arange(0, len(raw) + CHUNK, CHUNK))
        for k, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist(), strict=False)):
            if a == b:
                continue
            base = k * CHUNK
            part = _CODE[raw[base : base + CHUNK + size]]
            part *= self.up[: len(part)]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part)])
            p = places[a:b] - base
            h = sums[p + size]
            h -= sums[p]
            h *= self.down[p]
            out[a:b] = mix(h)
        return out


    def every(self, raw: np.ndarray, size: int) -> np.ndarray:
        """Fingerprints of ``raw[p : p + size]`` for all places."""
        n = max(len(raw) - size + 1, 0)
        out = np.empty(n, dtype=np.uint64)
        for base in range(0, n, CHUNK):
            m = min(CHUNK, n - base)
            part = _CODE[raw[base : base + m + size - 1]]
            part *= self.up[: len(part)]
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(part, out=sums[1:])
            h = sums[size : size + m]
            h = h - sums[:m]
            h *= self.down[:m]
            out[base : base + m] = mix(h)
        return out


class Cover:
    def __init__(self, length: int = LENGTH) -> None:
        fits = [v for v in COVERS if length - v + 1 >= min(16, length - 6)]
        if length < 8:
            raise ValueError("strings of fewer than 8 bytes are not compared")
        self.length, self.v = length, max(fits)
        self.depth = length - self.v + 1
        self.member = np.zeros(self.v, dtype=bool)
        self.member[list(COVERS[self.v])] = True
        self.hash = Hasher(2 * length)

    def sample(self, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sample places of documents that lie one behind the other, a whole sample string inside."""
        n = np.maximum(sizes - self.depth + 1, 0)
        starts = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(starts, n)
        # Residues without a division of every place.
        keep = self.member[place % self.v]
        return (place + np.repeat(begins, n))[keep]


_covers: dict[int, Cover] = {}


def _cover(length: int) -> Cover:
    return _covers.setdefault(length, Cover(length))


def _flat(block: X.Block) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(block.texts), dtype=np.uint8)
    return raw, np.cumsum(block.sizes) - block.sizes


def _owners(ids: list) -> np.ndarray:
    return np.array([_LAST if i is None else i for i in ids], dtype=np.int64)


_DONE = {"row": pa.int64(), "doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "spans": pa.list_(pa.int64())}
_DONE_ROW = "row long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"
_PIECE = {"bucket": pa.int32(), "block": pa.int64(), "mark": pa.int64(), "n": pa.int64(), "n_pieces": pa.int64(), "n_bytes": pa.int64(), "text": pa.binary(), "lengths": pa.binary(), "index": pa.binary(), "owners": pa.binary(), "n_owners": pa.int64()}
_PIECE_ROW = "bucket int, block long, mark long, n long, n_pieces long, n_bytes long, text binary, lengths binary, index binary, owners binary, n_owners long"


def _settled(block: X.Block, gone: np.ndarray) -> pa.Table:
    """Finished documents of a block; ``gone`` flags its removed bytes."""
    out: dict[str, list] = {c: [] for c in _DONE}
    at = 0
    for k, (doc_id, text) in enumerate(zip(block.ids, block.texts, strict=True)):
        flags = gone[at : at + len(text)]
        at += len(text)
        spans: list[int] = []
        kept = text
        if flags.any():
            spans = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))).tolist()
            kept = np.frombuffer(text, np.uint8)[~flags].tobytes()
        values = ((block.number << 20) + k, doc_id, len(text), len(text) - len(kept), len(spans) // 2, hashlib.sha256(kept).hexdigest(), spans)
        for c, v in zip(out, values, strict=True):
            out[c].append(v)
    return pa.table([pa.array(out[c], t) for c, t in _DONE.items()], names=list(_DONE))


def _doc_of(places: np.ndarray, begins: np.ndarray) -> np.ndarray:
    return np.searchsorted(begins, places, side="right") - 1


def _sampled(docs: DataFrame, length: int, width: int, buckets: int) -> DataFrame:
    """Classes of sample strings: a part row for each block and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cover = _cover(length)
        for block in X.cut(batches, BLOCK):
            raw, begins = _flat(block)
            h = cover.hash.at(raw, cover.sample(begins, block.sizes), cover.depth)
            h >>= np.uint64(64 - width)
            h.sort()
            new = np.ones(len(h), dtype=bool)
            new[1:] = h[1:] != h[:-1]
            first = np.flatnonzero(new)
            counts = np.minimum(np.diff(first, append=len(h)), 255).astype(np.uint8)
            yield from X.parts(block.number, block.mark, h[first], counts, width, buckets)

    return docs.mapInArrow(run, X.PART_ROW)


def _rank(h: np.ndarray) -> np.ndarray:
    """Place of each key among the ascending distinct keys."""
    order = np.argsort(h)
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[order][1:] != h[order][:-1]
    out = np.empty(len(h), dtype=np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _spans(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Flags of the places in any of the spans [a, b)."""
    step = np.bincount(a, minlength=n + 1) - np.bincount(b, minlength=n + 1)
    return np.cumsum(step)[: n - 1] > 0


class Pieces:
    """Suffixes of a block that may be repeated, as pieces of text: runs of neighbours of one bucket.

    ``begin`` and ``size`` are the pieces' first suffix and number of suffixes;
    ``kind`` numbers equal pieces alike, and ``first`` and ``owner`` are a kind's
    first piece and smallest document. Kinds come bucket by bucket.
    """

    def __init__(self, block: X.Block, counts: np.ndarray, cover: Cover, width: int, buckets: int) -> None:
        raw, begins = self.raw, self.begins = _flat(block)
        own = _owners(block.ids)
        places = cover.sample(begins, block.sizes)
        h = cover.hash.at(raw, places, cover.depth) >> np.uint64(64 - width)
        places = places[counts[_rank(h)] > 1] if len(h) else places
        del h
        n = len(raw) + 1
        doc = _doc_of(places, begins)
        near = _spans(np.maximum(places - (cover.v - 1), begins[doc]), places + 1, n)
        near &= _spans(begins, begins + np.maximum(block.sizes - cover.length + 1, 0), n)
        at = np.flatnonzero(near)
        if not len(at):
            self.begin = self.size = self.kind = self.first = self.owner = self.bucket = np.empty(0, np.int64)
            return
        # Least fingerprint of the strings of the sample's depth within each suffix, by doubling.
        low = cover.hash.every(raw, cover.depth)
        reach = 1
        while 2 * reach <= cover.v:
            low[: len(low) - reach] = np.minimum(low[: len(low) - reach], low[reach:])
            reach *= 2
        least = np.minimum(low[at], low[at + cover.v - reach])
        del low
        doc = _doc_of(at, begins)
        new = np.ones(len(at), dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
        # No piece is longer than a suffix, so its first and last suffixes cover all of it.
        start = np.flatnonzero(new)
        new[(np.arange(len(at)) - np.repeat(start, np.diff(start, append=len(at)))) % cover.length == 0] = True
        start = np.flatnonzero(new)
        self.begin, self.size = at[start], np.diff(start, append=len(at))
        # A piece's own fingerprint: its first suffixes' and its last's, and its length.
        edge = cover.hash.at(raw, self.begin, cover.length)
        last = self.begin + self.size - 1
        order = np.argsort(last, kind="stable")
        tail = np.empty_like(edge)
        tail[order] = cover.hash.at(raw, last[order], cover.length)
        mark = mix(edge * np.uint64(3) + tail) + self.size.astype(np.uint64)
        owner = own[doc[start]]
        # Least values crowd at the low end; mixed again they spread evenly over the buckets.
        lane = ((mix(least[start].copy()) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((np.arange(len(mark)), owner, mark, lane))
        m, b = mark[order], lane[order]
        fresh = np.ones(len(m), dtype=bool)
        fresh[1:] = (m[1:] != m[:-1]) | (b[1:] != b[:-1])
        self.kind = np.empty(len(m), dtype=np.int64)
        self.kind[order] = np.cumsum(fresh) - 1
        self.first = order[fresh]
        self.bucket, self.owner, self.mine = b[fresh], owner[self.first], owner

    def rows(self, block: X.Block, length: int) -> Iterator[dict]:
        edges = np.flatnonzero(np.diff(self.bucket, prepend=-1, append=-2)) if len(self.bucket) else np.empty(0, int)
        for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            piece = self.first[a:b]
            size = self.size[piece]
            text = _cat(self.raw, self.begin[piece], size + length - 1)
            known, index = np.unique(self.owner[a:b], return_inverse=True)
            yield {
                "bucket": int(self.bucket[a]), "block": block.number, "mark": block.mark, "n": int(size.sum()), "n_pieces": b - a, "n_bytes": len(text),
                "text": X.zipped(text), "lengths": X.zipped(size.astype("<u4")), "index": X.zipped(index.astype("<u4")), "owners": X.zipped(known.astype("<i8")), "n_owners": len(known),
            }


def _cat(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The named stretches of ``raw``, one behind the other."""
    start = np.cumsum(size) - size
    return raw[np.arange(int(size.sum())) + np.repeat(begin - start, size)]


def _pieces(docs: DataFrame, sample: DataFrame, length: int, width: int, buckets: int) -> DataFrame:
    def run(key: tuple, rows: pa.Table, said: pa.Table) -> pa.Table:
        cover = _cover(length)
        block = X.block_of(rows)
        found = Pieces(block, X.answers_of(block, said), cover, width, buckets)
        batches = [X.one_row(r, _PIECE) for r in found.rows(block, length)]
        return pa.Table.from_batches(batches, pa.schema(list(_PIECE.items())))

    both = X.blocks_of(docs, BLOCK).groupBy("block").cogroup(sample.groupBy("block"))
    return both.applyInArrow(run, _PIECE_ROW)


def _sorted_buckets(pieces: DataFrame, length: int) -> DataFrame:
    """For every suffix of a bucket, in its own order, whether a smaller document has it."""

    def run(t: pa.Table) -> pa.Table:
        cover = _cover(length)
        keys, owners, counts = [], [], []
        for k in range(len(t)):
            r = {c: t.column(c)[k].as_py() for c in _PIECE}
            text = X.unzipped(r["text"], "u1", r["n_bytes"])
            size = X.unzipped(r["lengths"], "<u4", r["n_pieces"]).astype(np.int64)
            whole = size + length - 1
            start = np.cumsum(whole) - whole
            at = np.arange(r["n"]) + np.repeat(start - (np.cumsum(size) - size), size)
            keys.append(cover.hash.at(text, at, length))
            of = X.unzipped(r["owners"], "<i8", r["n_owners"])[X.unzipped(r["index"], "<u4", r["n_pieces"])]
            owners.append(np.repeat(of, size))
            counts.append(r["n"])
        back = np.split(X.preceded(np.concatenate(keys), np.concatenate(owners)), np.cumsum(counts)[:-1])
        return pa.table({"block": t.column("block"), "bucket": t.column("bucket"), "mark": t.column("mark"), "n": t.column("n"), "answer": pa.array([X.zipped(a) for a in back], pa.binary())})

    return pieces.groupBy("bucket").applyInArrow(run, X.ANSWER_ROW)


def _finished(docs: DataFrame, sample: DataFrame, said: DataFrame, length: int, width: int, buckets: int) -> DataFrame:
    def run(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        cover = _cover(length)
        block = X.block_of(rows)
        late = answers.column("late").to_numpy(zero_copy_only=False).astype(bool)
        found = Pieces(block, X.answers_of(block, answers.filter(pa.array(~late))), cover, width, buckets)
        early = X.answers_of(block, answers.filter(pa.array(late))).astype(bool)
        gone = np.zeros(len(found.raw), dtype=bool)
        if len(found.begin):
            size = found.size[found.first]
            offset = np.cumsum(size) - size
            # Each piece reads its kind's answers; a later document's copy is repeated throughout.
            rows_ = np.arange(int(found.size.sum())) + np.repeat(offset[found.kind] - (np.cumsum(found.size) - found.size), found.size)
            place = np.arange(int(found.size.sum())) + np.repeat(found.begin - (np.cumsum(found.size) - found.size), found.size)
            behind = np.repeat(found.mine > found.owner[found.kind], found.size)
            hit = place[early[rows_] | behind]
            gone = _spans(hit, hit + length, len(found.raw) + 1)
        return _settled(block, gone)

    both = sample.withColumn("late", F.lit(False)).unionByName(said.withColumn("late", F.lit(True)))
    return X.blocks_of(docs, BLOCK).groupBy("block").cogroup(both.groupBy("block")).applyInArrow(run, _DONE_ROW)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(row, doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)``, one row per row of ``docs (doc_id, text)``.

    Every byte within a string of ``length`` bytes that also begins in a document
    with a smaller id goes; spans are the removed runs, begin and end in turn. Null
    text is empty, and its digest that of no bytes. A null id comes after all
    others; rows of equal id do not remove from each other. Texts shorter than
    ``length`` stay whole; an empty table gives no rows; other columns are ignored.
    ``docs`` must be a table scan.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    n_bytes = X.bytes_of(docs)
    width = int(min(60, max(24, int(n_bytes).bit_length() + 6)))
    buckets = int(max(12, n_bytes // 5 // X.BUCKET + 1))
    lanes = int(max(12, n_bytes // LANE + 1))
    sample = saved(X.met(_sampled(docs, length, width, buckets), X.counted, "u1"), "sample")
    said = _sorted_buckets(_pieces(docs, sample, length, width, lanes), length)
    return _finished(docs, sample, said, length, width, lanes)


def op1_suffixdup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated substrings of all ``documents``, removed."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("row", "spans")


ORACLE = """
WITH t AS (
  SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents
), starts AS (
  SELECT doc_id, i, t[i + 1:i + 50] AS s FROM (SELECT doc_id, t, unnest(range(octet_length(t) - 49)) AS i FROM t)
), repeats AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM starts) WHERE least < doc_id
), opened AS (
  SELECT *, CASE WHEN i > lag(i) OVER w + 50 OR lag(i) OVER w IS NULL THEN 1 ELSE 0 END AS o FROM repeats WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT *, sum(o) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM opened) GROUP BY doc_id, k
), gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT t.doc_id, coalesce(max(b), 0), octet_length(any_value(t)) FROM t LEFT JOIN spans USING (doc_id) GROUP BY t.doc_id
), kept AS (
  SELECT doc_id, string_agg(hex(t[a + 1:b]), '' ORDER BY a) AS h FROM gaps JOIN t USING (doc_id) GROUP BY doc_id
), sums AS (
  SELECT doc_id, sum(b - a) AS n, count(*) AS k FROM spans GROUP BY doc_id
)
SELECT t.doc_id, octet_length(t)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(k, 0)::BIGINT AS n_spans, sha256(unhex(h)) AS kept_sha256
FROM t JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""
