"""Hard negatives by inner product: length buckets and coordinate pruning.

Rows are sorted by length and cut into buckets. A bucket is one row of a table: its
integer vectors and, for each coordinate, the order of its rows by that coordinate of
their directions. Anchors come in blocks of bounded size; one block at a time is
sent to the buckets, which stay where they are.

For an anchor with a score to reach, a bucket whose longest row cannot reach it is
passed over. In the others the score becomes an angle, and every focus coordinate
(the largest ones of the anchor) a range of values the row must have. The
narrowest range of a sorted list gives the candidates, the other ranges thin them
out, and exact integer scores decide. Scores to reach rise as a task goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from presswire.llm.common import partitions_for, saved, table

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # per cent of the positive's score
BUCKET = 4096  # rows of a bucket
ANCHORS = 16_384  # anchors of a block
FOCUS = 6  # coordinates looked at
RANGE = 64 << 20  # bytes of vectors of a partition of buckets
_LIMIT = 1 << 26  # scaled components reach less than this
_SLACK = 1e-9

_BLOCK = "block long, n int, dim int, ids binary, labels binary, raw binary"
_BUCKET = "n int, dim int, top double, ids binary, labels binary, raw binary, lists binary"


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, v, length)`` of the rows that take part; v is the scaled vector, floored."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(sound)
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), scaled.alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return saved(rows.withColumn("length", length), "vectors")


def matrix_of(lists: pa.ListArray) -> np.ndarray:
    """Integer vectors as rows; shorter ones are filled up with zeros."""
    at = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()[at[0] : at[-1]]
    size = np.diff(at)
    out = np.zeros((len(size), int(size.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    if len(flat) and max(int(flat.max()), -int(flat.min())) >= _LIMIT:
        raise ValueError(f"a scaled component reaches {_LIMIT}; use a smaller scale")
    return out


def directions(raw: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(raw.astype(np.float64), axis=1, keepdims=True)
    return raw / np.where(length == 0, 1.0, length)


def _rows_in_turn(batches: Iterator[pa.RecordBatch], each: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(ids, labels, raw)`` of ``each`` rows at a time, in the order they come."""
    held: list[pa.RecordBatch] = []
    n = 0

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t = pa.Table.from_batches(held).combine_chunks()
        return t.column("vec_id").to_numpy(), t.column("label").to_numpy(), matrix_of(t.column("v").chunk(0))

    for batch in batches:
        at = 0
        while at < len(batch):
            part = batch.slice(at, each - n)
            held.append(part)
            n, at = n + len(part), at + len(part)
            if n == each:
                yield joined()
                held, n = [], 0
    if n:
        yield joined()


def _one(values: list, shape: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    names = [c.split(" ") for c in shape.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[k]) for v, (_, k) in zip(values, names, strict=True)], [n for n, _ in names])


def build_buckets(rows: DataFrame, each: int = BUCKET) -> DataFrame:
    """One row a bucket, of rows that follow each other by length. Equal lengths are cut by vec_id, so copies make many buckets."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, raw in _rows_in_turn(batches, each):
            lists = np.argsort(directions(raw), axis=0, kind="stable").T.astype("<i4")
            top = float(np.linalg.norm(raw.astype(np.float64), axis=1).max())
            yield _one([len(ids), raw.shape[1], top, ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), raw.astype("<i4").tobytes(), np.ascontiguousarray(lists).tobytes()], _BUCKET)

    n_bytes = rows.agg(F.sum(F.size("v") * 4 + 16)).first()[0] or 0
    order = [F.col("length").desc(), F.col("vec_id")]
    dealt = rows.repartitionByRange(partitions_for(rows.sparkSession, n_bytes, RANGE), *order).sortWithinPartitions(*order)
    return saved(dealt.select("vec_id", "label", "v").mapInArrow(pack, _BUCKET), "buckets")


def build_blocks(rows: DataFrame, each: int = ANCHORS) -> DataFrame:
    """One row a block of anchors. Rows are dealt in turn, so that blocks are alike."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        for k, (ids, labels, raw) in enumerate(_rows_in_turn(batches, each)):
            yield _one([number + k, len(ids), raw.shape[1], ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), raw.astype("<i4").tobytes()], _BLOCK)

    n = rows.count()
    return saved(rows.select("vec_id", "label", "v").repartition(-(-n // each) or 1).mapInArrow(pack, _BLOCK), "anchors")


class Side:
    """Rows of a bucket or a block."""

    def __init__(self, row: dict) -> None:
        self.n, self.dim = row["n"], row["dim"]
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        self.raw = np.frombuffer(row["raw"], "<i4").reshape(self.n, self.dim).astype(np.float64)
        self.unit = directions(self.raw)
        self.length = np.linalg.norm(self.raw, axis=1)
        self.reach = float(np.abs(self.raw).max(initial=0))


class Bucket(Side):
    def __init__(self, row: dict) -> None:
        super().__init__(row)
        self.top = row["top"]
        self.order = np.frombuffer(row["lists"], "<i4").reshape(self.dim, self.n)
        self.values = np.take_along_axis(self.unit.T, self.order, axis=1)

    def candidates(self, unit: np.ndarray, least: float, focus: np.ndarray) -> np.ndarray | None:
        """Rows whose direction may have a cosine of ``least`` with ``unit``; None for all."""
        if least <= 0:
            return None
        # Angles: the row's coordinate f is cos(b), the anchor's cos(a), and |a - b| is at most acos(least).
        turn = np.arccos(min(least, 1.0))
        a = np.arccos(np.clip(unit[focus], -1.0, 1.0))
        low = np.cos(np.minimum(a + turn, np.pi)) - _SLACK
        high = np.cos(np.maximum(a - turn, 0.0)) + _SLACK
        ends = [(int(np.searchsorted(self.values[f], lo)), int(np.searchsorted(self.values[f], hi, side="right"))) for f, lo, hi in zip(focus.tolist(), low, high, strict=True)]
        k = min(range(len(ends)), key=lambda j: ends[j][1] - ends[j][0])
        begin, end = ends[k]
        rows = self.order[focus[k], begin:end]
        for j, f in enumerate(focus.tolist()):
            if j != k and len(rows):
                x = self.unit[rows, f]
                rows = rows[(x >= low[j]) & (x <= high[j])]
        return rows


def _scores(bucket: Bucket, rows: np.ndarray | slice, vector: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; double precision holds them unless ``exact`` asks for whole numbers."""
    d = min(bucket.dim, len(vector))
    part = bucket.raw[rows, :d]
    if exact:
        return (part.astype(np.int64).astype(object) @ vector[:d].astype(np.int64).astype(object)).astype(np.int64)
    return (part @ vector[:d]).astype(np.int64)


class Best:
    """The first ``k`` rows of each of ``n`` lists: higher score, then smaller id."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.scores = [np.empty(0, np.int64)] * n
        self.ids = [np.empty(0, np.int64)] * n
        self.least = np.full(n, -np.inf)  # the score a new row must reach

    def add(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > 8 * self.k:  # all that can be among the first k, ties included
            near = scores >= np.partition(scores, -self.k)[-self.k]
            scores, ids = scores[near], ids[near]
        s, i = np.concatenate([self.scores[at], scores]), np.concatenate([self.ids[at], ids])
        order = np.lexsort((i, -s))[: self.k]
        self.scores[at], self.ids[at] = s[order], i[order]
        if len(order) == self.k:
            self.least[at] = s[order[-1]]


def _searched(buckets: DataFrame, block: DataFrame, task: Callable[[dict], _Search], shape: str) -> DataFrame:
    """Every bucket meets the one row of ``block``; ``task`` makes the state a task of buckets passes through."""

    names = block.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch.column(c)[k].as_py() for c in _BUCKET_NAMES}
                if state is None:
                    state = task({c: batch.column("b_" + c)[k].as_py() for c in names})
                state.meet(Bucket(row))
        if state is not None:
            yield from state.results()

    # One row of bounded size: a block of the stated anchors meets all rows.
    both = buckets.join(F.broadcast(block.select(*[F.col(c).alias("b_" + c) for c in names])), F.col("top") >= 0)
    return both.mapInArrow(run, shape)


_BUCKET_NAMES = [c.split(" ")[0] for c in _BUCKET.split(", ")]


def _focus(unit: np.ndarray, dim: int, focus: int) -> np.ndarray:
    """The coordinates of largest absolute value, those behind the bucket's last one left out."""
    return np.argsort(-np.abs(unit[: min(dim, len(unit))]), kind="stable")[:focus]


class _Search:
    """Anchors of a block on their way through buckets."""

    def __init__(self, row: dict, focus: int) -> None:
        self.row, self.side, self.focus = row, Side(row), focus

    def rows(self, bucket: Bucket, at: int, least: float) -> tuple[np.ndarray | slice, np.ndarray] | None:
        """Rows of the bucket that may score ``least`` with anchor ``at``, and their scores."""
        side = self.side
        bound = bucket.top * side.length[at] * (1 + _SLACK)
        if least > bound:
            return None
        focus = _focus(side.unit[at], bucket.dim, self.focus)
        found = bucket.candidates(side.unit[at], least / bound - _SLACK, focus) if least > 0 and bound > 0 and len(focus) else None
        rows = slice(None) if found is None else found
        exact = bucket.reach * side.reach * max(bucket.dim, 1) >= 1 << 53
        return rows, _scores(bucket, rows, side.raw[at], exact)


class _Positives(_Search):
    def __init__(self, row: dict, focus: int, keep: int) -> None:
        super().__init__(row, focus)
        self.best = Best(self.side.n, keep)

    def meet(self, bucket: Bucket) -> None:
        side = self.side
        known = set(np.unique(bucket.labels).tolist())
        for at in range(side.n):
            label = int(side.labels[at])
            got = self.rows(bucket, at, self.best.least[at]) if label in known else None
            if got is not None:
                rows, scores = got
                ids = bucket.ids[rows]
                fit = (bucket.labels[rows] == label) & (ids != side.ids[at]) & (scores >= self.best.least[at])
                if fit.any():
                    self.best.add(at, scores[fit], ids[fit])

    def results(self) -> Iterator[pa.RecordBatch]:
        n = [len(s) for s in self.best.scores]
        at = np.repeat(np.arange(self.side.n), n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), self.row["block"])), pa.array(at.astype(np.int32)), pa.array(self.side.ids[at]), pa.array(np.concatenate(self.best.scores)), pa.array(np.concatenate(self.best.ids))],
            ["block", "at", "anchor_id", "score", "id"],
        )


class _Negatives(_Search):
    """``row`` also holds windows: place of the anchor, and the positive score."""

    def __init__(self, row: dict, focus: int, keep: int, low: int, high: int) -> None:
        super().__init__(row, focus)
        at, positive = np.frombuffer(row["w_at"], "<i8"), np.frombuffer(row["w_score"], "<i8")
        order = np.argsort(at, kind="stable")
        self.at, self.positive = at[order], positive[order]
        # Whole numbers between the two shares of the positive's score.
        self.lowest, self.highest = [-(-low * p // 100) for p in self.positive.tolist()], [high * p // 100 for p in self.positive.tolist()]
        self.best = Best(len(at), keep)
        self.best.least[:] = self.lowest
        self.edges = np.searchsorted(self.at, np.arange(self.side.n + 1))

    def meet(self, bucket: Bucket) -> None:
        side, best = self.side, self.best
        for a in range(side.n):
            windows = [w for w in range(int(self.edges[a]), int(self.edges[a + 1])) if self.lowest[w] <= self.highest[w]]
            if not windows:
                continue
            got = self.rows(bucket, a, min(best.least[w] for w in windows))
            if got is None:
                continue
            rows, scores = got
            ids, other = bucket.ids[rows], bucket.labels[rows] != side.labels[a]
            for w in windows:
                fit = other & (scores >= best.least[w]) & (scores <= self.highest[w])
                if fit.any():
                    best.add(w, scores[fit], ids[fit])

    def results(self) -> Iterator[pa.RecordBatch]:
        n = [len(s) for s in self.best.scores]
        w = np.repeat(np.arange(len(n)), n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(w), self.row["block"])), pa.array(self.at[w].astype(np.int32)), pa.array(self.positive[w]), pa.array(np.concatenate([np.empty(0, np.int64), *self.best.scores])), pa.array(np.concatenate([np.empty(0, np.int64), *self.best.ids]))],
            ["block", "at", "positive_score", "score", "id"],
        )


def _first(rows: DataFrame, by: list[str], keep: int) -> DataFrame:
    """The first rows of each list, with their rank; Spark keeps no more before its shuffle either."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def _windows(found: DataFrame, block: DataFrame) -> DataFrame:
    """The block's row with its windows: the positive scores of each anchor, each once."""

    def pack(t: pa.Table) -> pa.Table:
        at, score = (t.column(c).to_numpy().astype("<i8").tobytes() for c in ("at", "score"))
        return pa.table({"block": t.column("block").slice(0, 1), "w_at": pa.array([at], pa.binary()), "w_score": pa.array([score], pa.binary())})

    packed = found.select("block", "at", "score").distinct().groupBy("block").applyInArrow(pack, "block long, w_at binary, w_score binary")
    return block.join(packed, "block")


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    bucket: int = BUCKET,
    block: int = ANCHORS,
    focus: int = FOCUS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of the rows where ``anchor`` holds.

    ``vectors`` has vec_id, label (whole numbers) and embedding. Scores are integer inner products of
    the vectors times ``scale``, floored. An anchor's positives are its first rows of
    the same label; for each, the first rows of other labels whose score is between
    ``low`` and ``high`` per cent of the positive's. Higher scores come first, ties by
    smaller vec_id. Rows with a null vec_id, label or vector, or a null or non-finite
    component, take no part. Shorter vectors count as filled up with zeros. Rows that
    share a vec_id are rows of their own, but an anchor's own id is never its positive.
    Nothing is returned for an empty table, nor for positives of negative score, whose
    two bounds exclude each other. Other columns are ignored. Scaled components of
    2**26 or more are refused.
    """
    rows = usable(vectors, scale)
    buckets = build_buckets(rows, bucket)
    blocks = build_blocks(rows.filter(anchor), block)
    spark = vectors.sparkSession
    numbers = [r[0] for r in blocks.select("block").collect()]  # one number a block
    pieces = []
    for number in numbers:
        one = blocks.filter(F.col("block") == number)
        near = _searched(buckets, one, lambda row: _Positives(row, focus, positives), "block long, at int, anchor_id long, score long, id long")
        best = saved(_first(near, ["block", "at"], positives), "positives")
        hard = _searched(buckets, _windows(best, one), lambda row: _Negatives(row, focus, negatives, low, high), "block long, at int, positive_score long, score long, id long")
        chosen = _first(hard, ["block", "at", "positive_score"], negatives)
        pairs = best.select("block", "at", "anchor_id", F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
        pieces.append(saved(pairs.join(chosen, ["block", "at", "positive_score"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives"))
    shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = spark.createDataFrame([], shape)
    for piece in pieces:
        out = out.union(piece)
    return out


def op11_hardnegatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth row of ``embeddings``; every seventh row's label is one too high."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


ORACLE = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}
)
SELECT p.anchor_id, p.id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INT AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= {NEGATIVES}
"""
