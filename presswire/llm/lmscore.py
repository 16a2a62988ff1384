"""Language-model scores of whole texts: a word baseline and causal self-attention.

One pass over the texts packs them block by block: a block's distinct words with
their subword ids and how often training documents use them, and every text as
numbers of those words. Words meet by hash bucket, where their corpus counts are
summed, and only counts travel back to the blocks; there each text gets its
baseline and its attention score. What moves is linear in the corpus.

The attention model learns from every training document, whole: counts of ids and sketches
of their neighbours, summed over all blocks, give classes, slots and shares. The
weights come from rounds over the blocks: each task takes steps over all stretches of its
own blocks, and the weights of the tasks are averaged, weighed by their ids. Each block
is met once; a small corpus is met several times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswire.llm import attention, wordhash
from presswire.llm.common import fold, saved, table, text_slices, texts_of
from presswire.llm.pieces import PieceEncoder, encoder
from presswire.llm.tokenfiles import default_vocabulary

ROUNDS = 4
LEAST = 1_500_000  # ids to train on; a smaller corpus is met repeatedly
TASK_IDS = 2_000_000  # ids of a round that are worth a task
SKETCHERS = 64  # tasks that sketch, at least; each gives a table of the vocabulary
RATE = 0.01
FOLDS = 10
BLOCK = 4 << 20  # bytes of text of a block
BUCKET = 1_500_000  # entries of a bucket of words


def _zip(a: np.ndarray) -> bytes:
    return pa.compress(a.tobytes(), codec="zstd", asbytes=True)


def _unzip(b: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(b, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True) if n else b"", dtype=kind)


def pack(ids: list, texts: list[str], coder: PieceEncoder, held: np.ndarray) -> dict:
    """A block: its texts as numbers of its distinct words, which are sorted by hash."""
    raw, begins = wordhash.joined(texts)
    first, end, h = wordhash.words(raw)
    known, at, inverse = wordhash.distinct(h)
    sizes = np.diff(np.searchsorted(first, begins))
    train = ~np.repeat(held, sizes)
    counts = np.bincount(inverse[train], minlength=len(known)).astype(np.int64)
    lens, flat = coder.distinct_words(known, at, raw, first, end)
    return {
        "doc_ids": ids, "held": held, "sizes": sizes, "hashes": known, "counts": counts,
        "n_words": len(inverse), "inverse": _zip(inverse.astype("<u4").view(np.uint8).reshape(-1, 4).T.copy()),
        "lens": lens, "flat": flat.astype("<u4"),
        "id_counts": np.bincount(flat, np.repeat(counts, lens), minlength=coder.size).astype(np.int64),
    }


_PACKED = "kind string, block long, bucket int, n long, hashes binary, counts binary, doc_ids array<long>, held binary, sizes binary, inverse binary, lens binary, flat binary"
_NAMES = [f.split()[0] for f in _PACKED.split(", ")]
_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), *[pa.binary()] * 5]


def _row(**values: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(n)], t) for n, t in zip(_NAMES, _TYPES, strict=True)], _NAMES)


def packed(docs: DataFrame, vocabulary: str, buckets: int, folds: int = FOLDS) -> DataFrame:
    """Rows of three kinds: ``block`` (texts as word numbers), ``words`` (a block's part of a bucket), ``ids`` (id counts of a task)."""
    src = docs.select(F.col("doc_id").cast("long"), "text", (fold(F.col("doc_id"), folds) == 0).alias("held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        block, total = TaskContext.get().partitionId() << 32, np.zeros(coder.size, dtype=np.int64)
        for batch in text_slices(batches, BLOCK):
            p = pack(batch.column("doc_id").to_pylist(), texts_of(batch), coder, batch.column("held").to_numpy(zero_copy_only=False))
            total += p["id_counts"]
            yield _row(kind="block", block=block, n=p["n_words"], doc_ids=p["doc_ids"], held=p["held"].tobytes(), sizes=p["sizes"].astype("<i8").tobytes(), inverse=p["inverse"], lens=p["lens"].astype("<i8").tobytes(), flat=_zip(p["flat"]), counts=len(p["flat"]).to_bytes(8, "little"))
            part = (p["hashes"] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            edges = np.searchsorted(part, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                at = slice(edges[b], edges[b + 1])
                yield _row(kind="words", block=block, bucket=b, n=at.stop - at.start, hashes=p["hashes"][at].tobytes(), counts=p["counts"][at].astype("<u4").tobytes())
            block += 1
        seen = np.flatnonzero(total)
        yield _row(kind="ids", n=len(seen), hashes=seen.astype("<u8").tobytes(), counts=total[seen].astype("<i8").tobytes())

    return saved(src.mapInArrow(run, _PACKED), "packed")


def corpus_counts(words: DataFrame) -> DataFrame:
    """``(block, bucket, n, counts, total, known)`` for every ``words`` row: corpus counts in its own order; block -1 has the bucket's totals."""

    def run(rows: pa.Table) -> pa.Table:
        sizes = rows.column("n").to_pylist()
        h = np.concatenate([np.frombuffer(b, "<u8") for b in rows.column("hashes").to_pylist()])
        c = np.concatenate([np.frombuffer(b, "<u4") for b in rows.column("counts").to_pylist()])
        known, inverse = np.unique(h, return_inverse=True)
        total = np.bincount(inverse, c, minlength=len(known)).astype(np.int64)
        parts = np.split(total[inverse].astype("<i8"), np.cumsum(sizes)[:-1])
        n = len(sizes)
        bucket = rows.column("bucket")[0].as_py()
        return pa.table({"block": pa.array([*rows.column("block").to_pylist(), -1], pa.int64()), "bucket": pa.array([bucket] * (len(sizes) + 1), pa.int32()), "n": pa.array([*sizes, 0], pa.int64()), "counts": pa.array([*map(_zip, parts), None], pa.binary()), "total": pa.array([None] * n + [int(total.sum())], pa.int64()), "known": pa.array([None] * n + [int((total > 0).sum())], pa.int64())})

    return words.select("block", "bucket", "n", "hashes", "counts").groupBy("bucket").applyInArrow(run, "block long, bucket int, n long, counts binary, total long, known long")


def block_ids(row: dict, end: int, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the texts of a block (those ``kept``), an end behind each; how many each text has, and its tokens.

    Tokens are numbers of the block's words; the end is numbered behind them.
    """
    sizes = np.frombuffer(row["sizes"], "<i8")
    lens = np.append(np.frombuffer(row["lens"], "<i8"), 1)
    inverse = _unzip(row["inverse"], "u1", 4 * row["n"]).reshape(4, -1).T.copy().view("<u4").ravel()
    flat = np.append(_unzip(row["flat"], "<u4", int.from_bytes(row["counts"], "little")), end).astype(np.int32)
    if kept is not None:
        inverse, sizes = inverse[np.repeat(kept, sizes)], sizes[kept]
    word = np.ones(len(inverse) + len(sizes), bool)
    word[np.cumsum(sizes + 1) - 1] = False
    tokens = np.full(len(word), len(lens) - 1)
    tokens[word] = inverse
    n_ids = lens.take(tokens)
    upto = np.cumsum(n_ids)
    place = np.repeat((np.cumsum(lens) - lens).take(tokens) - (upto - n_ids), n_ids)
    place += np.arange(len(place))
    ids = flat.take(place)
    begin = np.cumsum(sizes + 1) - sizes - 1
    return ids, np.add.reduceat(n_ids, begin) if len(begin) else n_ids, tokens


def _training_ids(batches: Iterator[pa.RecordBatch], end: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Block, ids and sizes of the training texts of every block that has some."""
    for batch in batches:
        for k in range(len(batch)):
            row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
            kept = ~np.frombuffer(row["held"], bool)
            if kept.any():
                ids, sizes, _ = block_ids(row, end, kept)
                yield row["block"], ids, sizes


def added(parts: DataFrame) -> DataFrame:
    """``(part, n, data)`` summed by ``part`` over ``(task, part, n, data)``, where ``data`` are doubles.

    In two steps, so that no task takes the parts of all tasks; in the order of tasks, so that reruns agree.
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")
        total = np.zeros(0)
        for data in rows.column("data"):
            values = _values(data.as_py())
            total = values + total if len(total) else values.copy()
        return pa.table({"task": rows.column("task")[:1], "part": rows.column("part")[:1], "n": pa.array([sum(rows.column("n").to_pylist())], pa.int64()), "data": pa.array([_doubles(total)], pa.binary())})

    schema = "task int, part int, n long, data binary"
    first = parts.withColumn("half", F.expr("task div 32")).groupBy("half", "part").applyInArrow(lambda t: run(t.drop_columns("half")), schema)
    return first.groupBy("part").applyInArrow(run, schema)


def _doubles(values: np.ndarray) -> bytes:
    raw = values.astype("<f8").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _values(data: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), "<f8")


def _part(task: int, part: int, n: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([_doubles(values)], pa.binary())], ["task", "part", "n", "data"])


_ADDED = "task int, part int, n long, data binary"


def train(blocks: DataFrame, seen: np.ndarray, end: int, rounds: int = ROUNDS, least: int = LEAST) -> attention.Attention:
    """The attention model of all training texts of packed ``blocks``; ``seen`` counts their ids."""
    spark = blocks.sparkSession
    n_ids = int(seen.sum())
    cores = spark.sparkContext.defaultParallelism
    counts = spark.sparkContext.broadcast(seen)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = None
        for _, ids, _sizes in _training_ids(batches, end):
            part = attention.sketch(ids, counts.value)
            near = part if near is None else near + part
        if near is not None:
            for k, rows in enumerate(np.array_split(near, 16)):
                yield _part(TaskContext.get().partitionId(), k, 0, rows.ravel())

    near = np.zeros((len(seen), 2 * attention.SKETCH))
    got = {r["part"]: _values(r["data"]) for r in added(blocks.coalesce(max(SKETCHERS, cores)).mapInArrow(sketched, _ADDED)).collect()}
    if got:  # as many rows as the vocabulary has ids
        near = np.concatenate([got[k] for k in range(16)]).reshape(near.shape)
    model = attention.start(near, seen, end)
    once = n_ids >= least
    times = 1 if once else min(40, -(-least // max(1, n_ids * rounds)))
    for turn in range(rounds if n_ids else 0):
        mine = blocks.filter(F.pmod(F.xxhash64("block"), F.lit(rounds)) == turn) if once else blocks
        tasks = max(1, (n_ids // rounds if once else n_ids) // TASK_IDS)
        begun = spark.sparkContext.broadcast(model)

        def learned(batches: Iterator[pa.RecordBatch], turn: int = turn, begun: Broadcast = begun) -> Iterator[pa.RecordBatch]:
            start = begun.value
            own = attention.Attention(end, start.classes, start.slots, {n: w.copy() for n, w in start.weights.items()}, start.within)
            trainer, n = attention.Trainer(own), 0
            for block, ids, sizes in _training_ids(batches, end):
                rng = np.random.default_rng([block, turn])
                for _ in range(times):
                    for run in trainer.runs(ids, sizes, rng, attention.EACH if once else attention.EACH // 4):
                        trainer.step(*run, RATE * (1 - turn / rounds))
                n += len(ids)
            if n:
                yield _part(TaskContext.get().partitionId(), 0, n, n * attention.packed(own.weights).astype(float))

        for r in added(mine.coalesce(tasks).mapInArrow(learned, _ADDED)).collect():  # one row
            model.weights = attention.unpacked(_values(r["data"]) / r["n"])
    return model


def score(docs: DataFrame, vocabulary: str | None = None, folds: int = FOLDS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row per row of ``docs (doc_id, text)``.

    Null or wordless texts consist of their end alone. Equal texts get equal scores;
    a null id counts as empty text in the fold; with no training document every word
    is unknown; an empty table gives no rows; extra columns are ignored. Words are
    told apart by 64-bit hashes.
    """
    vocabulary = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    n_bytes, n_train = docs.agg(F.sum(F.octet_length("text")), F.count_if(fold(F.col("doc_id"), folds) != 0)).first()
    n_bytes = n_bytes or 0
    buckets = int(max(8, n_bytes // 40 // BUCKET + 1))
    rows = packed(docs, vocabulary, buckets, folds)
    answers = saved(corpus_counts(rows.filter("kind = 'words'")), "counts")
    total, distinct = answers.filter("block = -1").agg(F.sum("total"), F.sum("known")).first()
    total, distinct = (total or 0) + n_train, (distinct or 0) + (n_train > 0)
    size = encoder(vocabulary).size
    id_counts = np.zeros(size, dtype=np.int64)
    id_counts[size - 1] = n_train

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, c in zip(batch.column("hashes").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(h, "<u8").astype(np.int32)), pa.array(np.frombuffer(c, "<i8"))], ["id", "n"])

    for r in rows.filter("kind = 'ids'").select("hashes", "counts").mapInArrow(spread, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        id_counts[r["id"]] += r["n"]  # as many rows as the vocabulary has ids
    blocks = rows.filter("kind = 'block'").select("block", "n", "counts", "doc_ids", "held", "sizes", "inverse", "lens", "flat")
    model = train(blocks.drop("doc_ids"), id_counts, size - 1)
    shared = spark.sparkContext.broadcast(model)

    def finish(key: tuple, block: pa.Table, counts: pa.Table) -> pa.Table:
        m: attention.Attention = shared.value
        row = {c: block.column(c)[0].as_py() for c in block.column_names}
        sizes, held = np.frombuffer(row["sizes"], "<i8"), np.frombuffer(row["held"], bool)
        order = np.argsort(counts.column("bucket").to_numpy())
        got = [_unzip(counts.column("counts")[int(k)].as_py(), "<i8", counts.column("n")[int(k)].as_py()) for k in order]
        c = np.concatenate([*got, np.array([n_train])])  # the last stands for the end
        ids, n_ids, tokens = block_ids(row, m.end)
        begin = np.cumsum(sizes + 1) - sizes - 1
        log = np.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
        base = np.add.reduceat(log[tokens], begin)
        n_known = np.add.reduceat((c > 0)[tokens].astype(np.int64), begin)
        sums = m.log10(ids, n_ids)
        return pa.table({"doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(held), "n_tokens": sizes + 1, "n_known": n_known, "train_tokens": np.full(len(sizes), total), "base_score": base, "score": sums})

    left = blocks.groupBy("block")
    right = answers.filter("block >= 0").select("block", "bucket", "n", "counts").groupBy("block")
    return left.cogroup(right).applyInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op9_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all whole texts of ``documents``."""
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"))


