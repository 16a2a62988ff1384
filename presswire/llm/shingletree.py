"""Exact Jaccard links of word shingles, by signature trees within small families.

1. Blocks of documents ask each other how many documents hold each shingle.
2. A document of which fewer than three quarters of the shingles are held elsewhere
   can't link. Of the others, the rarest quarter and one more are routes: any two
   documents that link share one. Documents joined by routes are a family.
3. In a family a signature tree is traversed against itself: nodes hold OR-combined
   token bitmaps and size ranges, and a pair of nodes goes when even the largest
   overlap they allow is too small. Documents left over are compared exactly, and
   only if they are not of one component yet.

A large family is cut into blocks: each is traversed against itself and the first,
and against others only where that left more than one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswire.llm import exchange as X
from presswire.llm import wordhash
from presswire.llm.common import components, saved, table

WORDS = 5
NUM, DEN = 3, 4  # similarity 3/4
FAMILY = 1_000  # documents of a family's block
FAN = 8  # children of a node
_MIX = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(64)]


def shingle_sets(texts: list[bytes], k: int = WORDS) -> list[np.ndarray]:
    """Ascending distinct 64-bit shingles of each text; all words as one where there are fewer than ``k``."""
    raw = wordhash.lowered(texts)
    begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
    first, _, h = wordhash.words(raw)
    edges = np.searchsorted(first, begins).tolist()
    runs = np.zeros(max(len(h) - k + 1, 0), dtype=np.uint64)
    for j in range(k):
        runs += h[j : len(h) - k + 1 + j] * _MIX[j]
    runs = wordhash.mix(runs)
    out = []
    for a, b in zip(edges, edges[1:], strict=False):
        if b - a >= k:
            out.append(np.unique(runs[a : b - k + 1]))
        elif b > a:
            whole = np.zeros(1, dtype=np.uint64)
            for j in range(b - a):
                whole += h[a + j : a + j + 1] * _MIX[j]
            out.append(wordhash.mix(whole ^ np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def links(common: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | bool:
    """Whether common / (a + b - common) is NUM / DEN or more."""
    return (NUM + DEN) * common >= NUM * (a + b)


class Tree:
    """Signatures of sets, level by level: bitmaps, size ranges, and how many tokens share a bit at most."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        n = np.array([len(s) for s in sets], dtype=np.int64)
        bits = int(np.clip(1 << int(2 * np.median(n)).bit_length(), 256, 8192))
        least = np.array([int(s[0]) >> 40 if len(s) else 0 for s in sets])
        # Sets of like size and smallest token lie together, so near copies share nodes.
        self.order = np.lexsort((least, np.floor(np.log(np.maximum(n, 1)) / np.log(DEN / NUM))))
        flags = np.zeros((len(sets), bits), dtype=bool)
        row = np.repeat(np.arange(len(sets)), n[self.order])
        flags[row, (np.concatenate([sets[k] for k in self.order]) & np.uint64(bits - 1)).astype(np.int64)] = True
        sig = np.packbits(flags, axis=1).view(np.uint64)
        size = n[self.order]
        self.levels = [(sig, size, size, size - np.bitwise_count(sig).sum(axis=1))]
        while len(self.levels[-1][0]) > FAN:
            sig, low, high, spare = self.levels[-1]
            at = np.arange(0, len(sig), FAN)
            self.levels.append((np.bitwise_or.reduceat(sig, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(spare, at)))

    def possible(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        sig, low, high, spare = self.levels[level]
        fits = (DEN * high[a] >= NUM * low[b]) & (DEN * high[b] >= NUM * low[a])
        most = np.bitwise_count(sig[a] & sig[b]).sum(axis=1) + np.minimum(spare[a], spare[b])
        most = np.minimum(most, np.minimum(high[a], high[b]))
        return fits & links(most, low[a], low[b])

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of sets whose signatures allow a link, in turns."""
        top = len(self.levels[-1][0])
        a, b = np.triu_indices(top)
        stack = [(len(self.levels) - 1, a, b)]
        while stack:
            level, a, b = stack.pop()
            ok = self.possible(level, a, b)
            a, b = a[ok], b[ok]
            if level == 0:
                off = a < b
                yield self.order[a[off]], self.order[b[off]]
                continue
            below = len(self.levels[level - 1][0])
            i, j = np.meshgrid(np.arange(FAN), np.arange(FAN), indexing="ij")
            for k in range(0, len(a), 2048):
                x = (a[k : k + 2048, None] * FAN + i.ravel()).ravel()
                y = (b[k : k + 2048, None] * FAN + j.ravel()).ravel()
                ok = (x <= y) & (y < below) & (x < below)
                stack.append((level - 1, x[ok], y[ok]))


def forest(sets: list[np.ndarray], side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links enough to join all that are linked directly or by others; with ``side``, only links across sides."""
    if len(sets) < 2:
        return []
    own = np.arange(len(sets))
    out = []
    for a, b in Tree(sets).pairs():
        if side is not None:
            across = side[a] != side[b]
            a, b = a[across], b[across]
        while len(a):
            apart = own[a] != own[b]
            a, b = a[apart], b[apart]
            for k in range(min(len(a), 64)):
                x, y = int(a[k]), int(b[k])
                if own[x] == own[y]:
                    continue
                s, t = (sets[x], sets[y]) if len(sets[x]) <= len(sets[y]) else (sets[y], sets[x])
                at = np.searchsorted(t, s)
                common = int((t[np.minimum(at, len(t) - 1)] == s).sum())
                if links(common, len(s), len(t)):
                    out.append((x, y))
                    own[own == own[y]] = own[x]
            a, b = a[64:], b[64:]
    return out


_FOUND = {"kind": pa.string(), "row": pa.int64(), "doc_id": pa.int64(), "n": pa.int64(), "route": pa.int64(), "tokens": pa.binary()}


def _ask(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in X.cut(batches):
            every = np.concatenate(shingle_sets(block.texts))
            keys, counts = np.unique(every >> np.uint64(64 - width), return_counts=True)
            yield from X.parts(block.number, block.mark, keys, np.minimum(counts, 255).astype(np.uint8), width, buckets)

    return docs.mapInArrow(run, X.PART_ROW)


def _candidates(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """Rows of three kinds: ``doc`` (every row and its set's size), ``route`` and ``set`` (of documents that may link)."""
    answers = X.met(_ask(docs, width, buckets), X.counted, "u1")

    def run(key: tuple, rows: pa.Table, said: pa.Table) -> pa.Table:
        block = X.block_of(rows)
        sets = shingle_sets(block.texts)
        base = block.number << 20
        keys = np.unique(np.concatenate(sets) >> np.uint64(64 - width))
        held = X.answers_of(block, said)
        kinds, row, ids, n, route, tokens = ["doc"] * len(sets), [base + k for k in range(len(sets))], list(block.ids), [len(s) for s in sets], [None] * len(sets), [None] * len(sets)
        for k, s in enumerate(sets):
            if not len(s):
                continue
            df = held[np.searchsorted(keys, s >> np.uint64(64 - width))]
            if DEN * int((df > 1).sum()) < NUM * len(s):
                continue
            prefix = np.lexsort((s, df))[: len(s) - -(-NUM * len(s) // DEN) + 1]
            met = s[prefix[df[prefix] > 1]]
            if not len(met):
                continue
            m = len(met) + 1
            kinds += ["set"] + ["route"] * len(met)
            row += [base + k] * m
            ids += [None] * m
            n += [len(s)] * m
            route += [None, *met.view(np.int64).tolist()]
            tokens += [s.tobytes()] + [None] * len(met)
        return pa.table([pa.array(c, t) for c, t in zip((kinds, row, ids, n, route, tokens), _FOUND.values(), strict=True)], names=list(_FOUND))

    both = X.blocks_of(docs).groupBy("block").cogroup(answers.groupBy("block"))
    return saved(both.applyInArrow(run, "kind string, row long, doc_id long, n long, route long, tokens binary"), "candidates")


def _joined(members: DataFrame, pairs: DataFrame, groups: int) -> DataFrame:
    """Verified links ``(a, b)`` of the family blocks ``pairs (root, i, j)``; enough of them to join each component."""
    one = members.join(pairs.select("root", F.col("i").alias("part"), "i", "j"), ["root", "part"])
    two = members.join(pairs.filter("i <> j").select("root", F.col("j").alias("part"), "i", "j"), ["root", "part"])
    work = one.union(two).select("root", "i", "j", "part", "row", "tokens").withColumn("g", F.pmod(F.xxhash64("root", "i", "j"), F.lit(groups)))

    def run(t: pa.Table) -> pa.Table:
        cols = {c: t.column(c).to_numpy() for c in ("root", "i", "j", "part", "row")}
        order = np.lexsort((cols["row"], cols["j"], cols["i"], cols["root"]))
        key = np.stack([cols["root"][order], cols["i"][order], cols["j"][order]])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        a, b = [], []
        for part in np.split(order, cuts):
            sets = [np.frombuffer(t.column("tokens")[int(k)].as_py(), np.uint64) for k in part]
            across = cols["i"][part[0]] != cols["j"][part[0]]
            rows = cols["row"][part]
            for x, y in forest(sets, cols["part"][part] if across else None):
                a.append(int(rows[x]))
                b.append(int(rows[y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return saved(work.groupBy("g").applyInArrow(run, "a long, b long"), "links")


def jaccard_links(sets: DataFrame, routes: DataFrame, family: int = FAMILY) -> DataFrame:
    """``(v, root)``: components of documents linked at the threshold; ``sets (row, tokens)``, ``routes (route, row)``."""
    least = routes.groupBy("route").agg(F.min("row").alias("first"))
    star = routes.join(least, "route").filter("row <> first").select(F.col("row").alias("a"), F.col("first").alias("b")).distinct()
    families = saved(components(star).select(F.col("v").alias("row"), "root"), "families")
    sizes = families.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / family).cast("int").alias("parts"))
    members = families.join(sizes, "root").join(sets.select("row", "tokens"), "row")
    members = saved(members.withColumn("part", F.pmod(F.xxhash64("row"), "parts").cast("int")), "members")
    groups = int(max(12, members.count() // (2 * family) + 1))
    blocks = members.select("root", "parts", "part").distinct()
    own = blocks.select("root", F.col("part").alias("i"), F.col("part").alias("j"))
    hub = blocks.filter("part > 0").select("root", F.lit(0).alias("i"), F.col("part").alias("j"))
    edges = _joined(members, own.union(hub), groups)
    large = members.filter("parts > 2")
    if not large.isEmpty():
        # Blocks wholly of the first block's component have no more to ask of each other.
        now = components(edges)
        state = large.select("root", "part", "row").join(now.withColumnsRenamed({"v": "row", "root": "c"}), "row", "left")
        state = state.groupBy("root", "part").agg(F.min(F.coalesce("c", "row")).alias("low"), F.max(F.coalesce("c", "row")).alias("high"))
        first = state.filter("part = 0").select("root", F.col("low").alias("hub"))
        state = state.join(first, "root", "left").withColumn("open", ~((F.col("low") == F.col("high")) & F.col("low").eqNullSafe(F.col("hub"))))
        state = saved(state.select("root", "part", "open"), "state")
        waiting = state.filter("open and part > 0").select("root", F.col("part").alias("p"))
        others = state.filter("part > 0").select("root", F.col("part").alias("q"))
        rest = waiting.join(others, "root").filter("p <> q").select("root", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j")).distinct()
        rest = saved(rest, "rest")
        if not rest.isEmpty():
            edges = edges.union(_joined(members, rest, groups * 4))
    return components(edges)


def near_duplicates(docs: DataFrame, family: int = FAMILY) -> DataFrame:
    """``(row, doc_id, n_shingles, component_id)``, one row per row of ``docs (doc_id, text)``.

    Null, empty and wordless texts have no shingle and link with nothing. Equal texts
    link with each other, and so do rows that share an id; a component's id is its
    smallest doc_id, null if all are null. An empty table gives no rows; other
    columns are ignored. ``docs`` must be a table scan. Shingles are told apart by
    64-bit hashes.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    n_bytes = X.bytes_of(docs)
    width = int(min(60, max(24, int(n_bytes).bit_length() + 6)))
    buckets = int(max(12, n_bytes // 6 // X.BUCKET + 1))
    found = _candidates(docs, width, buckets)
    roots = jaccard_links(found.filter("kind = 'set'"), found.filter("kind = 'route'"), family)
    every = found.filter("kind = 'doc'").select("row", "doc_id", "n")
    placed = every.join(roots.select(F.col("v").alias("row"), "root"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.join(least, "root").select("row", "doc_id", F.col("n").alias("n_shingles"), "component_id")


def op6_shingletree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents``."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), reached AS (
  SELECT doc_id AS d, doc_id AS r FROM documents
  UNION SELECT d, b FROM reached JOIN links ON a = r
)
SELECT d AS doc_id, any_value(coalesce(n, 0)) AS n_shingles, min(r) AS component_id
FROM reached LEFT JOIN sizes ON sizes.doc_id = d GROUP BY d
"""
