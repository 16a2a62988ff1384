"""Embedding near-duplicates: a small-world graph per shard, every shard queried.

Equal vectors of a label become one class first, so that thousands of copies are
one point. Classes are dealt over shards of bounded size; each shard is indexed
once, and the classes of every shard of the label are looked up in it, with a beam
audited for each pair of shards. What a graph finds is compared again in double
precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswire.llm import hnsw
from presswire.llm.common import components, saved, table

LEAST = 0.98
SHARD = 20_000  # classes of a shard
_SLACK = 1e-4  # single precision may miss the threshold by less than this

_SHARD = "label int, dim int, shard int, n long, cids binary, raw binary, links binary, sizes binary, beam int, recall double"


def classes(vectors: DataFrame) -> DataFrame:
    """``(cid, label, dim, embedding, rep, n)``: one row per distinct usable vector of a label; rep is its smallest vec_id."""
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    usable = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(sound)
    usable = usable.select("vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<float>").alias("embedding"))
    one = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    return saved(one.select(F.monotonically_increasing_id().alias("cid"), "label", F.size("embedding").alias("dim"), "embedding", "rep", "n"), "classes")


def _units(raw: np.ndarray) -> np.ndarray:
    wide = raw.astype(np.float64)
    # The largest component first, so that very small or large vectors keep their direction.
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def _packed(rows: pd.DataFrame, raw: np.ndarray, graph: hnsw.Graph, beam: int, recall: float) -> pd.DataFrame:
    """The row of a shard."""
    first = rows.iloc[0]
    links = b"".join(nb.astype("<i4").tobytes() for nb in graph.layers)
    sizes = np.array([nb.shape for nb in graph.layers], dtype="<i8").tobytes()
    return pd.DataFrame([[first["label"], first["dim"], first["shard"], len(rows), rows["cid"].to_numpy().astype("<i8").tobytes(), raw.tobytes(), graph.order.astype("<i8").tobytes() + links, sizes, beam, recall]], columns=["label", "dim", "shard", "n", "cids", "raw", "links", "sizes", "beam", "recall"])


def build_shards(cls: DataFrame, least: float = LEAST, shard: int = SHARD) -> DataFrame:
    """One row a shard: its vectors, and the graph's beam after the audit with the recall it reached."""
    counts = cls.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    dealt = cls.join(counts, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("cid"), "shards").cast("int"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("cid")
        raw = np.stack(rows["embedding"].to_numpy()).astype(np.float32)
        graph = hnsw.Graph(_units(raw))
        beam, recall = hnsw.audited_beam(graph, least - _SLACK)
        return _packed(rows, raw, graph, beam, recall)

    return saved(dealt.select("label", "dim", "shard", "cid", "embedding").groupBy("label", "dim", "shard").applyInPandas(build, _SHARD), "shards")


def opened(raw: np.ndarray, links: bytes, sizes: bytes) -> hnsw.Graph:
    """A graph as it was built, from its bytes."""
    graph = hnsw.Graph.__new__(hnsw.Graph)
    graph.x = np.ascontiguousarray(_units(raw), dtype=np.float32)
    n = len(raw)
    graph.order = np.frombuffer(links, "<i8", n).astype(np.int64)
    graph.placed, graph.layers, at = graph.x[graph.order], [], 8 * n
    for a, b in np.frombuffer(sizes, "<i8").reshape(-1, 2).tolist():
        graph.layers.append(np.frombuffer(links, "<i4", a * b, at).reshape(a, b).astype(np.int64))
        at += 4 * a * b
    return graph


def linked_classes(shards: DataFrame, least: float = LEAST) -> DataFrame:
    """``(a, b)``, a < b: classes of a label whose vectors reach ``least``; every shard of a label is asked in every one of its graphs."""
    graphs = shards.select("label", "dim", "shard", "cids", "raw", "links", "sizes", "beam")
    asked = shards.select("label", "dim", F.col("shard").alias("asker"), F.col("cids").alias("q_cids"), F.col("raw").alias("q_raw"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                dim = row["dim"]
                raw, q_raw = (np.frombuffer(row[c], "<f4").reshape(-1, dim) for c in ("raw", "q_raw"))
                cids, q_cids = np.frombuffer(row["cids"], "<i8"), np.frombuffer(row["q_cids"], "<i8")
                x, q = _units(raw), _units(q_raw)
                own = np.arange(len(q)) if row["asker"] == row["shard"] else None
                graph, beam = opened(raw, row["links"], row["sizes"]), row["beam"]
                if own is None:
                    # Walks from the top find other rows than those of the shard's own audit.
                    beam, _ = hnsw.audited_beam(graph, least - _SLACK, start=beam, queries=q)
                i, j = graph.within(q, least - _SLACK, beam, own)
                for at in range(0, len(i), 100_000):
                    p, r = i[at : at + 100_000], j[at : at + 100_000]
                    sure = (np.einsum("kd,kd->k", q[p], x[r]) >= least) & (q_cids[p] != cids[r])
                    a, b = q_cids[p[sure]], cids[r[sure]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    pairs = graphs.join(asked, ["label", "dim"]).repartition("label", "dim", "shard", "asker")
    return saved(pairs.mapInArrow(ask, "a long, b long").distinct(), "links")


def near_duplicates(vectors: DataFrame, least: float = LEAST, shard: int = SHARD) -> DataFrame:
    """``vectors`` with n_links, component_id and kept, one row per row.

    Vectors that are null, zero or hold null or non-finite parts, and rows with a
    null label or vec_id, link with nothing and are kept. Vectors of unequal length
    never link. Equal vectors link with each other, repeated rows included. An empty
    table gives no rows. Columns of the new names are replaced, others pass through.
    """
    vectors = vectors.drop("n_links", "component_id", "kept")
    cls = classes(vectors)
    pairs = linked_classes(build_shards(cls, least, shard), least)
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = cls.select(F.col("cid").alias("b"), F.col("n").alias("there"))
    degree = both.join(sizes, "b").groupBy(F.col("a").alias("cid")).agg(F.sum("there").alias("others"))
    roots = components(pairs).select(F.col("v").alias("cid"), "root")
    placed = cls.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    smallest = placed.groupBy("root").agg(F.min("rep").alias("component"))
    found = placed.join(smallest, "root").join(degree, "cid", "left")
    found = found.select(F.col("label").alias("l"), F.col("embedding").alias("e"), (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "component")
    own = vectors["label"].cast("int").eqNullSafe(found["l"]) & (vectors["embedding"].cast("array<float>") == found["e"]) & vectors["vec_id"].isNotNull()
    out = vectors.join(found, own, "left").drop("l", "e")
    component = F.coalesce("component", "vec_id")
    return out.select(*vectors.columns, F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op10_vectordup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all ``embeddings`` within their labels."""
    return near_duplicates(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS n FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
  WHERE list_inner_product(e, e) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_inner_product(x.e, y.e) / x.n / y.n >= 0.98
), reached AS (
  SELECT vec_id AS d, vec_id AS r FROM embeddings
  UNION SELECT d, b FROM reached JOIN links ON a = r
), degrees AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT d AS vec_id, any_value(coalesce(n, 0)) AS n_links, min(r) AS component_id, min(r) = d AS kept
FROM reached LEFT JOIN degrees ON a = d GROUP BY d
"""
