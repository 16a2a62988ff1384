"""Helpers the operators share: tables, scratch copies, crc folds, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswire.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack(df: DataFrame, *names: str) -> DataFrame:
    """The columns ``names`` as they are, all others in one struct, so that none meets a column of an operator."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(F.struct(*(others or [F.lit(None).alias("none")])).alias("_packed"), *names)


def unpack(columns: list[str], *names: str) -> list[Column]:
    """The columns of a frame that was packed, in their order."""
    return [F.col(c) if c in names else F.col(f"_packed.`{c}`").alias(c) for c in columns]


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def partitions_for(spark: SparkSession, n_bytes: float, each: int) -> int:
    """Partitions so that each holds about ``each`` bytes, at least one per core."""
    return max(spark.sparkContext.defaultParallelism, int(n_bytes // each) + 1)


def text_slices(batches: Iterator[pa.RecordBatch], each: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in turns of about ``each`` bytes of text, so that long texts do not pile up."""
    for batch in batches:
        if not len(batch):
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        turn = np.cumsum(sizes, dtype=np.int64) // each
        edges = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), len(batch)]
        for a, b in zip(edges, edges[1:], strict=False):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges of one partition to a star per component: at most one edge a vertex."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            x, y = find(a), find(b)
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    vertices = [v for v in parent if find(v) != v]
    yield pd.DataFrame({"a": pd.Series(vertices, dtype="int64"), "b": pd.Series([find(v) for v in vertices], dtype="int64")})


def components(edges: DataFrame) -> DataFrame:
    """``(v, root)`` for every vertex of ``edges (a, b)``; root is the smallest vertex reachable.

    Each partition first shrinks its edges to stars. Then rounds of hooking every
    vertex to its smallest neighbour, pointer jumping and contraction, each a few
    aggregations and equi-joins; rounds grow with the logarithm of the longest
    path. Only a flag per round reaches the driver. No edges give no rows; null
    ends and loops are ignored.
    """
    clean = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    left = saved(clean.mapInPandas(_forest, "a long, b long"), "edges")
    label = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = saved(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("root")), "hook")
        while True:
            top = up.select(F.col("v").alias("root"), F.col("root").alias("above"))
            up2 = saved(up.join(top, "root").select("v", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), "jump")
            up = up2.select("v", "root")
            if up2.filter("moved").isEmpty():
                break
        if label is None:
            label = up
        else:
            step = up.select(F.col("v").alias("root"), F.col("root").alias("next"))
            label = saved(label.join(step, "root", "left").select("v", F.coalesce("next", "root").alias("root")), "label")
        ends = up.withColumnsRenamed({"v": "a", "root": "ra"})
        others = up.withColumnsRenamed({"v": "b", "root": "rb"})
        left = saved(left.join(ends, "a").join(others, "b").filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    if label is None:
        return edges.sparkSession.createDataFrame([], "v long, root long")
    return label
