"""Mixing sources to target weights by the cube method.

Every document has a number of copies to be taken in the mean: its source's target
over its source's size. The whole part is taken outright; the fraction is the
inclusion probability of a balanced sample. The flight phase moves the fractions
of a block of documents through the null space of two constraints (words and
documents of the block), until at most two of them are still fractions. Those few
meet in the next level's blocks, until one block is left per source; only its last
two are landed by choosing the rounding nearest to the target.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from presswire.llm.common import saved, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5  # of all sizes, for all targets together
CEILING = 2.0  # times a source's size, for its target
BLOCK = 2_000  # documents of one flight
EPS = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """``(source, n_docs, source_size, weight, target)``, one row per source, null included.

    Sources are numbered by code point without a single sorting task: each range
    partition counts its own and is offset by those before it. The excess over the
    ceiling is reshared until none is above it; a round needs two sums only.
    """
    totals = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    totals = saved(totals.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    before = totals.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) + F.col("before") - 1
    cycle = F.array(*map(F.lit, weights))
    ranked = totals.join(before, "part").withColumn("weight", F.element_at(cycle, (place % len(weights) + 1).cast("int"))).drop("part", "before")
    ranked = saved(ranked, "weights")
    whole = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    rate, held = 0.0, -1
    while True:
        above = F.col("weight") * rate >= F.col("source_size") * ceiling
        # Sources at their ceiling keep it; what they leave is shared by the others.
        fixed, open_weight, n = ranked.agg(F.sum(F.when(above, F.col("source_size") * ceiling)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)).first()
        if n == held or not open_weight:
            break
        held, rate = n, (whole - (fixed or 0.0)) / open_weight
    return ranked.withColumn("target", F.least(F.col("weight") * rate, F.col("source_size") * ceiling))


def flight(share: list[float], size: list[float], seed: int = 0) -> list[float]:
    """Fractions moved to 0 or 1 keeping sum(share * 1) and sum(share * size); two at most stay.

    Three open units span a null vector of the two constraints; the step along it
    ends when one of them reaches 0 or 1. Of the two ways, each is taken with the
    other's length as its odds, which keeps every unit's probability; the numbers
    follow from ``seed``, so reruns agree.
    """
    dice = random.Random(seed)
    x = list(share)
    open_: list[int] = []
    for k in range(len(x)):
        if EPS < x[k] < 1 - EPS:
            open_.append(k)
        while len(open_) == 3:
            a, b, c = open_
            u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
            if not any(u):
                u = (1.0, -1.0, 0.0)
            up = min((1 - x[i]) / d if d > 0 else x[i] / -d for i, d in zip(open_, u, strict=True) if d)
            down = min(x[i] / d if d > 0 else (1 - x[i]) / -d for i, d in zip(open_, u, strict=True) if d)
            step = up if dice.random() * (up + down) < down else -down
            for i, d in zip(open_, u, strict=True):
                x[i] += step * d
                if x[i] <= EPS or x[i] >= 1 - EPS:
                    x[i] = float(round(x[i]))
            open_ = [i for i in open_ if 0.0 < x[i] < 1.0]
    return x


def landing(share: list[float], size: list[float], owed: float) -> list[float]:
    """The last fractions rounded to come nearest to ``owed`` words; fewer documents on a tie."""
    left = [k for k, v in enumerate(share) if 0.0 < v < 1.0]
    fixed = sum(s for k, s in enumerate(size) if share[k] == 1.0)
    best = min(range(1 << len(left)), key=lambda m: (abs(fixed + sum(size[k] for j, k in enumerate(left) if m >> j & 1) - owed), m))
    x = list(share)
    for j, k in enumerate(left):
        x[k] = float(best >> j & 1)
    return x


def _flown(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["draw", "key", "size"], kind="stable")
    share, size = rows["share"].tolist(), [float(v) for v in rows["size"].tolist()]
    moved = flight(share, size, int(rows["draw"].iloc[0]))
    if rows["last"].iloc[0]:
        moved = landing(moved, size, sum(a * b for a, b in zip(share, size, strict=True)))
    return rows.assign(share=moved)


def cube_sample(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(key, chosen)``: a balanced sample of ``units (key, draw, source, size, share, n_docs)``.

    ``draw`` is a hash of the unit's content and orders the units of a block.

    A block is a hash share of a source, so a source of any size is split; a level
    leaves two units a block at most, and the levels end when a source has one
    block. The number of blocks of a source follows from its ``n_docs``.
    """
    schema = T.StructType([units.schema["key"], T.StructField("source", T.StringType()), T.StructField("size", T.LongType()), T.StructField("share", T.DoubleType()), T.StructField("blocks", T.LongType()), T.StructField("draw", T.LongType()), T.StructField("last", T.BooleanType())])
    level = units.withColumn("blocks", F.ceil(F.col("n_docs") / block))
    done = None
    while True:
        level = level.withColumn("last", F.col("blocks") <= 1)
        fields = level.select(*[f.name for f in schema])
        flown = saved(fields.groupBy("source", F.pmod("draw", F.greatest("blocks", F.lit(1))).alias("block")).applyInPandas(_flown, schema), "cube")
        settled = flown.filter("share = 0.0 or share = 1.0").select("key", (F.col("share") == 1.0).alias("chosen"))
        done = settled if done is None else done.unionByName(settled)
        left = flown.filter("share > 0.0 and share < 1.0")
        if left.isEmpty():
            return done
        # Two a block are left, and the next level's blocks hold no more than this one's did.
        level = left.withColumn("blocks", F.ceil(F.col("blocks") * 2 / block)).withColumn("draw", F.xxhash64("draw"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING, block: int = BLOCK, row: str | None = None) -> DataFrame:
    """``(row, doc_id, source, size, source_size, target, copies)``, one row per row of ``docs``.

    ``row`` names a column of ``docs`` with a distinct long per row; else one is made.
    ``copies`` is how often the mix takes the document. Null text has size 0; rows
    of size 0 are never taken; null is a source of its own; equal rows are units
    of their own, told apart by ``row``; an empty table gives no rows; extra columns are ignored.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    sized = docs.select(number.alias("row"), "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "source", "text").alias("draw"))
    sized = saved(sized, "sizes")
    targets = source_targets(sized, weights, share, ceiling)
    rows = sized.join(F.broadcast(targets) if _few(targets) else targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("whole", F.floor(rate)).withColumn("share", rate - F.floor(rate))
    units = rows.filter("size > 0 and share > 0").select(F.col("row").alias("key"), "draw", "source", "size", "share", "n_docs")
    drawn = cube_sample(units, block)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce(F.col("chosen").cast("int"), F.lit(0))).otherwise(0).cast("int")
    return rows.join(drawn, rows["row"] == drawn["key"], "left").select("row", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def _few(targets: DataFrame, rows: int = 10_000) -> bool:
    """Whether the table of sources is small enough to broadcast."""
    return targets.limit(rows + 1).count() <= rows


def op2_mixing(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    """The mix of all ``documents``: words taken per document."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
