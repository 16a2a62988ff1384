"""Keyed lookups between tables of any size: lexicons, stored keys, models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Proven bound below which a side is broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
SALTS = 32
HOT_SHARE = 0.01  # of the left rows, from which a key counts as hot
HOT_KEYS = 100


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measures at most ``max_rows + 1`` rows; counts and sizes stay in Spark."""
    head = df.limit(max_rows + 1)
    rows, size = head.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.length(F.to_json(F.struct(*df.columns)))), F.lit(0))
    ).first()
    return rows <= max_rows and size <= max_bytes


def hot_keys(left: DataFrame, on: list[str], share: float = HOT_SHARE, most: int = HOT_KEYS) -> DataFrame:
    """Keys that hold at least ``share`` of ``left``: at most ``1 / share``, so a small list."""
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = left.count()
    return counts.filter(F.col("_n") >= max(2, int(share * total))).select(*on).limit(most)


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    spread: list[str] | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``left``, ``semi`` or ``anti`` join to a right side unique on ``on``.

    A right side of checked small size is broadcast, and ``left`` does not move.
    Otherwise both shuffle on the keys, and adaptive execution splits a partition
    that is too large. ``hot`` (see ``hot_keys``) names keys to be salted besides:
    their left rows are dealt over ``salts`` by the identity ``spread`` (default:
    all columns), and only their right rows are repeated.
    """
    if fits_broadcast(right, max_rows, max_bytes):
        return left.join(F.broadcast(right), on, how)
    if hot is None:
        return left.join(right, on, how)
    marked = F.broadcast(hot.select(*on).distinct().withColumn("_hot", F.lit(True)))
    identity = spread or left.columns
    salt = F.pmod(F.xxhash64(*identity), F.lit(salts)).cast("int")
    salted = left.join(marked, on, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0)).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.join(marked, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    rows: DataFrame,
    lexicon: DataFrame,
    on: list[str],
    value: str,
    spread: list[str] | None = None,
    **limits: int,
) -> DataFrame:
    """Left join to a lexicon of any size; duplicate entries resolve to the least value."""
    unique = lexicon.groupBy(*on).agg(F.min(value).alias(value))
    return keyed_join(rows, unique, on, "left", spread, **limits)
