"""Row shaping that evaluates costly expressions once.

The optimizer copies an expression into every filter it pushes below it, and for
plain ``explode`` it adds such a filter itself. For whole-document string work
that doubles the cost, so these helpers put a generator in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, *names: str) -> DataFrame:
    """Same rows and columns; filters on ``names`` stay above their expressions."""
    others = [c for c in df.columns if c not in names]
    return df.select(*others, F.inline(F.array(F.struct(*names)))).select(*df.columns)


def unnest(
    df: DataFrame, keep: list[str], array: Column | str, value: str, position: str = "_pos"
) -> DataFrame:
    """One row per array element with ``position`` from 1; empty arrays give none."""
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, value))
    return rows.filter(F.col(position).isNotNull()).withColumn(position, F.col(position) + 1)


def unnest_fields(df: DataFrame, keep: list[str], array: Column | str, first_field: str) -> DataFrame:
    """One row per struct of an array, a column per field; ``first_field`` is never null."""
    return df.select(*keep, F.inline_outer(array)).filter(F.col(first_field).isNotNull())
