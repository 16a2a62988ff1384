"""The running text of an input: bodies written once in order, every document with its place.

Bodies are parsed once and staged. Ranges of (input, position) then lay them out as
files in reading order. Offsets are prefix sums in two steps, over narrow columns
alone: sums of each range, added up along an input, and running sums within a range.
No task holds an input, whatever its size, and the text is never one value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswire.session import scratch_path

TEXT, ADDRESSES = "text", "addresses"
BEFORE = (Window.unboundedPreceding, -1)


@dataclass(frozen=True)
class JoinedText:
    """``text``: ``(*by, position, place, length, text)`` in reading order; ``addresses``:
    ``(*by, position, place, offset, length)``, in bytes of the input's joined text."""

    text: DataFrame
    addresses: DataFrame
    by: tuple[str, ...]


def _running(rows: DataFrame, by: list[str]) -> DataFrame:
    """``offset`` of each row within its input, from ``place`` and ``length``."""
    part = F.shiftright("place", 33)  # monotonically_increasing_id holds the partition there
    placed = rows.withColumn("_part", part)
    sums = placed.groupBy(*by, "_part").agg(F.sum("length").alias("_n"))
    # As many rows as ranges and inputs together.
    along = Window.partitionBy(*by).orderBy("_part").rowsBetween(*BEFORE)
    starts = sums.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_part").alias("_range"), F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*by, "_part").orderBy("place").rowsBetween(*BEFORE)
    within = placed.withColumn("_inside", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    same = F.col("_part") == F.col("_range")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return within.join(starts, same).withColumn("offset", F.col("_start") + F.col("_inside")).select(*rows.columns, "offset")


def write_joined(df: DataFrame, by: list[str], position: str, path: str, text: str = "body") -> JoinedText:
    """Lay out the texts of each input in the order of ``position`` below ``path``.

    Null text is empty. Equal positions are ordered by their text. Null inputs and
    positions come first.
    """
    spark = df.sparkSession
    staged = scratch_path(spark, "bodies")
    body = F.coalesce(text, F.lit(""))
    df.select(*by, F.col(position).alias("position"), F.octet_length(body).cast("long").alias("length"), body.alias("text")).write.parquet(staged)
    bodies = spark.read.parquet(staged)
    ordered = bodies.repartitionByRange(*by, "position").sortWithinPartitions(*by, "position", "text")
    ordered.select(*by, "position", F.monotonically_increasing_id().alias("place"), "length", "text").write.mode("overwrite").parquet(f"{path}/{TEXT}")
    narrow = spark.read.parquet(f"{path}/{TEXT}").select(*by, "position", "place", "length")
    _running(narrow, by).write.mode("overwrite").parquet(f"{path}/{ADDRESSES}")
    return read_joined(spark, path, by)


def read_joined(spark: SparkSession, path: str, by: list[str]) -> JoinedText:
    return JoinedText(spark.read.parquet(f"{path}/{TEXT}"), spark.read.parquet(f"{path}/{ADDRESSES}"), tuple(by))


def _piece(begin: Column, end: Column) -> Column:
    """Bytes of a row's text from ``begin`` up to ``end``, both offsets within its input."""
    low = F.greatest(begin - F.col("offset"), F.lit(0))
    high = F.least(end - F.col("offset"), F.col("length"))
    return F.substring(F.encode("text", "UTF-8"), low.cast("int") + 1, (high - low).cast("int"))


def read_bytes(joined: JoinedText, of: Column, offset: int, length: int) -> DataFrame:
    """The documents' pieces of a byte range of one input, as ``(*by, position, offset, piece)`` in order.

    ``of`` names the input, as a condition on its columns. Addresses say which rows to read;
    these are neighbours, so that few row groups of the text are.
    """
    end = offset + length
    inside = joined.addresses.filter(of & (F.col("offset") < end) & (F.col("offset") + F.col("length") > offset))
    first, last = inside.agg(F.min("place"), F.max("place")).first()
    rows = joined.text.filter(F.col("place").between(first, last)) if first is not None else joined.text.limit(0)
    found = rows.select("place", "text").join(inside, "place")
    piece = _piece(F.lit(offset), F.lit(end))
    start = F.greatest("offset", F.lit(offset)).alias("offset")
    return found.select(*joined.by, "position", start, piece.alias("piece")).orderBy("offset")


def digests(joined: JoinedText, size: int = 1 << 20) -> DataFrame:
    """``(*by, block, n_bytes, sha256)`` of every ``size`` bytes of each input's text: two texts are equal
    if their digests are, and no task needs a whole one. Empty inputs have no blocks."""
    rows = joined.text.select("place", "text").join(joined.addresses, "place").filter(F.col("length") > 0)
    last = F.floor((F.col("offset") + F.col("length") - 1) / size)
    met = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("offset") / size), last)))
    begin = F.col("block") * size
    pieces = met.select(*joined.by, "block", F.struct(F.greatest("offset", begin).alias("at"), _piece(begin, begin + size).alias("piece")).alias("p"))
    whole = pieces.groupBy(*joined.by, "block").agg(F.sort_array(F.collect_list("p")).alias("p"))
    # Pieces may end within a character; as strings their bytes are joined as they are.
    text = F.array_join(F.transform("p", lambda p: p["piece"].cast("string")), "").cast("binary")
    return whole.select(*joined.by, "block", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha256"))
