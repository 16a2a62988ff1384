"""Document store on plain files: append, keyed upsert, lookup.

Upserts write a log, one partition per run and batch. A run is the stable name of a
query; batch numbers count within it, so queries that write one store keep apart.
Commits are numbered in a manifest of the store, so no writer's clock matters. A
replayed batch rewrites its own partition and keeps its number, and no path is
overwritten while it is read.

A batch is laid out by a hash of its keys, and ``index_keys`` keeps a bitmap of the keys of
every file. Lookups read the files that may hold a key, and those not indexed yet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswire.operators.keyfilter import bit_is_set
from presswire.operators.lookup import keyed_join

LOG, SNAPSHOT, MANIFEST, COMMITS, INDEX = "log", "snapshot", "manifest", "commits", "index"
DEFAULT_RUN = "main"
ORDER = ["committed", "run", "batch_id", "seq", "row_hash"]
NUMBERS = 1 << 26  # of key hashes; about 16 times the keys of a store keeps its bitmaps sparse
GROUPS = 256  # ranges of numbers a batch is laid out by
_COMMIT = "committed long, run string, batch_id long"
_INDEX = "file string, slice long, bits binary"


def append(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Plain append. Running it twice stores the rows twice."""
    df.write.mode("append").format(fmt).options(**options).save(path)


def append_batch(df: DataFrame, path: str, batch_id: int, run: str = DEFAULT_RUN) -> None:
    """Append that may be replayed: the batch owns partition ``(run, batch_id)``."""
    (
        df.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("long")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run", "batch_id")
        .parquet(path)
    )


def batch_appender(
    path: str, transform: Callable[[DataFrame], DataFrame] | None = None, run: str = DEFAULT_RUN
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function storing each micro-batch; an empty one leaves nothing."""

    def write(df: DataFrame, batch_id: int) -> None:
        append_batch(transform(df) if transform else df, path, batch_id, run)

    return write


def _commits(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: a row a batch; of a batch recorded twice the first number holds."""
    try:
        rows = spark.read.schema(_COMMIT).parquet(f"{path}/{COMMITS}")
    except AnalysisException:
        rows = spark.createDataFrame([], _COMMIT)
    return rows.groupBy("run", "batch_id").agg(F.min("committed").alias("committed"))


def _number(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(NUMBERS)) + 1  # bitmap slices count from 1


def _laid_out(df: DataFrame, key: str) -> DataFrame:
    """Rows of near key hashes together, in files of even size: ranges that are too large for
    one are split, small ones share one."""
    group = F.floor((_number(key) - 1) / (NUMBERS // GROUPS)).cast("int")
    return df.withColumn("_group", group).hint("rebalance", "_group").drop("_group")


def _row_hash(df: DataFrame) -> Column:
    """Tells apart rows of one key that are equal in commit and seq, whatever columns are read."""
    plain = {f.name: "map<" not in f.dataType.simpleString() for f in df.schema}
    return F.xxhash64(*[F.col(c) if plain[c] else F.to_json(c) for c in sorted(df.columns)])


def upsert_batch(
    df: DataFrame, path: str, batch_id: int, seq: str = "seq", run: str = DEFAULT_RUN, key: str = "doc_id"
) -> None:
    """Log a batch of documents. Within a batch the greatest ``seq`` wins; later
    commits win over earlier ones, whichever run they are of. A batch that a snapshot
    already holds is not written again. The batch is laid out by ``key`` if it has that column."""
    spark = df.sparkSession
    _, held = _compacted(spark, path)
    if batch_id <= held.get(run, -1):
        return
    if seq != "seq":
        df = df.withColumnRenamed(seq, "seq")
    this = (F.col("run") == run) & (F.col("batch_id") == batch_id)
    own, last = _commits(spark, path).agg(F.max(F.when(this, F.col("committed"))), F.max("committed")).first()
    committed = own if own is not None else (last or 0) + 1
    rows = df.withColumns({"row_hash": _row_hash(df), "committed": F.lit(committed).cast("long")})
    append_batch(_laid_out(rows, key) if key in df.columns else rows, f"{path}/{LOG}", batch_id, run)
    if own is None:
        append(spark.createDataFrame([(committed, run, batch_id)], _COMMIT).coalesce(1), f"{path}/{COMMITS}")


def upserter(path: str, seq: str = "seq", run: str = DEFAULT_RUN, key: str = "doc_id") -> Callable[[DataFrame, int], None]:
    def write(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            upsert_batch(df, path, batch_id, seq, run, key)

    return write


def _newest(versions: DataFrame, key: str) -> DataFrame:
    rest = [c for c in versions.columns if c != key]
    return (
        versions.groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.struct(*ORDER)).alias("_v"))
        .select(key, "_v.*")
    )


def _compacted(spark: SparkSession, path: str) -> tuple[int, dict[str, int]]:
    """Number of the newest snapshot and the last batch of each run within it."""
    try:
        manifest = spark.read.schema("snapshot long, run string, upto long").parquet(f"{path}/{MANIFEST}")
        newest = manifest.agg(F.max("snapshot")).first()[0]
    except AnalysisException:
        return 0, {}
    rows = manifest.filter(F.col("snapshot") == newest).collect()  # a row per run
    return newest, {r["run"]: r["upto"] for r in rows}


def _read(spark: SparkSession, folder: str, skip: list[str], columns: list[str] | None, with_file: bool) -> DataFrame:
    """Rows of a folder's files but those to skip, which are not opened."""
    rows = spark.read.parquet(folder)
    name = F.col("_metadata.file_path")
    if skip:
        rows = rows.filter(~name.isin(skip))
    names = rows.columns if columns is None else list(dict.fromkeys([*columns, *ORDER]))
    return rows.select(*names, *([name.alias("file")] if with_file else []))


def versions(
    spark: SparkSession, path: str, skip: list[str] | None = None, columns: list[str] | None = None, with_file: bool = False
) -> DataFrame:
    """Snapshot rows plus the log batches written after it; all columns, or the named ones.

    Of the log only partitions that no snapshot holds are listed, and files to ``skip`` are
    not read. ``with_file`` adds each row's file.
    """
    number, held = _compacted(spark, path)
    log = _read(spark, f"{path}/{LOG}", skip or [], columns, with_file)
    log = log.withColumns({"run": F.col("run").cast("string"), "batch_id": F.col("batch_id").cast("long")})
    for run, upto in held.items():
        log = log.filter((F.col("run") != run) | (F.col("batch_id") > upto))
    if not number:
        return log
    return _read(spark, f"{path}/{SNAPSHOT}/number={number}", skip or [], columns, with_file).unionByName(log)


def _only(rows: DataFrame, columns: list[str] | None, key: str) -> DataFrame:
    if columns is None:
        return rows
    return rows.select(*dict.fromkeys([key, *columns, *ORDER]))


def latest(
    spark: SparkSession, path: str, key: str = "doc_id", columns: list[str] | None = None
) -> DataFrame:
    """Newest version per key, all columns or the named ones.

    Each task keeps one version per key before the shuffle, so a key updated
    very often does not pile up. Columns not asked for are not read.
    """
    return _newest(versions(spark, path, columns=None if columns is None else [key, *columns]), key)


def compact(spark: SparkSession, path: str, key: str = "doc_id") -> int:
    """Write the latest view to a new snapshot and record it; returns its number."""
    number, held = _compacted(spark, path)
    last = _commits(spark, path).groupBy("run").agg(F.max("batch_id").alias("upto")).collect()  # a row per run
    upto = held | {r["run"]: r["upto"] for r in last}
    if upto == held:
        return number
    rows = versions(spark, path)
    for run, batch in upto.items():  # batches that arrive meanwhile stay in the log
        rows = rows.filter((F.col("run") != run) | (F.col("batch_id") <= batch))
    rows = _newest(rows.filter(F.col("run").isin(*upto)), key)
    number += 1
    _laid_out(rows, key).write.mode("overwrite").parquet(f"{path}/{SNAPSHOT}/number={number}")
    entries = [(number, run, batch) for run, batch in upto.items()]
    spark.createDataFrame(entries, "snapshot long, run string, upto long").coalesce(1).write.mode("append").parquet(
        f"{path}/{MANIFEST}"
    )
    return number


def _index(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_INDEX).parquet(f"{path}/{INDEX}")
    except AnalysisException:
        return spark.createDataFrame([], _INDEX)


def index_keys(spark: SparkSession, path: str, key: str = "doc_id") -> int:
    """Bitmaps of the keys of every file that has none yet; returns how many files got one.

    Run it after some batches, as ``compact`` is. Of new files the key column is read, of
    others nothing.
    """
    known = [r["file"] for r in _index(spark, path).select("file").distinct().collect()]  # names of files
    number = _number(key)
    new = versions(spark, path, skip=known, columns=[key], with_file=True)
    keys = new.select("file", F.bitmap_bucket_number(number).alias("slice"), F.bitmap_bit_position(number).alias("_at"))
    target = f"{path}/{INDEX}"
    bits = keys.groupBy("file", "slice").agg(F.bitmap_construct_agg("_at").alias("bits"))
    append(bits, target)
    return spark.read.schema(_INDEX).parquet(target).select("file").distinct().count() - len(known)


def files_without(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> list[str]:
    """Indexed files that hold none of ``keys``. Files are named to the driver, as a listing does."""
    number = _number(key)
    asked = keys.select(F.bitmap_bucket_number(number).alias("slice"), F.bitmap_bit_position(number).alias("_at")).distinct()
    hit = F.coalesce(bit_is_set(F.col("bits"), F.col("_at")), F.lit(False))
    files = _index(spark, path).join(asked, "slice", "left").groupBy("file").agg(F.max(hit).alias("hit"))
    return [r["file"] for r in files.filter(~F.col("hit")).select("file").collect()]


def lookup(spark: SparkSession, path: str, value: str, key: str = "doc_id") -> DataFrame:
    """Newest version of one key, from the files that may hold it; the filter reaches the scan."""
    skip = files_without(spark, path, spark.range(1).select(F.lit(value).alias(key)), key)
    return _newest(versions(spark, path, skip).filter(F.col(key) == value), key)


def lookup_many(
    spark: SparkSession,
    path: str,
    keys: DataFrame,
    key: str = "doc_id",
    columns: list[str] | None = None,
    **limits: int,
) -> DataFrame:
    """Newest versions of many keys, from the files that may hold one; other keys drop out
    before the grouping."""
    wanted = keys.select(key).distinct()
    rows = versions(spark, path, files_without(spark, path, wanted, key))
    found = keyed_join(_only(rows, columns, key), wanted, [key], "semi", [key, *ORDER], **limits)
    return _newest(found, key)


def skip_existing(
    incoming: DataFrame, stored: DataFrame, key: str = "doc_id", spread: list[str] | None = None, **limits: int
) -> DataFrame:
    """Incoming rows whose key is not stored yet."""
    return keyed_join(incoming, stored.select(key).distinct(), [key], "anti", spread, **limits)


def skip_stored(
    incoming: DataFrame, path: str, key: str = "doc_id", spread: list[str] | None = None, **limits: int
) -> DataFrame:
    """Incoming rows whose key the store does not hold; only files that may hold one are read, and of them the key."""
    spark = incoming.sparkSession
    skip = files_without(spark, path, incoming, key)
    return skip_existing(incoming, versions(spark, path, skip, [key]), key, spread, **limits)
