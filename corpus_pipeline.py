"""A training corpus from ``documents``: five stages, each one operator of ``presswire.llm``.

The first four keep the columns of ``documents``, whatever their names: a stage packs them into one
struct, so that none meets a column of an operator. The last returns a row for each
document of the token files. In every stage null text counts as empty, equal rows are rows
of their own unless the stage says otherwise, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswire.llm.common import pack, saved, table, unpack
from presswire.llm.decontaminate import hits
from presswire.llm.langcrf import identify
from presswire.llm.mixing import mix
from presswire.llm.shingletree import near_duplicates
from presswire.llm.tokenfiles import read_tokens, write_tokens
from presswire.session import scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay; a missing ``lang`` is filled in. Texts that are null or hold no
    letter have none and go."""
    own = ("doc_id", "text", "lang")
    found = identify(pack(docs, *own)).filter(F.col("lang_pred") != "und")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*unpack(docs.columns, *own))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles, the one with the smallest id stays, one row of those
    that share it; null ids come last. Documents without words are linked with nothing and stay."""
    own = ("doc_id", "text")
    keyed = pack(docs, *own).withColumn("_row", F.monotonically_increasing_id())
    found = near_duplicates(keyed.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "component_id")
    linked = saved(found.join(keyed.select("_row", "doc_id"), "_row"), "linked")
    first = linked.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"].alias("kept"), F.count(F.lit(1)).alias("n"))
    others = linked.join(first.filter("n > 1"), "component_id").filter("_row <> kept").select("_row")
    return keyed.join(others, "_row", "left_anti").select(*unpack(docs.columns, *own))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window stay."""
    kept = hits(pack(docs, "text"), table(spark, sf_dir, "benchmark")).filter("n_hit = 0")
    return kept.select(*unpack(docs.columns, "text"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; those without words are not taken."""
    own = ("doc_id", "text", "source")
    keyed = pack(docs, *own).withColumn("_row", F.monotonically_increasing_id())
    taken = mix(keyed, row="_row").filter("copies > 0").select(F.col("row").alias("_row"), "copies")
    copies = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    return keyed.join(taken, "_row").select("_packed", *own, copies).select(*unpack(docs.columns, *own))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token files, read back: place, length and checksum of every document. Null text
    gives the end id alone."""
    path = scratch_path(spark, "corpus-tokens")
    write_tokens(docs.select("doc_id", "text"), path)
    return read_tokens(spark, path)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
    ("token_files", token_files),
]

#: The language model of the first stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
