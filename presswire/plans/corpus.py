"""``<DOC>`` records derived from the ``documents`` table: the input the parsers expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswire.functions.text import escape_entities

# Letters used to derive Arabic-script text from Latin text.
LATIN = "abcdefghijklmnopqrstuvwxyz0123456789"
ARABIC = "اأبآتثجحخدىذرزسشصضطـظعَغفقكل٠١٢٣٤٥٦٧٨٩"[: len(LATIN)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def job_language(lang: Column) -> Column:
    """Language a job runs a document under: Spanish texts as ESP, all others as ENG."""
    return F.when(lang == "es", F.lit("ESP")).otherwise(F.lit("ENG"))


def own_language(lang: Column) -> Column:
    """The text's own language; French and German have no route."""
    return F.when(lang == "en", F.lit("ENG")).when(lang == "es", F.lit("ESP"))


def type_of(source: Column) -> Column:
    """Three sources deliver something else than plain stories."""
    return (
        F.when(source == "src1", F.lit("STORY"))
        .when(source == "src3", F.lit("multi"))
        .when(source == "src7", F.lit("other"))
        .otherwise(F.lit("story"))
    )


def plain_type_of(source: Column) -> Column:
    """Stories only, for what is not about routing; one source writes the type in capitals."""
    return F.when(source == "src1", F.lit("STORY")).otherwise(F.lit("story"))


def doc_record(
    doc_id: Column, kind: Column, head: Column, date: Column, text: Column, escape: bool = False
) -> Column:
    """One record on one line; every line of the text is a paragraph."""
    clean = escape_entities if escape else (lambda c: c)
    paragraphs = F.array_join(
        F.transform(
            F.split(clean(text), "\n", -1), lambda p: F.concat(F.lit("<P> "), p, F.lit(" </P>"))
        ),
        " ",
    )
    return F.concat(
        F.lit('<DOC id="'), doc_id, F.lit('" type="'), kind, F.lit('" > <HEADLINE> '), clean(head),
        F.lit(" </HEADLINE> <DATELINE> "), clean(date), F.lit(" </DATELINE> <TEXT> "), paragraphs,
        F.lit(" </TEXT> </DOC>"),
    )


def head_of(text: Column) -> Column:
    return F.replace(F.substring(text, 1, 40), F.lit("\n"), F.lit(" "))


def date_of(source: Column) -> Column:
    return F.concat(F.upper(source), F.lit(" 2024-01-01"))


def wrap(docs: DataFrame, text: str = "text", escape: bool = False, routed: bool = False) -> DataFrame:
    """``key``, ``lang`` and the record in ``value``; ``rec_id`` stays.

    With ``routed``, some sources deliver other types than stories. The headline is
    made of the first characters; the body is the whole text.
    """
    return docs.select(
        *[c for c in docs.columns if c == "rec_id"],
        F.col("doc_id").alias("key"),
        "lang",
        doc_record(
            F.concat(F.lit("D"), F.col("doc_id").cast("string")),
            (type_of if routed else plain_type_of)(F.col("source")),
            head_of(F.col(text)),
            date_of(F.col("source")),
            F.col(text),
            escape,
        ).alias("value"),
    )


def damage(records: DataFrame) -> DataFrame:
    """Breaks some records, one way per remainder of ``key`` by 25."""
    kind = F.pmod("key", F.lit(25))
    value = F.col("value")
    broken = (
        F.when(kind == 3, F.replace(value, F.lit("<TEXT>"), F.lit("")))
        .when(kind == 7, F.replace(value, F.lit("</HEADLINE>"), F.lit("")))
        .when(kind == 11, F.replace(value, F.lit("</DATELINE>"), F.lit("")))
        .when(kind == 13, F.regexp_replace(value, '^<DOC id="[^"]*"', "<DOC"))
        .when(kind == 17, F.concat(F.lit("junk "), value))
        .when(kind == 19, F.lit(" \t "))
        .otherwise(value)
    )
    return records.withColumn("value", broken)


def arabic_text(text: Column) -> Column:
    return F.translate(F.lower(text), LATIN, ARABIC)
