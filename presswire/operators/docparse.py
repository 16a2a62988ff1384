"""``<DOC>`` records to typed document rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswire.functions.text import (
    decode_entities,
    finish_sentence,
    jsplit_regex,
    jtrim,
    let,
)
from presswire.operators.rows import pin, unnest

# Fixed values.
ROUTED_LANGUAGES = ("ENG", "ESP", "ARA")
NORMAL_DROPS = ("blank", "not_story")
DOC_XML_SCHEMA = (
    "_id string, _type string, HEADLINE string, DATELINE string, "
    "TEXT struct<P: array<string>>, _corrupt_record string"
)
PARSED = (
    "doc_id", "type", "head_line", "date_line", "language", "paragraphs", "body", "reason",
)


def nonblank(df: DataFrame, column: str = "value") -> DataFrame:
    return df.filter(jtrim(column) != "")


def split_docs(df: DataFrame, column: str = "value") -> DataFrame:
    """One row per ``<DOC ...>`` of a record, adding ``doc_pos`` from 1.

    Text between records (log lines) goes. A document cut short is kept as its
    own row, to be reported by the parser; a record with no document stays whole.
    """
    others = [c for c in df.columns if c != column]
    cut = F.transform(
        F.filter(
            F.split(F.col(column), "(?=<DOC )", -1), lambda p: p.startswith("<DOC ")
        ),
        lambda p: F.when(
            p.contains("</DOC>"), F.concat(F.substring_index(p, "</DOC>", 1), F.lit("</DOC>"))
        ).otherwise(p),
    )
    pieces = let(cut, lambda a: F.when(F.size(a) > 0, a).otherwise(F.array(F.col(column))))
    return unnest(df, others, pieces, column, "doc_pos")


def envelope(df: DataFrame, column: str = "value") -> DataFrame:
    """``id#<DOC ...>`` messages: adds ``mongo_id`` and leaves the document in ``column``.

    A message that already starts with ``<DOC`` carries no id, whatever ``#`` its body has.
    """
    message = F.col(column)
    at = F.instr(message, "#")
    tagged = ~jtrim(message).startswith("<DOC") & (at > 0)
    return df.withColumns(
        {
            "mongo_id": F.when(tagged, message.substr(F.lit(1), at - 1)).otherwise(F.lit("")),
            column: F.when(tagged, message.substr(at + 1, F.length(message))).otherwise(message),
        }
    )


def _attribute(header: Column, name: str) -> Column:
    found = F.regexp_extract_all(
        header, F.lit(rf'(?i)(?:^|\s){name}\s*=\s*("[^"]*"|[^"\s>]*)'), F.lit(1)
    )
    return F.coalesce(
        F.replace(F.try_element_at(found, F.lit(-1)), F.lit('"'), F.lit("")), F.lit("")
    )


def _between(zone: Column, tag: str) -> Column:
    inner = F.regexp_extract(zone, f"(?s)<{tag}>(.*?)</{tag}>", 1)
    return jtrim(F.replace(inner, F.lit(f"<{tag}>"), F.lit(" ")))


def _unclosed(zone: Column, tag: str) -> Column:
    return zone.contains(f"<{tag}>") & ~zone.rlike(f"(?s)<{tag}>.*</{tag}>")


def body_pieces(text: Column) -> Column:
    """Raw paragraph pieces of the part from ``<TEXT>`` on."""
    bare = text
    for tag in ("</DOC>", "<TEXT>", "</TEXT>", "<P>"):
        bare = F.replace(bare, F.lit(tag), F.lit(""))
    return jsplit_regex(bare, "</P>")


def _arabic_piece(piece: Column) -> Column:
    # A piece that already ends in a full stop, or is empty, keeps its blanks.
    return let(
        jtrim(piece),
        lambda s: F.when((s == "") | s.endswith("."), piece).otherwise(F.concat(s, F.lit("."))),
    )


def parse_docs(
    df: DataFrame,
    language: Column | str = "ENG",
    column: str = "value",
    require_id: bool = True,
    decode: bool = False,
) -> DataFrame:
    """Adds the parsed columns and ``reason`` (null on good rows).

    ``language`` is a column or a constant: ENG, ESP or ARA, anything else is not
    routed. Body work runs only for rows that pass every earlier test.
    """
    language = F.lit(language) if isinstance(language, str) else language
    doc = F.col("_doc")
    zone = F.col("_zone")
    story = F.lower(jtrim("type")) == "story"
    rules = [
        (doc == "", "blank"),
        (~doc.startswith("<DOC"), "not_doc"),
        (F.col("_text_at") == 0, "no_text"),
        (~doc.contains("</TEXT>"), "cut_short"),
        (_unclosed(zone, "DATELINE"), "bad_dateline"),
        (_unclosed(zone, "HEADLINE"), "bad_headline"),
    ]
    if require_id:
        rules.append((F.col("doc_id") == "", "no_id"))
    rules += [
        (~story, "not_story"),
        (~F.coalesce(F.col("language").isin(*ROUTED_LANGUAGES), F.lit(False)), "bad_lang"),
    ]
    reason = F
    for test, name in rules:
        reason = reason.when(test, F.lit(name))

    step = (
        df.withColumn("_doc", jtrim(F.replace(F.coalesce(F.col(column), F.lit("")), F.lit("\n"), F.lit(" "))))
        .withColumn("_text_at", F.instr("_doc", "<TEXT>"))
        .withColumn("_zone", F.when(F.col("_text_at") > 0, doc.substr(F.lit(1), F.col("_text_at") - 1)).otherwise(F.lit("")))
        .withColumn("_header", F.regexp_replace(F.substring_index("_zone", ">", 1), "^<DOC", ""))
        .withColumns(
            {
                "doc_id": _attribute(F.col("_header"), "id"),
                "type": _attribute(F.col("_header"), "type"),
                "head_line": _between(zone, "HEADLINE"),
                "date_line": _between(zone, "DATELINE"),
                "language": language,
            }
        )
        .withColumn("reason", reason)
    )
    text = doc.substr(F.col("_text_at"), F.length(doc))
    pieces = body_pieces(decode_entities(text) if decode else text)
    arabic = F.col("language") == "ARA"
    finished = F.when(arabic, F.transform(pieces, _arabic_piece)).otherwise(
        F.transform(pieces, finish_sentence)
    )
    step = step.withColumn("_pieces", F.when(F.col("reason").isNull(), finished)).withColumns(
        {
            "paragraphs": F.filter(F.transform("_pieces", jtrim), lambda p: p != ""),
            "body": F.when(arabic, F.array_join("_pieces", "")).otherwise(F.array_join("_pieces", " ")),
        }
    )
    return pin(step.select(*[c for c in df.columns if c not in PARSED], *PARSED), "reason")


def parse_docs_xml(
    df: DataFrame, language: Column | str = "ENG", column: str = "value"
) -> DataFrame:
    """XML form: entities decoded, every document type kept, malformed rows get a reason."""
    blank = jtrim(F.coalesce(F.col(column), F.lit(""))) == ""
    parsed = df.withColumns({"_xml": from_doc_xml(column), "_blank": blank})
    return _xml_columns(parsed, language, df.columns)


def typed_docs_xml(df: DataFrame, language: Column | str = "ENG") -> DataFrame:
    """The same columns for rows the XML source has already typed."""
    parsed = df.select(F.struct(*df.columns).alias("_xml"), F.lit(False).alias("_blank"))
    return _xml_columns(parsed, language, [])


def _xml_columns(parsed: DataFrame, language: Column | str, keep: list[str]) -> DataFrame:
    language = F.lit(language) if isinstance(language, str) else language
    xml = F.col("_xml")
    blank = F.lit("")
    pieces = F.transform(
        F.coalesce(xml["TEXT"]["P"], F.array().cast("array<string>")),
        lambda p: finish_sentence(F.replace(jtrim(F.coalesce(p, blank)), F.lit("\n"), F.lit(" "))),
    )
    doc_id = jtrim(F.coalesce(xml["_id"], blank))
    malformed = xml["_corrupt_record"].isNotNull() | xml.isNull()
    out = parsed.withColumn("_pieces", pieces).withColumns(
        {
            "doc_id": doc_id,
            "type": jtrim(F.coalesce(xml["_type"], blank)),
            "head_line": jtrim(F.coalesce(xml["HEADLINE"], blank)),
            "date_line": jtrim(F.coalesce(xml["DATELINE"], blank)),
            "language": language,
            "paragraphs": F.filter("_pieces", lambda p: p != ""),
            "body": F.array_join("_pieces", " "),
            "reason": F.when(F.col("_blank"), "blank")
            .when(malformed, "bad_xml")
            .when(doc_id == "", "no_id"),
        }
    )
    return pin(out.select(*[c for c in keep if c not in PARSED], *PARSED), "reason")


def from_doc_xml(column: str = "value") -> Column:
    return F.from_xml(
        F.col(column),
        DOC_XML_SCHEMA,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )


def paragraph_sentences(df: DataFrame, column: str = "value") -> DataFrame:
    """Every ``<P>`` as the next sentence of its document, empty ones included."""
    xml = F.col("_xml")
    blank = F.lit("")
    others = [c for c in df.columns if c != column]
    parsed = df.withColumn("_xml", from_doc_xml(column)).select(
        *others, jtrim(F.coalesce(xml["_id"], blank)).alias("doc_id"), xml["TEXT"]["P"].alias("_p")
    )
    rows = unnest(parsed, [*others, "doc_id"], "_p", "sentence", "sentence_id")
    text = F.replace(jtrim(F.coalesce(F.col("sentence"), blank)), F.lit("\n"), F.lit(" "))
    return rows.withColumn("sentence", text)


def accepted(df: DataFrame) -> DataFrame:
    """Rows that parsed and are routed."""
    return df.filter(F.col("reason").isNull())


def dead_letters(df: DataFrame, raw: str = "value") -> DataFrame:
    """Failed rows with their reason; blanks and other document types are normal drops."""
    return df.filter(
        F.col("reason").isNotNull() & ~F.col("reason").isin(*NORMAL_DROPS)
    ).select("reason", F.col(raw).alias("raw"))


def concat_bodies(df: DataFrame, by: list[str], position: str, text: str = "body") -> DataFrame:
    """Bodies in the order in which each input's text runs together: ``(*by, position, text)``.

    One row a document at any size, so no group and no value grows with the input.
    Partitions are ascending ranges, and a write lays the text out in order.
    """
    return df.select(*by, position, text).repartitionByRange(*by, position).sortWithinPartitions(*by, position)
