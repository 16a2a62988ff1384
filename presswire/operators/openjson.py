"""JSON documents of changing shape: known fields as columns, all others kept as they are.

A document is parsed once into a VARIANT. Known fields are taken from it by name and type; what
it holds beside them, nested to any depth, stays one column and goes out again when the
document is written, so a producer may add fields that this job has never heard of.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields with a column of their own.
FIELDS = ("doc_id", "type", "head_line", "date_line", "language", "text")
OBJECT = "map<string,variant>"


def object_fields(v: Column) -> Column:
    """The top-level fields of a variant; null for anything but an object."""
    return F.try_variant_get(v, "$", OBJECT)


def open_documents(
    df: DataFrame, column: str = "value", fields: tuple[str, ...] = FIELDS, languages: tuple[str, ...] = ("ENG", "ESP", "ARA")
) -> DataFrame:
    """Adds a string column for each of ``fields``, ``others`` (a variant) and ``reason``.

    Numbers and truth values are taken as text; a known field that is an object or a
    list counts as missing. ``reason`` is ``bad_json`` for what is no JSON object,
    then ``no_id``, ``no_text``, ``bad_lang``; null on good rows.
    """
    known = F.try_variant_get("_v", "$", OBJECT)
    parsed = df.drop(*fields, "others", "reason").withColumn("_v", F.try_parse_json(column))
    parsed = parsed.withColumn("_o", known)

    def text(name: str) -> Column:
        field = F.element_at("_o", F.lit(name))
        nested = F.schema_of_variant(field).rlike("^(OBJECT|ARRAY)")
        return F.when(~nested, F.try_variant_get(field, "$", "string"))

    values = {f: text(f) for f in fields}
    rest = F.map_filter("_o", lambda k, _: ~k.isin(*fields))
    opened = parsed.withColumns({**values, "others": F.to_variant_object(rest)})
    reason = F.when(F.col("_o").isNull(), "bad_json")
    if "doc_id" in fields:
        reason = reason.when(F.coalesce(F.col("doc_id"), F.lit("")) == "", "no_id")
    if "text" in fields:
        reason = reason.when(F.col("text").isNull(), "no_text")
    if "language" in fields:
        reason = reason.when(~F.coalesce(F.col("language").isin(*languages), F.lit(False)), "bad_lang")
    return opened.withColumn("reason", reason).drop("_v", "_o")


def close_documents(df: DataFrame, columns: tuple[str, ...], others: str = "others") -> DataFrame:
    """``value``: the JSON of ``columns`` and of the fields in ``others``; a column wins over a field of its name.

    Columns may hold arrays, maps and structs. ``df``'s other columns stay.
    """
    own = object_fields(F.to_variant_object(F.struct(*columns)))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))
    kept = F.map_filter(F.coalesce(object_fields(F.col(others)), none), lambda k, _: ~k.isin(*columns))
    return df.withColumn("value", F.to_json(F.map_concat(kept, own)))
