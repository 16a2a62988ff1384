"""Tag-run merging on token arrays: linear in the sentence, no shuffle, stream legal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswire.functions.text import let

OUTSIDE = "O"
SPANS = "array<struct<tag: string, text: string, first: int, last: int>>"


def piece(tokens: Column, start: Column, count: Column) -> Column:
    """``count`` tokens from ``start`` (from 0), null behind the last; ``slice`` would first copy them all."""
    found = F.transform(F.sequence(start, start + count - 1), lambda j: F.get(tokens, j))
    return F.when(count > 0, found).otherwise(F.array().cast("array<string>"))


def mention_text(tokens: Column, drop_commas: bool = True) -> Column:
    """Tokens joined by a space; for entities commas go, and words left empty with them."""
    if drop_commas:
        bare = F.transform(tokens, lambda t: F.replace(t, F.lit(","), F.lit("")))
        tokens = F.filter(bare, lambda t: t != "")
    return F.array_join(tokens, " ")


def merge_runs(tokens: Column, tags: Column, drop_commas: bool = True) -> Column:
    """Runs of one tag as ``array<struct<tag, text, first, last>>`` (1-based positions).

    ``O`` or another tag ends a run; a run whose text becomes empty is dropped.
    Sentences without a tag end after one test.
    """

    def edge(marks: Column, step: int) -> Column:
        # Positions whose neighbour at ``step`` carries another tag.
        def differs(mark: Column, i: Column) -> Column:
            turn = (mark != OUTSIDE) & ~mark.eqNullSafe(F.get(marks, i + step))
            return F.when(turn, i + 1)

        return F.array_compact(F.transform(marks, differs))

    def spans(toks: Column, marks: Column) -> Column:
        def run(first: Column, last: Column) -> Column:
            return F.struct(
                F.get(marks, first - 1).alias("tag"),
                mention_text(piece(toks, first - 1, last - first + 1), drop_commas).alias("text"),
                first.alias("first"),
                last.alias("last"),
            )

        return F.filter(F.zip_with(edge(marks, -1), edge(marks, 1), run), lambda s: s["text"] != "")

    def build(toks: Column, marks: Column) -> Column:
        return F.when(F.exists(marks, lambda m: m != OUTSIDE), spans(toks, marks)).otherwise(
            F.array().cast(SPANS)
        )

    return let(tokens, lambda toks: let(tags, lambda marks: build(toks, marks)))


def tagged_tokens(tokens: Column, tags: Column) -> Column:
    """Every tagged token as its own entry, no run merge; same shape as ``merge_runs``."""

    def build(toks: Column, marks: Column) -> Column:
        def entry(mark: Column, i: Column) -> Column:
            at = i + 1
            return F.when(mark != OUTSIDE, F.struct(mark.alias("tag"), F.get(toks, i).alias("text"), at.alias("first"), at.alias("last")))

        some = F.exists(marks, lambda m: m != OUTSIDE)
        return F.when(some, F.array_compact(F.transform(marks, entry))).when(marks.isNotNull(), F.array().cast(SPANS))

    return let(tokens, lambda toks: let(tags, lambda marks: build(toks, marks)))


def group_by_tag(spans: Column) -> Column:
    """``map<tag, array<text>>``; tags sorted, texts in sentence order."""

    def build(s: Column) -> Column:
        names = F.array_sort(F.array_distinct(F.transform(s, lambda x: x["tag"])))
        return F.map_from_entries(
            F.transform(
                names,
                lambda n: F.struct(
                    n, F.transform(F.filter(s, lambda x: x["tag"] == n), lambda x: x["text"])
                ),
            )
        )

    return let(spans, build)


def render_groups(groups: Column) -> Column:
    """Flat form ``(TYPE,a|b),(TYPE2,c)`` of a tag map."""
    return F.array_join(
        F.transform(
            F.map_entries(groups),
            lambda e: F.concat(F.lit("("), e["key"], F.lit(","), F.array_join(e["value"], "|"), F.lit(")")),
        ),
        ",",
    )


def neighbour_pairs(tokens: Column, spans: Column) -> Column:
    """Adjacent mention pairs with the words between them."""

    def build(s: Column) -> Column:
        following = F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0)))
        zipped = F.filter(
            F.arrays_zip(s.alias("a"), following.alias("b")), lambda z: z["b"].isNotNull()
        )
        return F.transform(
            zipped,
            lambda z: F.struct(
                z["a"]["tag"].alias("type1"),
                z["a"]["text"].alias("mention1"),
                F.array_join(piece(tokens, z["a"]["last"], z["b"]["first"] - z["a"]["last"] - 1), " ").alias("connector"),
                z["b"]["tag"].alias("type2"),
                z["b"]["text"].alias("mention2"),
            ),
        )

    return let(spans, build)


def render_pairs(pairs: Column) -> Column:
    return F.array_join(
        F.transform(
            pairs,
            lambda p: F.concat(
                p["type1"], F.lit("("), p["mention1"], F.lit(") "), p["connector"], F.lit(" "),
                p["type2"], F.lit("("), p["mention2"], F.lit(")"),
            ),
        ),
        "; ",
    )


def render_chunks(spans: Column) -> Column:
    """``(NP a b) (VP c)``."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat(F.lit("("), s["tag"], F.lit(" "), s["text"], F.lit(")"))),
        " ",
    )


def bracket_runs(tokens: Column, tags: Column) -> Column:
    """``render_chunks`` of ``merge_runs`` with commas kept, for tokens that are not empty.

    Every token brings its own part of the text, so that a run is neither cut out nor held."""

    def parts(toks: Column, marks: Column) -> Column:
        def part(mark: Column, i: Column) -> Column:
            begun = F.when((i > 0) & (mark == F.get(marks, i - 1)), F.lit(" ")).otherwise(F.concat(F.lit(" ("), mark, F.lit(" ")))
            closed = F.when(mark == F.get(marks, i + 1), F.lit("")).otherwise(F.lit(")"))
            return F.when(mark != OUTSIDE, F.concat(begun, F.get(toks, i), closed)).otherwise(F.lit(""))

        return F.substring(F.array_join(F.transform(marks, part), ""), 2, 2147483647)

    return let(tokens, lambda toks: let(tags, lambda marks: parts(toks, marks)))
