"""Mentions of one document linked to a canonical one, by passes in order of certainty.

Every mention offers keys under which it may be meant: its own text, its last words, its
initials. Keys are sorted once, so that equal ones stand together: a group's longest
mention is the canonical one of the mention that is the key. The passes add keys, not
comparisons, and the work grows with the words of the mentions. Pronouns come last: each takes the
latest mention before it that agrees. All is array work within the document's row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswire.functions.text import let

# The passes in order, and the entity types a pronoun may stand for.
PASSES = ("exact", "head", "acronym", "pronoun")
PRONOUNS = {
    "he": ("PERSON",), "him": ("PERSON",), "his": ("PERSON",), "she": ("PERSON",), "her": ("PERSON",),
    "it": ("ORGANIZATION", "LOCATION", "MISC"), "its": ("ORGANIZATION", "LOCATION", "MISC"),
}
LINKS = "array<struct<sentence_id: int, ner: string, mention: string, canonical: string, sieve: string>>"


def mentions_of(sentences: Column) -> Column:
    """``array<struct<at, ner, mention>>`` of a document's sentences, in sentence order."""

    def of_sentence(s: Column) -> Column:
        return F.flatten(
            F.transform(
                F.map_entries(s["ner"]),
                lambda e: F.transform(e["value"], lambda m: F.struct(s["sentence_id"].alias("at"), e["key"].alias("ner"), m.alias("mention"))),
            )
        )

    found = F.flatten(F.transform(sentences, lambda s: F.coalesce(of_sentence(s), F.array())))
    return F.array_sort(F.coalesce(found, F.array()))


def _keys(m: Column, passes: tuple[str, ...], fold: bool) -> Column:
    """The keys of a mention, with the pass that reads it."""
    low = F.lower if fold else (lambda c: c)
    words = F.split(m["mention"], " ")
    size = F.size(words)

    def key(text: Column, name: str) -> Column:
        rank = F.struct(F.length(m["mention"]).alias("n"), (-m["at"]).alias("early"), m["mention"].alias("mention"))
        return F.struct(m["ner"].alias("ner"), text.alias("key"), rank.alias("rank"), F.lit(name).alias("sieve"))

    parts = [F.array(key(low(m["mention"]), "exact"))]
    if "head" in passes:
        ends = F.slice(F.sequence(F.lit(1), size), F.lit(2), F.greatest(size - 1, F.lit(0)))
        parts.append(F.transform(ends, lambda i: key(low(F.array_join(F.slice(words, i, size), " ")), "head")))
    if "acronym" in passes:
        initials = F.array_join(F.transform(words, lambda w: F.left(w, F.lit(1))), "")
        fits = (size > 1) & initials.rlike(r"^\p{Lu}+$")
        parts.append(F.filter(F.array(key(low(initials), "acronym")), lambda _: fits))
    return F.concat(*parts)


def canonical_forms(mentions: Column, passes: tuple[str, ...], fold: bool = True) -> Column:
    """``array<struct<ner, key, canonical, sieve>>``: of every mention's text the longest mention it may
    stand for. With ``fold`` texts compare, and keys are given, in lower case."""
    keys = F.array_sort(F.flatten(F.transform(mentions, lambda m: _keys(m, passes, fold))))

    def groups(e: Column) -> Column:
        def begins(x: Column, i: Column) -> Column:
            before = F.get(e, i - 1)
            return F.when(before.isNull() | (before["ner"] != x["ner"]) | (before["key"] != x["key"]), i)

        starts = F.array_compact(F.transform(e, begins))

        def of_group(s: Column, t: Column) -> Column:
            # The mention that is the key is the shortest; the longest comes last.
            own, last = F.get(e, s), F.get(e, t - 1)
            return F.struct(own["ner"].alias("ner"), own["key"].alias("key"), last["rank"]["mention"].alias("canonical"), last["sieve"].alias("sieve"), own["sieve"].alias("own"))

        def ranged(at: Column) -> Column:
            ends = F.concat(F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0))), F.array(F.size(e)))
            return F.filter(F.zip_with(at, ends, of_group), lambda g: g["own"] == "exact")

        return F.when(F.size(e) > 0, let(starts, ranged)).otherwise(F.filter(F.transform(e, lambda x: of_group(F.lit(0), F.lit(0))), lambda _: F.lit(False)))

    return let(keys, groups)


def _linked(mentions: Column, canonical: Column) -> Column:
    """Every mention with its canonical one: both sorted by type and key, the mentions' groups are the keys' order."""
    placed = F.array_sort(F.transform(mentions, lambda m: F.struct(m["ner"].alias("ner"), F.lower(m["mention"]).alias("key"), m["at"].alias("at"), m["mention"].alias("mention"))))

    def build(p: Column) -> Column:
        def begins(x: Column, i: Column) -> Column:
            before = F.get(p, i - 1)
            return F.when(before.isNull() | (before["ner"] != x["ner"]) | (before["key"] != x["key"]), i)

        starts = F.array_compact(F.transform(p, begins))

        def ranged(at: Column) -> Column:
            ends = F.concat(F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0))), F.array(F.size(p)))
            of_groups = F.arrays_zip(at.alias("s"), ends.alias("t"), canonical.alias("c"))
            return F.flatten(
                F.transform(
                    of_groups,
                    lambda g: F.transform(
                        F.slice(p, g["s"] + 1, g["t"] - g["s"]),
                        lambda m: F.struct(
                            m["at"].alias("sentence_id"), m["ner"].alias("ner"), m["mention"].alias("mention"), g["c"]["canonical"].alias("canonical"),
                            F.when(m["mention"] == g["c"]["canonical"], F.lit("self")).otherwise(g["c"]["sieve"]).alias("sieve"),
                        ),
                    ),
                )
            )

        return F.when(F.size(p) > 0, let(starts, ranged)).otherwise(F.array().cast(LINKS)).cast(LINKS)

    return let(placed, build)


def _pronouns(sentences: Column, links: Column) -> Column:
    """Pronouns with the canonical form of the latest agreeing mention in an earlier sentence; of one
    sentence the greatest by type and text. Those without one are left out."""
    agreeing = {types: [p for p, t in PRONOUNS.items() if t == types] for types in dict.fromkeys(PRONOUNS.values())}
    parts = []
    for types, words in agreeing.items():
        def events(types=types, words=words) -> Column:  # noqa: ANN001
            meant = F.transform(
                F.filter(links, lambda m: m["ner"].isin(*types)),
                lambda m: F.struct((m["sentence_id"] * 2).alias("at"), m["ner"].alias("ner"), m["canonical"].alias("canonical"), F.lit(None).cast("string").alias("word")),
            )

            def said(s: Column) -> Column:
                # A mention of its own sentence comes too late for a pronoun.
                return F.transform(
                    F.filter(F.coalesce(s["token"], F.array().cast("array<string>")), lambda t: F.lower(t).isin(*words)),
                    lambda t: F.struct((s["sentence_id"] * 2 - 1).alias("at"), F.lit(None).cast("string").alias("ner"), F.lit(None).cast("string").alias("canonical"), t.alias("word")),
                )

            return F.array_sort(F.concat(meant, F.flatten(F.transform(sentences, said))))

        def resolved(e: Column) -> Column:
            # The place of the latest mention before each event: places of mentions, counted along.
            places = F.array_compact(F.transform(e, lambda x, i: F.when(x["word"].isNull(), i)))

            def with_places(p: Column) -> Column:
                spans = F.zip_with(p, F.concat(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), F.array(F.size(e))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
                answered = F.transform(
                    spans,
                    lambda s: F.transform(
                        F.slice(e, s["a"] + 2, s["b"] - s["a"] - 1),
                        lambda x: F.struct(
                            F.floor((x["at"] + 1) / 2).cast("int").alias("sentence_id"), F.get(e, s["a"])["ner"].alias("ner"), x["word"].alias("mention"),
                            F.get(e, s["a"])["canonical"].alias("canonical"), F.lit("pronoun").alias("sieve"),
                        ),
                    ),
                )
                return F.when(F.size(p) > 0, F.flatten(answered)).otherwise(F.array().cast(LINKS)).cast(LINKS)

            return let(places, with_places)

        parts.append(let(events(), resolved))
    return F.concat(*parts)


def link_mentions(docs: DataFrame, passes: tuple[str, ...] = PASSES) -> DataFrame:
    """Adds ``links``: every mention of the document's sentences with its canonical form and the pass that found it.

    ``sentences`` needs ``sentence_id``, ``ner`` and, for pronouns, ``token``. ``exact`` joins
    mentions equal but for case, ``head`` those that are the last words of another of their
    type, ``acronym`` those that are its initials; the longest is canonical, the
    earliest of equally long ones, then the greatest text. ``self`` marks a canonical form.
    ``pronoun`` adds the pronouns. No shuffle, and legal on streams.
    """
    if unknown := set(passes) - set(PASSES):
        raise ValueError(f"no pass is called {', '.join(sorted(unknown))}")

    def build(mentions: Column) -> Column:
        links = _linked(mentions, canonical_forms(mentions, passes))
        return let(links, lambda m: F.concat(m, _pronouns(F.col("sentences"), m))) if "pronoun" in passes else links

    found = let(mentions_of(F.col("sentences")), build)
    return docs.withColumn("links", F.array_sort(found))
