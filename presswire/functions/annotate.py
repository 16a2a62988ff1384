"""Per-sentence annotations as columns over a token array.

``found`` arguments are lexicon lookups parallel to the tokens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswire.functions.spans import OUTSIDE, piece
from presswire.functions.text import let

# Default part-of-speech tags by word shape, first match wins.
POS_SHAPES = (
    (r"^[\p{N}][\p{N}.,-]*$", "CD"),
    (r"^[.!?]$", "."),
    (r"^[,]$", ","),
    (r"^[^\p{L}\p{N}]$", "SYM"),
)
POS_UPPER = r"^\p{Lu}"
POS_UPPER_TAGS = (("s", "NNPS"), ("", "NNP"))
POS_SUFFIXES = (("ing", "VBG"), ("ed", "VBD"), ("ly", "RB"), ("s", "NNS"))
POS_DEFAULT = "NN"

# Phrase class of a part-of-speech tag.
CHUNK_OF_POS = {
    "NP": ("DT", "PRP", "PRP$", "JJ", "CD", "NN", "NNS", "NNP", "NNPS"),
    "VP": ("MD", "VB", "VBD", "VBG", "VBN", "VBP", "VBZ", "RB"),
    "PP": ("IN", "TO"),
}

MISSING_SENTIMENT = -1
NEUTRAL_SENTIMENT = 2


def lemmas(tokens: Column, found: Column) -> Column:
    """Lexicon lemma, else the token in lower case."""
    return F.zip_with(tokens, found, lambda t, f: F.coalesce(f, F.lower(t)))


def _by_suffix(t: Column, suffixes: tuple[tuple[str, str], ...], default: str) -> Column:
    out = F
    for suffix, tag in suffixes:
        out = out.when(t.endswith(suffix), F.lit(tag))
    return out.otherwise(F.lit(default))


def pos_tags(tokens: Column, found: Column) -> Column:
    """Most frequent tag from the lexicon, else a tag by word shape.

    Words starting with a plain letter, by far the most, are told by comparing; the others take
    pattern tests.
    """

    def by_shape(t: Column) -> Column:
        other = F
        for pattern, tag in POS_SHAPES:
            other = other.when(t.rlike(pattern), F.lit(tag))
        upper, lower = _by_suffix(t, POS_UPPER_TAGS, POS_DEFAULT), _by_suffix(t, POS_SUFFIXES, POS_DEFAULT)
        return (
            F.when((t >= "a") & (t < "{"), lower)
            .when((t >= "A") & (t < "["), upper)
            .when(t.rlike(r"^\p{L}"), F.when(t.rlike(POS_UPPER), upper).otherwise(lower))
            .otherwise(other.otherwise(lower))
        )

    return F.zip_with(tokens, found, lambda t, f: F.coalesce(f, by_shape(t)))


def chunk_tags(pos: Column) -> Column:
    default = next(name for name, tags in CHUNK_OF_POS.items() if POS_DEFAULT in tags)

    def one(p: Column) -> Column:
        out = F.when(p == POS_DEFAULT, F.lit(default))  # by far the most
        for name, tags in CHUNK_OF_POS.items():
            out = out.when(p.isin(*tags), F.lit(name))
        return out.otherwise(F.lit(OUTSIDE))

    return F.transform(pos, one)


def entity_tags(tokens: Column, found: Column, longest: int) -> Column:
    """One tag per token: the longest gazetteer phrase covering it, the leftmost
    among equally long ones, ``O`` where there is none.

    ``found`` holds the phrases starting with each token (``phrase_lexicon``);
    ``longest`` is the most words a phrase has. Sentences without any such token
    end after one test.
    """

    def matches(candidates: Column) -> Column:
        def at(c: Column, i: Column) -> Column:
            def fits(p: Column) -> Column:
                text = F.lower(F.array_join(piece(tokens, i, p["k"]), " "))
                return (p["k"] == 1) | (text == p["phrase"])

            return F.when(c.isNotNull(), F.get(F.filter(c, fits), F.lit(0)))

        return F.transform(candidates, at)

    def cover(hits: Column) -> Column:
        def at(hit: Column, i: Column) -> Column:
            around = [hit] + [F.get(hits, i - back) for back in range(1, longest)]
            options = [
                F.when(
                    h["k"] > back,
                    F.struct(h["k"].alias("k"), F.lit(back).alias("back"), h["tag"].alias("tag")),
                )
                for back, h in enumerate(around)
            ]
            if longest == 1:
                return F.coalesce(hit["tag"], F.lit(OUTSIDE))
            best = F.coalesce(F.greatest(*options)["tag"], F.lit(OUTSIDE))
            return F.when(F.coalesce(*around).isNull(), F.lit(OUTSIDE)).otherwise(best)

        some = F.exists(hits, lambda h: h.isNotNull())
        return F.when(some, F.transform(hits, at)).otherwise(F.array_repeat(F.lit(OUTSIDE), F.size(hits)))

    def tag(candidates: Column) -> Column:
        some = F.exists(candidates, lambda c: c.isNotNull())
        return F.when(some, let(matches(candidates), cover)).otherwise(
            F.array_repeat(F.lit(OUTSIDE), F.size(candidates))
        )

    return let(found, tag)


def sentiment(tokens: Column, found: Column) -> Column:
    """Class 0..4 from summed polarity; 2 without a hit, -1 for an empty sentence."""
    total = F.aggregate(
        found, F.lit(0), lambda acc, w: acc + F.coalesce(w.cast("int"), F.lit(0))
    )
    return F.when(F.size(tokens) == 0, F.lit(MISSING_SENTIMENT)).otherwise(
        F.least(F.greatest(total, F.lit(-2)), F.lit(2)) + NEUTRAL_SENTIMENT
    )


def overlay(tags: Column, extra: Column) -> Column:
    """First tag set, filled from ``extra`` where it says ``O``."""
    return F.zip_with(tags, extra, lambda a, b: F.when(a == OUTSIDE, b).otherwise(a))
