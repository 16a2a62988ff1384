"""Annotated documents: profiles, nested assembly, JSON."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswire.functions import annotate as A
from presswire.functions import spans as S
from presswire.functions.lexicon import PHRASES, InlineLexicon, phrase_entries, regex_tags
from presswire.functions.segment import sentences_of, tokens_of
from presswire.functions.text import let
from presswire.operators.planner import CARD_FIELDS, PROFILES, Plan, Wanted, profile
from presswire.operators.planner import plan as annotation_plan
from presswire.operators.rows import pin
from presswire.operators.sieves import canonical_forms, mentions_of

SENTENCE_FIELDS = (
    "sentence_id", "sentence", "parse_sentence", "dependency_tree", "token", "lemma",
    "ner", "relation", "sentiment",
)
SENTENCE_TYPE = (
    "struct<sentence_id: int, sentence: string, parse_sentence: string, "
    "dependency_tree: string, token: array<string>, lemma: array<string>, "
    "ner: map<string, array<string>>, relation: string, sentiment: int>"
)
DOCUMENT_FIELDS = ("doc_id", "type", "head_line", "date_line", "language", "corref", "sentences")

PARSER_MODES = ("default", "fast")


Entries = Iterable[tuple[str, str, str]]
FIELD_TYPES = {"lemma": "string", "pos": "string", "weight": "int", "phrases": PHRASES}


def card_type(fields: Iterable[str]) -> str:
    return "struct<" + ", ".join(f"{f}: {FIELD_TYPES[f]}" for f in fields) + ">"


@dataclass(frozen=True)
class Found:
    """How a sentence reads its words and their cards: ``tokens(sentence, language, number)``, ``cards(tokens, language,
    number)``, and of these cards the lemma of each token, a field of each card, and the entity tag of each token."""

    tokens: Callable[[Column, Column, Column], Column]
    cards: Callable[[Column, Column, Column], Column]
    lemmas: Callable[[Column, Column], Column]
    field: Callable[[Column, str], Column]
    marks: Callable[[Column, Column], Column]


def _in_place(longest: int, lookup: Callable[[Column, Column], Column] | None = None) -> Found:
    """Tokens cut from the sentence, and cards looked up token by token."""

    def field(cards: Column, name: str) -> Column:
        return F.transform(cards, lambda c: c[name])

    return Found(
        tokens=lambda sentence, language, number: tokens_of(sentence, language),
        cards=lambda tokens, language, number: lookup(tokens, language),
        lemmas=lambda tokens, cards: A.lemmas(tokens, field(cards, "lemma")),
        field=field,
        marks=lambda tokens, cards: A.entity_tags(tokens, field(cards, "phrases"), longest),
    )


class Resources:
    """Lexicons of a run, each ``(language, word or phrase, value)``; an empty one
    leaves its annotation at the default.

    They fold into one table of word cards, so annotating takes one lookup per
    token. The table is a constant of the plan, of checked size; ``tables.TableResources``
    takes lexicons of any size.
    """

    def __init__(
        self,
        lemma: Entries = (),
        pos: Entries = (),
        gazetteer: Entries = (),
        polarity: Entries = (),
        rules: Iterable[tuple[str, str]] = (),
    ):
        gazetteer = list(gazetteer)
        self.rules = tuple(rules)
        self.longest = max((len(p.split(" ")) for _, p, _ in gazetteer), default=1)
        self._cards: dict[tuple[str, str], dict] = {}
        self._folded: dict[tuple[str, ...], InlineLexicon] = {}

        def put(name: str, language: str, word: str, value: object) -> None:
            card = self._cards.setdefault((language, word.lower()), {})
            card[name] = min(card[name], value) if name in card else value

        for name, entries in (("lemma", lemma), ("pos", pos)):
            for language, word, value in entries:
                put(name, language, word, value)
        for language, word, value in polarity:
            put("weight", language, word, int(value))
        for language, word, value in phrase_entries(gazetteer):
            put("phrases", language, word, value)
        self.cards(CARD_FIELDS)

    def cards(self, fields: tuple[str, ...]) -> InlineLexicon:
        """The cards with no other fields than ``fields``."""
        if fields not in self._folded:
            kept = [(lang, word, {f: card[f] for f in fields if f in card}) for (lang, word), card in self._cards.items()]
            self._folded[fields] = InlineLexicon([e for e in kept if e[2]], card_type(fields))
        return self._folded[fields]

    def attach(self, df: DataFrame, fields: tuple[str, ...], body: str) -> tuple[DataFrame, Found]:
        """``df`` as it is, and the lookup of a token array's cards."""
        return df, _in_place(self.longest, self.cards(fields).lookup)


def _for_languages(language: Column, names: list[str], value: Column) -> Column:
    return F.when(language.isin(*names), value) if names else F.lit(None)


def sentence_struct(
    sentence: Column,
    number: Column,
    language: Column,
    rules: tuple[tuple[str, str], ...],
    found: Found,
    parser: str,
    plan: Plan,
    every_token: bool,
) -> Column:
    """One sentence with the annotations of the plan; fields it does not give are null."""
    if parser not in PARSER_MODES:
        raise ValueError(f"parser mode {parser!r} is not one of {PARSER_MODES}")
    steps = plan.steps

    def step(name: str, value: Callable[[], Column], after: Callable[[Column], Column]) -> Column:
        """A step others read, evaluated once; left out where nothing reads it."""
        return let(value(), after) if name in steps else after(F.lit(None))

    def pick(name: str, value: Callable[[], Column]) -> Column:
        return _for_languages(language, plan.languages(name), value()) if name in steps else F.lit(None)

    def tags(toks: Column, cards: Column) -> Column:
        named = found.marks(toks, cards)
        return A.overlay(named, regex_tags(toks, rules, F.lit(S.OUTSIDE))) if rules else named

    def chunks(toks: Column, cards: Column) -> Column:
        pos = A.pos_tags(toks, found.field(cards, "pos"))
        return S.bracket_runs(toks, A.chunk_tags(pos))

    def build(toks: Column, cards: Column, marks: Column, merged: Column) -> Column:
        ner = F.coalesce(
            pick("ner_merged", lambda: S.group_by_tag(merged)).cast("map<string,array<string>>"),
            pick("ner_grouped", lambda: S.group_by_tag(S.tagged_tokens(toks, marks))).cast("map<string,array<string>>"),
        )
        values = {
            "sentence_id": number,
            "sentence": sentence,
            "parse_sentence": pick("parse", lambda: chunks(toks, cards)),
            "dependency_tree": F.lit(None),
            "token": toks if every_token else pick("token", lambda: toks),
            "lemma": pick("lemma", lambda: found.lemmas(toks, cards)),
            "ner": ner,
            "relation": pick("relation", lambda: S.render_pairs(S.neighbour_pairs(toks, merged))),
            "sentiment": pick("sentiment", lambda: A.sentiment(toks, found.field(cards, "weight"))),
        }
        return F.struct(*[values[f].alias(f) for f in SENTENCE_FIELDS]).cast(SENTENCE_TYPE)

    def with_cards(toks: Column, cards: Column) -> Column:
        return step(
            "tag",
            lambda: tags(toks, cards),
            lambda marks: step("mention", lambda: S.merge_runs(toks, marks), lambda merged: build(toks, cards, marks, merged)),
        )

    def with_tokens(toks: Column) -> Column:
        return let(found.cards(toks, language, number), lambda cards: with_cards(toks, cards)) if plan.card else with_cards(toks, F.lit(None))

    return let(found.tokens(sentence, language, number), with_tokens) if steps or every_token else build(*[F.lit(None)] * 4)


def annotate_documents(
    df: DataFrame,
    res: Resources,
    parser: str = "default",
    extra: frozenset[str] = frozenset(),
    body: str = "body",
    wanted: Wanted | None = None,
) -> DataFrame:
    """Adds ``sentences``: with inline lexicons the whole annotation in one narrow
    stage, on batches and streams.

    ``wanted`` names the annotations to build (``planner.ANNOTATIONS``), for all languages or by
    language; what they do not need is neither looked up nor computed, and its
    field is null. ``corref`` is attached when it is named, and brings ``ner`` with it.
    """
    language = F.col("language")
    plan = annotation_plan(wanted, extra)
    held, found = res.attach(df, plan.card, body) if plan.card else (df, _in_place(1))
    nested = F.transform(
        sentences_of(body, language),
        lambda s, i: sentence_struct(s, i + 1, language, res.rules, found, parser, plan, wanted is None),
    )
    done = pin(held.withColumn("sentences", nested), "sentences").select(*[c for c in df.columns if c != "sentences"], "sentences")
    linked = plan.languages("corref")
    return with_corref(done, linked) if linked else done


def to_documents(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The stored document shape; ``corref`` is null unless attached."""
    corref = F.col("corref") if "corref" in df.columns else F.lit(None).cast("string")
    base = df.withColumn("corref", corref)
    return base.select(*DOCUMENT_FIELDS, *keep)


def assemble(sentences: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Nested documents from sentence rows, in sentence order. A group is one document."""
    return (
        sentences.groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("sentence_id", *fields))).alias("sentences"))
    )


def mention_rows(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Mention rows of annotated documents: ``ner``, ``mention``, ``position``."""
    per_sentence = docs.select(*keys, F.explode("sentences").alias("s")).select(
        *keys, F.col("s.sentence_id").alias("position"), F.explode("s.ner").alias("ner", "_m")
    )
    return per_sentence.select(*keys, "ner", "position", F.explode("_m").alias("mention"))


def attach_corref(docs: DataFrame, aliases: DataFrame, keys: list[str]) -> DataFrame:
    """Fills ``corref`` with ``type: alias -> canonical`` entries, sorted."""
    text = F.concat("ner", F.lit(": "), "mention", F.lit(" -> "), "canonical")
    per_doc = (
        aliases.filter(F.col("mention") != F.col("canonical"))
        .groupBy(*keys)
        .agg(F.array_join(F.array_sort(F.collect_list(text)), "; ").alias("corref"))
    )
    return docs.drop("corref").join(per_doc, keys, "left")


def with_corref(docs: DataFrame, languages: list[str] | None = None) -> DataFrame:
    """Fills ``corref`` from the document's own sentences: ``type: alias -> canonical``.

    A mention's canonical form is the longest of its type that it ends, the earliest
    on a tie. Array work within the row, linear in the words of the mentions but for a
    sort: no shuffle, and legal on streams. Languages without aliases in their profile
    get null.
    """

    def entries(forms: Column) -> Column:
        known = F.filter(forms, lambda g: g["key"] != g["canonical"])
        return F.transform(known, lambda g: F.concat(g["ner"], F.lit(": "), g["key"], F.lit(" -> "), g["canonical"]))

    forms = let(mentions_of(F.col("sentences")), lambda m: canonical_forms(m, ("exact", "head"), fold=False))
    text = F.array_join(F.array_sort(entries(forms)), "; ")
    names = sorted(n for n in PROFILES if "corref" in profile(n)) if languages is None else languages
    return docs.withColumn("corref", _for_languages(F.col("language"), names, F.nullif(text, F.lit(""))))


def flat_tokens(token: Column) -> Column:
    """Comma-joined rendering of a token or lemma array."""
    return F.array_join(token, ",")


def to_json_rows(df: DataFrame, key: str | None = None) -> DataFrame:
    """Documents as JSON text in ``value``, with an optional message key."""
    columns = [F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("value")]
    if key:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*columns)
