"""What annotating a sentence takes: a graph of steps, closed over what is asked for.

A step names the steps it reads and the fields of a word's card it looks up. Only
steps that a wanted annotation needs, directly or through others, are built; a word
is looked up only if some step reads its card, and the card holds no more
fields than those steps read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

# Annotations produced per language. Both parser modes bracket every
# sentence, however long; ``sentences.mark_long`` flags those over the limit.
PROFILES: dict[str, frozenset[str]] = {
    "ENG": frozenset({"token", "lemma", "parse", "ner_merged", "sentiment", "corref"}),
    "ESP": frozenset({"token", "lemma", "parse", "ner_grouped"}),
    "ARA": frozenset({"token", "parse"}),
}
OPTIONAL = frozenset({"relation"})


@dataclass(frozen=True)
class Step:
    needs: tuple[str, ...] = ()
    card: tuple[str, ...] = ()


STEPS: dict[str, Step] = {
    "token": Step(),
    "lemma": Step(("token",), ("lemma",)),
    "pos": Step(("token",), ("pos",)),
    "parse": Step(("token", "pos")),
    "tag": Step(("token",), ("phrases",)),
    "mention": Step(("token", "tag")),
    "ner_merged": Step(("mention",)),
    "ner_grouped": Step(("token", "tag")),
    "relation": Step(("token", "mention")),
    "sentiment": Step(("token",), ("weight",)),
    "corref": Step(("ner_merged",)),
}
CARD_FIELDS = ("lemma", "pos", "weight", "phrases")

# What callers ask for, and the steps that can answer it.
ANNOTATIONS: dict[str, tuple[str, ...]] = {
    "token": ("token",),
    "lemma": ("lemma",),
    "parse": ("parse",),
    "ner": ("ner_merged", "ner_grouped"),
    "relation": ("relation",),
    "sentiment": ("sentiment",),
    "corref": ("corref",),
}
Wanted = Iterable[str] | Mapping[str, Iterable[str]]


def closure(names: Iterable[str]) -> tuple[str, ...]:
    """The steps ``names`` need, themselves included, each after those it reads."""
    order: dict[str, None] = {}

    def add(name: str) -> None:
        if name not in order:
            for other in STEPS[name].needs:
                add(other)
            order[name] = None

    for name in sorted(names):
        add(name)
    return tuple(order)


@dataclass(frozen=True)
class Plan:
    """The annotations of each language and what building them takes."""

    given: dict[str, frozenset[str]]

    @property
    def steps(self) -> tuple[str, ...]:
        return closure({name for names in self.given.values() for name in names})

    @property
    def card(self) -> tuple[str, ...]:
        """Fields the steps look up."""
        read = {f for s in self.steps for f in STEPS[s].card}
        return tuple(f for f in CARD_FIELDS if f in read)

    def languages(self, name: str) -> list[str]:
        return sorted(lang for lang, names in self.given.items() if name in names)


def profile(language: str, extra: Iterable[str] = ()) -> frozenset[str]:
    """Annotations of a language, with optional ones switched on."""
    return PROFILES.get(language, frozenset()) | (frozenset(extra) & OPTIONAL)


def plan(wanted: Wanted | None = None, extra: Iterable[str] = ()) -> Plan:
    """The plan for ``wanted``: names of annotations, or names by language.

    A language gives what its profile holds of them; an optional annotation that is
    named is on. Without ``wanted`` a language gives its whole profile but ``corref``, which
    is attached to documents on its own. Languages left out of a mapping get nothing.
    """
    given = {}
    for language in PROFILES:
        if wanted is None:
            given[language] = profile(language, extra) - {"corref"}
            continue
        asked = frozenset(wanted.get(language, ()) if isinstance(wanted, Mapping) else wanted)
        if unknown := asked - ANNOTATIONS.keys():
            raise ValueError(f"no annotation is called {', '.join(sorted(unknown))}; there are {', '.join(ANNOTATIONS)}")
        steps = {s for name in asked for s in ANNOTATIONS[name]}
        kept = frozenset(steps) & profile(language, frozenset(extra) | asked)
        given[language] = kept | ({"ner_merged"} if "corref" in kept else frozenset())  # it reads the stored mentions
    if isinstance(wanted, Mapping) and (unknown := wanted.keys() - PROFILES.keys()):
        raise ValueError(f"no profile for {', '.join(sorted(unknown))}")
    return Plan(given)
