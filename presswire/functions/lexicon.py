"""Lexicon lookups as plain expressions, for lexicons of a checked size.

The entries become one constant: per language an array of small maps, chosen by
the key's CRC, so a lookup costs a few comparisons whatever the number of entries,
needs no join and no shuffle, and is legal on streams. The constant travels with
every task, so its size in bytes is checked. Tables larger than that go through
``operators.lookup.lookup_join`` instead.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswire.functions.text import let

MAX_INLINE_BYTES = 64 << 20
MAX_INLINE_ENTRIES = 500_000  # rows taken from a frame
MAX_LISTED = 2_000  # keys up to which a word is first tested against the list of all


class InlineLexicon:
    """``(language, key) -> value``; keys are compared in lower case.

    Of several values for one key the least is kept. ``kind`` is the value's
    Spark type, for values that are more than a string.
    """

    def __init__(self, entries: Iterable[tuple[str, str, Any]], kind: str = "string"):
        by_language: dict[str, dict[str, Any]] = {}
        total = 0
        for language, key, value in entries:
            known = by_language.setdefault(language, {})
            word = key.lower()
            known[word] = min(known[word], value) if word in known else value
            total += 1
        self.buckets = max([1, *(len(v) for v in by_language.values())])
        table = {}
        for language, known in by_language.items():
            table[language] = [{} for _ in range(self.buckets)]
            for word, value in known.items():
                table[language][zlib.crc32(word.encode()) % self.buckets][word] = value
        self._table = json.dumps(table, ensure_ascii=False)
        size = len(self._table.encode())
        if size > MAX_INLINE_BYTES:
            raise ValueError(f"{total} entries take {size} bytes: inline lexicons hold {MAX_INLINE_BYTES}; use lookup_join")
        self._kind = f"map<string,array<map<string,{kind}>>>"
        self._keys = sorted({word for known in by_language.values() for word in known})

    @classmethod
    def from_frame(cls, frame: DataFrame) -> "InlineLexicon":
        """From a three-column frame (language, key, value); refuses a large one."""
        rows = frame.limit(MAX_INLINE_ENTRIES + 1).collect()
        if len(rows) > MAX_INLINE_ENTRIES:
            raise ValueError(f"more than {MAX_INLINE_ENTRIES} rows; use lookup_join")
        return cls(tuple(r) for r in rows)

    def lookup(self, tokens: Column, language: Column) -> Column:
        """Values for a token array, null where the lexicon has none."""

        def find(table: Column, key: Column) -> Column:
            slot = F.pmod(F.crc32(key.cast("binary")), F.lit(self.buckets)).cast("int")
            value = F.get(table, slot)[key]
            # Most words are in no lexicon; a set of literals tells that in one test.
            return F.when(key.isin(self._keys), value) if len(self._keys) <= MAX_LISTED else value

        return let(
            F.from_json(F.lit(self._table), self._kind)[language],
            lambda table: F.transform(tokens, lambda t: let(F.lower(t), lambda k: find(table, k))),
        )


def phrase_lexicon(entries: Iterable[tuple[str, str, str]]) -> "InlineLexicon":
    """Gazetteer ``(language, phrase, tag)`` keyed by first word, longest phrases first."""
    return InlineLexicon(phrase_entries(entries), PHRASES)


PHRASES = "array<struct<k: int, phrase: string, tag: string>>"


def phrase_entries(entries: Iterable[tuple[str, str, str]]) -> list[tuple[str, str, list[dict]]]:
    tags: dict[tuple[str, str], str] = {}
    for language, phrase, tag in entries:
        at = (language, phrase.lower())
        tags[at] = min(tags.get(at, tag), tag)
    grouped: dict[tuple[str, str], list[dict]] = {}
    for (language, phrase), tag in tags.items():
        words = phrase.split(" ")
        grouped.setdefault((language, words[0]), []).append({"k": len(words), "phrase": phrase, "tag": tag})
    return [
        (language, first, sorted(found, key=lambda e: -e["k"]))
        for (language, first), found in grouped.items()
    ]


def regex_tags(tokens: Column, rules: Iterable[tuple[str, str]], default: Column) -> Column:
    """Tag tokens by whole-token patterns; patterns of one tag fold into one
    alternation, the first tag listed wins, ``default`` elsewhere."""
    folded: dict[str, list[str]] = {}
    for pattern, tag in rules:
        folded.setdefault(tag, []).append(pattern)

    def one(t: Column) -> Column:
        out = None
        for tag, patterns in folded.items():
            test = t.rlike("^(?:" + "|".join(patterns) + ")$")
            out = F.when(test, F.lit(tag)) if out is None else out.when(test, F.lit(tag))
        return default if out is None else out.otherwise(default)

    return F.transform(tokens, one)
