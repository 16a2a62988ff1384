"""Small lexicons used by the registered queries and shared with their SQL."""

from __future__ import annotations

from presswire.operators.assemble import Resources

# Fixed values: (language, word, lemma).
LEMMAS = (
    ("ENG", "is", "be"), ("ENG", "are", "be"), ("ENG", "was", "be"), ("ENG", "were", "be"),
    ("ENG", "been", "be"), ("ENG", "has", "have"), ("ENG", "had", "have"), ("ENG", "an", "a"),
    ("ENG", "those", "that"), ("ENG", "these", "this"),
    ("ESP", "la", "el"), ("ESP", "los", "el"), ("ESP", "las", "el"), ("ESP", "una", "un"),
    ("ESP", "del", "de"), ("ESP", "al", "a"), ("ESP", "es", "ser"), ("ESP", "son", "ser"),
)

# Fixed values: (language, word, most frequent part-of-speech tag).
POS = (
    ("ENG", "the", "DT"), ("ENG", "a", "DT"), ("ENG", "an", "DT"), ("ENG", "this", "DT"),
    ("ENG", "that", "IN"), ("ENG", "of", "IN"), ("ENG", "in", "IN"), ("ENG", "for", "IN"),
    ("ENG", "on", "IN"), ("ENG", "with", "IN"), ("ENG", "as", "IN"), ("ENG", "by", "IN"),
    ("ENG", "at", "IN"), ("ENG", "from", "IN"), ("ENG", "to", "TO"), ("ENG", "and", "CC"),
    ("ENG", "or", "CC"), ("ENG", "is", "VBZ"), ("ENG", "was", "VBD"), ("ENG", "are", "VBP"),
    ("ENG", "be", "VB"), ("ENG", "it", "PRP"), ("ENG", "he", "PRP"),
    ("ESP", "el", "DT"), ("ESP", "la", "DT"), ("ESP", "los", "DT"), ("ESP", "las", "DT"),
    ("ESP", "un", "DT"), ("ESP", "una", "DT"), ("ESP", "de", "IN"), ("ESP", "en", "IN"),
    ("ESP", "por", "IN"), ("ESP", "con", "IN"), ("ESP", "para", "IN"), ("ESP", "que", "IN"),
    ("ESP", "y", "CC"), ("ESP", "no", "RB"), ("ESP", "se", "PRP"), ("ESP", "su", "PRP$"),
    ("ESP", "es", "VBZ"),
)

# Further tags of words above, which make them ambiguous.
MORE_POS = (
    ("ENG", "that", "DT"), ("ENG", "this", "PRP"), ("ENG", "as", "RB"), ("ENG", "on", "RB"), ("ENG", "in", "RB"),
    ("ENG", "by", "RB"), ("ENG", "or", "IN"), ("ESP", "la", "PRP"), ("ESP", "que", "PRP"), ("ESP", "una", "PRP"),
)

# Fixed values: (language, phrase, entity type).
GAZETTEER = (
    ("ENG", "orre", "PERSON"), ("ENG", "orre orre", "PERSON"), ("ENG", "th", "PERSON"),
    ("ENG", "the er", "LOCATION"), ("ENG", "thanedble", "PERSON"), ("ENG", "er", "LOCATION"),
    ("ENG", "thon", "LOCATION"), ("ENG", "inoran", "LOCATION"), ("ENG", "in the th", "LOCATION"),
    ("ENG", "nd", "ORGANIZATION"), ("ENG", "of th", "PERSON"),
    ("ENG", "attion to thanedble", "ORGANIZATION"), ("ENG", "orantion", "ORGANIZATION"),
    ("ENG", "ing", "MISC"), ("ENG", ",", "MISC"),
    ("ESP", "ción", "ORGANIZATION"), ("ESP", "ado", "PERSON"), ("ESP", "mente", "LOCATION"),
    ("ESP", "de la", "LOCATION"), ("ESP", "los ci", "PERSON"), ("ESP", "ci", "PERSON"), ("ESP", "ra", "PERSON"),
)

# Fixed values: (language, word, weight).
POLARITY = (
    ("ENG", "ing", "1"), ("ENG", "ble", "1"), ("ENG", "tion", "1"), ("ENG", "an", "1"),
    ("ENG", "ed", "-1"), ("ENG", "st", "-1"), ("ENG", "ha", "-2"), ("ENG", "was", "-1"),
    ("ESP", "ta", "1"), ("ESP", "do", "1"), ("ESP", "rr", "-1"), ("ESP", "no", "-1"),
)

# Fixed values: (whole-token pattern, entity type), first match wins.
RULES = (
    (r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", "IP"),
    (r"[0-9a-f]{40}", "HASH"),
    (r"[0-9]+(?:[.,][0-9]+)*", "NUMBER"),
    (r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*\.(?:com|net|org)", "DOMAIN"),
    (r"\p{Lu}{2,}", "ACRONYM"),
)


def resources(rules: bool = False) -> Resources:
    return Resources(LEMMAS, POS, GAZETTEER, POLARITY, RULES if rules else ())
