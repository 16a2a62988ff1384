"""Arabic letter normalisation applied before tokenising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswire.functions.text import col

# Fixed values.
DIGITS_FROM = "٠١٢٣٤٥٦٧٨٩"
DIGITS_TO = "0123456789"
ALIF_FROM = "آأإٱ"
ALIF_TO = "اااا"
YA_FROM = "ى"
YA_TO = "ي"
DIACRITICS = r"[ً-ْٰ]"
TATWEEL = "ـ"
PRO_MARKER = r"\[nullp\]"
SEGMENT_MARKER = r"(^|\s)-+|-+(\s|$)"
MORPH_MARKER = "+"
LENGTHENING = r"([ء-ي])\1{2,}"
BRACKETS = (("(", "-LRB-"), (")", "-RRB-"))


def normalize_arabic(c: Column | str) -> Column:
    """Digits, alif and ya forms folded; diacritics, tatweel, markers and
    stretched letters removed."""
    text = F.translate(col(c), DIGITS_FROM + ALIF_FROM + YA_FROM, DIGITS_TO + ALIF_TO + YA_TO)
    text = F.regexp_replace(text, DIACRITICS, "")
    text = F.replace(text, F.lit(TATWEEL), F.lit(""))
    text = F.regexp_replace(text, PRO_MARKER, "")
    text = F.regexp_replace(text, SEGMENT_MARKER, "$1$2")
    text = F.replace(text, F.lit(MORPH_MARKER), F.lit(""))
    return F.regexp_replace(text, LENGTHENING, "$1")


def escape_brackets(tokens: Column) -> Column:
    """Round brackets as ``-LRB-`` and ``-RRB-`` in a token array."""

    def one(t: Column) -> Column:
        out = t
        for plain, name in BRACKETS:
            out = F.when(t == plain, F.lit(name)).otherwise(out)
        return out

    return F.transform(tokens, one)
