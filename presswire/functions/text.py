"""String functions with JVM string semantics, built from Spark expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BLANKS = "".join(map(chr, range(0x21)))
MARKUP = r"(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>|<[^>]+>"
ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Without it the optimizer may inline ``value`` into a lambda, where it would
    be evaluated again for every array element. The value is the start of an aggregate over no
    elements: unlike the result of a ``transform`` it is not copied, however deep lets are nested.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, body)


def jtrim(c: Column | str) -> Column:
    """Trim every character up to U+0020 (Spark's ``trim`` strips spaces only)."""
    return F.btrim(col(c), F.lit(BLANKS))


def jtrim_element(t: Column) -> Column:
    """The same for the element of an array, which may be named several times.

    A trim of given characters first lists the places of the whole text, so one whose first and
    last character stay is left as it is."""
    return F.when((t >= "!") & (F.right(t, F.lit(1)) >= "!"), t).otherwise(jtrim(t))


def jsplit(c: Column | str) -> Column:
    """Split on one space: trailing empty words go, inner and leading ones stay."""
    c = col(c)
    head = F.rtrim(c)
    return F.when((c != "") & (head == ""), F.array().cast("array<string>")).otherwise(
        F.split(head, " ")
    )


def jsplit_regex(c: Column | str, pattern: str) -> Column:
    """Split on a pattern and drop trailing empty pieces; ``''`` stays one piece."""
    def kept(pieces: Column) -> Column:
        last = F.array_max(F.transform(pieces, lambda x, i: F.when(x != "", i + 1).otherwise(0)))
        return F.slice(pieces, F.lit(1), last)

    return let(
        col(c),
        lambda t: F.when(t == "", F.array(t)).otherwise(let(F.split(t, pattern, -1), kept)),
    )


def decode_entities(c: Column | str) -> Column:
    out = col(c)
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


def escape_entities(c: Column | str) -> Column:
    out = col(c)
    for name, char in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def strip_markup(c: Column | str) -> Column:
    """Plain text of a marked-up page: tags, scripts and styles out, blanks folded."""
    plain = decode_entities(F.regexp_replace(col(c), MARKUP, " "))
    return jtrim(F.regexp_replace(plain, r"\s+", " "))


def extract_field(c: Column | str, tag: str) -> Column:
    """Text between ``<tag>`` and ``</tag>``; the whole input when either is missing.

    Line breaks become spaces and ``<\\`` becomes ``</`` first.
    """
    opened, closed = f"<{tag}>", f"</{tag}>"
    text = F.replace(F.replace(col(c), F.lit("\n"), F.lit(" ")), F.lit("<\\"), F.lit("</"))
    return let(
        text,
        lambda t: F.when(
            t.contains(opened) & t.contains(closed),
            F.get(F.split(F.get(F.split(t, F.lit(opened), -1), F.lit(1)), F.lit(closed), -1), F.lit(0)),
        ).otherwise(t),
    )


def last_index(c: Column | str, needle: str) -> Column:
    """1-based position of the last occurrence, 0 when absent."""
    c = col(c)
    back = F.instr(F.reverse(c), needle[::-1])
    return F.when(back == 0, F.lit(0)).otherwise(F.length(c) - back - len(needle) + 2)


def finish_sentence(c: Column | str) -> Column:
    """Trimmed text ending in a full stop; empty stays empty."""
    return let(
        jtrim(c),
        lambda s: F.when((s == "") | s.endswith("."), s).otherwise(F.concat(s, F.lit("."))),
    )
