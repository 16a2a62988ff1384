import pytest
from pyspark.sql import functions as F

from presswire.functions import text as X
from presswire.functions.arabic import normalize_arabic
from presswire.functions.segment import segment, segment_periods, tokenize, tokenize_arabic


@pytest.mark.parametrize(
    ("given", "want"),
    [("\n a \t", "a"), ("\x00\x1f x y \x01", "x y"), ("", ""), (" \t\r\n ", ""), (" a ", " a ")],
)
def test_jtrim(one, given, want):
    assert one(given, X.jtrim("x")) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("a b", ["a", "b"]), ("a  b  ", ["a", "", "b"]), (" a", ["", "a"]), ("", [""]), ("  ", []),
        ("a\nb c", ["a\nb", "c"]), ("a\t ", ["a\t"]), ("a", ["a"]), (" a ", ["", "a"]), ("a   b", ["a", "", "", "b"]),
    ],
)
def test_jsplit(one, given, want):
    assert one(given, X.jsplit("x")) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [("a</P>b</P>", ["a", "b"]), ("a</P> ", ["a", " "]), ("", [""]), ("</P></P>", []), ("</P>a", ["", "a"])],
)
def test_jsplit_regex(one, given, want):
    assert one(given, X.jsplit_regex("x", "</P>")) == want


def test_null_stays_null(one):
    for expression in (X.jtrim("x"), X.jsplit_regex("x", ","), X.finish_sentence("x"), segment("x")):
        assert one(None, expression) is None


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("<user>\n<name>A b</name></user>", "A b"), ("<name>A<\\name>", "A"), ("no\ntag", "no tag"),
        ("<name>open", "<name>open"), ("<name></name>", ""), ("x<name>1</name><name>2</name>", "1"),
    ],
)
def test_extract_field(one, given, want):
    assert one(given, X.extract_field("x", "name")) == want


def test_strip_markup(one):
    html = "<html><style>p{}</style><p>a &amp; b</p><!-- <p>no</p> --><script>var t='</p>';</script>\n<b>c&nbsp;&lt;d</b>"
    assert one(html, X.strip_markup("x")) == "a & b c <d"


def test_last_index(one):
    assert one("a>b>", X.last_index("x", ">")) == 4
    assert one("a<P>b<P>c", X.last_index("x", "<P>")) == 6
    assert one("abc", X.last_index("x", ">")) == 0


@pytest.mark.parametrize(("given", "want"), [(" a ", "a."), ("a.", "a."), ("a!", "a!."), ("  ", ""), ('"a."', '"a.".')])
def test_finish_sentence(one, given, want):
    assert one(given, X.finish_sentence("x")) == want


def test_segment_keeps_decimals_and_quotes(one):
    text = 'He paid 2.5 pounds. "Really?" she said! Yes.  No'
    assert one(text, segment("x")) == ["He paid 2.5 pounds.", '"Really?"', "she said!", "Yes.", "No"]
    assert one(" . ", segment("x")) == ["."]
    assert one("", segment("x")) == []


def test_period_split_cuts_decimals(one):
    assert one("a 2.5 b. . c", segment_periods("x")) == ["a 2", "5 b", "c"]


def test_tokenize(one):
    assert one("U.S. firm's 16,000 e-mails: ok?", tokenize("x")) == [
        "U.S", ".", "firm's", "16,000", "e-mails", ":", "ok", "?",
    ]


def test_arabic_normalisation(one):
    assert one("أحمد إلى آخر", normalize_arabic("x")) == "احمد الي اخر"
    assert one("كَتَبَ ٢٠٢٤", normalize_arabic("x")) == "كتب 2024"
    assert one("جمييييل", normalize_arabic("x")) == "جميل"
    assert one("سـلام و+ال -ه [nullp]", normalize_arabic("x")) == "سلام وال ه "
    assert one("قال (نعم)", tokenize_arabic("x")) == ["قال", "-LRB-", "نعم", "-RRB-"]


def test_let_binds_once(one):
    assert one("a", X.let(F.upper("x"), lambda v: F.concat(v, v))) == "AA"
