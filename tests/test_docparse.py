import pytest
from pyspark.sql import functions as F

from presswire.operators import docparse as P
from presswire.sources.files import lines_from


def story(body="<P> a b </P>", attrs='id="X1" type="story" ', head="", date=""):
    return f"<DOC {attrs}> {head} {date} <TEXT> {body} </TEXT> </DOC>"


def parse(spark, value, **options):
    return P.parse_docs(lines_from(spark, [value]), **options).first()


@pytest.mark.parametrize(
    ("value", "reason"),
    [
        ("", "blank"), ("   \t ", "blank"), ("junk", "not_doc"), ('<DOC id="1" type="story">', "no_text"),
        (story(head="<HEADLINE> x"), "bad_headline"), (story(date="<DATELINE> x"), "bad_dateline"),
        (story(head="</HEADLINE><HEADLINE>"), "bad_headline"),
        (story(attrs='type="story"'), "no_id"), (story(attrs='id="1" type="multi"'), "not_story"), (story(), None),
    ],
)
def test_reasons(spark, value, reason):
    assert parse(spark, value)["reason"] == reason


def test_language_routing(spark):
    assert parse(spark, story(), language="FRA")["reason"] == "bad_lang"
    assert parse(spark, story(), language=F.lit(None).cast("string"))["reason"] == "bad_lang"
    assert parse(spark, story(), language="ESP")["reason"] is None


@pytest.mark.parametrize(
    ("attrs", "doc_id", "kind"),
    [
        ('id="A" type="story"', "A", "story"), ('ID="A" TYPE="STORY"', "A", "STORY"), ('id = "A" type = "story"', "A", "story"),
        ("id=A type=story", "A", "story"), ('id="A b" type="story"', "A b", "story"), ('id="A" id="B" type="story"', "B", "story"),
        ('docid="Z" id="A" type=" story "', "A", " story "),
    ],
)
def test_attributes(spark, attrs, doc_id, kind):
    row = parse(spark, story(attrs=attrs))
    assert (row["doc_id"], row["type"], row["reason"]) == (doc_id, kind, None)


def test_header_in_either_order(spark):
    head, date = "<HEADLINE> Big\nnews </HEADLINE>", "<DATELINE> MUMBAI </DATELINE>"
    for value in (story(head=head, date=date), story(head=date, date=head)):
        row = parse(spark, value)
        assert (row["head_line"], row["date_line"], row["doc_id"]) == ("Big news", "MUMBAI", "X1")


def test_body_spaced_and_arabic(spark):
    body = '<P> one </P> <P> two. </P> <P> </P> <P>three!</P>'
    row = parse(spark, story(body))
    assert row["body"] == "one. two.  three!. "
    assert row["paragraphs"] == ["one.", "two.", "three!."]
    arabic = parse(spark, story(body), language="ARA")
    assert arabic["body"] == "one.  two.   three!.  "


def test_body_without_paragraphs_and_entities(spark):
    assert parse(spark, "<DOC id=1 type=story><TEXT>plain &amp; simple</TEXT></DOC>")["body"] == "plain &amp; simple."
    row = parse(spark, story("<P>a &lt; b $5</P>"), decode=True)
    assert row["paragraphs"] == ["a < b $5."]


def test_id_can_be_optional(spark):
    assert parse(spark, story(attrs="type=story"), require_id=False)["reason"] is None


def test_split_docs(spark):
    a, b = story(attrs='id="1" type="story"'), story(attrs='id="2" type="story"')
    df = P.split_docs(lines_from(spark, [f"log {a} Exception: {b} x <DOC id=\"3", "no document"]))
    rows = P.parse_docs(df).orderBy("value", "doc_pos").select("doc_pos", "doc_id", "reason").collect()
    assert sorted((r["doc_pos"], r["doc_id"], r["reason"]) for r in rows) == [
        (1, "", "not_doc"), (1, "1", None), (2, "2", None), (3, "", "no_text"),
    ]


@pytest.mark.parametrize(
    ("message", "mongo_id", "rest"),
    [("7#<DOC a#b>", "7", "<DOC a#b>"), ("<DOC a#b>", "", "<DOC a#b>"), ("plain", "", "plain"), ("#x", "", "x"), ("a#b#c", "a", "b#c")],
)
def test_envelope(spark, message, mongo_id, rest):
    row = P.envelope(lines_from(spark, [message])).first()
    assert (row["mongo_id"], row["value"]) == (mongo_id, rest)


def test_dead_letters_skip_normal_drops(spark):
    values = ["", "junk", story(), story(attrs="id=1 type=other"), '<DOC id=1 type="story">']
    df = P.dead_letters(P.parse_docs(lines_from(spark, values)))
    assert sorted(r["reason"] for r in df.collect()) == ["no_text", "not_doc"]


def test_xml_form(spark):
    values = [
        '<DOC ID="A" TYPE="multi"><HEADLINE> H </HEADLINE><TEXT><P> a &amp;\nb </P><P/><P>c.</P></TEXT></DOC>',
        '<DOC id="B"><TEXT><P>broken</TEXT></DOC>',
        '<DOC type="story"><TEXT><P>x</P></TEXT></DOC>',
        " ",
        '<DOC id="C"><TEXT>mixed only</TEXT></DOC>',
    ]
    rows = {r["value"]: r for r in P.parse_docs_xml(lines_from(spark, values)).collect()}
    good = rows[values[0]]
    assert (good["doc_id"], good["type"], good["head_line"], good["reason"]) == ("A", "multi", "H", None)
    assert good["body"] == "a & b.  c." and good["paragraphs"] == ["a & b.", "c."]
    assert rows[values[1]]["reason"] == "bad_xml"
    assert rows[values[2]]["reason"] == "no_id"
    assert rows[values[3]]["reason"] == "blank"
    assert (rows[values[4]]["reason"], rows[values[4]]["body"]) == (None, "")


def test_paragraph_sentences_keep_empty_ones(spark):
    df = P.paragraph_sentences(lines_from(spark, ['<DOC id="A"><TEXT><P>a</P><P> </P><P>b</P></TEXT></DOC>']))
    assert [(r["sentence_id"], r["sentence"]) for r in df.orderBy("sentence_id").collect()] == [(1, "a"), (2, ""), (3, "b")]


def test_concat_bodies_keeps_order_at_any_size(spark):
    rows = [("f", i, f"{i};") for i in range(2500)] + [("g", 3, "z")]
    df = spark.createDataFrame(rows, "src string, pos long, body string").repartition(5)
    out = P.concat_bodies(df, ["src"], "pos").collect()
    assert [(r["src"], r["pos"], r["body"]) for r in out] == rows


def test_cut_record_is_reported(spark):
    rows = lines_from(spark, ['<DOC id="A" type="story"><TEXT><P>whole</P></TEXT></DOC>', '<DOC id="B" type="story"><TEXT><P>cut sho</DOC>'])
    assert [r["reason"] for r in P.parse_docs(rows).collect()] == [None, "cut_short"]
