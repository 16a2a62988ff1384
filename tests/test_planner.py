"""Choosing annotations, and lexicons of any size in place of the inline ones."""

import random
import time

import pytest
from pyspark.sql import functions as F

from presswire.operators import assemble as D
from presswire.operators import entities as E
from presswire.operators import planner
from presswire.operators.docparse import accepted, parse_docs
from presswire.operators.keyfilter import SLICE, key_filter
from presswire.operators.tables import TableResources
from presswire.sources.files import lines_from
from presswire.streaming import run as T

WORDS = "The a new york times Times of York bought good bad in x1 Y2 z".split()
LEMMA = [("ENG", "bought", "buy"), ("ENG", "Times", "time"), ("ENG", "times", "t"), ("ESP", "bought", "no")]
POS = [("ENG", "the", "DT"), ("ENG", "bought", "VBD"), ("ENG", "bought", "VB"), ("ESP", "a", "IN")]
GAZ = [
    ("ENG", "new york", "LOC"), ("ENG", "New York Times", "ORG"), ("ENG", "york", "PER"), ("ENG", "york", "MISC"),
    ("ENG", "times of york", "ORG"), ("ESP", "new", "LOC"), ("ESP", "a new", "ORG"),
]
POLARITY = [("ENG", "good", "1"), ("ENG", "bad", "-2"), ("ENG", "bad", "-1"), ("ESP", "good", "2")]
RULES = [("[A-Z][0-9]", "CODE")]


def records(spark, n=60, seed=1):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        text = " ".join(f"<P>{' '.join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 12)))}. {rnd.choice(WORDS)}</P>" for _ in range(rnd.randint(1, 3)))
        rows.append((f'<DOC id="D{k}" type="story"><TEXT>{text}</TEXT></DOC>', rnd.choice(["ENG", "ESP", "ARA"])))
    rows += rows[:1] * 40  # one document holds many rows
    rows.append(('<DOC id="E" type="story"><TEXT></TEXT></DOC>', "ENG"))
    df = spark.createDataFrame(rows, "value string, lang string")
    return accepted(parse_docs(df, F.col("lang")))


def frame(spark, entries):
    return spark.createDataFrame(entries, "language string, word string, value string")


def tables(spark, **options):
    return TableResources(frame(spark, LEMMA), frame(spark, POS), frame(spark, GAZ), frame(spark, POLARITY), RULES, **options)


def content(df):
    return sorted((repr(r) for r in df.select("doc_id", "language", "sentences").collect()))


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


INLINE = D.Resources(LEMMA, POS, GAZ, POLARITY, RULES)


def test_closure_holds_what_a_step_reads_and_no_more():
    assert planner.closure({"relation"}) == ("token", "tag", "mention", "relation")
    assert planner.closure({"parse", "lemma"}) == ("token", "lemma", "pos", "parse")
    chosen = planner.plan({"ner"})
    assert chosen.card == ("phrases",) and "pos" not in chosen.steps
    assert chosen.languages("ner_merged") == ["ENG"] and chosen.languages("ner_grouped") == ["ESP"]
    assert planner.plan({"ENG": {"sentiment"}}).steps == ("token", "sentiment")
    assert planner.plan({"corref"}).languages("ner_merged") == ["ENG"]
    assert planner.plan(set()).steps == ()
    assert planner.plan().card == planner.CARD_FIELDS
    for wrong in ({"colour"}, {"FRA": {"ner"}}):
        with pytest.raises(ValueError):
            planner.plan(wrong)


@pytest.mark.parametrize("name", [n for n in planner.ANNOTATIONS if n != "corref"])
def test_one_annotation_is_as_in_the_whole(spark, name):
    docs = records(spark)
    whole = D.annotate_documents(docs, INLINE, extra=frozenset({"relation"})).collect()
    part = D.annotate_documents(docs, INLINE, wanted={name}).collect()
    field = {"parse": "parse_sentence"}.get(name, name)
    for a, b in zip(whole, part, strict=True):
        assert [s[field] for s in a["sentences"]] == [s[field] for s in b["sentences"]]
        others = set(D.SENTENCE_FIELDS) - {"sentence_id", "sentence", field}
        assert all(s[o] is None for s in b["sentences"] for o in others)


def test_unwanted_annotations_are_not_built(spark):
    docs = records(spark)
    # What each reads of the cards, which stand as JSON in the plan; tagging also has its suffix rules.
    marks = {"lemma": '"lemma":', "parse": "VBG", "sentiment": '"weight":', "ner": '"phrases":'}
    for name in marks:
        df = D.annotate_documents(docs, INLINE, wanted={name})
        assert "Exchange" not in plan_text(df) and "Join" not in plan_text(df)
        text = df._jdf.queryExecution().analyzed().toString()
        assert {other for other, mark in marks.items() if mark in text} == {name}


def test_corref_is_attached_when_asked_for(spark):
    docs = records(spark)
    asked = D.annotate_documents(docs, INLINE, wanted={"corref"})
    by_hand = D.with_corref(D.annotate_documents(docs, INLINE))
    assert sorted(map(repr, asked.select("doc_id", "corref").collect())) == sorted(map(repr, by_hand.select("doc_id", "corref").collect()))
    assert asked.filter("corref is not null").count() > 0


@pytest.mark.parametrize("blocks", [1, 7, None])
def test_tables_equal_the_inline_form(spark, blocks):
    docs = records(spark)
    res = tables(spark, blocks=blocks, slots=4)
    assert res.longest == 3
    for options in ({"extra": frozenset({"relation"})}, {"wanted": {"sentiment"}}, {"wanted": {"ner"}}, {"wanted": {"token"}}):
        assert content(D.annotate_documents(docs, res, **options)) == content(D.annotate_documents(docs, INLINE, **options))


def test_single_tables_and_empty_input(spark):
    docs = records(spark)
    only = TableResources(polarity=frame(spark, POLARITY))
    assert content(D.annotate_documents(docs, only)) == content(D.annotate_documents(docs, D.Resources(polarity=POLARITY)))
    assert D.annotate_documents(docs.limit(0), only).count() == 0
    nothing = TableResources(lemma=frame(spark, LEMMA[:0]))
    assert content(D.annotate_documents(docs, nothing)) == content(D.annotate_documents(docs, D.Resources()))
    with pytest.raises(ValueError):
        TableResources()


def test_five_million_entries(spark):
    n = 5_000_000
    words = spark.range(n).select(F.lit("ENG").alias("language"), F.concat(F.lit("w"), "id").alias("word"), F.concat(F.lit("l"), "id").alias("value"))
    res = TableResources(lemma=words, gazetteer=words.select("language", F.concat_ws(" ", "word", "word"), F.lit("T")))
    assert res.longest == 2 and res.table.count() == 2 * n
    text = '<DOC id="D" type="story"><TEXT><P>W17 w4999999 w4999999 w5000000 other.</P></TEXT></DOC>'
    first = D.annotate_documents(accepted(parse_docs(lines_from(spark, [text]))), res).first()["sentences"][0]
    assert first["lemma"] == ["l17", "l4999999", "l4999999", "w5000000", "other", "."]
    assert first["ner"] == {"T": ["w4999999 w4999999"]}


def test_streams_annotate_from_tables_batch_by_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    texts = [f'M{k}#<DOC id="D{k}" type="story"><TEXT><P>The New York Times bought good x{k}.</P></TEXT></DOC>' for k in range(6)]
    for part in (texts[:3], texts[3:], ["M9#junk"]):
        spark.createDataFrame([(t,) for t in part], "value string").coalesce(1).write.mode("append").text(source)
    res = tables(spark, blocks=2, slots=4)
    messages = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(source)
    with pytest.raises(ValueError, match="batch"):
        T.annotate_stream(messages, res)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    T.wait(T.start(T.store_messages(messages, res, good, bad), str(tmp_path / "checkpoint")))
    batch = T.annotate_stream(spark.createDataFrame([(t,) for t in texts], "value string"), INLINE)
    assert content(spark.read.parquet(good)) == content(batch)
    assert [r["reason"] for r in spark.read.parquet(bad).collect()] == ["not_doc"]


def test_key_filter_loses_no_key_and_admits_few_others(spark):
    table = spark.range(0, 40_000, 2).select(F.lit("ENG").alias("l"), F.col("id").cast("string").alias("k"))
    held = key_filter(table, ["l", "k"])
    assert held.bits % SLICE == 0
    rows = spark.range(40_000).select("id", F.lit("ENG").alias("l"), F.col("id").cast("string").alias("k"))
    admitted = held.admit(rows)
    assert admitted.filter("id % 2 = 0").count() == 20_000
    assert 0 < admitted.filter("id % 2 = 1").count() < 0.1 * 20_000
    assert admitted.columns == rows.columns
    assert "BroadcastHashJoin" in plan_text(admitted) and "Exchange hashpartitioning(id" not in plan_text(admitted)
    assert key_filter(table, ["l", "k"], bits=1).admit(rows).filter("id % 2 = 0").count() == 20_000
    assert key_filter(table.limit(0), ["l", "k"]).admit(rows).count() == 0


def test_large_gazetteers_move_little_more_than_matches(spark):
    rows = spark.range(3000).select(F.col("id").alias("sid"), F.lit("ENG").alias("language"), F.transform(F.sequence(F.lit(0), F.lit(19)), lambda k: F.concat(F.lit("w"), ((F.col("id") * 7 + k * 13) % 5000).cast("string"))).alias("token"))
    gazetteer = spark.range(100).select(F.lit("ENG").alias("language"), F.concat(F.lit("w"), F.col("id") * 50).alias("phrase"), F.lit("P").alias("ner"))
    small = E.tag_by_gazetteer(rows, gazetteer, ["sid"], 2)
    large = E.tag_by_gazetteer(rows, gazetteer, ["sid"], 2, max_rows=0)
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
    offered = rows.select("language", F.explode(F.transform(E.grams(F.col("token"), 2), lambda g: F.lower(g["text"]))).alias("phrase"))
    admitted = key_filter(gazetteer.select("language", "phrase"), ["language", "phrase"]).admit(offered).count()
    assert small.count() <= admitted <= small.count() + 0.01 * offered.count() + 50


def test_phrases_of_one_first_word_take_no_longer(spark):
    names = [("ENG", f"the w{n}", "A" if n % 2 else "B") for n in range(3000)] + [("ENG", "the w1 w2", "C"), ("ENG", "the", "D")]
    gazetteer = spark.createDataFrame(names, "language string, phrase string, ner string")
    body = " ".join(f"the w{n}" for n in range(3000)) + ". the w1 w2 the"
    docs = spark.createDataFrame([(str(n), "ENG", body) for n in range(40)], "doc_id string, language string, body string")
    begun = time.monotonic()
    res = TableResources(gazetteer=gazetteer, blocks=1)
    got = D.annotate_documents(docs, res, wanted={"ner"}).select("sentences").collect()
    assert time.monotonic() - begun < 60
    assert all(len(r[0]) == 2 and r[0][1]["ner"] == {"C": ["the w1 w2"], "D": ["the"]} for r in got)


def test_a_let_value_is_neither_copied_nor_evaluated_twice(spark):
    from presswire.functions.text import let

    df = spark.range(5).select(let(F.rand(1), lambda a: let(a + 1, lambda b: b - a)).alias("d"), let(F.lit(None).cast("int"), lambda v: F.coalesce(v, F.lit(7))).alias("n"))
    assert "transform(" not in df._jdf.queryExecution().executedPlan().toString()
    assert all(abs(r["d"] - 1) < 1e-9 and r["n"] == 7 for r in df.collect())


@pytest.mark.parametrize("entries", [5, 3000])
def test_lookups_agree_with_and_without_a_list_of_keys(spark, entries):
    from presswire.functions.lexicon import InlineLexicon

    known = InlineLexicon([("ENG", f"Word{i}", f"v{i}") for i in range(entries)] + [("ESP", "sí", "yes")])
    token = F.array(F.lit("word1"), F.lit("WORD4"), F.lit("none"), F.lit("SÍ"), F.lit(None).cast("string"))
    row = spark.range(1).select(known.lookup(token, F.lit("ENG")), known.lookup(token, F.lit("ESP")), known.lookup(token, F.lit("ARA"))).first()
    assert tuple(row[0]) == ("v1", "v4", None, None, None) and tuple(row[1]) == (None, None, None, "yes", None)
    assert row[2] is None or not any(row[2])


def test_cards_of_tables_are_looked_up_a_block_at_a_time(spark):
    """No lookup in the plan goes word by word, and lines without words keep their place."""
    import pyarrow as pa

    from presswire.operators.blocks import Phrases, Words

    docs = records(spark)
    done = D.annotate_documents(docs, tables(spark), extra=frozenset({"relation"}))
    text = done._jdf.queryExecution().analyzed().toString()
    assert "crc32" not in text and "FlatMapCoGroupsInArrow" in text
    words = Words.of(pa.array(["a b\n\nc", "", None, "\n", "a"]))
    assert words.words.to_pylist() == ["a", "b", "c", "a"]
    assert words.sizes.tolist() == [2, 0, 1, 0, 0, 0, 0, 1] and words.lines.tolist() == [3, 1, 1, 2, 1]
    found = Words.of(pa.array(["x a b c", "b\nc d", "b c d b"]))
    assert Phrases(pa.array(["a b", "b c", "b c d", "x", "c"]), 3).cover(found).tolist() == [3, 0, 0, 1, -1, 4, -1, 2, 2, 2, -1]
    assert Phrases(pa.array([], pa.string()), 2).cover(found).tolist() == [-1] * 11
