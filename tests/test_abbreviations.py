"""Learned abbreviations."""

import math
import random

import pytest

from presswire.functions.segment import segment
from presswire.operators import abbreviations as B


def corpus():
    rnd = random.Random(3)
    words = "house river mountain smith jones market bought quickly yesterday green".split()
    rows = []
    for _ in range(400):
        parts = []
        for _ in range(rnd.randint(2, 5)):
            s = [rnd.choice(words) for _ in range(rnd.randint(3, 9))]
            s[rnd.randrange(len(s) - 1)] = rnd.choice(["Dr.", "Mr.", "U.S.", "(e.g.", "no", "at"])
            parts.append(" ".join(s).capitalize() + rnd.choice([".", ".", "!", '."']))
        rows.append(" ".join(parts))
    return rows


@pytest.fixture(scope="module")
def learned(spark):
    return B.learn_abbreviations(spark.createDataFrame([(t,) for t in [*corpus(), None, ""]], "body string")).cache()


def test_types_that_carry_periods_are_found(learned):
    assert {r["word"] for r in learned.collect()} == {"dr", "mr", "u.s", "e.g"}


def test_scores_equal_the_formula(spark, learned):
    types = B.period_types(spark.createDataFrame([(t,) for t in corpus()], "body string")).collect()
    dotted, words = sum(r["dotted"] for r in types), sum(r["dotted"] + r["plain"] for r in types)
    got = {r["word"]: r["score"] for r in learned.collect()}
    for r in types:
        a, b, p = r["dotted"], r["plain"], dotted / words
        ll = -2 * (a * math.log(p) + b * math.log(1 - p) - a * math.log(0.99) - b * math.log(0.01))
        n = len(r["word"].replace(".", ""))
        score = ll * math.exp(-n) * (r["word"].count(".") + 1) * n**-b
        assert (score >= B.LIMIT and a > 0) == (r["word"] in got)
        if r["word"] in got:
            assert got[r["word"]] == pytest.approx(score)


def test_sentences_go_on_behind_an_abbreviation(one, learned):
    known = B.Abbreviations(learned)
    text = 'We met Dr. Smith. He left (e.g. by car). "Mr.\n Jones" bought U.S. stock! Why? It cost 2.5 no. 3. Then no. '
    want = ["We met Dr. Smith.", "He left (e.g. by car).", '"Mr.\n Jones" bought U.S. stock!', "Why?", "It cost 2.5 no.", "3.", "Then no."]
    assert one(text, known.segment("x")) == want
    assert one("", known.segment("x")) == [] and one("Dr. ", known.segment("x")) == ["Dr."]
    assert one(None, known.segment("x")) is None


def test_without_a_list_sentences_are_the_plain_ones(spark, one):
    nothing = B.Abbreviations(B.learn_abbreviations(spark.createDataFrame([], "body string")))
    for text in corpus()[:30]:
        assert one(text, nothing.segment("x")) == one(text, segment("x"))


def test_a_corpus_without_or_with_only_periods(spark):
    for text in ("no stop at all", "a. b."):
        assert B.learn_abbreviations(spark.createDataFrame([(text,)], "body string")).count() == 0


def test_patterns_run_on_words_already_counted(spark):
    df = spark.createDataFrame([("Dr. Dr. no", 1), ("(Dr.) no. no", 2), (None, 3)], "body string, k int")
    types = B.period_types(df)
    text = types._jdf.queryExecution().executedPlan().toString()
    first = text.index("Exchange hashpartitioning(w#")  # what stands behind it runs before it
    assert "RLIKE" in text[:first] and not any(x in text[first:] for x in ("RLIKE", "regexp_replace"))
    assert {tuple(r) for r in types.collect()} == {("dr", 3, 0), ("no", 1, 2)}
