import collections
import random

import pytest
from pyspark.sql import functions as F

from presswire.functions import annotate as A
from presswire.functions import spans as S
from presswire.functions.lexicon import InlineLexicon, phrase_lexicon, regex_tags
from presswire.operators import assemble as D
from presswire.operators import entities as E
from presswire.operators.blocks import blocked, offered
from presswire.operators.docparse import accepted, parse_docs
from presswire.sources.files import lines_from


def brute_runs(tokens, tags):
    out, i = [], 0
    while i < len(tags):
        j = i
        while j + 1 < len(tags) and tags[j + 1] == tags[i]:
            j += 1
        if tags[i] != "O":
            text = " ".join(w for w in (t.replace(",", "") for t in tokens[i : j + 1]) if w)
            if text:
                out.append((tags[i], text, i + 1, j + 1))
        i = j + 1
    return out


@pytest.fixture(scope="module")
def sentences(spark):
    rnd = random.Random(7)
    rows = []
    for n in range(120):
        size = rnd.randint(0, 25)
        tokens = [rnd.choice(["a", "b", ",", "c,d", "e:f", "g"]) for _ in range(size)]
        tags = [rnd.choice(["O", "O", "PER", "LOC"]) for _ in range(size)]
        rows.append((f"d{n % 7}", n, tokens, tags))
    return rows, spark.createDataFrame(
        rows, "doc_id string, sentence_id int, token array<string>, ner array<string>"
    )


def test_runs_match_brute_force(sentences):
    rows, df = sentences
    got = df.select("sentence_id", S.merge_runs(F.col("token"), F.col("ner")).alias("s")).collect()
    found = {r["sentence_id"]: [tuple(x) for x in r["s"]] for r in got}
    for _, n, tokens, tags in rows:
        assert found[n] == brute_runs(tokens, tags)


def test_window_form_equals_array_form(sentences):
    _, df = sentences
    keys = ["doc_id", "sentence_id"]
    flat = df.select(*keys, F.explode(F.arrays_zip("token", "ner")).alias("z"), ).select(*keys, "z.*")
    rows = df.select(*keys, F.posexplode(F.arrays_zip("token", "ner")).alias("idx", "z")).select(*keys, "idx", "z.*")
    windowed = E.merge_spans(rows.withColumn("idx", F.col("idx") + 1), keys)
    arrays = df.select(*keys, F.inline(S.merge_runs(F.col("token"), F.col("ner"))))
    left = sorted(tuple(r) for r in windowed.select(*keys, "ner", "mention", "first", "last").collect())
    right = sorted(tuple(r) for r in arrays.select(*keys, "tag", "text", "first", "last").collect())
    assert left == right and flat.count() == rows.count()


def test_groups_and_rendering(one):
    spans = S.merge_runs(F.array(*map(F.lit, "New York , Tata Rome".split())), F.array(*map(F.lit, "LOC LOC O ORG LOC".split())))
    assert one("x", S.group_by_tag(spans)) == {"LOC": ["New York", "Rome"], "ORG": ["Tata"]}
    assert one("x", S.render_groups(S.group_by_tag(spans))) == "(LOC,New York|Rome),(ORG,Tata)"
    pairs = S.neighbour_pairs(F.array(*map(F.lit, "New York , Tata Rome".split())), spans)
    assert [tuple(p) for p in one("x", pairs)] == [
        ("LOC", "New York", ",", "ORG", "Tata"), ("ORG", "Tata", "", "LOC", "Rome"),
    ]


def brute_tags(words, phrases, longest):
    hits = []
    for i in range(len(words)):
        for k in range(1, longest + 1):
            text = " ".join(words[i : i + k]).lower()
            if i + k <= len(words) and text in phrases:
                hits.append((i, k, phrases[text]))
    out = []
    for j in range(len(words)):
        over = [(-k, i, t) for i, k, t in hits if i <= j < i + k]
        out.append(min(over)[2] if over else "O")
    return out


def test_gazetteer_forms_match_brute_force(spark):
    rnd = random.Random(3)
    phrases = {"a": "P", "a b": "Q", "b c d": "R", "c": "P", "d a": "S", "b b": "T"}
    rows = [(n, "ENG", [rnd.choice("ABCDxb") for _ in range(rnd.randint(0, 14))]) for n in range(80)]
    df = spark.createDataFrame(rows, "sentence_id int, language string, token array<string>")
    entries = [("ENG", p, t) for p, t in phrases.items()]
    found = phrase_lexicon(entries).lookup(F.col("token"), F.col("language"))
    inline = {r[0]: r[1] for r in df.select("sentence_id", A.entity_tags(F.col("token"), found, 3)).collect()}
    table = spark.createDataFrame(entries, "language string, phrase string, ner string")
    for limits in ({}, {"max_rows": 0, "salts": 4}):
        joined = E.tag_by_gazetteer(df, table, ["sentence_id"], 3, **limits)
        by_row = {(r["sentence_id"], r["idx"]): r["ner"] for r in joined.collect()}
        for n, _, words in rows:
            want = brute_tags(words, phrases, 3)
            assert inline[n] == want
            assert [by_row.get((n, i + 1), "O") for i in range(len(words))] == want
        tokens = {(r["sentence_id"], r["idx"]): r["token"] for r in joined.collect()}
        assert all(token == rows[n][2][idx - 1] for (n, idx), token in tokens.items())


def test_aliases_match_brute_force(spark):
    rnd = random.Random(5)
    rows = [
        (f"d{rnd.randint(0, 3)}", rnd.choice("PQ"), " ".join(rnd.choice(["x", "y", "zz"]) for _ in range(rnd.randint(1, 4))), rnd.randint(1, 9))
        for _ in range(150)
    ]
    df = spark.createDataFrame(rows, "doc_id string, ner string, mention string, position int")
    got = {(r["doc_id"], r["ner"], r["mention"]): r["canonical"] for r in E.link_aliases(df, ["doc_id"]).collect()}
    first = {}
    for d, t, m, p in rows:
        first[(d, t, m)] = min(p, first.get((d, t, m), p))
    for d, t, m in first:
        options = [
            (len(M), -p, M) for (D_, T_, M), p in first.items()
            if (D_, T_) == (d, t) and (M == m or M.endswith(" " + m))
        ]
        assert got[(d, t, m)] == max(options)[2]
    assert len(got) == len(first)


def test_lexicon_lookup_and_defaults(one, spark):
    lexicon = InlineLexicon([("ENG", "Is", "be"), ("ENG", "is", "am"), ("ESP", "es", "ser")])
    tokens = F.array(F.lit("IS"), F.lit("Dogs"))
    assert one("x", A.lemmas(tokens, lexicon.lookup(tokens, F.lit("ENG")))) == ["am", "dogs"]
    assert one("x", A.lemmas(tokens, lexicon.lookup(tokens, F.lit("FRA")))) == ["is", "dogs"]
    frame = spark.createDataFrame([("ENG", "is", "be")], "l string, w string, v string")
    from_frame = InlineLexicon.from_frame(frame)
    assert one("x", from_frame.lookup(tokens, F.lit("ENG"))) == ["be", None]
    large = InlineLexicon(("ENG", f"w{i}", f"v{i}") for i in range(20_000))
    assert one("x", large.lookup(F.array(F.lit("W19999"), F.lit("none")), F.lit("ENG"))) == ["v19999", None]
    with pytest.raises(ValueError):
        InlineLexicon(("ENG", f"w{i}", "v" * (1 << 20)) for i in range(65))


def test_sentiment_bins(one):
    weights = InlineLexicon([("ENG", "good", "1"), ("ENG", "bad", "-1"), ("ENG", "awful", "-5")])

    def score(words):
        tokens = F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")
        return one("x", A.sentiment(tokens, weights.lookup(tokens, F.lit("ENG"))))

    assert [score(w) for w in (["x"], ["good"], ["good"] * 3, ["bad"], ["awful"], [])] == [2, 3, 4, 1, 0, -1]


def test_regex_rules_first_tag_wins(one):
    tokens = F.array(*map(F.lit, ["12", "1.2.3.4", "NATO", "x12"]))
    rules = [(r"\d+(?:\.\d+){3}", "IP"), (r"\d+", "NUM"), (r"[A-Z]{2,}", "ACR"), (r"\d+\.\d+", "NUM")]
    assert one("x", regex_tags(tokens, rules, F.lit("O"))) == ["NUM", "IP", "ACR", "O"]


def test_truecase(spark):
    tokens = spark.createDataFrame([(i, t) for i, t in enumerate(["The", "the", "the", "IBM", "ibm", "IBM"])], "idx int, token string")
    model = E.casing_model(tokens)
    assert {r["word"]: r["cased"] for r in model.collect()} == {"the": "the", "ibm": "IBM"}
    for limits in ({}, {"max_rows": 0}):
        out = E.truecase(tokens, model, ["idx"], **limits).orderBy("idx").collect()
        assert [r["truecase"] for r in out] == ["the", "the", "the", "IBM", "IBM", "IBM"]


def test_truecase_by_blocks_and_tags_move_no_token_rows(spark):
    rnd = random.Random(7)
    words = ["The", "the", "THE", "Paris", "paris", "ÎLE", "île", "x"]
    said = [(n % 5, "ENG", [rnd.choice(words) for _ in range(rnd.randint(0, 9))]) for n in range(60)] + [(None, "ESP", ["the", "The"])]
    df = spark.createDataFrame(said, "d int, language string, token array<string>")
    tokens = df.select("d", F.explode("token").alias("token"))
    model = E.casing_model(tokens).filter("casings > 1")
    want = collections.Counter(), collections.Counter()
    for r in E.truecase(tokens, model, ["d"]).collect():
        want[0][r["d"]] += 1
        want[1][r["d"]] += r["token"] != r["truecase"]
    for each in (8, 1 << 20):
        got = E.truecase_changes(blocked(df, ["d"], each), model, ["d"]).groupBy("d").agg(F.sum("n_tokens"), F.sum("n_changed")).collect()
        assert {r[0]: r[1] for r in got} == dict(want[0]) and {r[0]: r[2] for r in got} == {d: want[1][d] for d in want[0]}
    # A block asks for a phrase once, however often it occurs.
    often = spark.createDataFrame([("ENG", ["a", "B"] * 500)] * 4, "language string, token array<string>").coalesce(1)
    asked = offered(blocked(often, ["language"]), 2, "language")
    assert sorted(r["phrase"] for r in asked.collect()) == ["a", "a b", "b", "b a"]


RECORD = (
    '<DOC id="D1" type="story"> <TEXT> <P> Tata Motors bought Paris. Good deal </P> <P> %s </P> </TEXT> </DOC>'
    % " ".join(["w"] * 150)
)
RES = D.Resources(
    lemma=[("ENG", "bought", "buy")], pos=[("ENG", "bought", "VBD")],
    gazetteer=[("ENG", "tata motors", "ORG"), ("ENG", "paris", "LOC"), ("ESP", "tata motors", "ORG")],
    polarity=[("ENG", "good", "1")],
)


def annotated(spark, language, **options):
    rows = accepted(parse_docs(lines_from(spark, [RECORD]), language))
    return D.to_documents(D.annotate_documents(rows, RES, **options)).first()


def test_english_profile(spark):
    doc = annotated(spark, "ENG", extra=frozenset({"relation"}))
    first = doc["sentences"][0]
    assert first["sentence"] == "Tata Motors bought Paris." and first["sentence_id"] == 1
    assert first["token"] == ["Tata", "Motors", "bought", "Paris", "."]
    assert first["lemma"] == ["tata", "motors", "buy", "paris", "."]
    assert first["ner"] == {"LOC": ["Paris"], "ORG": ["Tata Motors"]}
    assert first["relation"] == "ORG(Tata Motors) bought LOC(Paris)"
    assert first["parse_sentence"] == "(NP Tata Motors) (VP bought) (NP Paris)"
    assert [s["sentiment"] for s in doc["sentences"]] == [2, 3, 2]
    assert doc["corref"] is None and first["dependency_tree"] is None


def test_long_sentences_are_bracketed_in_both_modes(spark):
    for mode in ("default", "fast"):
        assert annotated(spark, "ENG", parser=mode)["sentences"][-1]["parse_sentence"].startswith("(NP w w")
    with pytest.raises(ValueError):
        annotated(spark, "ENG", parser="other")


def test_other_profiles(spark):
    spanish = annotated(spark, "ESP")["sentences"][0]
    assert spanish["ner"] == {"ORG": ["Tata", "Motors"]}
    assert (spanish["sentiment"], spanish["relation"]) == (None, None)
    arabic = annotated(spark, "ARA")["sentences"][0]
    assert arabic["token"] and arabic["lemma"] is None and arabic["ner"] is None


def test_regrouping_restores_order(spark):
    rows = [("d", i, f"s{i}") for i in range(1, 40)]
    df = spark.createDataFrame(rows, "doc_id string, sentence_id int, sentence string").repartition(7)
    got = D.assemble(df, ["doc_id"], ["sentence"]).first()["sentences"]
    assert [s["sentence"] for s in got] == [f"s{i}" for i in range(1, 40)]


def test_copies_sharing_a_doc_id_stay_apart(spark):
    from presswire.operators import sentences as N

    records = N.with_record_id(lines_from(spark, [RECORD] * 5))
    rows = N.with_tokens(N.explode_sentences(accepted(parse_docs(records)), ["rec_id", "doc_id", "language"]))
    docs = D.assemble(rows, ["rec_id", "doc_id"], ["sentence", "token"]).collect()
    assert len(docs) == 5 and {len(d["sentences"]) for d in docs} == {3}


def test_bracketed_runs_equal_merged_ones(spark):
    rnd = random.Random(5)
    rows = [([rnd.choice(["a", ",", "É", "b'c"]) for _ in range(n)], [rnd.choice(["O", "NP", "NP", "VP"]) for _ in range(n)]) for n in [0, 1, 1, 2, 2, *range(3, 40)]]
    df = spark.createDataFrame([*rows, (["a"], ["O"])], "token array<string>, tag array<string>")
    merged = S.render_chunks(S.merge_runs(F.col("token"), F.col("tag"), drop_commas=False))
    pairs = df.select(merged, S.bracket_runs(F.col("token"), F.col("tag"))).collect()
    assert all(a == b for a, b in pairs) and any(a for a, _ in pairs)


def test_tagged_tokens_make_entries_of_tagged_ones_only(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["O", "X", "X"]), (["a"], ["O"]), ([], []), (None, None)], "token array<string>, tag array<string>")
    rows = [r[0] for r in df.select(S.tagged_tokens(F.col("token"), F.col("tag"))).collect()]
    assert rows == [[("X", "b", 2, 2), ("X", "c", 3, 3)], [], [], None]
    assert "arrays_zip" not in df.select(S.tagged_tokens(F.col("token"), F.col("tag")))._jdf.queryExecution().executedPlan().toString()


def test_a_sentence_of_many_mentions_is_linear(spark):
    """Neither runs nor connectors cut pieces out of a copy of the whole sentence."""
    df = spark.createDataFrame([(["a", ",", "b", "c", "d"], ["X", "X", "O", "Y", "X"])], "token array<string>, tag array<string>")
    spans = S.merge_runs(F.col("token"), F.col("tag"))
    pairs = df.select(S.render_pairs(S.neighbour_pairs(F.col("token"), spans)).alias("r"))
    assert pairs.first()[0] == "X(a) b Y(c); Y(c)  X(d)"
    assert "slice(token" not in pairs._jdf.queryExecution().executedPlan().toString()
    tagged = df.select(A.entity_tags(F.col("token"), phrase_lexicon([("ENG", "d e", "P"), ("ENG", "c d", "Q")]).lookup(F.col("token"), F.lit("ENG")), 2))
    assert tagged.first()[0] == ["O", "O", "O", "Q", "Q"]
    assert "slice(" not in tagged._jdf.queryExecution().executedPlan().toString()


def test_only_admitted_grams_leave_a_block(spark):
    """A gram that the gazetteer cannot hold is told by its words' hashes, before it is a row."""
    from presswire.operators.keyfilter import phrase_filter

    said = [("ENG", [f"W{(n * 7 + k) % 900}" for k in range(60)]) for n in range(200)] + [("ESP", ["w1", "w2"]), (None, ["w1", "w2"]), ("ENG", ["é", "日本"])]
    rows = blocked(spark.createDataFrame(said, "language string, token array<string>").coalesce(2), ["language"], 2000)
    phrases = [("ENG", "w5"), ("ENG", "w7 w8"), ("ENG", "w8 w9 w10"), ("ENG", "é 日本"), ("ESP", "w2"), ("ESP", "none"), (None, "w1")]
    known = spark.createDataFrame(phrases, "by string, phrase string")
    every = offered(rows, 3, "language").count()
    admitted = offered(rows, 3, "language", phrase_filter(known, "by", "phrase"))
    assert {(r["by"], r["phrase"]) for r in admitted.collect()} >= {p for p in phrases if p != ("ESP", "none")}
    assert admitted.join(known, ["by", "phrase"]).count() == offered(rows, 3, "language").join(known, ["by", "phrase"]).count()
    assert admitted.count() < 0.02 * every + 20
    assert offered(rows, 3, "language", phrase_filter(known.limit(0), "by", "phrase")).count() == 0


def test_gazetteer_tags_equal_a_search_word_by_word(spark):
    rnd = random.Random(3)
    said = [(n, "ENG" if n % 3 else "ESP", [rnd.choice("abcDé") for _ in range(rnd.randint(0, 12))]) for n in range(150)]
    entries = {(lang, " ".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 4)))): t for t in ("P", "Q", None) for lang in ("ENG", "ESP") for _ in range(8)}
    gazetteer = spark.createDataFrame([(*k, t) for k, t in entries.items()], "language string, phrase string, ner string")
    want = []
    for sid, lang, words in said:
        for i, word in enumerate(words):
            over = [(k, -at, entries[lang, p]) for at in range(i + 1) for k in range(i - at + 1, 5) if at + k <= len(words) and (lang, p := " ".join(words[at : at + k]).lower()) in entries]
            if over:
                want.append((sid, i + 1, word, max(over, key=lambda o: o[:2])[2]))
    df = spark.createDataFrame(said, "sid int, language string, token array<string>")
    for limits in ({}, {"max_rows": 0}):
        got = E.tag_by_gazetteer(df, gazetteer, ["sid"], 4, **limits).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
