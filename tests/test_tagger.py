"""The learned tagger against enumeration of all paths."""

import itertools
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswire.functions.lexicon import InlineLexicon
from presswire.operators import tagger as G

LEXICON = [
    ("ENG", "the", "DT"), ("ENG", "can", "MD"), ("ENG", "can", "NN"), ("ENG", "can", "VB"), ("ENG", "fish", "NN"),
    ("ENG", "fish", "VB"), ("ENG", "he", "PRP"), ("ENG", "old", "JJ"), ("ENG", "old", "NN"), ("ENG", "that", "DT"), ("ENG", "that", "IN"),
    ("ENG", "dog", "NN"), ("ENG", "will", "MD"), ("ENG", "go", "VB"),
]
TEXTS = ["the can", "he can fish", "the fish can fish", "old fish", "the old can", "that old fish can", "he fish", "", "the running dog", "he walked slowly", "that 12 .",
         "the dog", "the dog will go", "he will go", "the fish", "he will fish"] * 6


@pytest.fixture(scope="module")
def sentences(spark):
    lexicon = InlineLexicon(G.ambiguity(LEXICON))
    df = spark.createDataFrame([(k, t.split()) for k, t in enumerate(TEXTS)] + [(999, None)], "id int, token array<string>").repartition(4)
    return df.withColumn("c", G.word_classes(F.col("token"), lexicon, F.lit("ENG"))).cache()


@pytest.fixture(scope="module")
def trained(sentences):
    return G.train(sentences, "c", 4)


def paths(model, ids):
    """Every tag path with its log probability."""
    for path in itertools.product(range(len(model.tags)), repeat=len(ids)):
        p = model.start[path[0]] + sum(model.moves[a, b] for a, b in itertools.pairwise(path)) + sum(model.emit[c, t] for c, t in zip(ids, path, strict=True))
        if np.isfinite(p):
            yield path, p


def test_classes(sentences):
    got = {r["id"]: r["c"] for r in sentences.collect()}
    assert got[1] == ["PRP", "MD|NN|VB", "NN|VB"] and got[8] == ["DT", "#ing", "NN"]
    assert got[9] == ["PRP", "#ed", "#ly"] and got[10] == ["DT|IN", "#number", "#stop"] and got[999] is None


def test_expected_counts_equal_enumeration(trained):
    model, _ = trained
    place = {c: n for n, c in enumerate(model.classes)}
    some = [["DT", "JJ|NN", "NN|VB"], ["PRP", "MD|NN|VB"], ["NN|VB"], ["DT", "NN|VB", "MD|NN|VB"]]
    ids = [np.array([place[c] for c in s]) for s in some]
    start, moves, emit, total = G.expected(model, ids)
    k = len(model.tags)
    s2, m2, e2, t2 = np.zeros(k), np.zeros((k, k)), np.zeros((len(place), k)), 0.0
    for s in ids:
        every = list(paths(model, s.tolist()))
        norm = np.logaddexp.reduce([p for _, p in every])
        t2 += norm
        for path, p in every:
            w = np.exp(p - norm)
            s2[path[0]] += w
            for a, b in itertools.pairwise(path):
                m2[a, b] += w
            for c, t in zip(s.tolist(), path, strict=True):
                e2[c, t] += w
    for a, b in ((start, s2), (moves, m2), (emit, e2), (total, t2)):
        np.testing.assert_allclose(a, b, atol=1e-9)


def test_rounds_equal_a_run_in_one_place_and_raise_the_likelihood(sentences, trained):
    model, seen = trained
    rows = [r["c"] for r in sentences.collect() if r["c"]]
    counts = {}
    for s in rows:
        for c in s:
            counts[c] = counts.get(c, 0) + 1
    alone = G.Model.first(counts)
    place = {c: n for n, c in enumerate(alone.classes)}
    for n in range(4):
        start, moves, emit, total = G.expected(alone, [np.array([place[c] for c in s]) for s in rows])
        assert seen[n] == pytest.approx(total)
        alone = alone.next(start, moves, emit)
    np.testing.assert_allclose(model.moves, alone.moves, atol=1e-6)
    assert all(b >= a - 1e-6 for a, b in itertools.pairwise(seen))


def test_decode_equals_enumeration(sentences, trained):
    model, _ = trained
    place = {c: n for n, c in enumerate(model.classes)}
    for r in sentences.withColumn("t", model.decode(F.col("c"))).collect():
        if not r["c"]:
            assert r["t"] == r["c"]
            continue
        ids = [place[c] for c in r["c"]]
        best = max(p for _, p in paths(model, ids))
        path = [model.tags.index(t) for t in r["t"]]
        p = next(p for q, p in paths(model, ids) if list(q) == path)
        assert p == pytest.approx(best, abs=1e-9)


def test_context_decides(sentences, trained):
    model, _ = trained
    tags = {" ".join(r["token"]): r["t"] for r in sentences.filter("token is not null").withColumn("t", model.decode(F.col("c"))).collect()}
    assert tags["the fish"] == ["DT", "NN"]
    assert tags["he will fish"] == ["PRP", "MD", "VB"]
    assert tags["that 12 ."][1:] == ["CD", "."]


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "c array<string>")
    model, seen = G.train(empty, "c")
    assert model.tags == () and seen == []
    assert spark.createDataFrame([(["DT"],)], "c array<string>").select(model.decode(F.col("c"))).first()[0] == [None]


def test_long_sentence_takes_time_by_its_words(spark, trained):
    model, _ = trained
    words = ["DT", "NN|VB"] * 40_000
    rows = spark.createDataFrame([(words,), (["DT"],), ([],), (None,), (["strange"],)], "c array<string>")
    begun = time.monotonic()
    got = [r["t"] for r in rows.select(model.decode(F.col("c")).alias("t")).collect()]
    assert time.monotonic() - begun < 60
    assert len(got[0]) == len(words) and got[0][:4] == ["DT", "NN", "DT", "NN"]
    assert got[1:4] == [["DT"], [], None] and len(got[4]) == 1


def test_blocks_make_no_difference(trained, monkeypatch):
    model, _ = trained
    draw = np.random.default_rng(7)
    rows = [draw.integers(0, len(model.classes), n).astype(np.intp) for n in (3, 0, 9, 1, 9, 4, 12)]
    whole = G.expected(model, rows)
    monkeypatch.setattr(G, "BLOCK_WORDS", 10)
    for a, b in zip(whole, G.expected(model, rows), strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-9)


def test_stretches_count_as_their_sentences(spark, trained, monkeypatch):
    """Cut at words of a single tag, and equal stretches counted once, sums and best paths are those of whole sentences."""
    model, _ = trained
    draw = np.random.default_rng(11)
    rows = [draw.integers(0, len(model.classes), n).astype(np.intp) for n in (0, 1, 1, 2, 5, 9, 30, 0, 12, 3) * 8]
    rows += rows[:20]
    ids, sizes = np.concatenate(rows), np.array([len(r) for r in rows])
    counts = G._Stretches.of(model, ids, sizes).keys(ids).value_counts()
    times = counts.field("counts").to_numpy()
    assert times.max() > 1 and len(times) < len(ids) / 2
    for a, b in zip(G.expected(model, rows), G._expected(model, *G._read(counts.field("values")), times), strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)
    names = [[model.classes[i] for i in r] for r in rows] + [["strange", "DT", "strange"], None, []]
    found = G.pa.array(names, G.pa.list_(G.pa.string()))
    apart = G._tagged(model, found).to_pylist()
    monkeypatch.setattr(G.Model, "allowed", property(lambda self: np.ones((len(self.classes), len(self.tags)), dtype=bool)))
    assert apart == G._tagged(model, found).to_pylist()


def test_rounds_read_the_stretches_and_not_the_sentences(spark, tmp_path):
    """The sentences are read for their classes and their stretches, whatever the number of rounds."""
    lexicon = InlineLexicon(G.ambiguity(LEXICON))
    df = spark.createDataFrame([(k, t.split()) for k, t in enumerate(TEXTS)], "id int, token array<string>")
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    classes = df.select(G.word_classes(F.col("token"), lexicon, F.lit("ENG")).alias("c"))
    G.train(classes.mapInArrow(seen, "c array<string>"), "c", 4)
    assert read.value == 2 * len(TEXTS)


def test_shapes_of_plain_words_are_those_of_the_patterns(spark):
    import re

    words = ["sing", "SING", "red", "fly", "cats", "s", "a", "Zebra", "{", "[", "ñing", "Ñu", "éd", "1s", "x1", "?", "-", "z", "A", "ab-ing", "İs"]
    got = spark.createDataFrame([(words,)], "t array<string>").select(G.word_classes(F.col("t"), InlineLexicon([]), F.lit("ENG"))).first()[0]
    kinds = {r"\p{N}": "0-9", r"\p{Lu}": "A-ZÑİ", r"\p{L}": "a-zA-ZñÑéİ"}
    for word, name in zip(words, got, strict=True):
        fits = []
        for pattern, shape, _ in G.SHAPES:
            for k, v in kinds.items():
                pattern = pattern.replace(k, v if f"[^" in pattern else f"[{v}]")
            if re.search(pattern, word):
                fits.append(shape)
        assert name == fits[0], word
