"""Learned relations against a run in plain Python."""

import random
from collections import defaultdict

import pytest

from presswire.operators import bootstrap as B


def corpus(seed=1):
    rnd = random.Random(seed)
    rows = []
    for _ in range(900):
        pattern = rnd.choice([("P", "leads", "O"), ("P", "head of", "O"), ("P", "of", "O"), ("O", "in", "L"), ("P", "visited", "O"), ("P", "", "O")])
        a, b = rnd.randrange(20), rnd.randrange(20)
        if pattern[1] in ("leads", "head of"):
            b = a  # these join what belongs together
        elif pattern[1] == "of" and rnd.random() < 0.7:
            b = a
        rows.append((*pattern, f"p{a}", f"o{b}"))
    return rows


def brute(facts, seeds, rounds, support, trust, belief):
    known = {s: (1.0, 0) for s in seeds}
    patterns = {}
    for n in range(1, rounds + 1):
        joined = defaultdict(set)
        for *p, a, b in facts:
            joined[tuple(p)].add((a, b))
        patterns = {}
        for p, pairs in joined.items():
            k = len([x for x in pairs if x in known])
            if k >= support and k / len(pairs) >= trust:
                patterns[p] = (k, len(pairs), k / len(pairs))
        err = defaultdict(lambda: 1.0)
        for *p, a, b in sorted(facts):
            if tuple(p) in patterns:
                err[a, b] *= 1 - patterns[tuple(p)][2]
        before = len(known)
        for x, e in err.items():
            if 1 - e >= belief - 1e-12 and known.get(x, (0, 1))[1] != 0:
                known[x] = (1 - e, known[x][1] if x in known else n)
        if len(known) == before:
            break
    return patterns, known


@pytest.mark.parametrize(("rounds", "support", "trust", "belief"), [(1, 1, 0.2, 0.2), (2, 2, 0.3, 0.4), (4, 2, 0.15, 0.3), (3, 1, 0.9, 0.9)])
def test_rounds_equal_plain_python(spark, rounds, support, trust, belief):
    rows = corpus()
    facts = B.pair_facts(spark.createDataFrame(rows, "type1 string, connector string, type2 string, mention1 string, mention2 string")).cache()
    seeds = [(f"p{k}", f"o{k}") for k in range(6)]
    seed_rows = spark.createDataFrame([*seeds, *seeds[:2]], "mention1 string, mention2 string")
    patterns, pairs = B.bootstrap(facts, seed_rows, rounds, support, trust, belief)
    want_patterns, want_pairs = brute(set(rows), seeds, rounds, support, trust, belief)
    got = {(r["type1"], r["connector"], r["type2"]): (r["known"], r["pairs"], r["confidence"]) for r in patterns.collect()}
    assert got == want_patterns
    found = {(r["mention1"], r["mention2"]): (r["score"], r["round"]) for r in pairs.collect()}
    assert found.keys() == want_pairs.keys()
    for k, (score, n) in found.items():
        assert score == pytest.approx(want_pairs[k][0]) and n == want_pairs[k][1]


def test_nothing_known_learns_nothing(spark):
    facts = B.pair_facts(spark.createDataFrame(corpus()[:50], "type1 string, connector string, type2 string, mention1 string, mention2 string"))
    patterns, pairs = B.bootstrap(facts, spark.createDataFrame([], "mention1 string, mention2 string"))
    assert patterns.count() == 0 and pairs.count() == 0
