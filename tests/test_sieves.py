"""Linked mentions against a pairwise search."""

import random

import pytest

from presswire.operators import sieves as V

SHAPE = "doc_id int, sentences array<struct<sentence_id: int, token: array<string>, ner: map<string, array<string>>>>"


def documents(seed=1, n=60):
    rnd = random.Random(seed)
    names = ["International Business Machines", "Business Machines", "IBM", "ibm", "Machines", "New York", "York", "NY", "Big Blue", "big blue", "a B", "x"]
    rows = []
    for d in range(n):
        sentences = []
        for s in range(rnd.randint(0, 6)):
            ner = {t: [rnd.choice(names) for _ in range(rnd.randint(1, 3))] for t in rnd.sample(["PERSON", "ORGANIZATION", "LOCATION"], rnd.randint(0, 3))}
            token = [rnd.choice(["He", "it", "said", "her", "x"]) for _ in range(rnd.randint(0, 5))]
            sentences.append((s + 1, token, rnd.choice([ner, ner, None])))
        rows.append((d, sentences))
    return rows


def brute(sentences, passes):
    mentions = [(i, t, m) for i, _, ner in sentences for t, ms in (ner or {}).items() for m in ms]

    def sieve(m, big):
        words = big.split(" ")
        if m.lower() == big.lower():
            return "exact"
        if "head" in passes and big.lower().endswith(" " + m.lower()):
            return "head"
        initials = "".join(w[:1] for w in words)
        if "acronym" in passes and len(words) > 1 and initials.isupper() and initials.isalpha() and initials.lower() == m.lower():
            return "acronym"
        return None

    out = []
    for i, t, m in mentions:
        options = [(len(b), -j, b, sieve(m, b)) for j, u, b in mentions if u == t and sieve(m, b)]
        n, j, b, _ = max(o[:3] + (None,) for o in options)
        name = max((o[3] for o in options if o[:3] == (n, j, b)), default=None)
        out.append((i, t, m, b, "self" if m == b else name))
    if "pronoun" in passes:
        for i, token, _ in sentences:
            for w in token or []:
                types = V.PRONOUNS.get(w.lower(), ())
                before = [(k, t, c) for k, t, m, c, s in out if s != "pronoun" and k < i and t in types]
                if before:
                    _, t, c = max(before)
                    out.append((i, t, w, c, "pronoun"))
    return sorted(out)


@pytest.mark.parametrize("passes", [V.PASSES, ("exact",), ("exact", "head"), ("exact", "acronym")])
def test_links_equal_a_pairwise_search(spark, passes):
    rows = documents()
    df = V.link_mentions(spark.createDataFrame(rows, SHAPE), passes)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    got = {r["doc_id"]: [tuple(x) for x in r["links"]] for r in df.collect()}
    for d, sentences in rows:
        assert got[d] == brute(sentences, passes)


def test_a_document_of_many_mentions(spark):
    many = [(k + 1, ["He"], {"PERSON": [f"First{k % 700} Name{k % 50}", f"Name{k % 50}"]}) for k in range(3000)]
    links = V.link_mentions(spark.createDataFrame([(1, many)], SHAPE)).first()["links"]
    assert len(links) == 9000 - 1
    assert all(x["canonical"].startswith("First") for x in links)


def test_unknown_pass(spark):
    with pytest.raises(ValueError):
        V.link_mentions(spark.createDataFrame([], SHAPE), ("guess",))
