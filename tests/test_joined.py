"""Joined texts against plain string joining."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from presswire.operators import joined as J


def table(n=400, seed=2):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        # One input holds two thirds of the rows.
        source = rnd.choice(["a", "a", "a", "a", "b", None])
        text = rnd.choice([None, "", "x", "é" * rnd.randint(1, 30), "naïve 文字 " * rnd.randint(0, 40)])
        rows.append((source, rnd.choice([None, *range(60)]), text, rnd.random()))
    return rows


def whole(rows):
    texts = defaultdict(list)
    for source, position, text, _ in rows:
        texts[source].append((position is not None, position or 0, (text or "").encode()))
    return {s: sorted(v) for s, v in texts.items()}


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    rows = table()
    path = str(tmp_path_factory.mktemp("joined"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many ranges of few rows
    try:
        df = spark.createDataFrame(rows, "source string, pos int, body string, place double").repartition(5)
        J.write_joined(df, ["source"], "pos", path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return whole(rows), J.read_joined(spark, path, ["source"])


def test_addresses_find_every_body(written):
    texts, joined = written
    joint = {s: b"".join(t for _, _, t in v) for s, v in texts.items()}
    rows = joined.text.select("place", "text").join(joined.addresses, "place").collect()
    assert len(rows) == 400 and len({r["place"] >> 33 for r in rows}) > 3
    got = defaultdict(list)
    for r in rows:
        body = r["text"].encode()
        assert joint[r["source"]][r["offset"] : r["offset"] + r["length"]] == body and len(body) == r["length"]
        got[r["source"]].append((r["position"] is not None, r["position"] or 0, body))
    assert {s: sorted(v) for s, v in got.items()} == texts
    for r in joined.addresses.groupBy("source").agg(F.sum("length").alias("n")).collect():
        assert r["n"] == len(joint[r["source"]])


@pytest.mark.parametrize("size", [37, 1000, 1 << 20])
def test_digests_are_those_of_the_joined_text(written, size):
    texts, joined = written
    want = set()
    for source, parts in texts.items():
        t = b"".join(x for _, _, x in parts)
        want |= {(source, k // size, len(t[k : k + size]), hashlib.sha256(t[k : k + size]).hexdigest()) for k in range(0, len(t), size)}
    got = J.digests(joined, size).collect()
    assert {(r["source"], r["block"], r["n_bytes"], r["sha256"]) for r in got} == want and len(got) == len(want)


def test_byte_ranges(written):
    texts, joined = written
    text = b"".join(x for _, _, x in texts["b"])
    for offset, length in ((0, 10), (5, 301), (len(text) - 7, 50), (len(text), 5), (0, len(text))):
        rows = J.read_bytes(joined, F.col("source") == "b", offset, length).collect()
        assert b"".join(bytes(r["piece"]) for r in rows) == text[offset : offset + length]


def test_parsed_once_and_empty(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(500).select(F.lit("s").alias("source"), "id", F.concat(F.lit("t"), "id").alias("body"))
    J.write_joined(rows.mapInArrow(count, rows.schema), ["source"], "id", str(tmp_path / "one"))
    assert seen.value == 500
    none = J.write_joined(rows.limit(0), ["source"], "id", str(tmp_path / "none"))
    assert none.addresses.count() == 0 and J.digests(none).count() == 0
