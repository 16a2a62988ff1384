"""Unknown JSON fields survive a round trip."""

import json
import random

import pytest
from pyspark.sql import functions as F

from presswire.operators import openjson as J


def value(rnd, depth=0):
    kind = rnd.randrange(7 if depth < 3 else 5)
    if kind == 5:
        return [value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]
    if kind == 6:
        return {f"k{rnd.randrange(5)}": value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))}
    return [None, True, rnd.randrange(-9, 10**12), rnd.randrange(1000) / 8, rnd.choice(["", "é\n\"x\"", "null"])][kind]


def documents(seed=1, n=150):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        d = {"doc_id": f"D{k}", "text": "a b", "language": rnd.choice(["ENG", "ESP"]), "type": "story"}
        d |= {rnd.choice(["meta", "x y", "Ünï", "tags", "others", "$.a", "doc_id2"]): value(rnd) for _ in range(rnd.randint(0, 4))}
        out.append(d)
    return out


def test_unknown_fields_come_back(spark):
    docs = documents()
    df = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "n int, value string")
    opened = J.open_documents(df).withColumn("sentences", F.split("text", " ")).withColumn("language", F.lower("language"))
    back = J.close_documents(opened.filter("reason is null"), ("doc_id", "language", "text", "sentences"))
    got = {r["n"]: json.loads(r["value"]) for r in back.collect()}
    assert len(got) == len(docs)
    for k, d in enumerate(docs):
        want = {**d, "language": d["language"].lower(), "sentences": ["a", "b"]}
        del want["type"]  # a known field that is not asked for
        assert got[k] == want


def test_columns_and_reasons(spark):
    rows = [
        ('{"doc_id":"1","text":"t","language":"ENG"}', None, "1"), ('{"doc_id":7,"text":true,"language":"ESP"}', None, "7"),
        ('{"doc_id":"","text":"t","language":"ENG"}', "no_id", ""), ('{"text":"t","language":"ENG"}', "no_id", None),
        ('{"doc_id":{"a":1},"text":"t","language":"ENG"}', "no_id", None), ('{"doc_id":"1","text":null,"language":"ENG"}', "no_text", "1"),
        ('{"doc_id":"1","text":"t"}', "bad_lang", "1"), ('{"doc_id":"1","text":"t","language":"FRA"}', "bad_lang", "1"),
        ("[1]", "bad_json", None), ("{", "bad_json", None), ("", "bad_json", None), ("null", "bad_json", None), (None, "bad_json", None),
    ]
    df = spark.createDataFrame([(k, r[0]) for k, r in enumerate(rows)], "n int, value string")
    got = {r["n"]: (r["reason"], r["doc_id"], r["text"]) for r in J.open_documents(df).collect()}
    for k, (_, reason, doc_id) in enumerate(rows):
        assert got[k][:2] == (reason, doc_id)
    assert got[1][2] == "true"


def test_others_can_be_stored_and_streamed(spark, tmp_path):
    df = spark.createDataFrame([('{"doc_id":"1","text":"t","language":"ENG","a":{"b":[1,{"c":null}]}}',), ('{"doc_id":"2","text":"t","language":"ENG"}',)], "value string")
    J.open_documents(df).write.parquet(str(tmp_path / "open"))
    stored = spark.read.parquet(str(tmp_path / "open"))
    back = J.close_documents(stored, ("doc_id",)).orderBy("doc_id").collect()
    assert [json.loads(r["value"]) for r in back] == [{"doc_id": "1", "a": {"b": [1, {"c": None}]}}, {"doc_id": "2"}]
    assert stored.select(F.variant_get("others", "$.a.b[0]", "int")).first()[0] == 1


@pytest.mark.parametrize("column", ["others", "reason", "doc_id"])
def test_columns_of_the_new_names_are_replaced(spark, column):
    df = spark.createDataFrame([('{"doc_id":"1","text":"t","language":"ENG"}', "old")], f"value string, {column} string")
    assert J.open_documents(df).first()["doc_id"] == "1"
