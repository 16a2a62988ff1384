import pytest
from pyspark.sql import functions as F

from presswire.operators.lookup import fits_broadcast, hot_keys, keyed_join, lookup_join


@pytest.fixture(scope="module")
def rows(spark):
    # One key holds a third of the rows.
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    return spark.range(9000).select("id", hot.alias("k"))


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame([("hot", "H"), *[(f"k{i}", f"v{i}") for i in range(0, 50, 2)]], "k string, v string")


@pytest.mark.parametrize("how", ["left", "semi", "anti", "inner"])
def test_salted_join_equals_broadcast_join(rows, right, how):
    small = keyed_join(rows, right, ["k"], how)
    large = keyed_join(rows, right, ["k"], how, ["id"], max_rows=0, salts=7, hot=hot_keys(rows, ["k"], 0.1))
    plain = keyed_join(rows, right, ["k"], how, ["id"], max_rows=0)
    assert plain.count() == small.count()
    assert sorted(small.columns) == sorted(large.columns)
    order = sorted(small.columns)
    assert sorted(map(repr, small.select(order).collect())) == sorted(map(repr, large.select(order).collect()))


def test_hot_key_spreads_over_salts(rows):
    salted = rows.filter("k = 'hot'").select(F.pmod(F.xxhash64("id"), F.lit(32)).alias("s"))
    biggest = salted.groupBy("s").count().agg(F.max("count")).first()[0]
    assert biggest < 3000 / 32 * 2


def test_only_hot_keys_are_copied(rows, right):
    hot = hot_keys(rows, ["k"], 0.1)
    assert [r["k"] for r in hot.collect()] == ["hot"]
    plan = keyed_join(rows, right, ["k"], "left", ["id"], max_rows=0)._jdf.queryExecution().toString()
    assert "Generate" not in plan


def test_size_check(spark):
    df = spark.range(100).select(F.lit("x" * 100).alias("v"))
    assert fits_broadcast(df, max_rows=100)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_rows=100, max_bytes=1000)
    assert fits_broadcast(spark.range(0))


def test_lookup_join_resolves_duplicates(spark, rows):
    lexicon = spark.createDataFrame([("hot", "b"), ("hot", "a")], "k string, v string")
    for limits in ({}, {"max_rows": 0}):
        out = lookup_join(rows, lexicon, ["k"], "v", ["id"], **limits)
        assert out.count() == 9000
        assert [r[0] for r in out.filter("k = 'hot'").select("v").distinct().collect()] == ["a"]
