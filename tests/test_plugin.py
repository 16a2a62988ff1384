import os

from pyspark.sql import functions as F

from presswire.operators import plugin as U


def test_faults_stay_with_their_annotator(spark):
    df = spark.createDataFrame([("a b",), ("bad",), (None,)], "text string")

    def count(_, text):
        return len(text.split(" "))

    def shout(_, text):
        if text == "bad":
            raise ValueError("no")
        return [text.upper()]

    out = U.annotate_with(df, U.SharedInstance(lambda: None), {"n": (count, "int"), "up": (shout, "array<string>")}, "text")
    rows = {r["text"]: r for r in out.collect()}
    assert (rows["a b"]["n"], rows["a b"]["up"], rows["a b"]["errors"]) == (2, ["A B"], [])
    assert (rows["bad"]["n"], rows["bad"]["up"], rows["bad"]["errors"]) == (1, None, ["up: ValueError: no"])
    assert rows[None]["n"] is None and len(rows[None]["errors"]) == 2


def test_broken_factory_is_reported_per_row(spark):
    def build():
        raise RuntimeError("model missing")

    out = U.annotate_with(spark.createDataFrame([("x",)], "text string"), U.SharedInstance(build), {"n": (len, "int")}, "text")
    assert out.first()["errors"] == ["n: RuntimeError: model missing"]


def builds(spark, tmp_path, kind):
    folder = tmp_path / kind.__name__
    folder.mkdir()

    def build():
        name = f"{os.getpid()}-{len(os.listdir(folder))}"
        (folder / name).write_text("")
        return os.getpid()

    df = spark.range(400).repartition(40).select(F.col("id").cast("string").alias("text"))
    out = U.annotate_with(df, kind(build), {"pid": (lambda pid, _: pid, "long")}, "text")
    workers = out.select("pid").distinct().count()
    return len(os.listdir(folder)), workers


def test_shared_instance_is_built_once_per_worker(spark, tmp_path):
    made, workers = builds(spark, tmp_path, U.SharedInstance)
    assert made <= workers + 8 and made < 40


def test_task_instance_is_built_per_task(spark, tmp_path):
    made, _ = builds(spark, tmp_path, U.TaskInstance)
    assert made >= 20


def test_batched_annotators_fall_back_to_single_texts(spark):
    @U.batched
    def size(_, texts):
        if (texts == "bad").any():
            raise ValueError("no")
        return texts.str.len()

    df = spark.createDataFrame([("ab",), ("bad",), ("c",)], "text string").coalesce(1)
    rows = {r["text"]: r for r in U.annotate_with(df, U.SharedInstance(lambda: None), {"n": (size, "long")}, "text").collect()}
    assert (rows["ab"]["n"], rows["c"]["n"], rows["bad"]["n"]) == (2, 1, None)
    assert rows["bad"]["errors"] == ["n: ValueError: no"] and rows["ab"]["errors"] == []


def test_spread_deals_rows_evenly(spark):
    df = spark.range(320).coalesce(1).select(F.lit("same").alias("text"))
    assert U.spread(spark.range(320).repartition(40).select(F.lit("same").alias("text"))).rdd.getNumPartitions() == 40
    out = U.spread(df, factor=1, always=True)
    assert out.rdd.getNumPartitions() == 8
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 60
