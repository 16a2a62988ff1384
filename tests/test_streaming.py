import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from presswire.operators import wordcount as W
from presswire.operators.assemble import Resources
from presswire.plans import jobs
from presswire.sinks import publish as M
from presswire.sinks import store as K
from presswire.sources.streams import read_topics, union_topics, watch_files
from presswire.streaming import run as T

DOC = '<DOC id="%s" type="story"><TEXT><P>%s</P></TEXT></DOC>'


def drain(writer, checkpoint):
    assert T.wait(T.start(writer, str(checkpoint)), 120)


def test_document_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.txt").write_text("m1#" + DOC % ("A", "one. two") + "\n\n  \njunk\n")
    lines = watch_files(spark, str(source), "value string", "text")
    out = str(tmp_path / "out")
    query = jobs.annotate_messages(lines, str(tmp_path / "cp"), Resources(), fmt="text", interval=None, path=out)
    assert T.wait(query, 120)
    (source / "2.txt").write_text(DOC % ("B", "no # id") + "\n")
    assert T.wait(jobs.annotate_messages(lines, str(tmp_path / "cp"), Resources(), fmt="text", interval=None, path=out), 120)
    got = sorted((json.loads(r[0]) for r in spark.read.text(out).collect()), key=lambda d: d["doc_id"])
    assert [(d["doc_id"], d["mongo_id"], len(d["sentences"])) for d in got] == [("A", "m1", 2), ("B", "", 1)]
    batch = T.annotate_stream(spark.read.text(str(source)), Resources())
    assert sorted(r["doc_id"] for r in batch.collect()) == ["A", "B"]


def test_word_count_stays_per_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.txt").write_text("a b\na\n")
    (source / "2.txt").write_text("a\n")
    lines = watch_files(spark, str(source), "value string", "text", files_per_batch=1)
    drain(T.word_count_per_batch(lines, str(tmp_path / "out")), tmp_path / "cp")
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.select("batch_id").distinct().count() == 2
    assert rows.filter("word = 'a'").count() == 2
    totals = {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.sum("count").alias("n")).collect()}
    batch = {r["word"]: r["count"] for r in W.word_count(spark.read.text(str(source))).collect()}
    assert totals == batch == {"a": 3, "b": 1}


def test_windowed_counts_update_the_store(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for n, rows in enumerate([["2024-01-01 00:00:01,x y"], ["2024-01-01 00:00:20,x", "2024-01-01 00:01:00,x"]]):
        (source / f"{n}.csv").write_text("\n".join(rows) + "\n")
    events = watch_files(spark, str(source), "ts timestamp, line string", "csv", files_per_batch=1)
    counts = W.windowed_word_count(events, "line", "ts", "30 seconds", "1 hour")
    keyed = counts.select(F.struct("window_start", "word").alias("cell"), "count", F.lit(0).alias("seq"))
    path = str(tmp_path / "store")
    drain(T.per_batch(keyed, K.upserter(path), "update"), tmp_path / "cp")
    got = {(str(r["cell"]["window_start"])[11:], r["cell"]["word"]): r["count"] for r in K.latest(spark, path, "cell").collect()}
    assert got == {("00:00:00", "x"): 2, ("00:00:00", "y"): 1, ("00:01:00", "x"): 1}


def test_topics_and_upserts(spark, tmp_path):
    streams = {}
    for topic in ("left", "right"):
        (tmp_path / topic).mkdir()
        (tmp_path / topic / "1.txt").write_text(f"{topic} one\n{topic} two\n")
        streams[topic] = watch_files(spark, str(tmp_path / topic), "value string", "text")
    both = union_topics(streams).select(
        F.col("topic").alias("doc_id"), "value", F.length("value").alias("seq")
    )
    path = str(tmp_path / "store")
    drain(T.per_batch(both, K.upserter(path)), tmp_path / "cp")
    assert sorted(r["doc_id"] for r in K.latest(spark, path).collect()) == ["left", "right"]
    drain(T.per_batch(both, K.upserter(path)), tmp_path / "cp")
    assert K.versions(spark, path).count() == 4


def test_topic_reader_needs_the_connector(spark):
    # The Kafka connector is not installed here; the reader's own options resolve before it.
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_topics(spark, ["a", "b"], "host:1", min_partitions=20)


def test_intervals_are_the_documented_ones():
    assert (T.ANNOTATE_INTERVAL, T.WORD_COUNT_INTERVAL) == ("300 seconds", "30 seconds")


def test_failed_messages_of_the_annotate_job_are_kept(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.txt").write_text("m1#" + DOC % ("A", "one. two") + "\nm2#junk\nm3#" + DOC.replace("</TEXT>", "") % ("C", "cut") + "\n")
    lines = watch_files(spark, str(source), "value string", "text")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for failures in (None, str(tmp_path / "bad")):
        assert T.wait(jobs.annotate_messages(lines, checkpoint, Resources(), fmt="text", interval=None, path=out, failures=failures), 120)
        assert [json.loads(r["value"])["doc_id"] for r in spark.read.text(out).collect()] == ["A"]
        bad = spark.read.parquet(failures or f"{checkpoint}-failed")
        assert sorted((r["mongo_id"], r["reason"]) for r in bad.collect()) == [("m2", "not_doc"), ("m3", "cut_short")]
        out, checkpoint = out + "2", checkpoint + "2"


def test_preview_of_a_stream_goes_to_the_console(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.txt").write_text("".join(f"line {k}\n" for k in range(9)))
    query = T.start(M.preview_stream(watch_files(spark, str(source), "value string", "text"), 4), str(tmp_path / "cp"))
    assert T.wait(query, 120)
    progress = query.lastProgress
    assert progress["numInputRows"] == 9 and "Console" in progress["sink"]["description"]


def test_a_table_of_several_files_is_streamed(spark, tmp_path):
    from presswire.plans import catalog as C

    rows = spark.createDataFrame([(1, "one. two", "en", "src2"), (2, "three", "es", "src1")], "doc_id long, text string, lang string, source string")
    rows.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("a b c",)], "text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert sorted(tuple(r) for r in C.stream_topics(spark, str(tmp_path)).collect()) == [("conversations", 1, 3), ("documents", 2, 3)]
    assert sorted(r["doc_id"] for r in C.stream_docs(spark, str(tmp_path)).collect()) == ["D1", "D2"]
    assert C.stream_json_sink(spark, str(tmp_path)).count() == 3


def test_a_batch_is_kept_with_its_text_once(spark, tmp_path, monkeypatch):
    """The record of a good document and its paragraphs are not held beside its body."""
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.txt").write_text("m1#" + DOC % ("A", "one. two") + "\nm2#junk\n")
    frame = type(spark.range(1))
    held, persist = [], frame.persist

    def kept(df, *args):
        held.append(df)
        return persist(df, *args)

    monkeypatch.setattr(frame, "persist", kept)
    lines = watch_files(spark, str(source), "value string", "text")
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    seen = []

    def spread(batch):
        seen.append(batch)
        return batch

    drain(T.store_messages(lines, Resources(), out, bad, spread=spread), tmp_path / "cp")
    assert len(seen) == len(held) == 1
    assert "paragraphs" not in held[0].columns and {"body", "value", "reason"} <= set(held[0].columns)
    assert [(r["doc_id"], r["mongo_id"]) for r in spark.read.parquet(out).collect()] == [("A", "m1")]
    assert [(r["mongo_id"], r["raw"]) for r in spark.read.parquet(bad).collect()] == [("m2", "junk")]
