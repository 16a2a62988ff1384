from pyspark.sql import functions as F

from presswire.operators.assemble import Resources
from presswire.plans import jobs
from presswire.sinks import publish as M
from presswire.sinks import store as K


def versions(spark, *rows):
    return spark.createDataFrame(rows, "doc_id string, text string, seq long")


def content(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_upsert_replay_and_compaction(spark, tmp_path):
    path = str(tmp_path / "store")
    K.upsert_batch(versions(spark, ("a", "1", 1), ("b", "1", 1)), path, 0)
    second = versions(spark, ("a", "2", 1), ("a", "3", 2), ("c", "1", 1))
    K.upsert_batch(second, path, 1)
    K.upsert_batch(second, path, 1)
    want = [("a", "3"), ("b", "1"), ("c", "1")]
    assert content(K.latest(spark, path)) == want
    assert K.versions(spark, path).count() == 5
    assert K.compact(spark, path) == 1
    assert content(K.latest(spark, path)) == want
    assert K.versions(spark, path).count() == 3
    K.upsert_batch(versions(spark, ("b", "9", 1)), path, 2)
    assert content(K.latest(spark, path)) == [("a", "3"), ("b", "9"), ("c", "1")]
    assert K.compact(spark, path) == 2
    assert K.compact(spark, path) == 2
    assert content(K.latest(spark, path)) == [("a", "3"), ("b", "9"), ("c", "1")]


def test_runs_do_not_overwrite_each_other(spark, tmp_path):
    path = str(tmp_path / "store")
    K.upsert_batch(versions(spark, ("a", "1", 1)), path, 0, run="one")
    K.upsert_batch(versions(spark, ("b", "1", 1)), path, 0, run="two")
    assert content(K.latest(spark, path)) == [("a", "1"), ("b", "1")]
    K.compact(spark, path)
    K.upsert_batch(versions(spark, ("z", "1", 1), ("a", "2", 1)), path, 0, run="three")
    K.upsert_batch(versions(spark, ("a", "1", 1)), path, 0, run="one")
    assert content(K.latest(spark, path)) == [("a", "2"), ("b", "1"), ("z", "1")]


def test_often_updated_key_keeps_one_row_per_task(spark, tmp_path):
    path = str(tmp_path / "store")
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("doc_id"),
        F.col("id").cast("string").alias("text"), F.col("id").alias("seq"),
    )
    K.upsert_batch(hot, path, 0)
    assert K.lookup(spark, path, "hot").first()["text"] == "2997"
    plan = K.latest(spark, path)._jdf.queryExecution().toString()
    assert "partial_max_by" in plan


def test_lookups_and_skip(spark, tmp_path):
    path = str(tmp_path / "store")
    K.upsert_batch(versions(spark, ("a", "1", 1), ("b", "1", 1), ("b", "2", 2)), path, 0)
    keys = spark.createDataFrame([("b",), ("b",), ("z",)], "doc_id string")
    for limits in ({}, {"max_rows": 0}):
        assert content(K.lookup_many(spark, path, keys, **limits)) == [("b", "2")]
        left = K.skip_existing(versions(spark, ("a", "x", 1), ("n", "x", 1)), K.latest(spark, path), **limits)
        assert content(left) == [("n", "x")]
    assert content(K.lookup(spark, path, "a")) == [("a", "1")]
    assert K.lookup(spark, path, "none").count() == 0


def test_append_twice_stores_twice_but_batches_do_not(spark, tmp_path):
    df = versions(spark, ("a", "1", 1))
    for _ in range(2):
        K.append(df, str(tmp_path / "plain"))
        K.append_batch(df, str(tmp_path / "batched"), 5)
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 2
    assert spark.read.parquet(str(tmp_path / "batched")).count() == 1


def test_publish_and_preview(spark, tmp_path):
    M.publish(versions(spark, ("a", "1", 1)), "text", str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first()[0] == '{"doc_id":"a","text":"1","seq":1}'
    assert M.preview(spark.range(50)).count() == 10


def test_jobs(spark, tmp_path):
    lines = tmp_path / "corpus.txt"
    doc = '<DOC id="%s" type="%s"><TEXT><P>%s</P></TEXT></DOC>'
    lines.write_text(
        "\n".join([doc % ("A", "story", "one two"), "", "junk", doc % ("B", "multi", "x"), doc % ("C", "story", "one")]) + "\n"
    )
    got = jobs.annotate_corpus(spark, str(lines), str(tmp_path / "docs"), Resources(), failures=str(tmp_path / "bad"))
    assert (got["records"], got["good"], got["dropped"], got["failed"]) == (4, 2, 1, 1)
    docs = spark.read.parquet(str(tmp_path / "docs"))
    assert sorted(r["doc_id"] for r in docs.collect()) == ["A", "C"]
    assert spark.read.parquet(str(tmp_path / "bad")).first()["reason"] == "not_doc"

    words = tmp_path / "words.txt"
    words.write_text("I am x\nI am  y\n")
    jobs.count_words(spark, str(words), str(tmp_path / "counts"))
    counts = {r["word"]: r["count"] for r in spark.read.parquet(str(tmp_path / "counts")).collect()}
    assert counts == {"I": "2", "am": "2", "x": "1", "y": "1", "": "1"}

    corpus = tmp_path / "corpus.xml"
    corpus.write_text(f"<root>\n{doc % ('A', 'story', 'first &amp; old')}\n{doc % ('B', 'multi', 'b')}\n{doc % ('A', 'story', 'second')}\n</root>\n")
    for batch in (0, 0):
        latest = jobs.upsert_corpus(spark, str(corpus), str(tmp_path / "store"), batch, Resources())
    assert {r["doc_id"]: r["sentences"][0]["sentence"] for r in latest.collect()} == {"A": "second.", "B": "b."}


def files_read(spark, df):
    """Files the scans of a frame opened, with its rows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        rows = again.collect()
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scans = [leaves.apply(i) for i in range(leaves.size()) if leaves.apply(i).nodeName().startswith("Scan parquet")]
    return sum(s.metrics().apply("numFiles").value() for s in scans), rows


def test_equal_rows_win_alike_whatever_is_asked_for(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(f"k{k}", f"v{v}", f"t{(v * 7 + k) % 5}", 1) for k in range(40) for v in range(2)]
    K.upsert_batch(spark.createDataFrame(rows, "doc_id string, version string, text string, seq long"), path, 0)
    whole = {r["doc_id"]: (r["version"], r["text"]) for r in K.latest(spark, path).collect()}
    for column, place in (("version", 0), ("text", 1)):
        alone = {r["doc_id"]: r[column] for r in K.latest(spark, path, columns=[column]).collect()}
        assert alone == {k: v[place] for k, v in whole.items()}


def test_commits_are_numbered_by_the_store(spark, tmp_path):
    path = str(tmp_path / "store")
    for run, batch, text in (("b", 0, "1"), ("a", 0, "2"), ("b", 1, "3")):
        K.upsert_batch(versions(spark, ("x", text, 1)), path, batch, run=run)
        assert content(K.latest(spark, path)) == [("x", text)]
    K.upsert_batch(versions(spark, ("x", "1", 1)), path, 0, run="b")  # a replay keeps its number
    numbers = {(r["run"], r["batch_id"]): r["committed"] for r in K.versions(spark, path).collect()}
    assert numbers == {("b", 0): 1, ("a", 0): 2, ("b", 1): 3}
    K.compact(spark, path)
    K.upsert_batch(versions(spark, ("x", "old", 9)), path, 0, run="a")  # held by the snapshot
    assert content(K.latest(spark, path)) == [("x", "3")]
    K.upsert_batch(versions(spark, ("x", "4", 1)), path, 1, run="a")
    assert content(K.latest(spark, path)) == [("x", "4")]


def test_lookups_read_only_files_that_may_hold_a_key(spark, tmp_path):
    path = str(tmp_path / "store")
    for batch in range(6):
        K.upsert_batch(versions(spark, *[(f"b{batch}-{k}", str(batch), 1) for k in range(50)]), path, batch)
    assert K.index_keys(spark, path) == 6 and K.index_keys(spark, path) == 0
    read, rows = files_read(spark, K.lookup(spark, path, "b3-7"))
    assert read == 1 and rows[0]["text"] == "3"
    keys = spark.createDataFrame([("b1-1",), ("b4-49",), ("no",)], "doc_id string")
    read, rows = files_read(spark, K.lookup_many(spark, path, keys))
    assert read == 2 and sorted(r["doc_id"] for r in rows) == ["b1-1", "b4-49"]
    read, rows = files_read(spark, K.skip_stored(spark.createDataFrame([("b5-0", 1), ("no", 2)], "doc_id string, n int"), path))
    assert read == 1 and [r["doc_id"] for r in rows] == ["no"]
    read, rows = files_read(spark, K.lookup(spark, path, "none"))
    assert read == 0 and rows == []
    # A batch written since, and one written again, are read in whole until they are indexed.
    K.upsert_batch(versions(spark, ("b3-7", "new", 1)), path, 6)
    K.upsert_batch(versions(spark, ("b0-0", "again", 1)), path, 0)
    read, rows = files_read(spark, K.lookup(spark, path, "b3-7"))
    assert read == 3 and rows[0]["text"] == "new"
    assert K.index_keys(spark, path) == 2
    assert files_read(spark, K.lookup(spark, path, "b3-7"))[0] == 2
    assert content(K.lookup(spark, path, "b0-0")) == [("b0-0", "again")] and content(K.lookup(spark, path, "b0-1")) == []
    K.compact(spark, path)
    assert content(K.lookup(spark, path, "b3-7")) == [("b3-7", "new")]
    assert K.index_keys(spark, path) > 0
    assert content(K.lookup(spark, path, "b4-4")) == [("b4-4", "4")]


def test_large_batches_are_laid_out_by_key_hash(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"), F.lit(1).alias("seq"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        K.upsert_batch(rows, path, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = K.index_keys(spark, path)
    assert files > 3
    read, found = files_read(spark, K.lookup(spark, path, "k123"))
    assert read == 1 and len(found) == 1


def test_append_route_keeps_documents_without_an_id(spark, tmp_path):
    lines = tmp_path / "corpus.txt"
    lines.write_text('<DOC type="story"><TEXT><P>one</P></TEXT></DOC>\njunk\n')
    for failures in (None, str(tmp_path / "bad")):
        got = jobs.annotate_corpus(spark, str(lines), str(tmp_path / f"docs{failures is None}"), Resources(), failures=failures, wanted={"token"})
        assert (got["records"], got["good"], got["failed"]) == (2, 1, 1)
    assert [r["doc_id"] for r in spark.read.parquet(str(tmp_path / "docsFalse")).collect()] == [""]
    assert [r["reason"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["not_doc"]
    jobs.annotate_corpus(spark, str(lines), str(tmp_path / "strict"), Resources(), failures=str(tmp_path / "bad2"), require_id=True)
    assert sorted(r["reason"] for r in spark.read.parquet(str(tmp_path / "bad2")).collect()) == ["no_id", "not_doc"]
