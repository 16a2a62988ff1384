import pytest

from presswire.operators.docparse import parse_docs_xml, typed_docs_xml
from presswire.sources import files as R


def test_tagged_reader_splits_and_drops_noise(spark, tmp_path):
    one = '<DOC id="%d"><TEXT><P>p\n%d</P></TEXT></DOC>'
    (tmp_path / "f.txt").write_text("head\n" + "\nnoise\n".join(one % (i, i) for i in range(500)) + "\ntail")
    whole = sorted(r["value"] for r in R.read_tagged(spark, str(tmp_path), "<DOC ", "</DOC>").collect())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = R.read_tagged(spark, str(tmp_path), "<DOC ", "</DOC>")
        assert df.rdd.getNumPartitions() > 3
        split = sorted(r["value"] for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert whole == split == sorted(one % (i, i) for i in range(500))


def test_xml_source_equals_tag_reader(spark, tmp_path):
    docs = "".join(
        f'<DOC {"ID" if i % 2 else "id"}="D{i}" type="story"><HEADLINE> h{i} </HEADLINE><TEXT><P>a &amp; {i}</P><P>b.</P></TEXT></DOC>\n' for i in range(30)
    )
    (tmp_path / "c.xml").write_text(f"<CORPUS>\n{docs}</CORPUS>")
    columns = ["doc_id", "type", "head_line", "body", "reason"]
    typed = typed_docs_xml(R.read_doc_rows(spark, str(tmp_path))).select(columns)
    tagged = parse_docs_xml(R.read_doc_xml(spark, str(tmp_path))).select(columns)
    assert sorted(map(repr, typed.collect())) == sorted(map(repr, tagged.collect()))
    assert typed.count() == 30 and typed.filter("reason is not null").count() == 0


def test_listing_and_first_file(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("b.txt", "a.txt", "sub/c.txt", "x.xml"):
        (tmp_path / name).write_text("line\n")
    every = R.list_files(spark, str(tmp_path))
    assert sorted(r["path"].split(str(tmp_path))[1] for r in every.collect()) == ["/a.txt", "/b.txt", "/sub/c.txt", "/x.xml"]
    assert R.list_files(spark, str(tmp_path), glob="*.txt", recursive=False).count() == 2
    assert R.first_file(every).first()["path"].endswith("/a.txt")
    lines = R.read_lines(spark, str(tmp_path), glob="*.txt", recursive=True, min_partitions=9)
    assert lines.count() == 3 and lines.rdd.getNumPartitions() == 9


def test_json_documents_and_users(spark):
    rows = [
        '{"doc_id":"1","language":"ENG","text":"a b"}', '{"doc_id":"2","language":"FRA","text":"a"}',
        '{"language":"ENG","text":"a"}', "broken", '{"doc_id":"3","language":"ENG"}',
    ]
    got = [r["reason"] for r in R.json_documents(R.lines_from(spark, rows)).collect()]
    assert got == [None, "bad_lang", "no_id", "no_id", "no_text"]
    users = R.user_records(R.lines_from(spark, [
        "<user><account> 7 </account><name>Ann B</name><number>12</number></user>",
        "<user><account>8</account><name>C</name><number>x</number></user>",
    ])).collect()
    assert [tuple(u) for u in users] == [("7", "Ann B", 12), ("8", "C", None)]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from presswire import session

    class Context:
        master = "spark://host:7077"

    class Fake:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(_, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.shared_dir(Fake())
    assert session.shared_dir(spark) == session.shared_dir(spark)


def test_first_file_query_writes_and_reads_by_many_tasks(spark, tmp_path, monkeypatch):
    from presswire.plans import catalog

    rows = [(i, f"Text {i}.", "en" if i % 2 else "es", "src1") for i in range(64)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: str(tmp_path / name))
    assert catalog.first_file(spark, str(tmp_path)).count() == 32
    files = [f for f in (tmp_path / "first" / "a").glob("*.txt") if f.stat().st_size]
    assert len(files) > 1 and max(f.stat().st_size for f in files) < sum(f.stat().st_size for f in files) / 2
