"""The split record reader against the whole-file rule and the line-separator reader."""

import io
import random

import pyarrow as pa
import pytest

from presswire.sources import files as R
from presswire.sources import records as S
from presswire.streaming import run as T

BEGIN, END = "<DOC ", "</DOC>"


def brute(data, begin=BEGIN.encode(), end=END.encode()):
    out, at = [], 0
    while at < len(data):
        e = data.find(end, at)
        stop = len(data) if e < 0 else e + len(end)
        k = data.find(begin, at, stop)
        if k >= 0:
            out.append((k, data[k:stop], e < 0))
        at = stop
    return out


def texts(seed):
    rnd = random.Random(seed)
    parts = ["<DOC a>", "</DOC>", "</DOC>", "<DO", "</D", "x", "\n", "é", "<DOC b", "noise "]
    return "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 120))).encode()


@pytest.mark.parametrize("seed", range(12))
def test_splits_of_any_size_give_every_record_once(seed, monkeypatch):
    data = texts(seed)
    want = brute(data)
    for size in (1, 2, 3, 5, 7, 16, 1000):
        for block in (1, 4, 1 << 20):
            monkeypatch.setattr(S, "BLOCK", block)
            got = []
            for split in S.splits_of("f", 0, len(data), size):
                got += S.records_of(pa.PythonFile(io.BytesIO(data), mode="r"), split, BEGIN.encode(), END.encode())
            assert got == want


def test_regions_of_a_growing_file():
    data = b"head <DOC 1>a</DOC>\n<DOC 2>b</DOC> <DOC 3>c</DOC>tail"
    ends = [19, 34, 49]
    got, first = [], 0
    for last in ends:
        for split in S.splits_of("f", first, last, 4):
            got += S.records_of(pa.PythonFile(io.BytesIO(data), mode="r"), split, BEGIN.encode(), END.encode())
        first = last
    assert got == brute(data[:49]) and len(got) == 3


def test_reader_equals_the_separator_reader(spark, tmp_path):
    one = '<DOC id="%d"><TEXT><P>pé\n%d</P></TEXT></DOC>'
    for name, rows in (("a.txt", range(300)), ("b.txt", range(300, 310))):
        (tmp_path / name).write_text("head\n" + "\nnoise\n".join(one % (i, i) for i in rows) + "\ntail")
    (tmp_path / "_hidden").write_text(one % (9, 9))
    (tmp_path / "c.txt").write_text("")
    old = sorted((r["value"], r["file_path"].split("/")[-1]) for r in R.read_tagged(spark, str(tmp_path / "*.txt"), BEGIN, END).collect())
    df = S.read_records(spark, str(tmp_path), BEGIN, END, split_bytes=1500)
    assert df.rdd.getNumPartitions() > 6
    rows = df.collect()
    assert sorted((r["value"], r["file_path"].split("/")[-1]) for r in rows) == old and len(rows) == 310
    assert not any(r["cut"] for r in rows)
    data = (tmp_path / "a.txt").read_bytes()
    assert all(data[r["offset"] :].startswith(r["value"].encode()) for r in rows if r["file_path"].endswith("a.txt"))
    assert S.read_records(spark, str(tmp_path / "b.txt"), BEGIN, END).count() == 10
    assert S.read_records(spark, str(tmp_path), BEGIN, END, glob="b*").count() == 10


def test_a_cut_last_record_is_reported(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"<DOC 1>x</DOC> <DOC 2>never \xff ends")
    rows = sorted(S.read_records(spark, str(tmp_path), BEGIN, END, split_bytes=5).collect(), key=lambda r: r["offset"])
    assert [(r["value"], r["offset"], r["cut"]) for r in rows] == [("<DOC 1>x</DOC>", 0, False), ("<DOC 2>never � ends", 15, True)]
    for begin, end in (("", "x"), ("x", ""), ("<a>", "abba")):
        with pytest.raises(ValueError):
            S.read_records(spark, str(tmp_path), begin, end)


def test_a_stream_waits_for_whole_records_and_goes_on_after_a_restart(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    source.mkdir()

    def drain():
        df = S.stream_records(spark, str(source), BEGIN, END, split_bytes=10)
        T.wait(T.start(df.writeStream.format("parquet").option("path", out).outputMode("append"), checkpoint))
        return sorted(r["value"] for r in spark.read.parquet(out).collect())

    (source / "a").write_text("<DOC 1>one</DOC><DOC 2>tw")
    assert drain() == ["<DOC 1>one</DOC>"]
    with (source / "a").open("a") as f:
        f.write("o</DOC> <DOC 3>th")
    (source / "b").write_text("noise <DOC 9>nine</DOC>")
    assert drain() == ["<DOC 1>one</DOC>", "<DOC 2>two</DOC>", "<DOC 9>nine</DOC>"]
    assert len(drain()) == 3
    with (source / "a").open("a") as f:
        f.write("ree</DOC>")
    assert drain()[2] == "<DOC 3>three</DOC>"
