"""Closing windows: emitted, late and open counts are all the rows, over batches and restarts."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from presswire.sources.streams import watch_files
from presswire.streaming import run as T
from presswire.streaming import windows as W

SHAPE = "ts timestamp, line string"
ZERO = dt.datetime(2024, 1, 1, 23, 50)


def batches(seed):
    rnd = random.Random(seed)
    out = []
    for b in range(5):
        rows = []
        for _ in range(60):
            at = ZERO + dt.timedelta(seconds=b * 300 + rnd.choice([0, 0, 0, -600, -1500]) + rnd.randint(0, 299))
            rows.append((None if rnd.random() < 0.03 else at, " ".join(rnd.choice("xyz") for _ in range(rnd.randint(1, 3)))))
        out.append(rows)
    return out


def brute(every, lateness, window=60):
    before, partial, emitted, late = None, Counter(), Counter(), Counter()
    for rows in every:
        for at, line in rows:
            if at is None:
                late["no_time", None, line] += 1
                continue
            start = at - dt.timedelta(seconds=at.second % window)
            if before is not None and start + dt.timedelta(seconds=window) <= before:
                late["late", at, line] += 1
            else:
                for w in line.split(" "):
                    partial[start, w] += 1
        times = [at for at, _ in rows if at is not None]
        if times:
            before = max([max(times) - dt.timedelta(seconds=lateness), *([before] if before else [])])
        for start, w in [k for k in partial if k[0] + dt.timedelta(seconds=window) <= before]:
            emitted[start, w] = partial.pop((start, w))
    return emitted, late, partial


def write(spark, source, rows):
    # Timestamps as text, so that the session's time zone reads what was meant.
    df = spark.createDataFrame([(str(a) if a else None, s) for a, s in rows], "t string, line string")
    df.select(F.col("t").cast("timestamp").alias("ts"), "line").coalesce(1).write.mode("append").parquet(source)


def found(spark, path):
    text = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("w")
    e = W.emitted(spark, path).select(text, "word", "count").collect()
    assert len({(r["w"], r["word"]) for r in e}) == len(e)  # each window once
    late = W.late_rows(spark, path, SHAPE).select("reason", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"), "line").collect()
    o = W.open_windows(spark, path).select(text, "word", "count").collect()
    return {(r["w"], r["word"]): r["count"] for r in e}, Counter((r["reason"], r["t"], r["line"]) for r in late), {(r["w"], r["word"]): r["count"] for r in o}


def wanted(every, lateness):
    e, late, o = brute(every, lateness)
    return {(str(a), w): n for (a, w), n in e.items()}, Counter({(r, str(a) if a else None, s): n for (r, a, s), n in late.items()}), {(str(a), w): n for (a, w), n in o.items()}


@pytest.mark.parametrize("lateness", [0, 400])
def test_batches_and_restarts(spark, tmp_path, lateness):
    every = batches(lateness + 1)
    source, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")

    def drain():
        stream = watch_files(spark, source, SHAPE, files_per_batch=1)
        assert T.wait(T.start(W.count_windows(stream, path, "line", "ts", "1 minute", f"{lateness} seconds"), checkpoint), 300)

    for rows in every[:3]:
        write(spark, source, rows)
    drain()
    assert found(spark, path) == wanted(every[:3], lateness)
    for rows in every[3:]:  # the query starts again from its checkpoint
        write(spark, source, rows)
        drain()
    e, late, o = found(spark, path)
    assert (e, late, o) == wanted(every, lateness)
    words = sum(len(s.split(" ")) for rows in every for _, s in rows)
    assert sum(e.values()) + sum(o.values()) + sum(len(s.split(" ")) * n for (_, _, s), n in late.items()) == words


def test_a_replayed_batch_decides_the_same(spark, tmp_path):
    every = batches(9)
    path = str(tmp_path / "out")
    seen = []

    frames = [spark.createDataFrame([(str(a) if a else None, s) for a, s in rows], "t string, line string").select(F.col("t").cast("timestamp").alias("ts"), "line") for rows in every[:3]]
    original = W.per_batch
    try:
        W.per_batch = lambda df, write: write  # batches are handed over here, not by a stream
        step = W.count_windows(frames[0], path, "line", "ts", "1 minute", "60 seconds")
    finally:
        W.per_batch = original
    for n, df in enumerate(frames):
        for _ in range(2 if n else 1):
            step(df, n)
            seen.append(found(spark, path))
    assert seen[1] == seen[2] and seen[3] == seen[4] == wanted(every[:3], 60)
