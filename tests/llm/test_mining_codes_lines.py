"""Hard negatives, vector codes and line dedup against brute force."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswire.llm import hardnegatives as H
from presswire.llm import linededup as L
from presswire.llm import pivotcodes as P

VECTORS = "vec_id long, embedding array<double>, label int"
BAD = [(700, None, 1), (701, [1.0, None, 0.0, 0.0], 1), (702, [float("nan")] * 4, 1), (703, [float("inf"), 0.0, 0.0, 0.0], 2)]


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


# --- hard negatives -----------------------------------------------------------


def brute_negatives(rows, every, scale=256, k_pos=5, k_neg=3):
    kept = [(i, [math.floor(scale * x) for x in v], y) for i, v, y in rows if i is not None and y is not None and sound(v)]
    out = []
    for i, a, y in kept:
        if i % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a, v, strict=False)), j, z) for j, v, z in kept if j != i)
        for s, j, _ in [r for r in scored if r[2] == y][:k_pos]:
            fit = [(-t, n) for t, n, z in scored if z != y and 50 * -s <= 100 * -t <= 95 * -s][:k_neg]
            out += [(i, j, rank, n, -s, t) for rank, (t, n) in enumerate(fit, 1)]
    return sorted(out)


def mined(df, every, **options):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[n] for n in names) for r in H.hard_negatives(df, F.col("vec_id") % every == 0, **options).collect())


def lengthy_rows(seed=4, dim=6):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(5, dim))
    rows = []
    for k in range(220):
        v = (centre[k % 5] + rng.normal(size=dim) * 0.6) * rng.uniform(0.2, 3)
        rows.append((k, v.tolist(), int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"bucket": 16, "block": 7}, {"bucket": 50, "block": 100, "focus": 1}])
def test_hard_negatives_equal_brute_force(spark, sizes):
    rows = lengthy_rows()
    same = rows[40][1]
    rows += [(300 + k, same, k % 2) for k in range(40)]  # copies, in ties
    rows += [(400, [0.0] * 6, 1), (410, [], 1), (420, [1.0, 2.0], 2), (430, same, None), (None, same, 1), (40, rows[41][1], 1), *BAD]
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit("x")).withColumn("block", F.lit(1)).repartition(5)
    assert mined(df, 10, **sizes) == brute_negatives(rows, 10)


def test_hard_negatives_of_large_components_and_empty_tables(spark):
    rows = lengthy_rows(7)[:60]
    most = max(abs(x) for _, v, _ in rows for x in v)
    rows = [(k, [x / most * 250_000.0 for x in v], y) for k, v, y in rows]  # products beyond double precision
    assert mined(spark.createDataFrame(rows, VECTORS), 5) == brute_negatives(rows, 5)
    empty = spark.createDataFrame([], VECTORS)
    assert mined(empty, 10) == []
    assert mined(spark.createDataFrame(rows, VECTORS), 1_000_003, bucket=8) == brute_negatives(rows, 1_000_003)
    with pytest.raises(Exception, match="smaller scale"):
        mined(spark.createDataFrame([(0, [1e9], 1), (1, [1.0], 1)], VECTORS), 1)


def test_buckets_prune_and_lose_nothing():
    rng = np.random.default_rng(5)
    raw = rng.integers(-200, 200, (50, 16))[rng.integers(50, size=2000)] + rng.integers(-30, 30, (2000, 16))
    order = np.argsort(-np.linalg.norm(raw, axis=1))
    raw = raw[order]
    lists = np.ascontiguousarray(np.argsort(H.directions(raw), axis=0, kind="stable").T.astype("<i4"))
    ids = np.arange(2000)
    row = {"n": 2000, "dim": 16, "top": float(np.linalg.norm(raw[0])), "ids": ids.astype("<i8").tobytes(), "labels": ids.astype("<i8").tobytes(), "raw": raw.astype("<i4").tobytes(), "lists": lists.tobytes()}
    bucket = H.Bucket(row)
    met = 0
    for a in raw[:40]:
        scores = raw @ a
        least = int(np.partition(scores, -5)[-5])
        unit = a / np.linalg.norm(a)
        found = bucket.candidates(unit, least / (bucket.top * np.linalg.norm(a)) - 1e-9, H._focus(unit, 16, 6))
        assert set(np.flatnonzero(scores >= least)) <= set(found.tolist())
        met += len(found)
    assert met < 0.3 * 40 * 2000


# --- vector codes -------------------------------------------------------------


def brute_codes(rows, scale=4096, parts=8, k=16, rounds=6):
    kept = [(i, [math.floor(scale * x) for x in v], y) for i, v, y in rows if sound(v)]
    width = -(-max(len(v) for _, v, _ in kept) // parts) or 1
    cut = []
    for _, v, _ in kept:
        v = v + [0] * (parts * width - len(v))
        cut.append([v[j * width : (j + 1) * width] for j in range(parts)])
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))
    books = [[cut[r][j] for r in order[:k]] for j in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), n) for n, e in enumerate(books[j])) for j, x in enumerate(c)] for c in cut]

    for _ in range(rounds):
        got = assign()
        for j in range(parts):
            for n in range(len(books[j])):
                mine = [c[j] for c, g in zip(cut, got, strict=True) if g[j][1] == n]
                if mine:
                    books[j][n] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    final = [(kept[r][0], kept[r][2], "".join(f"{n:02x}" for _, n in g), sum(d for d, _ in g)) for r, g in enumerate(assign())]
    return sorted(final, key=repr), digest


@pytest.mark.parametrize("dim", [16, 11])
def test_codes_equal_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(k, (rng.normal(size=dim) * 0.3).tolist(), int(rng.integers(4))) for k in range(150)]
    rows += [(200 + k, rows[3][1], None) for k in range(60)] + [(None, rows[4][1], 1), (5, rows[6][1], 1), (5, rows[2][1], 0), (300, [0.0] * dim, 2), (301, [], 2), (302, [0.5, -0.5], 3), *BAD]
    df = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("x")).withColumn("error", F.lit(1)).repartition(4)
    codes, books = P.vector_codes(df)
    want, digest = brute_codes(rows)
    assert sorted(((r["vec_id"], r["label"], r["code"], r["error"]) for r in codes.collect()), key=repr) == want
    assert books.digest() == digest


def test_codes_of_few_and_no_vectors(spark):
    few = [(3, [0.1] * 8, 1), (1, [0.2] * 8, None)]
    codes, books = P.vector_codes(spark.createDataFrame(few, VECTORS))
    assert sorted(((r["vec_id"], r["label"], r["code"], r["error"]) for r in codes.collect()), key=repr) == brute_codes(few)[0]
    assert books.entries.shape == (8, 2, 1)
    codes, books = P.vector_codes(spark.createDataFrame(BAD, VECTORS))
    assert codes.count() == 0 and books is None


def test_pivots_prune_exactly():
    rng = np.random.default_rng(1)
    book = rng.integers(-3000, 3000, (16, 8))
    x = book[rng.integers(16, size=3000)] + rng.integers(-300, 300, (3000, 8))
    x[:50] = (book[3] + book[4]) // 2
    pivots = P.spread_pivots(book, 4)
    far = P.distances(x, pivots).astype(np.float32).astype(np.float64)
    code, best, evaluated = P.nearest(x, far, book, P.distances(pivots, book))
    full = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    assert (code == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
    assert evaluated < 0.5 * full.size


# --- lines --------------------------------------------------------------------


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute_lines(rows):
    holders = defaultdict(set)
    lists = [(i, (t or "").split("\n")) for i, t in rows]
    keys = [[lower(x.strip(" \t\n\v\f\r")) for x in lines] for _, lines in lists]
    for (i, _), ks in zip(lists, keys, strict=True):
        for k in ks:
            if len(k) >= 40:
                holders[k].add(-(1 << 63) if i is None else i)
    out = []
    for (i, lines), ks in zip(lists, keys, strict=True):
        own = -(1 << 63) if i is None else i
        left = [x for x, k in zip(lines, ks, strict=True) if len(holders[k]) < 5 or max(holders[k]) == own]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def line_table(seed=3):
    rng = np.random.default_rng(seed)
    pool = [f"line number {k} of a pool that many documents share, é" + "x" * (k % 3) for k in range(12)]
    rows = []
    for i in range(120):
        lines = [pool[int(rng.integers(12)) if rng.random() < 0.5 else 0] for _ in range(int(rng.integers(0, 9)))]
        lines += [f"  {lines[0].upper()}\t"] if lines else ["", "short", f"only document {i} has this line, which is long enough"]
        rows.append((i, "\n".join(lines)))
    rows += [(130, None), (131, ""), (132, "\n\n"), (133, "y" * 39 + "\n" + pool[1]), (None, pool[0] + "\n" + pool[0]), (None, pool[3]), (7, pool[2]), (7, rows[7][1])]
    rows += [(140 + k, "z" * 40 + "\n " + "É" * 40) for k in range(5)] + [(150 + k, "w" * 40) for k in range(4)]
    return rows


@pytest.mark.parametrize("size", [48 << 20, 400])
def test_lines_equal_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(L, "RANGE", size)
    rows = line_table()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("mark", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("h", F.lit(2)).repartition(4)
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in L.kept_texts(df).collect()), key=repr)
    assert got == brute_lines(rows)
    assert L.kept_texts(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_ranges_cut_anywhere_give_the_same_lines(seed):
    rng = np.random.default_rng(seed)
    rows = sorted({(int(rng.integers(6)), int(rng.integers(2)), -int(rng.integers(9)), int(rng.integers(4))) for _ in range(260)})
    docs = defaultdict(set)
    for h, c, i, _ in rows:
        docs[h, c].add(-i)
    want = {(h, c, -i, p) for h, c, i, p in rows if len(docs[h, c]) >= 5 and -i != max(docs[h, c])}
    cuts = sorted(rng.integers(0, len(rows), 4).tolist())
    drops, edges, witness = [], [], []
    for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        stream = L.Stream(5)
        outs = []
        step = int(rng.integers(1, 30))
        for k in range(a, b, step):
            part = np.array(rows[k : min(k + step, b)], dtype=np.int64).reshape(-1, 4)
            outs += stream.feed([part[:, 0], part[:, 1], -part[:, 2], part[:, 0], part[:, 3]])
        for kind, found in outs + stream.finish():
            (drops, edges, witness)[kind].extend(zip(*(found[k].tolist() for k in (0, 1, 2, 4)), strict=True))
    holders = defaultdict(set)
    for h, c, i, _ in edges + witness:
        holders[h, c].add(i)
    settled = [r for r in edges if len(holders[r[:2]]) >= 5 and r[2] != max(holders[r[:2]])]
    assert len(drops) + len(settled) == len(want) and set(drops) | set(settled) == want


def test_bitmaps_round_trip():
    for n, gone in ((1, [0]), (9, [8]), (20, [0, 7, 8]), (100_000, [5, 99_999])):
        keep = L.unpack_keep(L.pack_keep(np.array(gone)), n)
        assert len(keep) == n and np.flatnonzero(~keep).tolist() == gone
    assert len(L.pack_keep(np.arange(100_000))) < 500
