"""Dedup, mixing, decontamination, joins, scores: small tables against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from presswire.llm import decontaminate, langcrf, lmscore, mixing, shingletree, suffixdup, tokencount, tokenfiles
from presswire.llm.common import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Texts with copies, near copies, shared passages, nulls and odd ones; and the table they were saved as."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeéßA") for _ in range(rng.randint(1, 6)))
    vocabulary = [word() for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = text(40)
    rows = [(k, text(rng.randint(1, 120))) for k in range(60)]
    rows += [(60, None), (61, ""), (62, " \n\t "), (63, rows[5][1]), (64, rows[5][1]), (65, rows[7][1] + " tail"), (66, "one two"), (67, "One  two")]
    rows += [(68 + k, text(20) + " " + passage + " " + text(25)) for k in range(8)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    for k in range(12):  # near copies in a chain
        base = [*base]
        base[(k * 11) % 150] = "edit%d" % k
        rows.append((80 + k, " ".join(base)))
    rows += [(200, "x " * 30000), (None, rows[3][1]), (None, "only here"), (5, rows[5][1]), (-4, rows[9][1]), (201, "12 %% 34"), (202, "漢字 🙂" * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.lit("en")), "source": F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit("s"), F.col("doc_id") % 5)), "score": F.lit("mine"), "row": F.lit(1), "n_words": F.lit(0)}
    )
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    df.repartition(3).write.parquet(path)
    table = spark.read.parquet(path)
    return table, [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]


def words(text):
    return SPACED.findall((text or "").translate(LOW))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 77), (7, 7)]
    got = {r["v"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert got == {i: 0 for i in range(41)} | {50: 50, 77: 50, 100: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_suffix_dedup_equals_brute_force(corpus):
    docs, rows = corpus
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixdup.remove_repeats(docs).collect()), key=repr)
    order = lambda i: math.inf if i is None else i
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(first.get(b[p : p + 50], math.inf), order(i))
    want = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < order(i):
                gone[p] += 1
                gone[p + 50] -= 1
        flags = np.cumsum(gone)[:-1] > 0
        kept = np.frombuffer(b, np.uint8)[~flags].tobytes()
        spans = int((np.diff(np.concatenate([[0], flags.astype(int)])) == 1).sum())
        want.append((i, len(b), int(flags.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want, key=repr)


def test_suffix_dedup_covers_and_lengths(spark, tmp_path):
    for v, residues in suffixdup.COVERS.items():
        assert {(a - b) % v for a in residues for b in residues} == set(range(v))
    docs = spark.createDataFrame([(2, "0123456789abcdefghijKLMNOP"), (1, "zz0123456789abcdefghijKLMNyy")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "d"))
    got = {r["doc_id"]: r["n_removed"] for r in suffixdup.remove_repeats(spark.read.parquet(str(tmp_path / "d")), 12).collect()}
    assert got == {1: 0, 2: 24}
    docs.limit(0).write.parquet(str(tmp_path / "none"))
    assert suffixdup.remove_repeats(spark.read.parquet(str(tmp_path / "none"))).count() == 0


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("family", [1000, 3])
def test_shingle_join_equals_brute_force(corpus, family):
    docs, rows = corpus
    sets = [shingles(t) for _, t in rows]
    own = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                if sets[a] and sets[b] and own[a] != own[b]:
                    common = len(sets[a] & sets[b])
                    if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                        own = [min(own[a], own[b]) if o in (own[a], own[b]) else o for o in own]
                        changed = True
    least = collections.defaultdict(list)
    for o, (i, _) in zip(own, rows, strict=True):
        if i is not None:
            least[o].append(i)
    want = sorted(((i, len(s), min(least[o], default=None)) for (i, _), s, o in zip(rows, sets, own, strict=True)), key=repr)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in shingletree.near_duplicates(docs, family).collect()), key=repr)
    assert got == want


def test_signature_tree_keeps_every_link():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, rng.integers(1, 300), dtype=np.uint64)) for _ in range(150)]
    for k in range(60):
        s = sets[k]
        drop = rng.random(len(s)) > 0.1
        sets.append(np.unique(np.concatenate([s[drop], rng.integers(0, 1 << 63, len(s) // 20, dtype=np.uint64)])))
    found = set()
    for a, b in shingletree.Tree(sets).pairs():
        found |= {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist(), strict=True)}
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if shingletree.links(common, len(sets[a]), len(sets[b])):
                assert (b, a) in found
    assert len(found) < len(sets) ** 2 / 8


def test_mixing_targets_and_balance(spark, corpus):
    docs, rows = corpus
    got = mixing.mix(docs, block=20).collect()
    again = mixing.mix(docs.repartition(5), block=20).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["copies"]) for r in got) == sorted((str(r["doc_id"]), r["size"], r["copies"]) for r in again)
    size = collections.Counter()
    for r in got:
        size[r["source"]] += r["size"]
    names = sorted((s for s in size if s is not None), key=lambda s: s) + [None] * (None in size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    whole, held = 1.5 * sum(size.values()), {}
    while True:  # reshare until none is above its ceiling
        rate = (whole - sum(held.values())) / sum(weight[s] for s in names if s not in held)
        over = {s: 2.0 * size[s] for s in names if s not in held and weight[s] * rate >= 2 * size[s]}
        if not over:
            break
        held |= over
    taken, most = collections.Counter(), collections.Counter()
    for r in got:
        target = held.get(r["source"], weight[r["source"]] * rate)
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(target)
        assert 0 <= r["copies"] <= 2 and r["size"] == len(words(next(t for i, t in rows if i == r["doc_id"]))) or r["doc_id"] in (None, 5)
        taken[r["source"]] += r["copies"] * r["size"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    for s in names:
        target = held.get(s, weight[s] * rate)
        assert abs(taken[s] - target) <= 2 * most[s]
    assert mixing.mix(docs.limit(0)).count() == 0


def test_flight_keeps_totals_and_chances():
    rng = random.Random(1)
    size = [float(rng.randint(1, 50)) for _ in range(60)]
    share = [rng.random() for _ in range(60)]
    hits = np.zeros(60)
    for seed in range(300):
        x = mixing.flight(share, size, seed)
        assert sum(0 < v < 1 for v in x) <= 2
        assert sum(x) == pytest.approx(sum(share)) and sum(a * b for a, b in zip(x, size, strict=True)) == pytest.approx(sum(a * b for a, b in zip(share, size, strict=True)))
        hits += x
    assert np.abs(hits / 300 - share).max() < 0.13


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def test_decontamination_equals_brute_force(spark, corpus):
    docs, rows = corpus
    texts = dict(rows)
    items = [(1, " ".join(texts[3].split()[2:30])), (2, "ONE, two!"), (None, " ".join(texts[70].split()[25:40])), (4, None), (5, "…"), (6, "absent " * 12), (7, " ".join(texts[3].split()[2:30])), (8, "x " * 10), (9, "漢字 漢字")]
    wins = collections.defaultdict(set)
    for i, t in items:
        w = item_words(t)
        for s in range(max(len(w) - 9, 1) if w else 0):
            wins[tuple(w[s : s + 10])].add(i)
    want = []
    for i, t in rows:
        w, hit, ids = item_words(t), set(), set()
        for g, owners in wins.items():
            for s in range(len(w) - len(g) + 1):
                if tuple(w[s : s + len(g)]) == g:
                    hit |= set(range(s, s + len(g)))
                    ids |= owners
        listed = ",".join(sorted("" if x is None else str(x) for x in ids))
        want.append((i, len(w), len(hit), len(ids), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in decontaminate.decontaminate(docs, bench).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert decontaminate.decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    near = decontaminate.proximity_matches(docs, bench, 2)
    assert {3} <= {r["doc_id"] for r in near.collect()}


def test_language_crf(spark):
    rng = random.Random(2)
    sounds = {"aa": ["ta", "ra", "mo"], "bb": ["xik", "zu", "qe"], "cc": ["ñe", "ß", "öl"]}
    text = lambda lang, n: " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    rows = [(k, text(lang, 30), lang) for k, lang in enumerate(["aa", "bb", "cc"] * 60)]
    rows += [(900, None, "aa"), (901, "", None), (902, "12 3 !", "bb"), (903, text("aa", 20) + " " + text("bb", 10), None), (904, text("cc", 6000), "cc"), (None, text("bb", 9), "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = {r["doc_id"]: r for r in langcrf.identify(docs).collect()}
    right = [got[k]["lang_pred"] == lang for k, _, lang in rows[:180] if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum(right) == len(right) > 20
    assert [got[k]["lang_pred"] for k in (900, 901, 902, 903, 904, None)] == ["und", "und", "und", "aa", "cc", "bb"]
    assert got[900]["score"] == 0.0 and all(0 <= r["score"] <= 1 for r in got.values())
    assert 0.2 < got[903]["mixed"] < 0.5 and got[903]["lang"] is None
    none = langcrf.identify(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()
    assert [r[0] for r in none] == ["und"]
    assert langcrf.identify(docs.limit(0), langcrf.fit([])).count() == 0


def test_crf_marginals_equal_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    emit, moves, start = rng.normal(size=(5, 3)).astype(np.float32), rng.normal(size=(3, 3)), rng.normal(size=3)
    total = np.zeros((5, 3))
    for path in itertools.product(range(3), repeat=5):
        w = np.exp(start[path[0]] + sum(emit[t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
        for t, y in enumerate(path):
            total[t, y] += w
    assert np.allclose(langcrf.marginals(emit, np.array([0]), moves, start), total / total.sum(axis=1, keepdims=True), atol=1e-5)
    long = rng.normal(size=(9000, 3)).astype(np.float32)
    begins = np.array([0, 3, 8000])
    assert np.allclose(langcrf.long_marginals(long, begins, moves, start), langcrf.marginals(long, begins, moves, start), atol=1e-5)


def test_token_counts_equal_the_tokenizer(spark, corpus):
    from tokenizers import Tokenizer, models

    docs, _ = corpus
    pieces = tokencount.pieces(tokencount.default_vocabulary())
    tables = [pieces, [("▁a", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("ba", -2.0), ("aba", -3.0)]]
    texts = ["aabab abba", "ab", "", " ", "a  b", "cab\nab", "éa b", "  ab  ", "▁ a"] + [t for _, t in corpus[1] if t]
    for vocabulary in tables:
        full = [("<unk>", 0.0)] + [(f"<0x{k:02X}>", 0.0) for k in range(256)] + vocabulary
        # The library takes the least score of its whole table; ours is of the pieces.
        tokenizer = Tokenizer(models.Unigram([(p, s) for p, s in full], 0, True))
        n, _ = tokencount.Counter(vocabulary).count(texts)
        assert [len(tokenizer.encode("▁" + t.replace(" ", "▁")).ids) if t else 0 for t in texts] == n.tolist()
    got = {r["doc_id"]: r["n_tokens"] for r in tokencount.token_counts(docs).collect()}
    assert got[60] == got[61] == 0 and got[63] == got[64]
    assert tokencount.token_counts(docs.limit(0)).count() == 0


def test_scores_against_plain_counts(spark, corpus):
    docs, rows = corpus
    got = sorted(lmscore.score(docs).collect(), key=lambda r: (str(r["doc_id"]), r["n_tokens"], r["base_score"]))
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    c, n_train = collections.Counter(), sum(not h for h in held)
    for (_, t), h in zip(rows, held, strict=True):
        if not h:
            c.update(words(t))
    total, distinct = sum(c.values()) + n_train, len(c) + 1
    log = lambda k: math.log10((k + 0.1) / (total + 0.1 * (distinct + 1)))
    want = sorted(((i, h, len(words(t)) + 1, 1 + sum(c[w] > 0 for w in words(t)), total, sum(log(c[w]) for w in words(t)) + log(n_train)) for (i, t), h in zip(rows, held, strict=True)), key=lambda r: (str(r[0]), r[2], r[5]))
    assert len(got) == len(want)
    for r, w in zip(got, want, strict=True):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:5]
        assert r["base_score"] == pytest.approx(w[5]) and r["score"] < 0
    assert lmscore.score(docs.limit(0)).count() == 0


def test_every_training_text_trains_and_no_other(spark):
    from presswire.llm import attention

    # 1,500 texts, more than any sample was, of which some are long; the held-out ones are of words of their own.
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(1500)]
    texts = [("zq kx " * 20 if h else f"the w{i % 7} of " * (2000 if i % 300 == 7 else 3)) for i, h in enumerate(held)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    met = []
    fit, lmscore.LEAST = lmscore.train, 1000
    try:
        lmscore.train = lambda blocks, seen, end: met.append((blocks, seen, end)) or fit(blocks, seen, end, 2, 1000)
        scored = {r["doc_id"]: r["score"] / r["n_tokens"] for r in lmscore.score(docs).collect()}
    finally:
        lmscore.train, lmscore.LEAST = fit, 1_500_000
    blocks, seen, end = met[0]
    rows = [{**r.asDict(), **{k: bytes(r[k]) for k in ("held", "sizes", "inverse", "lens", "flat", "counts")}} for r in blocks.collect()]
    batch = pa.RecordBatch.from_pylist(rows)
    parts = list(lmscore._training_ids(iter([batch]), end))
    assert sum(len(sizes) for _, _, sizes in parts) == held.count(False)
    assert np.array_equal(np.bincount(np.concatenate([ids for _, ids, _ in parts]), minlength=len(seen)), seen)
    assert max(scored[i] for i in scored if held[i]) < min(scored[i] for i in scored if not held[i])
    # What two tasks learned is averaged by their ids; sketches are summed.
    rows = [(t, 0, n, bytearray(lmscore._doubles(np.full(3, float(n * t))))) for t, n in ((0, 1), (40, 3), (41, 1))]
    total = lmscore.added(spark.createDataFrame(rows, "task int, part int, n long, data binary")).collect()
    assert total[0]["n"] == 5 and lmscore._values(total[0]["data"]).tolist() == [161.0] * 3
    model = attention.start(np.zeros((12, 2 * attention.SKETCH)), np.arange(12), 11)
    again = attention.unpacked(attention.packed(model.weights))
    assert all(np.array_equal(again[n], w) for n, w in model.weights.items())


def test_attention_gradient_and_normalisation():
    from presswire.llm import attention

    rng = np.random.default_rng(4)
    step = [np.append((np.arange(60) * 7 + k) % 11, 11) for k in range(40)]
    model = attention.fit(step, 12, 11, steps=150, each=32)
    model.within = attention.shares(model.classes, np.bincount(np.concatenate(step), minlength=12))
    text = np.array(step[0])
    # All continuations of a prefix share one unit of probability.
    prefix = text[:20]
    each = [10 ** model.log10(np.append(prefix, k), np.array([21]))[0] for k in range(12)]
    assert sum(each) == pytest.approx(10 ** model.log10(prefix, np.array([20]))[0], rel=1e-3)
    # The learned step is far more likely than chance, and texts scored together score as alone.
    assert model.log10(text, np.array([len(text)]))[0] > 0.5 * len(text) * np.log10(1 / 12)
    both = model.log10(np.concatenate([text, text[:7]]), np.array([len(text), 7]))
    assert both[1] == pytest.approx(model.log10(text[:7], np.array([7]))[0], abs=1e-4)
    assert rng is not None


def test_training_takes_a_few_stretches_at_once(monkeypatch):
    import tracemalloc

    from presswire.llm import attention

    rng = np.random.default_rng(8)
    sizes = rng.integers(1, 300, 400)
    ids = (rng.zipf(1.3, sizes.sum()) % 500).astype(np.int32)
    seen = np.bincount(ids, minlength=501)
    trainer = attention.Trainer(attention.start(attention.sketch(ids, seen), seen, 500))
    trainer.step(*next(trainer.runs(ids, sizes, rng)), 0.01)
    (run,) = trainer.runs(ids, sizes, rng, 1 << 20)
    tracemalloc.start()
    found = trainer.model.gradient(*run)
    assert tracemalloc.get_traced_memory()[1] < 1000 * run[0].size  # 1,600 bytes of a position when all stretches were worked on at once
    tracemalloc.stop()
    monkeypatch.setattr(attention, "TURN", 1 << 20)
    whole = trainer.model.gradient(*run)
    assert all(np.abs(found[n] - whole[n]).max() < 1e-5 * np.abs(whole[n]).max() for n in whole if n not in ("k", "cls", "own"))

    # The slope of the loss itself, where the key of a stretch before does not matter.
    def loss():
        scores = trainer.model.forward(run[0], run[1], trainer.model.tables())[0].astype(float)
        chosen = scores[np.arange(len(scores)), run[2].ravel()]
        return ((np.log(np.exp(scores).sum(axis=1)) - chosen) * run[3].ravel()).sum() / run[3].sum()

    for name in ("q", "v", "x_out", "a_out", "bias", "back"):
        weight, at = trainer.model.weights[name], np.unravel_index(np.abs(whole[name]).argmax(), whole[name].shape)
        kept = weight[at]
        weight[at] = kept + 0.02
        up = loss()
        weight[at] = kept - 0.02
        assert (up - loss()) / 0.04 == pytest.approx(whole[name][at], rel=0.03)
        weight[at] = kept


def test_token_files_round_trip(spark, corpus, tmp_path):
    from tokenizers import Tokenizer

    docs, rows = corpus
    path = str(tmp_path / "tokens")
    tokenfiles.write_tokens(docs, path)
    got = tokenfiles.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(tokenfiles.default_vocabulary())
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    keys = [-math.inf if r["doc_id"] is None else r["doc_id"] for r in got]
    assert keys == sorted(keys)
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    start = 0
    for r in got:
        assert r["ids"] in texts[r["doc_id"]] and r["start"] == start and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += len(r["ids"])
    tokenfiles.write_tokens(docs.limit(0), str(tmp_path / "none"))
    assert tokenfiles.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_rans_blocks():
    from presswire.llm import rans

    rng = np.random.default_rng(1)
    counts = np.bincount(rng.zipf(1.3, 50_000) % 5000, minlength=5000)
    table = rans.Frequencies.unpack(rans.Frequencies.of_counts(counts).pack())
    pool = np.flatnonzero(counts)
    for n in (0, 1, 63, 64, 1000, 300_000):
        ids = rng.choice(pool, n)
        block = rans.encode(ids, table)
        assert (rans.decode(block, table) == ids).all()
    lanes_every = rans.LANES * rans.EVERY
    assert (rans.decode(block, table, 1) == ids[lanes_every:]).all() and (rans.decode(block, table, 0, 1) == ids[:lanes_every]).all()
    broken = bytearray(block)
    broken[len(block) // 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.decode(bytes(broken), table)


def test_pieces_equal_the_library():
    from presswire.llm.pieces import PieceEncoder

    coder = PieceEncoder(tokenfiles.default_vocabulary())
    texts = ["a\tb\tc\n\n\nd", "name\tage\tcity\n\n\nrow", "a\t\tb\n\n", "a\r\nb\r\n\r\nc", "a b c　d\n\n\ne", "x\x0by\x1cz\n\n\nw"]
    texts += ["", " ", "\n", "  x", "\t x", "a ", "a\t", "a  b\n\n\nc\n\nd", "one, two.\nthree\n\n  - x\n\t- y", "plain words\nand a line"]
    want = [coder.ids(t).tolist() for t in texts]
    assert [np.frombuffer(b, coder.kind).tolist() for b in coder.encode(texts)] == want
    rng = random.Random(3)
    some = ["a", "word", "it's", "x,", ".", "1", "é", " ", " ", "\n", "\n", "\t", "\r\n", " ", " ", "\x0b", "\x1c", "\x85"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    want = [coder.ids(t).tolist() for t in texts]
    assert [np.frombuffer(b, coder.kind).tolist() for b in coder.encode(texts)] == want


def test_words_are_asked_for_without_marks(monkeypatch):
    from presswire.llm.pieces import PieceEncoder

    coder = PieceEncoder(tokenfiles.default_vocabulary())
    texts = ["olive### olive$$$ olive, olive", "née!! 22%% née,.\nolive?! it's' <|endoftext|> a<|endoftext|>! ×!! ”,"]
    texts += ["a\u00a0b!! \u2003. x\u3000### \x1cy##", "z" * 70 + "!" * 12 + " w" + "." * 8 + " w" + "." * 9]
    want = [coder.ids(t).tolist() for t in texts]
    asked, ids = [], coder.ids
    monkeypatch.setattr(coder, "ids", lambda text: asked.append(text) or ids(text))
    for _ in range(2):
        assert [np.frombuffer(b, coder.kind).tolist() for b in coder.encode(texts)] == want
    met = collections.Counter(p.strip() for text in asked for p in text.split("\n"))
    assert met["olive"] == 3  # behind a space, as the first of a text, and of a later line
    assert not [p for p in met if re.search(r"(olive|née|22)[#$,!%?]", p)] and met["###"] == 1
