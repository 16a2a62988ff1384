"""Vector near-duplicates, page text, and the pipeline's stages on small tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from presswire.llm import hnsw, htmltext, vectordup


def brute(rows, least=0.98):
    sound = [v is not None and i is not None and l is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v, l in rows]
    n = len(rows)
    links = [[] for _ in range(n)]
    for a in range(n):
        for b in range(a):
            if sound[a] and sound[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], np.float32).astype(float), np.array(rows[b][1], np.float32).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    links[a].append(b)
                    links[b].append(a)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        out.append((rows[a][0], len(links[a]), min(ids, default=None)))
    return out


@pytest.mark.parametrize("shard", [20_000, 40])
def test_near_duplicates_equal_brute_force(spark, shard):
    rng = np.random.default_rng(8)
    rows = []
    for label in (1, 2):
        for c in range(12):
            centre = rng.normal(size=8)
            rows += [(len(rows), (centre + rng.normal(size=8) * 0.05 * (c % 4)).astype(np.float32).tolist(), label) for _ in range(8)]
    same = rows[3][1]
    rows += [(900 + k, same, 1) for k in range(30)] + [(950, same, 2), (951, same, None), (None, same, 1)]
    rows += [(960, None, 1), (961, [0.0] * 8, 1), (962, [1.0] * 7 + [None], 1), (963, [float("nan")] * 8, 1), (964, [float("inf")] + [1.0] * 7, 1), (965, [1.0, 2.0], 1), (966, [1e-30, 2e-30], 1), (967, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("kept", F.lit("no")).repartition(4)
    got = vectordup.near_duplicates(df, shard=shard).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == sorted(brute(rows), key=repr)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert vectordup.near_duplicates(df.limit(0)).count() == 0


def test_graph_recall_on_spread_vectors():
    rng = np.random.default_rng(2)
    x = vectordup._units(rng.normal(size=(3000, 16)).astype(np.float32))
    graph = hnsw.Graph(x)
    beam, recall = hnsw.audited_beam(graph, 0.98)
    assert recall >= 0.97 and beam <= 512
    full = x @ x.T
    ids, _ = graph.search(x[:200], beam)
    want = np.argsort(-full[:200], axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) for a, b in zip(ids, want, strict=True)]) >= 9
    again = vectordup.opened(x.astype(np.float32), graph.order.astype("<i8").tobytes() + b"".join(nb.astype("<i4").tobytes() for nb in graph.layers), np.array([nb.shape for nb in graph.layers], "<i8").tobytes())
    assert (again.search(x[:50], 32)[0] == graph.search(x[:50], 32)[0]).all()


def islands(rng, groups, each):
    """Two sets of rows around the same centres, and a graph of the first whose groups are cut off from each other."""
    centre = rng.normal(size=(groups, 16))
    x, q = (vectordup._units((np.repeat(centre, each, 0) + rng.normal(size=(groups * each, 16)) * 0.01).astype(np.float32)) for _ in "xq")
    graph = hnsw.Graph(x)
    group = graph.order // each
    graph.layers = [np.where(group[np.maximum(nb, 0)] == group[: len(nb), None], nb, -1) for nb in graph.layers]
    return x, q, graph


def test_descent_is_audited():
    x, q, graph = islands(np.random.default_rng(6), 20, 40)
    least = 0.98
    own, recall = hnsw.audited_beam(graph, least)
    assert own == 64 and recall >= 0.97
    beam, recall = hnsw.audited_beam(graph, least, start=own, queries=q)
    assert recall >= 0.97
    a, b = graph.within(q, least, beam)
    assert len(set(zip(a.tolist(), b.tolist()))) >= 0.97 * (q @ x.T >= least).sum()


def test_shards_above_the_beam_find_each_other(spark, monkeypatch):
    centre = np.random.default_rng(7).normal(size=(15, 16))
    rng = np.random.default_rng(8)
    rows = [(k, (centre[k % 15] + rng.normal(size=16) * 0.01).astype(np.float32).tolist(), 1) for k in range(1350)]

    def cut(cls, least, shard):
        """Three shards of 450 rows, whose groups of 30 are cut off from each other in the graph."""
        held, out = cls.toPandas().assign(shard=lambda c: c["rep"] // 15 % 3), []
        for _, part in held.groupby("shard"):
            raw = np.stack(part["embedding"].to_numpy()).astype(np.float32)
            graph = hnsw.Graph(vectordup._units(raw))
            near = graph.placed @ graph.placed.T >= 0.9
            graph.layers = [np.where(near[np.arange(len(nb))[:, None], np.maximum(nb, 0)], nb, -1) for nb in graph.layers]
            beam, recall = hnsw.audited_beam(graph, least)
            assert beam == 64 < len(raw) and recall >= 0.97
            out.append(vectordup._packed(part, raw, graph, beam, recall))
        return spark.createDataFrame(pd.concat(out), vectordup._SHARD)

    monkeypatch.setattr(vectordup, "build_shards", cut)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    x = vectordup._units(np.array([r[1] for r in rows], dtype=np.float32))
    want = (x @ x.T >= 0.98).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in vectordup.near_duplicates(df).collect()}
    assert sum(got.values()) >= 0.97 * want.sum() and all(got[k] <= want[k] for k in got)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>one<p>two &lt;b&gt;", "one\n\ntwo <b>"),
        ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>", "- a\n- b\n  3. c\n  4. d"),
        ("<table><tr><th>N<th>Value<tr><td>long cell<td>1</table>", "N          Value\nlong cell  1"),
        ("<table><tr><td>a<br>b<td>c</table>x", "a  c\nb\n\nx"),
        ("<head><title>t</title></head><body>x<script>a<b</script><style>p{}</style>y", "x y".replace(" ", "")),
        ("a<div hidden>no</div><div style='display: none'>no<p>no</div><span style=visibility:hidden>no</span>b", "ab"),
        ("<pre>  x\n    y</pre>z", "  x\n    y\n\nz"),
        ("a <b>b</b>\n  c<br>d<!-- no > --> e", "a b c\nd e"),
        ("<div>a</div><div>b</div><hr>c", "a\nb\n\nc"),
        ("<table><tr><td><table><tr><td>i<td>j</table><td>k</table>", "i  j  k"),
        ("</p></div>text < 3 <", "text < 3 <"),
        ("", ""),
        (None, ""),
    ],
)
def test_page_layout(spark, html, text):
    assert htmltext.visible_text(html or "") == text


def test_pages_keep_their_rows(spark):
    rows = [(1, "<p>a"), (1, "<p>a"), (2, None), (3, "<div>" * 3000 + "deep"), (4, "x" * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("old"))
    got = sorted((r["page_id"], r["text"][:10]) for r in htmltext.extract(df).collect())
    assert got == [(1, "a"), (1, "a"), (2, ""), (3, "deep"), (4, "x" * 10)]
    assert htmltext.extract(df.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as C

    item = "the quick brown fox jumps over one lazy dog again today"
    filler = lambda k: " ".join(f"word{k}x{j}" for j in range(30))
    rows = [(k, filler(k), "en", "s1") for k in range(20)]
    rows += [(50, filler(1), "en", "s2"), (51, filler(2) + " end", "en", "s2"), (52, "start " + item + " " + filler(60), "en", "s2"), (53, "123 456", None, "s1"), (54, None, "en", None), (None, filler(70), None, None), (55, filler(71), "de", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert sorted(out.columns) == sorted(docs.columns)
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        kept.append({r["doc_id"] for r in now.collect()})
    everyone = {r[0] for r in rows}
    assert kept[0] == everyone - {53, 54}
    assert kept[1] == kept[0] - {50, 51}
    assert kept[2] == kept[1] - {52}
    assert kept[3] <= kept[2]
    last = C.STAGES[-1][1](spark, now, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in last) == sorted(str(r["doc_id"]) for r in now.collect())
    assert C.run(spark, str(tmp_path)).count() == len(last)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<head><title>t</title><p>Hello", "Hello"),
        ("<html><head><meta charset=utf-8><title>t</title><style>p{}</style> <div>a</div>b", "a\nb"),
        ("<head><title>t</title>plain words<p>b", "plain words\n\nb"),
        ("<head><noscript><img src=x></noscript><template><p>no</template><script>1<2</script><h1>x</h1>", "x"),
        ("<head><title>t</title></head><body>x<head>y", "xy"),
        ("<p>so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>tex</annotation></math>.", "so x= 1 2."),
        ("<svg><title>t</title><defs><text>no</text></defs><path d='m'/><text x=1>North</text><g/><text>South</text></svg> end", "North South end"),
        ("<svg><defs/><text>a</text></svg><style/></style>b", "a b"),
        ("<label>Say</label><textarea>\none\n two &amp; three</textarea>x", "Say\none\n two & three\nx"),
        ("in <select><option>a<option selected>b<option>c</select> now", "in b now"),
        ("<select><option disabled>pick<option>a<option>b</select>", "a"),
        ("<select><option hidden selected>pick</option><option label='L'>a</select>", "pick"),
        ("<select multiple><optgroup label=G><option>a<option>b</select>x", "G\na\nb\nx"),
        ("<select hidden><option>a</select><datalist><option>b</datalist>c", "c"),
    ],
)
def test_page_text_is_whole(html, text):
    assert htmltext.visible_text(html) == text


CLASHING = (
    "row", "_row", "_copy", "copies", "hits", "offered", "w", "ws", "n_hit", "n_words", "window", "terms", "lang_pred", "score", "mixed",
    "component_id", "n_shingles", "size", "source_size", "target", "block", "packed", "none", "draw", "share", "pos", "start", "count", "key",
)


def test_stages_and_decontamination_keep_columns_of_any_name(spark, tmp_path):
    import corpus_pipeline as C
    from presswire.llm.decontaminate import decontaminate

    item = "the quick brown fox jumps over one lazy dog again today"
    rows = [(k, " ".join(f"word{k}x{j}" for j in range(20)), "en", f"s{k % 2}") for k in range(8)]
    rows += [(8, rows[3][1], None, None), (9, item, "en", "s0"), (None, None, None, None), (10, "", "en", "s1"), (3, rows[3][1], "en", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in CLASHING:
        df = df.withColumn(name, F.concat(F.lit(name + " of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    items = spark.createDataFrame([(1, item, "x"), (None, None, "y")], "item_id long, text string, row string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, items = spark.read.parquet(str(tmp_path / "documents.parquet")), spark.read.parquet(str(tmp_path / "benchmark.parquet"))
    new = {"n_words", "n_hit", "n_items", "items_sha256", "contaminated"}
    found = decontaminate(docs, items)
    assert set(found.columns) == set(docs.columns) | new and [r["doc_id"] for r in found.filter("contaminated").collect()] == [9]
    now = docs
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        for r in now.collect():
            assert all(r[c] == f"{c} of {r['doc_id']}" for c in CLASHING)
    assert now.count() and C.STAGES[-1][1](spark, now, str(tmp_path)).count() == now.count()
    for r in found.collect():
        assert all(r[c] == f"{c} of {'none' if r['doc_id'] is None else r['doc_id']}" for c in CLASHING if c not in new)


def test_stages_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as C

    for name, shape in (("documents", "doc_id long, text string, lang string, source string"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], shape).write.parquet(str(tmp_path / f"{name}.parquet"))
    for _, stage in C.STAGES:
        assert stage(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)).count() == 0
    assert C.run(spark, str(tmp_path)).count() == 0
