"""Benchmark decontamination over a distributed positional inverted index.

DataFrame functions only. The corpus becomes postings (term, document, position);
of each benchmark window the two terms that are rarest in the corpus are looked up,
their posting lists are shifted by the terms' offsets and intersected, and what is
left is compared word by word with the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from presswire.llm.common import pack, saved, table, unpack

LENGTH = 10  # words of a window
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALL_ROWS = 200_000  # rows of a benchmark-sided table that may be broadcast


def lower_ascii(text: Column) -> Column:
    """A-Z lowered, every other letter as it is."""
    plain = ~F.regexp_like(text, F.lit(r"[^\x00-\x7F]"))
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def words(text: Column) -> Column:
    """Words of a text in order; null has none."""
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def postings(docs: DataFrame) -> DataFrame:
    """``(row, pos, term)``: the forward half of the index, one row a word."""
    return docs.select("row", F.posexplode(words(F.col("text"))).alias("pos", "term"))


def windows(items: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(window, terms, item_id)``: every run of ``length`` words of an item, or the whole of a shorter one.

    ``window`` is the same for equal runs of words.
    """
    w = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - length + 1, F.lit(1)))
    runs = w.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, length))).alias("terms"))
    return runs.select(F.sha2(F.array_join("terms", " "), 256).alias("window"), "terms", "item_id").distinct()


def sized(small: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A broadcast hint only if ``small`` has few rows; otherwise the join shuffles."""
    return F.broadcast(small) if small.limit(rows + 1).count() <= rows else small


def anchors(runs: DataFrame, index: DataFrame) -> DataFrame:
    """``(window, terms, a, a_at, b, b_at)``: the two rarest terms of each window and their offsets.

    Rarity is the number of postings of a term in the whole corpus. Windows with a
    term the corpus lacks can't occur and go. A one-word window has no ``b``.
    """
    runs = runs.select("window", "terms").distinct()
    at = runs.select("window", F.posexplode("terms").alias("at", "term"))
    known = sized(saved(at.select("term").distinct(), "terms"))
    seen = saved(index.join(known, "term").groupBy("term").count(), "frequency")
    ranked = at.join(sized(seen), "term", "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "at", "term")))
    rare = ranked.groupBy("window").agg(order.alias("r")).filter(F.col("r")[0]["count"] > 0)
    second = F.try_element_at("r", F.lit(2))
    rare = rare.select("window", F.col("r")[0]["term"].alias("a"), F.col("r")[0]["at"].alias("a_at"), second["term"].alias("b"), second["at"].alias("b_at"))
    return saved(runs.join(rare, "window"), "anchors")


def candidates(index: DataFrame, chosen: DataFrame, slop: int = 0) -> DataFrame:
    """``(row, window, start)`` where both anchors stand at their offsets, or off by ``slop`` at most.

    Only postings of anchor terms move. They are stored once, and the two lists of
    a window are joined on (window, row, start): no list is held as a group.
    """
    wanted = sized(saved(chosen.select(F.explode(F.array_compact(F.array("a", "b"))).alias("term")).distinct(), "wanted"))
    store = saved(index.join(wanted, "term"), "postings")
    first = store.join(sized(chosen.select("window", F.col("a").alias("term"), "a_at", "b")), "term")
    first = first.select("row", "window", (F.col("pos") - F.col("a_at")).alias("start"), F.col("b").isNull().alias("alone"))
    second = store.join(sized(chosen.filter("b is not null").select("window", F.col("b").alias("term"), "b_at")), "term")
    second = second.select("row", "window", (F.col("pos") - F.col("b_at")).alias("start"))
    if slop:
        near = F.explode(F.sequence(F.col("start") - slop, F.col("start") + slop)).alias("start")
        second = second.select("row", "window", near).distinct()
    both = first.filter("not alone").drop("alone").join(second, ["row", "window", "start"])
    return first.filter("alone").drop("alone").unionByName(both)


def phrase_matches(docs: DataFrame, items: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (with ``row``) and the array ``found`` of ``(start, window, length)``: exact phrases.

    Null when nothing was found.
    """
    runs = saved(windows(items, length), "windows")
    index = postings(docs)
    chosen = anchors(runs, index)
    where = saved(candidates(index, chosen).filter("start >= 0"), "candidates")
    offered = where.join(sized(chosen.select("window", "terms")), "window")
    per_row = offered.groupBy("row").agg(F.collect_list(F.struct("start", "window", "terms")).alias("offered"))
    return docs.join(per_row, "row", "left")


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int, length: int = LENGTH) -> DataFrame:
    """``(doc_id, item_id, start)``: the window's two rarest terms stand within ``slop`` of their distance.

    ``slop`` 0 gives the candidates of the exact search. Rows follow ``docs``, with
    the same rules for nulls as ``decontaminate``.
    """
    docs = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    docs = saved(docs, "rows")
    runs = saved(windows(items, length), "windows")
    index = postings(docs)
    near = candidates(index, anchors(runs, index), slop).join(runs.select("window", "item_id"), "window")
    return near.join(docs.select("row", "doc_id"), "row").select("doc_id", "item_id", "start").distinct()


def _hits(docs: DataFrame, items: DataFrame, length: int) -> DataFrame:
    """The columns of ``docs`` packed, row, n_words, n_hit and ws: the windows that occur in a document."""
    held = pack(docs, "text").withColumn("row", F.monotonically_increasing_id())
    found = phrase_matches(held, items.select("item_id", "text"), length)
    # The words are cut once in a step of their own; the comparison only slices them.
    cut = found.withColumn("w", words(F.col("text")))
    same = F.filter(F.coalesce("offered", F.array()), lambda c: F.slice("w", c["start"] + 1, F.size(c["terms"])) == c["terms"])
    met = F.when(F.col("offered").isNotNull(), F.array_sort(F.transform(same, lambda c: F.struct(c["start"].alias("start"), (c["start"] + F.size(c["terms"])).alias("end"), c["window"].alias("window")))))
    cut = cut.select("_packed", "text", "row", F.size("w").cast("long").alias("n_words"), met.alias("hits"))
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, h: F.struct((a["n"] + F.greatest(h["end"] - F.greatest(h["start"], a["end"]), F.lit(0))).alias("n"), F.greatest(a["end"], h["end"]).alias("end")),
    )["n"]
    return cut.select("_packed", "text", "row", "n_words", F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"), F.array_distinct(F.transform("hits", lambda h: h["window"])).alias("ws"))


def hits(docs: DataFrame, items: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` plus n_words and n_hit, by the rules of ``decontaminate``; ``docs`` is a table scan,
    whose rows are numbered alike each time."""
    docs = docs.drop("n_words", "n_hit")
    return _hits(docs, items, length).select(*unpack(docs.columns, "text"), "n_words", "n_hit")


def decontaminate(docs: DataFrame, items: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` plus n_words, n_hit, n_items, items_sha256, contaminated.

    Null or wordless texts have no hits; a null item_id is written as an empty
    string in the digest; equal documents and equal items count each for
    themselves; empty tables give no hits; other columns pass through, whatever their
    names, replaced only when they bear one of the new names. ``docs`` is a table scan.
    """
    docs = docs.drop("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    cut = saved(_hits(docs, items, length), "hits")
    ids = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    of = windows(items.select("item_id", "text"), length).select("window", "item_id").distinct()
    met = cut.filter("n_hit > 0").select("row", F.explode("ws").alias("window")).join(sized(saved(of, "window_items")), "window")
    met = met.select("row", ids.alias("id"), "item_id").distinct()
    per = met.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("id")), ","), 256).alias("digest"))
    none = F.sha2(F.lit(""), 256)
    out = cut.drop("ws").join(per, "row", "left")
    return out.select(*unpack(docs.columns, "text"), "n_words", "n_hit", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("digest", none).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    """Benchmark phrases in every document."""
    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.drop("text")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS g, least(len(w), 10) AS n
        FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(s)),
hit AS (SELECT p.doc_id, p.s, p.n, win.item_id FROM pos p JOIN win ON p.g = win.g AND p.n = win.n),
cov AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT doc_id, s, n FROM hit), unnest(range(s, s + n)) AS u(k) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS dig FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(dig, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
