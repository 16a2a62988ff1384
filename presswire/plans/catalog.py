"""Registered queries: each runs operators over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswire.functions import annotate as A
from presswire.functions import spans as S
from presswire.functions.lexicon import InlineLexicon, phrase_lexicon, regex_tags
from presswire.functions.segment import TOKEN, sentences_of
from presswire.functions.text import extract_field, let, strip_markup
from presswire.operators import abbreviations as G
from presswire.operators import assemble as D
from presswire.operators import bootstrap
from presswire.operators import docparse as P
from presswire.operators import entities as E
from presswire.operators import joined as X
from presswire.operators import openjson as O
from presswire.operators import plugin as U
from presswire.operators import sentences as N
from presswire.operators import sieves as Y
from presswire.operators import tables as B
from presswire.operators import tagger as H
from presswire.operators import wordcount as W
from presswire.operators.blocks import blocked, offered, stored
from presswire.operators.lookup import fits_broadcast
from presswire.operators.rows import pin, unnest, unnest_fields
from presswire.plans import corpus as C
from presswire.plans import lexicons as L
from presswire.plans.jobs import metrics
from presswire.session import scratch_path
from presswire.sinks import publish as M
from presswire.sinks import store as K
from presswire.sources import files as R
from presswire.sources import records as V
from presswire.sources import streams as Z
from presswire.streaming import run as T
from presswire.streaming import windows as Q

Query = Callable[[SparkSession, str], DataFrame]
SENTENCE = ["doc_id", "sentence_id"]
# Rows of one record are grouped by its own number: copies may share a doc_id.
ONE_DOC = ["rec_id", "doc_id"]
ONE_SENTENCE = ["rec_id", *SENTENCE]


def _language() -> Column:
    return C.job_language(F.col("lang"))


def _own_language() -> Column:
    return C.own_language(F.col("lang"))


def _records(spark: SparkSession, sf_dir: str, escape: bool = False, routed: bool = False) -> DataFrame:
    docs = N.with_record_id(C.table(spark, sf_dir, "documents"))
    return C.wrap(R.at_least(docs, 2 * spark.sparkContext.defaultParallelism), escape=escape, routed=routed)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parse_docs(_records(spark, sf_dir, routed=True), _own_language())


def _stories(spark: SparkSession, sf_dir: str, routed: bool = False) -> DataFrame:
    """All documents; ``routed`` leaves out the sources that deliver no stories."""
    return P.accepted(P.parse_docs(_records(spark, sf_dir, routed=routed), _language()))


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.explode_sentences(_stories(spark, sf_dir), [*ONE_DOC, "language"])
    return rows.withColumn("sentence_id", F.col("sentence_id").cast("long"))


def _tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.with_tokens(_sentences(spark, sf_dir))


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_lexicon(L.GAZETTEER).lookup(F.col("token"), F.col("language"))
    longest = max(len(phrase.split(" ")) for _, phrase, _ in L.GAZETTEER)
    return _tokenized(spark, sf_dir).withColumn("ner", A.entity_tags(F.col("token"), found, longest))


def _found(entries: tuple) -> Column:
    return InlineLexicon(entries).lookup(F.col("token"), F.col("language"))


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unnest_fields(_tagged(spark, sf_dir), ONE_SENTENCE, S.merge_runs(F.col("token"), F.col("ner")), "tag")
    return rows.select(
        *ONE_SENTENCE,
        F.col("tag").alias("ner"),
        F.col("first").cast("long").alias("first"),
        F.col("last").cast("long").alias("last"),
        F.col("text").alias("mention"),
    )


def _annotated(spark: SparkSession, sf_dir: str, relations: bool = False, parser: str = "default", routed: bool = False) -> DataFrame:
    extra = frozenset({"relation"}) if relations else frozenset()
    return D.annotate_documents(_stories(spark, sf_dir, routed), L.resources(), parser, extra)


def _written(df: DataFrame, name: str) -> str:
    """Store record lines as text files and return their folder."""
    path = scratch_path(df.sparkSession, name)
    df.select("value").write.text(path)
    return path


def _md5(c: str) -> Column:
    return F.md5(F.col(c).cast("binary"))


def _sizes(docs: DataFrame, *keep: str) -> DataFrame:
    token = F.col("sentences.token")  # the only part of the sentences that is read
    return docs.filter(F.size(token) > 0).select(
        "doc_id",
        *keep,
        F.size(token).cast("long").alias("n_sentences"),
        F.aggregate(token, F.lit(0), lambda n, t: n + F.size(t)).cast("long").alias("n_tokens"),
    )


# --- sources ----------------------------------------------------------------


def scan_nonblank(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = C.table(spark, sf_dir, "documents").select(
        F.concat("text", F.lit("\n \t \n\n")).alias("value")
    )
    back = R.read_lines(spark, _written(lines, "lines"))
    return P.nonblank(back).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def _lang_folders(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    path = scratch_path(spark, "folders")
    C.table(spark, sf_dir, "documents").select("lang", F.col("text").alias("value")).write.partitionBy("lang").text(path)
    return path, R.list_files(spark, path, glob="*.txt")


def _folder(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files listed, then read one by one path: bytes and lines of each folder."""
    path, listing = _lang_folders(spark, sf_dir)
    listed = listing.filter(F.col("length") > 0).select("path", "length")
    lines = R.read_lines(spark, path, glob="*.txt", recursive=True)
    per_file = lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("n_lines"))
    # A listing and a scan may write the scheme differently.
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    both = listed.join(per_file, plain(F.col("path")) == plain(F.col("file_path")))
    return both.groupBy(_folder(F.col("path")).alias("folder")).agg(F.sum("length").alias("n_bytes"), F.sum("n_lines").alias("n_lines"))


def first_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of tagged files a language; the folder of the first file by path is parsed, the others
    are not. A folder holds a file for each task that wrote it, so none takes a whole language."""
    path = scratch_path(spark, "first")
    records = _records(spark, sf_dir).select("lang", "value")
    for lang in ("a", "b"):
        chosen = records.filter(F.col("lang") == "en") if lang == "a" else records.filter(F.col("lang") != "en")
        chosen.select("value").write.text(f"{path}/{lang}")
    first = R.first_file(R.list_files(spark, path, glob="*.txt")).first()["path"]
    docs = P.accepted(P.parse_docs(R.read_doc_xml(spark, first.rpartition("/")[0]), "ENG"))
    return docs.select("doc_id", _md5("body").alias("body_md5"))


def _xml_result(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("reason").isNull()).select(
        "doc_id", "type", "head_line", "date_line",
        F.size("paragraphs").cast("long").alias("n_paragraphs"),
        _md5("body").alias("body_md5"),
    )


def docs_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(_records(spark, sf_dir, escape=True), "xml")
    return _xml_result(P.parse_docs_xml(R.read_doc_xml(spark, path)))


def docs_xml_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(_records(spark, sf_dir, escape=True), "xml-lines")
    return _xml_result(P.parse_docs_xml(P.nonblank(R.read_lines(spark, path))))


def xml_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.paragraph_sentences(_records(spark, sf_dir, escape=True))
    return rows.select("doc_id", F.col("sentence_id").cast("long").alias("sentence_id"), "sentence")


def docs_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records gluing two documents together with log text."""
    docs = C.table(spark, sf_dir, "documents")
    flat = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    parts = [
        C.doc_record(
            F.concat(F.lit(p), F.col("doc_id").cast("string")), C.plain_type_of(F.col("source")),
            C.head_of(F.col("text")), C.date_of(F.col("source")), text,
        )
        for p, text in (("A", F.col("text")), ("B", flat))
    ]
    glued = docs.select(
        "lang", F.concat(F.lit("log line "), parts[0], F.lit(" Exception in parser: "), parts[1], F.lit(" end")).alias("value")
    )
    rows = P.accepted(P.parse_docs(P.split_docs(glued), _language()))
    return rows.select("doc_id", F.col("doc_pos").cast("long").alias("doc_pos"), _md5("body").alias("body_md5"))


def _tag_files(spark: SparkSession, sf_dir: str) -> str:
    """Files of records with text between them; language travels in the dateline."""
    docs = C.table(spark, sf_dir, "documents")
    rec = C.doc_record(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")), C.plain_type_of(F.col("source")),
        C.head_of(F.col("text")), _language(), F.col("text"),
    )
    return _written(docs.select(F.concat(F.lit("noise\n"), rec, F.lit("\nmore noise")).alias("value")), "tagged")


def _tag_documents(raw: DataFrame) -> DataFrame:
    language = F.regexp_extract("value", "<DATELINE> (.*?) </DATELINE>", 1)
    return P.accepted(P.parse_docs(raw, language)).select("doc_id", _md5("body").alias("body_md5"))


def docs_tag_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files cut on tags."""
    return _tag_documents(R.read_tagged(spark, _tag_files(spark, sf_dir), "<DOC ", "</DOC>"))


def docs_tag_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files by byte ranges, many to a file."""
    return _tag_documents(V.read_records(spark, _tag_files(spark, sf_dir), "<DOC ", "</DOC>", split_bytes=1 << 18))


def stream_tag_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as a stream of whole records."""
    path = scratch_path(spark, "stream-records")
    records = V.stream_records(spark, _tag_files(spark, sf_dir), "<DOC ", "</DOC>", split_bytes=1 << 20)
    _drain(T.per_batch(_tag_documents(records), K.batch_appender(path)), path + "-checkpoint")
    return spark.read.parquet(path).select("doc_id", "body_md5")


def docs_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("doc_id"),
        C.type_of(F.col("source")).alias("type"),
        F.coalesce(_own_language(), F.upper("lang")).alias("language"),
        "text",
    )
    path = _written(D.to_json_rows(docs), "json")
    back = R.json_documents(R.read_lines(spark, path))
    return back.select(
        "doc_id", "type", "language",
        F.size(sentences_of("body", F.col("language"))).cast("long").alias("n_sentences"), "reason",
    )


def docs_json_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents whose shape differs from one to the next: read, changed, written and read again."""
    docs = C.table(spark, sf_dir, "documents")
    known = [F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("doc_id"), F.coalesce(_own_language(), F.upper("lang")).alias("language"), "text"]
    meta = F.struct("source", F.array("lang", "source").alias("tags"), F.struct("n_chars").alias("size")).alias("meta")
    shapes = F.when(F.col("doc_id") % 6 == 0, F.to_json(F.struct(*known, meta, F.col("doc_id").alias("rank"))))
    shapes = shapes.when(F.col("doc_id") % 2 == 0, F.to_json(F.struct(*known, meta)))
    shapes = shapes.when(F.col("doc_id") % 3 == 0, F.to_json(F.struct(*known, (F.col("doc_id") / 4).alias("rank"))))
    lines = R.read_lines(spark, _written(docs.select(shapes.otherwise(F.to_json(F.struct(*known))).alias("value")), "json-open"))
    opened = O.open_documents(lines).withColumn("n_lines", F.size(F.split("text", "\n")))
    out = O.close_documents(opened, ("doc_id", "language", "n_lines", "reason"))
    field = lambda p: F.get_json_object("value", p)
    return out.select(
        field("$.doc_id").alias("doc_id"), field("$.language").alias("language"), field("$.reason").alias("reason"), field("$.n_lines").cast("long").alias("n_lines"),
        field("$.meta.tags[1]").alias("tag"), field("$.meta.size.n_chars").cast("long").alias("n_chars"), field("$.rank").cast("double").alias("rank"),
    )


def user_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.when(F.col("c_custkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("c_nationkey").cast("string"))
    xml = C.table(spark, sf_dir, "customer").select(
        F.concat(
            F.lit("<user><account>"), F.col("c_custkey").cast("string"), F.lit("</account><name>"),
            F.col("c_name"), F.lit("</name><number>"), number, F.lit("</number></user>"),
        ).alias("value")
    )
    rows = R.user_records(R.read_tagged(spark, _written(xml, "users"), "<user>", "</user>"))
    return rows.withColumn("number", F.col("number").cast("long"))


def memory_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = W.words(R.lines_from(spark, ["story STORY multi", "other multi"]))
    kinds = C.table(spark, sf_dir, "documents").select(C.type_of(F.col("source")).alias("word"))
    return (
        kinds.groupBy("word").count().join(F.broadcast(wanted), "word")
        .groupBy("word").agg(F.sum("count").alias("n"))
    )


# --- parsing ----------------------------------------------------------------


def doc_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select("doc_id", "type", "head_line", "date_line", "language")


def doc_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stories(spark, sf_dir, routed=True).select(
        "doc_id", F.size("paragraphs").cast("long").alias("n_paragraphs"), "body"
    )


def doc_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _parsed(spark, sf_dir)
        .groupBy(F.coalesce("language", F.lit("none")).alias("language"), F.coalesce("reason", F.lit("ok")).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parse_docs(C.damage(_records(spark, sf_dir, routed=True)), _own_language())


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = P.dead_letters(_damaged(spark, sf_dir).withColumn("value", F.struct("key", "value")))
    return failed.select(F.col("raw.key").alias("key"), "reason")


def extract_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.table(spark, sf_dir, "pages").select("page_id", extract_field("html", "title").alias("title"))


def _joined(spark: SparkSession, sf_dir: str) -> X.JoinedText:
    """The stories of each source as one text."""
    records = C.wrap(C.table(spark, sf_dir, "documents")).withColumn("source", F.regexp_extract("value", "<DATELINE> (\\S+) ", 1))
    stories = P.accepted(P.parse_docs(records, _language())).withColumn("source", F.lower("source"))
    return X.write_joined(stories, ["source"], "key", scratch_path(spark, "joined"))


def corpus_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document stands in the joined text of its source."""
    joined = _joined(spark, sf_dir)
    bodies = joined.text.select("place", _md5("text").alias("body_md5"))
    return joined.addresses.join(bodies, "place").select("source", "position", "offset", "length", "body_md5")


def corpus_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined text of each source, by the digests of its blocks."""
    return X.digests(_joined(spark, sf_dir), 100_000)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.when(F.col("key") % 3 != 0, F.concat(F.lit("M"), F.col("key").cast("string"), F.lit("#"))).otherwise(F.lit(""))
    return _records(spark, sf_dir).withColumn("value", F.concat(tag, "value"))


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.accepted(P.parse_docs(P.envelope(_messages(spark, sf_dir)), _language()))
    return rows.select("mongo_id", "doc_id", _md5("body").alias("body_md5"))


def doc_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stories(spark, sf_dir).withColumn("mongo_id", F.concat(F.lit("M"), F.col("key").cast("string")))
    text = D.to_json_rows(rows.select("mongo_id", "doc_id", "type", "language", "head_line", "body"))
    back = F.from_json("value", "mongo_id string, doc_id string, type string, language string, head_line string, body string")
    return text.select(back.alias("d")).select(
        "d.mongo_id", "d.doc_id", "d.type", "d.language", "d.head_line", F.md5(F.col("d.body").cast("binary")).alias("body_md5")
    )


# --- word counts ------------------------------------------------------------


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.word_count(_stories(spark, sf_dir), "body")


def word_count_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "counts")
    K.append(W.count_as_text(word_count(spark, sf_dir)), path)
    return spark.read.parquet(path)


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.top_words(word_count(spark, sf_dir), 10)


def threshold_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.table(spark, sf_dir, "orders").filter(F.col("o_orderkey") < 10000).agg(F.count(F.lit(1)).alias("n"))


# --- sentences and tokens ---------------------------------------------------


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sentences(spark, sf_dir).drop("rec_id")


def abbreviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.learn_abbreviations(_stories(spark, sf_dir)).select("word", "dotted", "plain")


def sentences_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences that do not end at abbreviations learned from the same corpus."""
    stories = _stories(spark, sf_dir)
    known = G.Abbreviations(G.learn_abbreviations(stories))
    rows = unnest(stories, ["doc_id"], known.segment("body"), "sentence", "sentence_id")
    return rows.withColumn("sentence_id", F.col("sentence_id").cast("long"))


def first_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.first_sentences(_stories(spark, sf_dir), ["doc_id"]).filter(F.col("sentence").isNotNull())


def _arabic_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").withColumn("text", C.arabic_text(F.col("text")))
    rows = N.explode_sentences(P.accepted(P.parse_docs(C.wrap(docs), "ARA")), ["doc_id", "language"])
    return rows.withColumn("sentence_id", F.col("sentence_id").cast("long"))


def arabic_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arabic_sentences(spark, sf_dir).select(*SENTENCE, "sentence")


def arabic_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.with_tokens(_arabic_sentences(spark, sf_dir)).select(*SENTENCE, D.flat_tokens("token").alias("token"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokenized(spark, sf_dir).select(
        *SENTENCE, F.size("token").cast("long").alias("n_tokens"), D.flat_tokens("token").alias("token")
    )


def long_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin(N.mark_long(_tokenized(spark, sf_dir)), "too_long").filter("too_long").select(
        *SENTENCE, F.size("token").cast("long").alias("n_tokens")
    )


# --- lexicon annotations ----------------------------------------------------


def _flat(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.select(*SENTENCE, F.array_join(value, ",").alias(name))


def lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = A.lemmas(F.col("token"), _found(L.LEMMAS))
    return _flat(_tokenized(spark, sf_dir), "lemma", value)


def pos_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = A.pos_tags(F.col("token"), _found(L.POS))
    return _flat(_tokenized(spark, sf_dir), "pos", value)


def pos_tags_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of a model of each language, learned from all its sentences and a lexicon of ambiguous words."""
    lexicon = InlineLexicon(H.ambiguity(L.POS + L.MORE_POS))
    path = scratch_path(spark, "classes")
    rows = _tokenized(spark, sf_dir).withColumn("classes", H.word_classes(F.col("token"), lexicon, F.col("language")))
    rows.select(*SENTENCE, "language", "classes").write.parquet(path)
    stored = spark.read.parquet(path)
    models = {name: H.train(stored.filter(F.col("language") == name), "classes")[0] for name in ("ENG", "ESP")}
    tags = F
    for name, model in models.items():
        own = F.col("language") == name
        tags = tags.when(own, model.decode(F.when(own, F.col("classes"))))
    return stored.select(*SENTENCE, F.array_join(tags, ",").alias("pos"))


def entity_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_tagged(spark, sf_dir), "ner", F.col("ner"))


def _said(spark: SparkSession, sf_dir: str, longest: int) -> DataFrame:
    """Every run of up to ``longest`` words of every message, in lower case, with the message's role."""
    words = F.array_join(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)), " ")
    messages = R.at_least(C.table(spark, sf_dir, "conversations"), 2 * spark.sparkContext.defaultParallelism)
    some = (F.monotonically_increasing_id() / 4096).cast("long")  # messages whose phrases are told apart before they move
    rows = messages.select("role", words.alias("_text"), some.alias("_block"))
    return offered(rows, longest, "role").select(F.col("by").alias("role"), "phrase").distinct()


def _in_languages(said: DataFrame) -> DataFrame:
    return said.select(F.explode(F.array(F.lit("ENG"), F.lit("ESP"))).alias("language"), "phrase", "role")


def entity_tags_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gazetteer derived from a table: all words and word pairs of all messages, typed by their role."""
    phrases = _in_languages(_said(spark, sf_dir, 2)).withColumnRenamed("role", "ner")
    tagged = E.tag_by_gazetteer(_tokenized(spark, sf_dir), phrases, ONE_SENTENCE, 2)
    return tagged.groupBy("doc_id", "ner").agg(F.count(F.lit(1)).alias("n"))


def regex_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules run on distinct tokens, which carry their counts."""
    distinct = N.explode_tokens(_tokenized(spark, sf_dir), SENTENCE).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    tag = F.get(regex_tags(F.array("token"), L.RULES, F.lit("O")), F.lit(0))
    return pin(distinct.withColumn("ner", tag), "ner").filter(F.col("ner") != "O")


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = A.sentiment(F.col("token"), _found(L.POLARITY))
    return _tokenized(spark, sf_dir).select(*SENTENCE, value.cast("long").alias("sentiment"))


def truecase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens not in their usual casing; a model too large to be broadcast is looked up by blocks of sentences."""
    rows = N.explode_tokens(_tokenized(spark, sf_dir), ONE_SENTENCE)
    model = scratch_path(spark, "casing")
    K.append(E.casing_model(rows), model)
    varied = spark.read.parquet(model).filter(F.col("casings") > 1)
    if not fits_broadcast(varied.select("word", "cased")):
        counted = E.truecase_changes(blocked(_tokenized(spark, sf_dir), ["doc_id"]), varied, ["doc_id"])
        return counted.groupBy("doc_id").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("n_changed").alias("n_changed"))
    cased = E.truecase(rows, varied, [*ONE_SENTENCE, "idx"])
    return cased.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.count_if(F.col("token") != F.col("truecase")).alias("n_changed")
    )


def casing_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.casing_model(N.explode_tokens(_tokenized(spark, sf_dir), SENTENCE)).drop("casings")


def clean_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.table(spark, sf_dir, "pages").select("page_id", strip_markup("html").alias("text"))


# --- entities ---------------------------------------------------------------


def entity_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = S.group_by_tag(S.tagged_tokens(F.col("token"), F.col("ner")))
    rows = _tagged(spark, sf_dir).select(*SENTENCE, S.render_groups(groups).alias("ner"))
    return pin(rows, "ner").filter(F.col("ner") != "")


def entity_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(spark, sf_dir).drop("rec_id")


def entity_spans_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.explode_tokens(_tagged(spark, sf_dir), ONE_SENTENCE, ("token", "ner"))
    spans = E.merge_spans(rows, ONE_SENTENCE)
    return spans.select(
        *SENTENCE, "ner", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), "mention"
    )


def mention_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.group_mentions(_spans(spark, sf_dir), ONE_SENTENCE).drop("rec_id")


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pos = A.pos_tags(F.col("token"), _found(L.POS))
    rows = _tokenized(spark, sf_dir).select(*SENTENCE, S.bracket_runs(F.col("token"), A.chunk_tags(pos)).alias("parse_sentence"))
    return pin(rows, "parse_sentence").filter(F.col("parse_sentence") != "")


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions = _spans(spark, sf_dir).withColumnRenamed("sentence_id", "position")
    return E.link_aliases(mentions, ONE_DOC).drop("rec_id")


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tagged(spark, sf_dir)
    spans = S.merge_runs(F.col("token"), F.col("ner"))
    return E.count_relations(unnest_fields(rows, [], S.neighbour_pairs(F.col("token"), spans), "type1"))


def relations_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of mentions believed after two rounds, from those that meet around more than one connector."""
    rows = _tagged(spark, sf_dir)
    spans = S.merge_runs(F.col("token"), F.col("ner"))
    path = scratch_path(spark, "facts")
    bootstrap.pair_facts(unnest_fields(rows, [], S.neighbour_pairs(F.col("token"), spans), "type1")).write.parquet(path)
    facts = spark.read.parquet(path)
    seeds = facts.groupBy(*bootstrap.PAIR).agg(F.sum("n").alias("n")).filter(F.col("n") > 2)
    _, pairs = bootstrap.bootstrap(facts, seeds, rounds=2, support=2, trust=0.3, belief=0.4)
    return pairs.select(*bootstrap.PAIR, F.round("score", 6).alias("score"), "round")


# --- documents --------------------------------------------------------------


def _sentence_rows(docs: DataFrame) -> DataFrame:
    s = F.col("s")
    return docs.select("doc_id", "type", "head_line", "date_line", "language", F.explode("sentences").alias("s")).select(
        "doc_id", "type", "head_line", "date_line", "language",
        s["sentence_id"].cast("long").alias("sentence_id"), s["sentence"].alias("sentence"),
        D.flat_tokens(s["token"]).alias("token"), D.flat_tokens(s["lemma"]).alias("lemma"),
        S.render_groups(s["ner"]).alias("ner"), s["relation"].alias("relation"),
        s["sentiment"].cast("long").alias("sentiment"), s["parse_sentence"].alias("parse_sentence"),
    )


def documents_assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sentence_rows(D.to_documents(_annotated(spark, sf_dir, relations=True, routed=True)))


def documents_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of both languages and the sentiment of English, and nothing else."""
    wanted = {"ENG": {"ner", "sentiment"}, "ESP": {"ner"}}
    docs = D.annotate_documents(_stories(spark, sf_dir, routed=True), L.resources(), wanted=wanted)
    return _sentence_rows(docs).drop("type", "head_line", "date_line", "sentence")


def table_resources(spark: SparkSession, sf_dir: str) -> B.TableResources:
    """Lexicons that grow with the data, derived from all words of all messages."""
    phrases = _in_languages(stored(_said(spark, sf_dir, 2), "said"))
    words = phrases.filter(~F.col("phrase").contains(" ")).select("language", F.col("phrase").alias("word")).distinct()
    size = F.length("word")
    return B.TableResources(
        lemma=words.select("language", "word", F.left("word", F.lit(4))),
        pos=words.select("language", "word", F.when(size % 3 == 0, "VB").when(size % 3 == 1, "NN").otherwise("IN")),
        gazetteer=phrases.select("language", "phrase", F.upper("role")),
        polarity=words.select("language", "word", (size % 3 - 1).cast("string")),
    )


def documents_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents annotated from lexicon tables of any size."""
    docs = _stories(spark, sf_dir, routed=True).select("doc_id", "type", "head_line", "date_line", "language", "body")
    return _sentence_rows(D.annotate_documents(docs, table_resources(spark, sf_dir))).drop("type", "head_line", "date_line", "sentence", "relation")


def documents_regrouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents rebuilt from sentence rows."""
    return _sizes(D.assemble(_tokenized(spark, sf_dir), ONE_DOC, ["sentence", "token"]))


def documents_coref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases within each document's own row; English has them in its profile."""
    return D.with_corref(_annotated(spark, sf_dir)).select("doc_id", "corref")


def documents_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions and pronouns of English documents with their canonical form, by passes."""
    docs = D.annotate_documents(_stories(spark, sf_dir).filter(F.col("language") == "ENG"), L.resources(), wanted={"ner", "token"})
    rows = Y.link_mentions(docs).select("doc_id", F.inline("links"))
    return rows.select("doc_id", F.col("sentence_id").cast("long").alias("sentence_id"), "ner", "mention", "canonical", "sieve")


def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    arabic = F.col("lang") == "de"
    text = F.when(arabic, C.arabic_text(F.col("text"))).otherwise(F.col("text"))
    language = F.when(arabic, F.lit("ARA")).otherwise(_language())
    stories = P.accepted(P.parse_docs(C.wrap(docs.withColumn("text", text)), language))
    s = F.col("s")
    rows = D.annotate_documents(stories, L.resources()).select("language", F.explode("sentences").alias("s"))
    return rows.groupBy("language").agg(
        F.count(F.lit(1)).alias("n_sentences"),
        F.count(s["lemma"]).alias("with_lemma"),
        F.count(s["ner"]).alias("with_ner"),
        F.count(s["sentiment"]).alias("with_sentiment"),
        F.count(s["parse_sentence"]).alias("with_parse"),
        F.count(s["dependency_tree"]).alias("with_dependency"),
    )


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted, seen = metrics(_damaged(spark, sf_dir))
    K.append(P.accepted(counted).select("doc_id", "body"), scratch_path(spark, "metered"))
    got = seen.get
    names = ("records", "good", "dropped", "failed")
    return spark.range(1).select(*[F.lit(got[n]).cast("long").alias(n) for n in names])


# --- store ------------------------------------------------------------------


def store_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "documents")
    K.append(D.to_documents(_annotated(spark, sf_dir, parser="fast", routed=True)), path)
    return _sizes(spark.read.parquet(path))


def sentence_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parses")
    pos = A.pos_tags(F.col("token"), _found(L.POS))
    parse = S.bracket_runs(F.col("token"), A.chunk_tags(pos))
    K.append(_tokenized(spark, sf_dir).select("sentence", parse.alias("parse")), path)
    return spark.read.parquet(path).groupBy("sentence", "parse").agg(F.count(F.lit(1)).alias("n"))


def _versions(spark: SparkSession, sf_dir: str, name: str, seq: int) -> DataFrame:
    return _stories(spark, sf_dir).select(
        "doc_id", "type", "language", "body", F.lit(name).alias("version"), F.lit(seq).cast("long").alias("seq")
    )


def store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything, then the capital-letter stories twice in one replayed batch, a
    compaction, then the Spanish ones."""
    path = scratch_path(spark, "store")
    K.upsert_batch(_versions(spark, sf_dir, "first", 1), path, 0)
    changed = F.col("type") == "STORY"
    twice = _versions(spark, sf_dir, "second", 1).filter(changed).unionByName(
        _versions(spark, sf_dir, "second, late", 2).filter(changed)
    )
    K.upsert_batch(twice, path, 1)
    K.upsert_batch(twice, path, 1)
    K.compact(spark, path)
    K.upsert_batch(_versions(spark, sf_dir, "third", 1).filter(F.col("language") == "ESP"), path, 2)
    return K.latest(spark, path).select("doc_id", "version", _md5("body").alias("body_md5"))


def store_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that both begin at batch 0, a compaction between them, and a replay.

    The first run stores everything, the second the capital-letter stories; then the
    first adds the Spanish ones, and the second's batch is replayed, which leaves
    its place among the commits as it was.
    """
    path = scratch_path(spark, "store")
    changed = F.col("type") == "STORY"
    second = _versions(spark, sf_dir, "second", 1).filter(changed)
    K.upsert_batch(_versions(spark, sf_dir, "first", 1), path, 0, run="one")
    K.compact(spark, path)
    K.upsert_batch(second, path, 0, run="two")
    K.upsert_batch(_versions(spark, sf_dir, "third", 1).filter(F.col("language") == "ESP"), path, 1, run="one")
    K.upsert_batch(second, path, 0, run="two")
    return K.latest(spark, path).select("doc_id", "version", _md5("body").alias("body_md5"))


def store_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "store")
    K.upsert_batch(_versions(spark, sf_dir, "first", 1), path, 0)
    K.upsert_batch(_versions(spark, sf_dir, "second", 1).filter(F.col("language") == "ESP"), path, 1)
    return K.lookup_many(spark, path, _wanted(spark, sf_dir), columns=["version"]).select("doc_id", "version")


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.table(spark, sf_dir, "labels").select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("doc_id"))


def store_lookup_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups through the bitmaps of keys: two batches indexed, one not yet, one snapshot between."""
    path = scratch_path(spark, "store")
    K.upsert_batch(_versions(spark, sf_dir, "first", 1), path, 0)
    K.compact(spark, path)
    K.upsert_batch(_versions(spark, sf_dir, "second", 1).filter(F.col("language") == "ESP"), path, 1)
    K.index_keys(spark, path)
    K.upsert_batch(_versions(spark, sf_dir, "third", 1).filter(F.col("type") == "STORY"), path, 2)
    return K.lookup_many(spark, path, _wanted(spark, sf_dir), columns=["version", "body"]).select("doc_id", "version", _md5("body").alias("body_md5"))


def skip_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose key an indexed store does not hold."""
    path = scratch_path(spark, "store")
    for batch, language in enumerate(("ENG", "ESP")):
        kept = _stories(spark, sf_dir).filter(F.col("language") == language).join(F.broadcast(_wanted(spark, sf_dir)), "doc_id", "semi")
        K.upsert_batch(kept.select("doc_id", "language", F.lit(1).alias("seq")), path, batch)
    K.index_keys(spark, path)
    return K.skip_stored(_stories(spark, sf_dir).select("doc_id", "language"), path)


def skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = C.table(spark, sf_dir, "labels").select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("doc_id")
    )
    return K.skip_existing(_stories(spark, sf_dir).select("doc_id", "language"), stored)


# --- streams ----------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, be it one file or a folder of files: the pattern matches either, and
    what is below a folder is listed."""
    schema = C.table(spark, sf_dir, name).schema
    return Z.watch_files(spark, f"{sf_dir}/{{{name}}}.parquet", schema)


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.wrap(_stream(spark, sf_dir, "documents"), routed=True).select(
        F.concat(F.lit("M"), F.col("key").cast("string"), F.lit("#"), F.col("value")).alias("value")
    )


def _drain(writer, checkpoint: str) -> None:  # noqa: ANN001
    T.wait(T.start(writer, checkpoint))


def stream_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-docs")
    res = L.resources()
    splits = 2 * spark.sparkContext.defaultParallelism

    def annotate(batch: DataFrame) -> DataFrame:
        return T.annotate_stream(R.at_least(batch, splits), res)

    _drain(T.per_batch(_message_stream(spark, sf_dir), K.batch_appender(path, annotate)), path + "-checkpoint")
    return _sizes(spark.read.parquet(path), "mongo_id")


def _stored_messages(spark: SparkSession, messages: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Documents and dead letters of a drained message stream."""
    path = scratch_path(spark, name)
    splits = 2 * spark.sparkContext.defaultParallelism
    writer = T.store_messages(
        messages, L.resources(), f"{path}/good", f"{path}/failed", name, spread=lambda batch: R.at_least(batch, splits)
    )
    _drain(writer, path + "-checkpoint")
    shape = "mongo_id string, reason string, raw string"
    return spark.read.parquet(f"{path}/good"), spark.read.schema(shape).parquet(f"{path}/failed")


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages: each that fails is stored with its reason."""
    records = C.damage(C.wrap(_stream(spark, sf_dir, "documents"), routed=True))
    # A message whose record has no opening tag at all; noise before a record is only log text.
    broken = F.replace("value", F.lit("junk <DOC "), F.lit("junk <DIC "))
    messages = records.select(F.concat(F.lit("M"), F.col("key").cast("string"), F.lit("#"), broken).alias("value"))
    _, failed = _stored_messages(spark, messages, "dead-letters")
    return failed.select(F.col("mongo_id").alias("key"), "reason")


def stream_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job users run: damaged messages published as JSON, or stored with their reason; none is lost."""
    path = scratch_path(spark, "published")
    records = C.damage(C.wrap(_stream(spark, sf_dir, "documents"), routed=True))
    messages = records.select(F.concat(F.lit("M"), F.col("key").cast("string"), F.lit("#"), "value").alias("value"))
    splits = 2 * spark.sparkContext.defaultParallelism
    writer = T.publish_messages(messages, L.resources(), f"{path}/failed", "text", f"{path}/good", spread=lambda b: R.at_least(b, splits))
    _drain(writer, path + "-checkpoint")
    good = spark.read.text(f"{path}/good").select(F.get_json_object("value", "$.mongo_id").alias("key"), F.lit("published").alias("outcome"))
    failed = spark.read.schema("mongo_id string, reason string").parquet(f"{path}/failed")
    return good.unionAll(failed.select(F.col("mongo_id").alias("key"), F.col("reason").alias("outcome")))


def stream_glued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that hold two documents with log text around them."""
    docs = _stream(spark, sf_dir, "documents")
    halves = [
        C.doc_record(
            F.concat(F.lit(p), F.col("doc_id").cast("string")), C.plain_type_of(F.col("source")),
            C.head_of(F.col("text")), C.date_of(F.col("source")), F.col("text"),
        )
        for p in ("A", "B")
    ]
    glued = F.concat(F.lit("M"), F.col("doc_id").cast("string"), F.lit("#"), halves[0], F.lit(" Exception in parser: "), halves[1], F.lit(" end"))
    good, _ = _stored_messages(spark, docs.select(glued.alias("value")), "glued")
    return _sizes(good, "mongo_id", "doc_pos").withColumn("doc_pos", F.col("doc_pos").cast("long"))


def stream_json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "topic-out")
    docs = T.annotate_stream(_message_stream(spark, sf_dir), L.resources())
    _drain(M.publish_stream(docs, "text", path), path + "-checkpoint")
    shape = f"doc_id string, mongo_id string, sentences array<{D.SENTENCE_TYPE}>"
    back = spark.read.text(path).select(F.from_json("value", shape).alias("d"))
    rows = back.select("d.doc_id", "d.mongo_id", F.explode("d.sentences").alias("s"))
    return rows.select(
        "doc_id", "mongo_id", F.col("s.sentence_id").cast("long").alias("sentence_id"),
        D.flat_tokens(F.col("s.token")).alias("token"),
    )


def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each micro-batch on its own; here they are added up over the batches."""
    path = scratch_path(spark, "stream-words")
    lines = _stream(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    _drain(T.word_count_per_batch(lines, path), path + "-checkpoint")
    return spark.read.parquet(path).groupBy("word").agg(F.sum("count").alias("count"))


def stream_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time windows as partial counts of each micro-batch. The events come in two
    batches, the later half first: none is too late."""
    path = scratch_path(spark, "stream-windows")
    events = C.table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    middle = events.agg(F.expr("timestamp_micros(cast((unix_micros(min(ts)) + unix_micros(max(ts))) / 2 as bigint))")).first()[0]
    source = scratch_path(spark, "events")
    for late in (True, False):  # files are read in the order in which they were written
        half = F.col("ts") >= F.lit(middle)
        events.filter(half if late else ~half).coalesce(1).write.mode("append").parquet(source)
    shape = "event_type string, ts timestamp"
    stream = Z.watch_files(spark, source, shape, files_per_batch=1)
    _drain(T.window_count_per_batch(stream, path, "event_type", "ts", "30 minutes"), path + "-checkpoint")
    totals = T.window_totals(spark.read.parquet(path))
    return totals.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_window_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that close, in three batches: the earlier half of four events in five, the later
    half, then the fifth event of all times, most of which is late."""
    path, source = scratch_path(spark, "late-windows"), scratch_path(spark, "events")
    events = C.table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    middle = events.agg(F.expr("timestamp_micros(cast((unix_micros(min(ts)) + unix_micros(max(ts))) / 2 as bigint))")).first()[0]
    fifth = F.pmod("event_id", F.lit(5)) == 0
    checkpoint, stream = path + "-checkpoint", None
    for part in (~fifth & (F.col("ts") < F.lit(middle)), ~fifth & (F.col("ts") >= F.lit(middle)), fifth):
        # Each part is drained as one batch; the query goes on from its checkpoint.
        events.filter(part).select("event_type", "ts").write.mode("append").parquet(source)
        stream = Z.watch_files(spark, source, "event_type string, ts timestamp")
        _drain(Q.count_windows(stream, path, "event_type", "ts", "30 minutes", "6 hours"), checkpoint)
    late = Q.late_rows(spark, path, "event_type string, ts timestamp")
    parts = {
        "emitted": Q.emitted(spark, path).select("window_start", "word", "count"),
        "open": Q.open_windows(spark, path),
        "late": late.groupBy(F.window("ts", "30 minutes")["start"].alias("window_start"), F.col("event_type").alias("word")).agg(F.count(F.lit(1)).alias("count")),
    }
    rows = [df.select(F.lit(kind).alias("kind"), F.col("window_start").cast("timestamp_ntz").alias("window_start"), "word", "count") for kind, df in parts.items()]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


def batch_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = C.table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    counts = W.windowed_word_count(events, "event_type", "ts", "30 minutes")
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-topics")
    topics = Z.union_topics(
        {n: _stream(spark, sf_dir, n).select(F.col("text").alias("value")) for n in ("documents", "conversations")}
    )

    def counts(batch: DataFrame) -> DataFrame:
        per_message = batch.select("topic", F.size(W.jsplit("value")).alias("n"))
        return per_message.groupBy("topic").agg(F.count(F.lit(1)).alias("n_messages"), F.sum("n").alias("n_words"))

    _drain(T.per_batch(topics, K.batch_appender(path, counts)), path + "-checkpoint")
    return spark.read.parquet(path).groupBy("topic").agg(
        F.sum("n_messages").alias("n_messages"), F.sum("n_words").alias("n_words")
    )


# --- plug-in annotators -----------------------------------------------------


def _token_pattern():  # noqa: ANN202
    import regex

    return regex.compile(TOKEN)


def bulk_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two annotators; one refuses some texts, the other still fills."""

    def count_tokens(pattern, text: str) -> int:  # noqa: ANN001
        return len(pattern.findall(text.split("|", 1)[1]))

    def count_chars(_, text: str) -> int:  # noqa: ANN001
        number, body = text.split("|", 1)
        if int(number) % 10 == 0:
            raise ValueError("refused")
        return len(body)

    docs = C.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws("|", F.col("doc_id").cast("string"), "text").alias("text")
    )
    done = U.annotate_with(
        U.spread(docs),
        U.SharedInstance(_token_pattern),
        {"n_tokens": (count_tokens, "long"), "n_chars": (count_chars, "long")},
        "text",
    )
    return done.select("doc_id", "n_tokens", "n_chars", F.size("errors").cast("long").alias("n_errors"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = C.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return turns.repartition(4 * spark.sparkContext.defaultParallelism)


def _kept(shared: U.SharedInstance, turns: DataFrame) -> DataFrame:
    """Token counts by a batched annotator, and the name of the instance that made them."""

    @U.batched
    def count_tokens(state, texts):  # noqa: ANN001, ANN202
        return [len(state[1].findall(t)) for t in texts]

    @U.batched
    def maker(state, texts):  # noqa: ANN001, ANN202
        return [state[0]] * len(texts)

    return U.annotate_with(turns, shared, {"n_tokens": (count_tokens, "long"), "maker": (maker, "string")}, "text")


def _named_pattern() -> tuple:
    return uuid.uuid4().hex, _token_pattern()


def worker_singleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One instance a worker: far fewer instances than tasks, all turns counted."""
    done = _kept(U.SharedInstance(_named_pattern), _turns(spark, sf_dir)).withColumn("part", F.spark_partition_id())
    per = done.agg(F.count_distinct("maker").alias("made"), F.count_distinct("part").alias("tasks"), F.count(F.lit(1)).alias("n_turns"), F.sum("n_tokens").alias("n_tokens"))
    return per.select("n_turns", "n_tokens", ((F.col("tasks") <= spark.sparkContext.defaultParallelism) | (F.col("made") < F.col("tasks"))).alias("shared"))


def task_instance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One instance a task, none shared by two."""
    done = _kept(U.TaskInstance(_named_pattern), _turns(spark, sf_dir)).withColumn("part", F.spark_partition_id())
    per = done.groupBy("maker").agg(F.count_distinct("part").alias("parts"), F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t"))
    return per.agg(F.sum("n").alias("n_turns"), F.sum("t").alias("n_tokens"), (F.max("parts") == 1).alias("apart"))


def build() -> dict[str, Query]:
    named = {"extract_field": extract_title}
    plain = (
        scan_nonblank, file_listing, first_file, docs_xml, docs_xml_lines, xml_paragraphs,
        docs_tagged, docs_tag_files, docs_tag_splits, docs_json, docs_json_open, user_records, memory_lines,
        doc_header, doc_body, doc_routing, dead_letters, corpus_concat, corpus_digests, envelope, doc_json,
        word_count, word_count_doc, top_words, threshold_count,
        sentences, abbreviations, sentences_learned, first_sentence, arabic_sentences, arabic_norm, tokens, long_sentences,
        lemmas, pos_tags, pos_tags_learned, entity_tags, entity_tags_joined, regex_entities, sentiment, truecase, casing_model, clean_markup,
        entity_groups, entity_spans, entity_spans_windowed, mention_groups, chunks, aliases, relations, relations_learned,
        documents_assembled, documents_selected, documents_tables, documents_regrouped, documents_coref, documents_links, profile_columns, run_metrics,
        store_append, sentence_store, store_upsert, store_two_runs, store_lookup, store_lookup_indexed, skip_existing, skip_stored,
        stream_docs, stream_tag_files, stream_dead_letters, stream_published, stream_glued, stream_json_sink, stream_word_count, stream_window_count, stream_window_late, batch_window_count, stream_topics,
        bulk_annotate, worker_singleton, task_instance,
    )
    return {**{f.__name__: f for f in plain}, **named}
