"""The plans stay the ones meant for large inputs."""

import pytest

import __spark_entry__ as entry
from presswire.operators import assemble as D
from presswire.operators import docparse as P
from presswire.plans import catalog as C
from presswire.plans import corpus, lexicons

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def records(spark):
    return corpus.wrap(C.N.with_record_id(corpus.table(spark, SF, "documents")))


def test_parse_and_annotate_never_shuffle(spark):
    parsed = P.accepted(P.parse_docs(records(spark), C._language()))
    docs = D.to_documents(D.annotate_documents(parsed, lexicons.resources()))
    text = plan(docs)
    assert "Exchange" not in text and "Python" not in text and "Join" not in text


def test_annotation_is_evaluated_once(spark):
    parsed = P.accepted(P.parse_docs(records(spark), C._language()))
    docs = D.annotate_documents(parsed, lexicons.resources()).selectExpr("doc_id", "explode(sentences) s")
    lines = [x for x in plan(docs).splitlines() if "regexp_extract_all" in x and "transform" in x]
    assert len(lines) == 1


def test_header_query_reads_no_more_than_it_needs(spark):
    text = plan(C.threshold_count(spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderkey), LessThan(o_orderkey,10000)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_word_count_combines_before_its_only_shuffle(spark):
    text = plan(C.W.word_count(P.accepted(P.parse_docs(records(spark), C._language())), "body"))
    assert text.count("Exchange hashpartitioning(word") == 1 and "partial_count" in text


def test_window_form_moves_rows_once(spark):
    tokens = C.N.explode_tokens(C.N.with_tokens(C.N.explode_sentences(P.accepted(P.parse_docs(records(spark), C._language())), ["rec_id", "doc_id", "language"])), C.ONE_SENTENCE)
    from pyspark.sql import functions as F

    spans = C.E.merge_spans(tokens.withColumn("ner", F.lit("P")), C.ONE_SENTENCE)
    assert plan(spans).count("Exchange hashpartitioning") == 1


def test_aliases_join_nothing(spark):
    text = plan(C.aliases(spark, SF))
    assert "Join" not in text and "partial_max_by" in text


def test_every_query_with_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert len(entry.entry(spark).take(1)) == 1


@pytest.fixture(scope="module")
def duck():
    from check import connect

    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, duck, name):
    from check import compare

    ok, note = compare(spark, duck, SF, name)
    assert ok, note


def test_sizes_read_nothing_but_tokens(spark, tmp_path):
    docs = D.to_documents(D.annotate_documents(P.accepted(P.parse_docs(records(spark), C._language())).limit(3), lexicons.resources()))
    docs.write.parquet(str(tmp_path / "d"))
    text = plan(C._sizes(spark.read.parquet(str(tmp_path / "d"))))
    assert "ReadSchema: struct<doc_id:string,sentences:array<struct<token:array<string>>>>" in text
