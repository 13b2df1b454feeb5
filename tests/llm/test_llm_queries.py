"""Registered queries over the test tables: SQL where there is some, else plain Python."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import quality
from basketry.llm.oracle import ORACLE
from basketry.llm.queries import QUERIES, table

import brute

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are missing")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for source in ("documents", "benchmark", "embeddings", "pages", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {source} AS SELECT * FROM '{FOLDER}/{source}.parquet'")
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    rows = duck.execute(ORACLE[name])
    places = [[d[0] for d in rows.description].index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in places) for row in rows.fetchall()), key=repr)
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == expected


def test_ngram_join_matches_all_pairs(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op10_ngram_join"](spark, FOLDER).collect())) == sorted(brute.near_components(rows))


def test_quality_on_the_held_out_third(spark):
    found = QUERIES["op3_quality_classifier"](spark, FOLDER)
    labels = table(spark, FOLDER, "labels").select("doc_id", "quality")
    judged = found.where("held_out").join(labels, "doc_id").collect()
    assert judged and sum(r.predicted == r.quality for r in judged) >= 0.9 * len(judged)


def test_every_text_is_encoded_and_decodes(spark):
    found = QUERIES["op4_sentence_pieces"](spark, FOLDER)
    assert found.where("round_trip").count() == table(spark, FOLDER, "documents").count()


def test_section_counts_add_up(spark):
    found = QUERIES["op8_token_counts"](spark, FOLDER)
    chars = table(spark, FOLDER, "documents").agg(F.sum(F.char_length("text"))).first()[0]
    assert found.agg(F.sum("n_chars")).first()[0] == chars


def test_url_filter_matches_plain_python(spark):
    pages = [tuple(r) for r in table(spark, FOLDER, "pages").select("page_id", "url").collect()]
    labels = [(r.doc_id, r.quality == 0 or r.toxic == 1) for r in table(spark, FOLDER, "labels").collect()]
    found = QUERIES["op7_url_filter"](spark, FOLDER).select("page_id", "host", "path", "rule", "verdict")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute.judged_urls(pages, labels), key=repr)


@pytest.mark.parametrize("name", ["op2_secret_scan", "op9_license_scan"])
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).count() == 1


def test_pipeline(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        after = {r.doc_id: r for r in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "quality classifier":
            bad = {r.doc_id for r in table(spark, FOLDER, "labels").where("quality = 0").collect()}
            clean = {r.doc_id for r in table(spark, FOLDER, "labels").where("quality = 1").collect()}
            assert len(bad & set(after)) <= 0.1 * len(bad) and len(clean - set(after)) <= 0.02 * len(clean)
        elif name == "line dedup":
            import hashlib

            expected = {i: sha for i, _, _, sha in brute.line_dedup(before)}
            assert {i: hashlib.sha256(r.text.encode()).hexdigest() for i, r in after.items()} == expected
        elif name == "n-gram Jaccard join":
            assert set(after) == {i for i, _, c in brute.near_components(before) if c == i}
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
            assert set(after) == {i for i, _, hit, _ in brute.contaminated(before, items) if not hit}
        else:
            assert set(after) == {i for i, _ in before} and all(r.round_trip for r in after.values())


def test_scores_never_see_labels_of_the_held_out_third(spark):
    documents, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    blind = labels.where(~quality.held_out(F.col("doc_id")))
    assert (quality.train(documents, labels) == quality.train(documents, blind)).all()
