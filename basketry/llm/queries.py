"""Queries that apply the operators, with their defaults, to whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (collocations, decontamination, license_scan, line_dedup, minhash, ngram_join, prefix_trie,
                          quality, secret_scan, sentence_pieces, token_counts, topk_search, url_filter)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_line_dedup(spark, folder):
    found = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped",
                        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def document_path():
    """The tables hold no file paths: a document lies in a folder of its source and language."""
    return F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))


def op2_secret_scan(spark, folder):
    return secret_scan.scan(table(spark, folder, "documents"), document_path())


def op3_quality_classifier(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text", "n_chars")
    scored = quality.score(documents, quality.train(documents, table(spark, folder, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op4_sentence_pieces(spark, folder):
    return sentence_pieces.encode(table(spark, folder, "documents"))


def op5_decontamination(spark, folder):
    found = decontamination.exact_matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op6_topk_search(spark, folder):
    return topk_search.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_url_filter(spark, folder):
    # A page's outcome is the label with its number: bad if of low quality or toxic.
    outcomes = table(spark, folder, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return url_filter.judge(table(spark, folder, "pages").select("page_id", "url"), outcomes).select(
        "page_id", "host", "path", "rule", "verdict")


def op8_token_counts(spark, folder):
    return token_counts.count_tokens(table(spark, folder, "documents"))


def op9_license_scan(spark, folder):
    # Documents have no paths of their own, and a made-up folder holds no licence to inherit.
    return license_scan.scan(table(spark, folder, "documents"))


def op10_ngram_join(spark, folder):
    return ngram_join.similar_components(table(spark, folder, "documents"))


def op11_prefix_trie(spark, folder):
    return prefix_trie.rebuilt_trie(table(spark, folder, "conversations"))


def op12_phrase_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


def op13_minhash_dedup(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"))


QUERIES = {query.__name__: query for query in (
    op1_line_dedup, op2_secret_scan, op3_quality_classifier, op4_sentence_pieces, op5_decontamination,
    op6_topk_search, op7_url_filter, op8_token_counts, op9_license_scan, op10_ngram_join,
    op11_prefix_trie, op12_phrase_collocations, op13_minhash_dedup)}
