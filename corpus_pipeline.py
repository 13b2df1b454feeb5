"""A corpus pipeline: five stages, each a written table that the next one reads.

Every stage but the last returns the columns of documents. A stage drops what it is there to
drop, or changes the text, and leaves everything else as it was.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import decontamination, line_dedup, ngram_join, quality, sentence_pieces
from basketry.session import work_folder


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, trained on the labels of ``sf_dir``, rejects."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that three documents or more share from all but the last of them."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: the one with the smallest id."""
    return ngram_join.keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark phrase."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentence_piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every text that is left."""
    return sentence_pieces.encode(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentence_piece_encoding),
]
# Fitted scores, hashed components and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{work_folder(spark)}/stage-{number}-{uuid.uuid4().hex[:8]}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
