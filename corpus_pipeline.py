"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns the
columns of documents; the last returns the pieces of the packed sequences.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import line_dedup, mil_quality, ngram_join, packing, secret_scan
from tidelog.sources.scratch import durable

LEAST_QUALITY = 0.3
TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least LEAST_QUALITY stay; the model is learned from the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = mil_quality.train(docs, labels)
    return mil_quality.score(docs, model).where(F.col("score") >= LEAST_QUALITY).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; every document stays."""
    cleaned = line_dedup.drop_boilerplate(docs)
    return _measured(cleaned.drop("lines_dropped")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word Jaccard 0.8 the one with the smallest id stays.

    Documents without an id or without words are in no group and stay; rows that repeat an id
    are one document and leave one row.
    """
    groups = ngram_join.similar_classes(docs, n=5, threshold="0.8")
    counted = groups.where("doc_id IS NOT NULL").groupBy("doc_id")
    found = durable(
        counted.agg(F.min("component_id").alias("first"), F.count(F.lit(1)).alias("rows")).where(
            "doc_id <> first OR rows > 1"
        )
    )
    # Written out: what goes is broadcast if that is known to be small, and texts stay put.
    kept = docs.join(found.select("doc_id"), "doc_id", "left_anti")
    again = docs.join(found.where("doc_id = first").select("doc_id"), "doc_id", "left_semi")
    return kept.union(again.dropDuplicates(["doc_id"])).select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked, in plain text and behind encodings; every document stays."""
    return _measured(secret_scan.redact(docs)).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 2048 tokens."""
    path = public_tokenizers.path(TOKENIZER)
    return packing.pack(packing.cut_documents(docs, path, with_ids=False))


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars as it is after a change of the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packed", packed),
]

#: Tokenising and the learned model are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written out and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
