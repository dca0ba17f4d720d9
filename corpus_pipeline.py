"""A training-corpus pipeline over ``documents``.

Stages, in order: toxic documents go, one document of each near-duplicate
class stays, documents that hold a benchmark passage go, personal data and
the terms that disclose it are generalised, and what is left is encoded into
SentencePiece ids (with the proof that they decode to the text).  Every stage
but the last returns the columns of ``documents``; stages hand over through
Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide.llm import bag_minhash, disclosure, edit_decontam, toxicity, unigram_pieces
from salestide.llm.common import table
from salestide.llm.queries import tokenizer_path
from salestide.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the factorization machine scores 0.5 or more."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each class of near-duplicates."""
    return bag_minhash.one_per_class(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of ``benchmark``."""
    return edit_decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms generalised or removed in the texts;
    ``n_chars`` follows the text."""
    out = disclosure.sanitise(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType))
    return out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids and round_trip of every document."""
    return unigram_pieces.encode_documents(docs, unigram_pieces.Pieces.load(tokenizer_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("pii", sanitise),
    ("sentencepiece", encode),
]
ORACLE_SQL = None  # a trained model and a tokenizer: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's output is written to the shared
    scratch folder and reread, so a lost executor costs no earlier stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
