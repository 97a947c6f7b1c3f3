"""The training-data pipeline: stages that each call one operator of ``tidemark.llm``.

Every stage takes the rows its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import chunk_dedup, decontamination, language_id, near_words, sentence_pieces
from tidemark.llm.common import read
from tidemark.llm.queries import tokenizer
from tidemark.session import shared_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops null texts and texts without a letter, which have no language (``und``), and nothing else.

    Neither which language it is nor its score decides about a document. Where no row has a label, no language can be
    learnt and every prediction is ``und``; texts with a letter stay then too.
    """
    model = language_id.trained(docs)
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    named = language_id.identify(docs, model)
    return named.where("lang_pred <> 'und'").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of texts whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    return near_words.kept(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts runs of chunks that a document of smaller id has; every document stays, with what is left of its text."""
    left = chunk_dedup.without_repeats(docs).withColumn("text", F.when(F.col("text").isNull(), None).otherwise(F.decode("kept", "UTF-8")))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes each text and decodes it again: doc_id, n_tokens and digests of ids and decoded text."""
    model = tokenizer("piece_bpe_32k.model")
    ids = sentence_pieces.encode(docs.select("doc_id", "text"), model).select("doc_id", "ids")
    return sentence_pieces.digests(sentence_pieces.decode(ids, model))


STAGES = [
    ("language ID", language),
    ("five-word near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("sentence pieces", pieces),
]

#: Near-duplicate groups, digests of ids and a fitted classifier have no SQL form; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over ``documents``, each written as Parquet to the shared folder and read again by the next."""
    folder = f"{shared_folder(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
