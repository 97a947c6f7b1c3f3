"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import byte_bpe, chunk_dedup, cuts, decontamination, embedding_dedup, heap_clusters, katz, language_id, licenses, sentence_pieces, simhash, spelling, suffix_dedup, token_files
from tidemark.llm.common import read
from tidemark.plans.registry import Query
from tidemark.session import shared_folder

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn
    return wrap


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_sentence_pieces")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer("piece_bpe_32k.model")
    ids = sentence_pieces.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), model).select("doc_id", "ids")
    return sentence_pieces.digests(sentence_pieces.decode(ids, model))


@query("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/llm/tokens-{uuid.uuid4().hex}"
    token_files.write(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), path, end=1)
    return token_files.read_documents(spark, path)


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language_id.trained(docs.where(~language_id.held_out()))
    return (language_id.identify(docs.select("doc_id", "text"), model)
            .select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score")))


@query("op3_simhash_groups")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.components(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


@query("op1_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    leaks = decontamination.with_leaks(docs, read(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query("op10_chunk_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuts.digests(chunk_dedup.without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op2_license_scan", licenses.check_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "sentence_ids", "licenses")


@query("op7_embedding_groups")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.groups(read(spark, sf_dir, "embeddings"))


@query("op5_katz_scores")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return katz.scores(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuts.digests(suffix_dedup.without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op11_heap_clusters")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heap_clusters.clusters(read(spark, sf_dir, "embeddings"), clusters=40, rounds=5)


@query("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


@query("op13_byte_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = tokenizer("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN).select("doc_id", "ids")
    return byte_bpe.digests(byte_bpe.decode(ids, ranks))
