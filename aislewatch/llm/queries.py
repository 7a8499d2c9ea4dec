"""One query per operator, over its whole table, and the pipeline."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from aislewatch.llm import (
    centroids,
    chat,
    jaccard,
    licences,
    lines,
    mixing,
    negatives,
    packing,
    quality,
    sketches,
    suffix_model,
    token_files,
    toxicity,
)
from aislewatch.llm.shared import scratch_folder, small_batches

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    LLM_QUERIES[fn.__name__] = fn
    return fn


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")


@_query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, compared."""
    return sketches.compare_with_edited(_documents(spark, sf_dir))


@_query
def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and near-duplicate component of each document: three words, nine tenths in common."""
    return jaccard.near_components(_documents(spark, sf_dir), jaccard.Nearness(width=3, percent=90))


@_query
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one full of control strings, read back from their formatted text."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.digest_conversations(chat.read_conversations(chat.format_conversations(turns.union(extra))))


@_query
def op4_suffix_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those whose crc32(doc_id) mod 5 is not 1."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    model = suffix_model.train(docs.filter(~held_out))
    scored = suffix_model.score(docs.withColumn("held_out", held_out), model, ["doc_id", "held_out"])
    return scored.withColumn("train_tokens", F.lit(model.train_tokens).cast("bigint"))


@_query
def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of all documents."""
    return packing.pack(_documents(spark, sf_dir))


@_query
def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated lines."""
    return lines.dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"))


@_query
def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of all documents."""
    found = licences.scan_licences(_documents(spark, sf_dir).select("doc_id", "text"))
    matches = F.col("licences.matches")
    base = F.filter(matches, lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    labels = lambda some: F.array_join(F.array_sort(F.array_distinct(F.transform(some, lambda m: m["label"]))), ",")
    return found.select(
        "doc_id",
        "licences.n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(matches).alias("labels"),
        F.coalesce(F.array_max(F.transform(matches, lambda m: m["coverage"])), F.lit(0.0)).alias("score"),
    )


@_query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as ORC and read back: place, number and checksum of each document's."""
    path = f"{scratch_folder(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_token_files(_documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    read = token_files.read_token_files(spark, path)
    tokens = F.size("ids").cast("bigint").alias("n_tokens")
    return read.select("doc_id", "start", tokens, token_files.ids_crc32("ids").alias("ids_crc32"))


@_query
def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    plan = mixing.mix_plan(_documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@_query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, compression ratios and verdict of each document."""
    judged = quality.with_quality(_documents(spark, sf_dir).select("doc_id", "text"), "q")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *[f"q.{n}" for n in names], "q.whole_ratio", "q.reason")


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, against all vectors."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(vectors, moved, F.col("vec_id") % 50 == 0)


LLM_ORACLES["op11_hard_negatives"] = negatives.ORACLE_SQL


@_query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from labels of those whose crc32(doc_id) mod 5 is not 0."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").filter(~held_out)
    model = toxicity.train(docs.filter(~held_out), labels)
    return toxicity.score(docs.withColumn("held_out", held_out), model, ["doc_id", "held_out"])


@_query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors after three rounds over 16 centroids."""
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


LLM_ORACLES["op13_centroids"] = centroids.oracle_sql()


LLM_QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
