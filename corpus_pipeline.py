"""From raw documents to packed training bins: quality, line dedup, near-duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aislewatch.llm import jaccard, lines, mixing, packing, quality
from aislewatch.llm.shared import small_batches, stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the compression bands accept."""
    small_batches(spark)
    return quality.keep_good(docs)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document or line holds; those with nothing left go."""
    small_batches(spark)
    return lines.dedup_lines(docs, drop_emptied=True)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by four fifths of its five-word shingles."""
    small_batches(spark)
    return jaccard.keep_one(docs, jaccard.Nearness(width=5, percent=80))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def packed_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins."""
    return packing.pack(docs)


STAGES = [
    ("quality", good_documents),
    ("lines", distinct_lines),
    ("near", distinct_documents),
    ("mix", mixed_sources),
    ("pack", packed_bins),
]

#: Compression, SimHash and balanced sampling have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return stored(STAGES[-1][1](spark, docs, sf_dir), f"pipeline-{STAGES[-1][0]}")
