"""A corpus pipeline of five document operators, each stage over what the one before it kept."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import decontam, langid, quality, queries, simhash
from tracewright.llm.common import stored

StageFn = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no learned language is found go: those without a letter, and those whose score is below the floor.

    Profiles are those of the language query; the floor is that of the scores of the labelled documents outside its held-out fold.
    """
    found = langid.predicted(F.col("text"), queries.language_profiles(spark, sf_dir))
    # columns of documents go as one value, so that none of them can clash
    scored = stored(docs.select(F.struct("*").alias("row"), found.alias("found")), "pipeline-language-scores")
    known = F.col("found.lang_pred") != langid.UNKNOWN
    key = F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 3
    training = scored.where(known & F.col("row.lang").isNotNull() & (key != 1))
    floor = langid.score_floor(training.select("found.score"))
    return scored.where(known & (F.col("found.score") >= floor)).select("row.*")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score below 0.7 go; the model is that of the quality query."""
    return docs.where(quality.scored(F.col("text"), queries.quality_model(spark, sf_dir)) >= queries.QUALITY_FLOOR)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each component stays, the one with the smallest id."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget go."""
    benchmark = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    return decontam.without_matches(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' ids packed into sequences; a row for each piece."""
    return queries.packing_digest(docs)


STAGES: list[tuple[str, StageFn]] = [
    ("language_id", language),
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("best_fit_packing", packed),
]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again by the next."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
