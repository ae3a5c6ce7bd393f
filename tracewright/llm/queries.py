"""One query per document operator, over its whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import decontam, langid, negatives, neighbours, packing, quality, sharding, simhash, simple8b, spotsigs, transcripts, warc, whitening
from tracewright.llm.common import bound_batches, fold, stored, text_rows
from tracewright.llm.vectors import quantised, usable

QueryFn = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprints of all documents and of their edited texts, with their likenesses."""
    return spotsigs.neighbour_fingerprints(table(spark, sf_dir, "documents"))


def packing_digest(docs: DataFrame) -> DataFrame:
    """Places of all pieces in sequences of 2048 ids, with a checksum of each piece's ids."""
    pieces = packing.token_pieces(docs, capacity=2048, end_id=0)
    digests = stored(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "packing-pieces")
    placed = packing.pack(digests, capacity=2048)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids packed into as few sequences of 2048 as the genetic search finds."""
    return packing_digest(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where benchmark items occur in documents within their edit budgets, a row for each document and item (window)."""
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components over four-word shingles, linked at 4 or fewer differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by subword embeddings, learned from labels outside the held-out fold."""
    model = quality_model(spark, sf_dir)
    docs = text_rows(table(spark, sf_dir, "documents"))
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    score = quality.scored(F.col("text"), model)
    found = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return found.withColumn("predicted", (F.col("score") >= QUALITY_FLOOR).cast("int"))


#: Score from which a document counts as good.
QUALITY_FLOOR = 0.7


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    docs = text_rows(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long"), F.col("quality").alias("label"))
    return quality.fit(docs, labels.where(fold("doc_id", 4) != 2), quality.Settings(pairs=True))


def language_profiles(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return langid.learn_profiles(docs.where(fold("doc_id", 3) != 1))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by rank-order profiles, learned from texts outside the held-out fold."""
    docs = text_rows(table(spark, sf_dir, "documents"))
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    found = langid.predicted(F.col("text"), language_profiles(spark, sf_dir))
    rows = docs.select("doc_id", held_out.alias("held_out"), found.alias("found"))
    return rows.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written to Simple-8b files in id order and read back."""
    found = simple8b.round_trip(table(spark, sf_dir, "documents"), end_id=1)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, repeated payloads as revisits, and read back."""
    found = warc.round_trip(table(spark, sf_dir, "pages"), min_revisit_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jump consistent hashing of all documents into 16 shards, with their place after one more shard."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles and turns of all conversations, written as raw transcripts, recovered and rendered line by line.

    The model is learned from the conversations whose crc32(conv_id as text) mod 4 is not 2.
    """
    raw = stored(transcripts.raw_lines(table(spark, sf_dir, "conversations")), "transcript-lines")
    lines = transcripts.numbered(raw)
    model = transcripts.fit(lines.where(fold("conv", 4) != 2))
    found = transcripts.rendered(transcripts.decode(lines, model))
    held_out = F.coalesce(fold("conv", 4) == 2, F.lit(False))
    return found.select(
        F.col("conv").cast("long").alias("conv_id"),
        "turn",
        "line",
        held_out.alias("held_out"),
        F.col("role").alias("role_pred"),
        F.col("first").alias("begins_turn"),
        "piece",
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their first eight principal components, scaled to unit variance."""
    rows = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    found = whitening.whitened(rows.select("id", quantised("vec", 1024, 100_000).alias("x")), components=8)
    return found.withColumnRenamed("id", "vec_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding among all, by exact integer scores; every seventh label is moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    rows = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", {"label": moved})
    return negatives.hard_negatives(rows.select("id", "label", quantised("vec", 256).alias("x")), F.col("id") % 50 == 0)


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth embedding among all."""
    return neighbours.neighbours(usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), F.col("id") % 100 == 0)


QUERIES: dict[str, QueryFn] = {
    "op1_spotsigs": op1_spotsigs,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_simhash": op4_simhash,
    "op5_quality": op5_quality,
    "op6_language": op6_language,
    "op7_token_ids": op7_token_ids,
    "op8_warc": op8_warc,
    "op9_sharding": op9_sharding,
    "op10_chat": op10_chat,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_neighbours": op13_neighbours,
}

ORACLE: dict[str, str] = {
    "op8_warc": """
        WITH sums AS (SELECT CAST(page_id AS BIGINT) AS page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
        fives AS (SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || substr(hex, CAST(i * 5 + 1 AS INTEGER), 5) AS BIGINT)) AS parts,
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS letters FROM sums),
        digests AS (
            SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY hex) AS first,
                   array_to_string(list_transform(parts, lambda v: letters[1 + (v >> 15) % 32] || letters[1 + (v >> 10) % 32]
                       || letters[1 + (v >> 5) % 32] || letters[1 + v % 32]), '') AS payload_digest
            FROM fives
        )
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM digests
    """,
    "op12_hard_negatives": """
        WITH whole AS (
            SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), score AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   CAST(list_inner_product(a.q, b.q) AS BIGINT) AS s
            FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ), positive AS (
            SELECT anchor_id, other_id AS positive_id, s AS positive_score FROM score WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.s DESC, n.other_id) AS INTEGER) AS rank,
               n.other_id AS negative_id, p.positive_score, n.s AS negative_score
        FROM positive p JOIN score n ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 50 * p.positive_score <= 100 * n.s AND 100 * n.s <= 95 * p.positive_score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.s DESC, n.other_id) <= 3
    """,
}
