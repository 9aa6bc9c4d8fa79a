"""Registered queries of the training-data operators, over whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floorlens.llm import (
    arc, byte_bpe, crf, curve_clusters, flat_graph, interleave, lsh_forest, packing, piece_bpe, ppm, prefix_trie, quality, sql, url_rules,
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def byte_bpe_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(byte_bpe.RANKS)
    rows = byte_bpe.decode(byte_bpe.encode(_read(spark, sf_dir, "documents"), path), path)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(byte_bpe.ids_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.packed(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return rows.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = arc.convert(arc.write_arc(_read(spark, sf_dir, "pages")))
    return arc.parse_warc(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_read(spark, sf_dir, "documents")).select(
        "doc_id", *[m for m in quality.MEASURES if m != "n_lines"], "base_failed", "kept", "fails"
    )


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_read(spark, sf_dir, "pages"), _read(spark, sf_dir, "labels")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def mixture_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave.interleaved(_read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def partial_matching_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    training = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    rows = ppm.scored(_read(spark, sf_dir, "documents"), training)
    return rows.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def word_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    field = crf.fit(docs, ~held_out)
    return crf.predict(docs, field).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def near_duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(_read(spark, sf_dir, "documents"), width=4)


def near_duplicate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_graph.near_duplicates(_read(spark, sf_dir, "embeddings"))


def sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(piece_bpe.MODEL)
    rows = piece_bpe.decode(piece_bpe.encode(_read(spark, sf_dir, "documents"), path), path)
    return rows.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curve_clusters.with_inertia(*curve_clusters.clustered(_read(spark, sf_dir, "embeddings")))
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def conversation_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.placed(prefix_trie.turn_ids(_read(spark, sf_dir, "conversations")))
    return prefix_trie.trie(*prefix_trie.rebuilt(turns)).drop("k1", "k2", "q1", "q2")


LLM_QUERIES = {
    "op1_byte_bpe": byte_bpe_codes,
    "op2_packing": packed_sequences,
    "op3_arc_to_warc": arc_to_warc,
    "op4_quality_rules": quality_ledger,
    "op5_url_filter": url_verdicts,
    "op6_language_id": word_languages,
    "op7_embedding_dedup": near_duplicate_vectors,
    "op8_sharding": mixture_shards,
    "op9_minhash_dedup": near_duplicate_documents,
    "op10_lm_scores": partial_matching_scores,
    "op11_sentencepiece": sentence_pieces,
    "op12_centroid_clusters": centroid_clusters,
    "op13_prefix_trie": conversation_prefixes,
}

LLM_SQL = {
    "op3_arc_to_warc": sql.PAGES,
    "op4_quality_rules": sql.QUALITY,
    "op8_sharding": sql.SHARDED,
    "op12_centroid_clusters": sql.CLUSTERED,
    "op13_prefix_trie": sql.PREFIXES,
}
