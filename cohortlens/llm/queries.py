"""The registered queries of this subpackage: each applies its operator to
its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import centroid_search, fingerprints, jaccard_join, knn_quality, license_scan, maxent_lm, packing, quality_rules, sentencepiece_codec, sharding, source_divergence, token_counts, warc
from cohortlens.llm.common import documents, tokenizer_path


def op1_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.judge(documents(spark, d), documents(spark, d, "labels"))


def op2_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, d), tokenizer_path("byte_bpe_50k.json"), limit=1024)


def op3_maxent_lm(spark: SparkSession, d: str) -> DataFrame:
    return maxent_lm.score(documents(spark, d))


def op4_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard(documents(spark, d), shards=8)


def op5_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return license_scan.scan(documents(spark, d))


def op6_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(documents(spark, d), tokenizer_path("word_bpe_49k.json"))


def op7_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_join.link_components(documents(spark, d), n=3, percent=90)


def op8_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.fingerprint_edits(documents(spark, d))


def op9_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return knn_quality.classify(documents(spark, d), documents(spark, d, "labels"))


def op10_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    coded = sentencepiece_codec.round_trip(documents(spark, d), tokenizer_path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op11_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    return source_divergence.audit(documents(spark, d), least=10, top=10)


def op12_warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.round_trip(documents(spark, d, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_centroid_clusters(spark: SparkSession, d: str) -> DataFrame:
    return centroid_search.cluster(documents(spark, d, "embeddings"), clusters=16, rounds=3)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op3_maxent_lm": op3_maxent_lm,
    "op4_sharding": op4_sharding,
    "op5_license_scan": op5_license_scan,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_fingerprints": op8_fingerprints,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_source_divergence": op11_source_divergence,
    "op12_warc": op12_warc,
    "op13_centroid_clusters": op13_centroid_clusters,
}
