"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.llm import byte_bpe, centroids, frames, language_mixture, line_dedup, packing, periodic_runs, pseudonyms, quality, secret_scan, simhash, suffix_dedup, weighted_sampling
from streakline.llm.common import documents


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(documents(spark, sf_dir), length=400)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(documents(spark, sf_dir), shingle=3, distance=3)
    return found.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(documents(spark, sf_dir))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(documents(spark, sf_dir), path="source").drop("row")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.compared_with_edits(documents(spark, sf_dir)).select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op6_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.written_and_read(documents(spark, sf_dir), end=1)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(documents(spark, sf_dir), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymize(documents(spark, sf_dir).select("doc_id", "text"), key="a key for these tables")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), params=packing.PackParams(capacity=2048), end=0)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_bpe.round_trip(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = centroids.cluster(vectors, k=40, rounds=5, dims=64, scale=256, prefix="2:")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroids.centroid_sha256("centroid").alias("centroid_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_repeated_tails(documents(spark, sf_dir).select("doc_id", "text"))
    found = periodic_runs.periodic_runs(docs, exponent=4, least=6, keep=["doc_id"])
    run = periodic_runs.longest("runs")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        run["start"].alias("start"),
        (-run["length"]).alias("length"),
        run["period"].alias("period"),
        F.floor(-1000 * run["length"] / run["period"]).cast("bigint").alias("exponent_milli"),
        F.sha2(periodic_runs.run_lines("runs").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mixture.languages(documents(spark, sf_dir)).drop("languages")


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_simhash": op2_simhash,
    "op3_quality": op3_quality,
    "op4_secrets": op4_secrets,
    "op5_fingerprints": op5_fingerprints,
    "op6_frames": op6_frames,
    "op7_line_dedup": op7_line_dedup,
    "op8_pseudonyms": op8_pseudonyms,
    "op9_packing": op9_packing,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_centroids": op11_centroids,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_language": op13_language,
}
