"""The corpus operators over the given tables, with their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerwave.llm import (
    collocations, decontamination, exact_dedup, hard_negatives, license_scan, line_dedup, mixing, packing, pii,
    secrets, sketch_join, substring_dedup, toxicity,
)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(
        documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet")
    )
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.op2_columns(secrets.secret_spans(documents(spark, folder)))


def op3_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(documents(spark, folder))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return sketch_join.jaccard_components(documents(spark, folder))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, folder))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup.deduplicate_lines(documents(spark, folder))
    return done.select("doc_id", "n_lines", F.size("gone").cast("long").alias("n_removed"), "text")


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_labels(documents(spark, folder))


def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).drop("source")


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.op9_columns(pii.personal_data(documents(spark, folder)))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.op10_columns(
        documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    )


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(documents(spark, folder))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(documents(spark, folder))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(spark.read.parquet(f"{folder}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_secrets": op2_secrets,
    "op3_repeated_passages": op3_repeated_passages,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_licenses": op7_licenses,
    "op8_mix_sources": op8_mix_sources,
    "op9_personal_data": op9_personal_data,
    "op10_toxicity": op10_toxicity,
    "op11_packing": op11_packing,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": decontamination.OP1_SQL,
    "op2_secrets": secrets.op2_sql(),
    "op4_jaccard_join": sketch_join.OP4_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op6_line_dedup": line_dedup.OP6_SQL,
    "op8_mix_sources": mixing.OP8_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
