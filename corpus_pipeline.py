"""Cleaning a corpus in five stages, each over all that the one before kept.

toxicity, line_dedup, jaccard_join, decontaminate, mix. All stages but the last
return the columns of ``documents``; the last adds how many words the mix takes
from each document. ``run`` writes every stage to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerwave.llm import decontamination, line_dedup, mixing, sketch_join, toxicity
from ledgerwave.llm.common import maybe_broadcast, text_key
from ledgerwave.session import stored


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id and text hash are not in ``gone`` (id_, key_)."""
    g = maybe_broadcast(stored(gone, "gone"))
    same = docs["doc_id"].eqNullSafe(g["id_"]) & text_key(docs["text"]).eqNullSafe(g["key_"])
    return docs.join(g, same, "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels.where(toxicity.fold() != 2))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of passages; those of which nothing
    is left go. ``n_chars`` follows the text."""
    names = ("lines_of_", "lines_gone_")
    done = line_dedup.deduplicate_lines(docs, names=names)
    gone = F.size(names[1])
    left = done.where((gone == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn(
            "n_chars", F.when(gone == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind))
        )
    return left.select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by n-gram similarity, the one with the smallest
    doc_id; of rows that repeat a doc_id, one. Rows without doc_id stay."""
    groups = stored(sketch_join.jaccard_components(docs), "components").where("doc_id is not null")
    members = stored(groups.where("doc_id != component_id").select("doc_id").distinct(), "members")
    kept = docs.join(maybe_broadcast(members), "doc_id", "left_anti").select(docs.columns)
    again = stored(groups.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "again")
    single = kept.join(maybe_broadcast(again), "doc_id", "left_anti").select(docs.columns)
    # Of rows that repeat a doc_id the smallest by text; the row travels as one column.
    order = Window.partitionBy("doc_").orderBy("key_")
    repeated = kept.join(maybe_broadcast(again), "doc_id", "left_semi").select(
        F.struct(*docs.columns).alias("row_"), F.col("doc_id").alias("doc_"), text_key(F.col("text")).alias("key_")
    ).withColumn("turn_", F.row_number().over(order))
    return single.unionByName(repeated.where("turn_ = 1").select("row_.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    hits = decontamination.hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, hits.select(F.col("doc_id").alias("id_"), F.col("key").alias("key_")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes words, with size, source_size, target
    and taken (words, repeats counted). Copies that agree in doc_id and text get
    their mean, rounded up."""
    taken = mixing.mix(docs, keyed=True).where("taken > 0")
    per_doc = taken.groupBy(F.col("doc_id").alias("id_"), F.col("text_key").alias("of_")).agg(
        F.first("size").alias("size"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"), F.ceil(F.avg("taken")).cast("long").alias("taken"),
    )
    new = ["size", "source_size", "target", "taken"]
    keep = [c for c in docs.columns if c not in new]
    # The row travels as one column, so no name of its own can clash.
    left = docs.select(
        F.struct(*keep).alias("row_"), F.col("doc_id").alias("doc_"), F.xxhash64("text").alias("key_")
    )
    met = left.join(
        per_doc, F.col("doc_").eqNullSafe(F.col("id_")) & F.col("key_").eqNullSafe(F.col("of_"))
    )
    return met.select("row_.*", *new)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_each_group),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
]

# The classifier of the first stage has no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
