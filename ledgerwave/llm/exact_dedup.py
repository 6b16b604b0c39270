"""Exact duplicates, with heavy hitters taken out of the shuffle.

Every text is digested once. A Misra-Gries summary of the digests (bounded, and
merged from partial summaries) names the frequent ones; their true counts and
winners are then found by a map-side combined aggregation and broadcast, so the
rows of a large group of copies are decided where they lie. All other digests
take the ordinary shuffle, and no group among them is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerwave.llm.common import SPACES
from ledgerwave.session import stored

# Bounds of the summary: frequent digests kept, and counters held for them. A
# digest with more than rows / COUNTERS copies cannot be missed.
HEAVY = 1_000
COUNTERS = 10_000


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _first(doc_id: str = "doc_id", row: str = "row") -> Column:
    """Orders copies: smallest doc_id, ids before nulls, then one fixed row."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(row).alias("row"))


def heavy_digests(rows: DataFrame, heavy: int = HEAVY, counters: int = COUNTERS) -> DataFrame:
    """At most ``heavy`` digests that the summary holds for frequent."""
    top = rows.agg(F.expr(f"approx_top_k(digest, {heavy}, {counters})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("digest"))


def exact_duplicates(docs: DataFrame, heavy: int = HEAVY, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size,
    kept, text_sha256.

    Texts are equal when they agree after each run of ASCII white space becomes
    one space. Null text counts as empty, and empty texts equal each other. The
    smallest doc_id of a group stays, ids before null ids; of rows that repeat
    that doc_id exactly one stays. Without rows the result is empty. Other
    columns are not read.
    """
    rows = stored(
        docs.select(
            "doc_id",
            F.sha2(normalized(F.col("text")), 256).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    winners = stored(
        rows.join(F.broadcast(heavy_digests(rows, heavy, counters)), "digest")
        .groupBy("digest")
        .agg(F.min(_first()).alias("won"), F.count("*").alias("group_size"))
        .where("group_size > 1"),
        "winners",
    )
    # At most ``heavy`` rows.
    decided = rows.join(F.broadcast(winners), "digest", "left")
    hot = decided.where("won is not null")
    group = Window.partitionBy("digest")
    rest = decided.where("won is null").select(
        "digest",
        "doc_id",
        "row",
        F.min(_first()).over(group).alias("won"),
        F.count("*").over(group).alias("group_size"),
    )
    return hot.select(rest.columns).unionByName(rest).select(
        "doc_id",
        F.col("won.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("won.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


OP5_SQL = r"""
with d as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
  from documents)
select doc_id,
  first_value(doc_id) over (partition by text_sha256 order by doc_id nulls last) as keep_id,
  count(*) over (partition by text_sha256) as group_size,
  row_number() over (partition by text_sha256 order by doc_id nulls last) = 1 as kept,
  text_sha256
from d
"""
