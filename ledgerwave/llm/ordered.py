"""Ranks and running sums of a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerwave.session import stored


def with_running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Add, per name, the sum of its column over all rows that come before a row.

    Rows are dealt out by range; sums run inside each range, and the totals of
    earlier ranges (one row per partition, whatever the table's size) are added.
    ``order`` must tell rows apart.
    """
    ranged = stored(
        df.withColumns(sums).repartitionByRange(*order).withColumn("range_", F.spark_partition_id()),
        "ranged",
    )
    inside = Window.partitionBy("range_").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("range_").agg(*[F.sum(n).alias(n) for n in sums]).select(
        "range_", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in sums]
    )
    held = ranged.withColumns({n: F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in sums})
    return (
        held.join(F.broadcast(offsets), "range_")
        .withColumns({n: F.col(n) + F.col(f"{n}_before") for n in sums})
        .drop("range_", *[f"{n}_before" for n in sums])
    )
