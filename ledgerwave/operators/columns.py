"""Whole-table column operators: names, stamps, fills, casts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def rename_catalog(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Lower-case all names, then rename by dictionary; absent names are skipped."""
    return lower_names(df).withColumnsRenamed(names)


def stamp_processed_at(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn("processed_at", F.lit(day).cast("date"))


def fill_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna("", subset=columns)


def fill_by_type(df: DataFrame, text: str = "", number: float = 0) -> DataFrame:
    """Nulls of text columns become ``text``; nulls and NaN of numeric columns become
    ``number``. Dates, flags and nested columns stay as they are."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    if numeric:
        df = df.fillna(number, subset=numeric)
    return df.fillna(text, subset=texts) if texts else df


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, all columns in one pass: (column_name, n_null)."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    pairs = [x for c in df.columns for x in (F.lit(c), F.col(f"`{c}`"))]
    return counts.select(F.stack(F.lit(len(df.columns)), *pairs).alias("column_name", "n_null"))
