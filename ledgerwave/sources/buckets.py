"""Statement tables laid out by company and year.

A table bucketed by (id_cnpj, dt_year) is read as already dealt by these keys:
joins and aggregations on them, or on finer keys, need no exchange. A bucket holds many
companies' years and one company-year has a few rows, so no bucket grows with a
single company.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

COMPANY_YEAR = ("id_cnpj", "dt_year")


def bucket_count(spark: SparkSession) -> int:
    """Default number of buckets: the partitions of a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_by_bucket(spark: SparkSession) -> None:
    """Let joins on more keys than the bucket keys keep the layout they read.

    Without it Spark deals both sides anew by all join keys. It changes plans only.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def deal(df: DataFrame, keys: Iterable[str] = COMPANY_YEAR, buckets: int | None = None) -> DataFrame:
    """Rows where a bucketed table will have them. Aggregations on ``keys`` or finer
    keys put after this need no exchange of their own."""
    return df.repartition(buckets or bucket_count(df.sparkSession), *keys)


def write_bucketed(
    df: DataFrame, path: str, keys: Iterable[str] = COMPANY_YEAR, buckets: int | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Write a bucketed table, one file per bucket, and return its scan.

    ``dealt`` says that ``df`` comes dealt by ``deal`` with the same keys and number
    of buckets; else its rows are dealt here.
    """
    spark, keys = df.sparkSession, list(keys)
    n = buckets or bucket_count(spark)
    rows = df if dealt else deal(df, keys, n)
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = rows.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(n, *keys).sortBy(*keys).saveAsTable(name)
    join_by_bucket(spark)
    return spark.table(name)


def read_bucketed(
    spark: SparkSession, path: str, schema: StructType, buckets: int, keys: Iterable[str] = COMPANY_YEAR
) -> DataFrame:
    """The scan of a bucketed table that another session wrote. The files know
    their bucket; their number and keys are declared here, as written."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    place = path.replace("'", "\\'")
    spark.sql(
        f"create table {name} ({columns}) using parquet"
        f" clustered by ({by}) sorted by ({by}) into {buckets} buckets location '{place}'"
    )
    join_by_bucket(spark)
    return spark.table(name)
