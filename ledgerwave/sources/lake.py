"""Scans and sinks of the three-layer lake."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerwave.operators.quarters import dedupe_subset
from ledgerwave.session import stored

CORRUPT = "_corrupt_record"

# How the published files of each statement kind are named.
FILE_STEM = {
    "fca_aberta_geral": "fca_cia_aberta_geral",
    "fca_valor_mobiliario": "fca_cia_aberta_valor_mobiliario",
    "itr_dre": "itr_cia_aberta_DRE_con",
    "itr_bpa": "itr_cia_aberta_BPA_con",
    "itr_bpp": "itr_cia_aberta_BPP_con",
    "itr_dfc": "itr_cia_aberta_DFC_MI_con",
    "itr_dfc_table": "itr_cia_aberta_DFC_MI_con",
    "dfp_dre": "dfp_cia_aberta_DRE_con",
    "dfp_bpa": "dfp_cia_aberta_BPA_con",
    "dfp_bpp": "dfp_cia_aberta_BPP_con",
    "dfp_dfc": "dfp_cia_aberta_DFC_MI_con",
}


def text_schema(names: Iterable[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def scan_delimited(
    spark: SparkSession, path: str | list[str], schema: StructType, keep_corrupt: bool = False
) -> DataFrame:
    """Semicolon-separated Latin-1 text with a header, read in one pass.

    Columns are bound by position. Rows that do not parse are kept with nulls;
    ``keep_corrupt`` adds the raw text of such rows as one more column.
    """
    if keep_corrupt:
        schema = StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ";")
        .option("encoding", "ISO-8859-1")
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", True)
    )
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path)


def scan_with_quarantine(
    spark: SparkSession, path: str | list[str], schema: StructType, out: str
) -> tuple[DataFrame, DataFrame]:
    """Rows that parse and, apart from them, rows that do not: both outputs are
    written by one scan of the text.

    The first has the columns of ``schema``; the second the raw text of a row and the
    name of its file. A row is set apart when it has too few or too many fields or a field
    that does not fit its type.
    """
    df = scan_delimited(spark, path, schema, keep_corrupt=True)
    kept = StructType([*schema.fields, StructField(CORRUPT, StringType()), StructField("file_name", StringType())])
    marked = df.withColumn("file_name", F.col("_metadata.file_name"))
    marked.withColumn("is_corrupt", F.col(CORRUPT).isNotNull()).write.partitionBy("is_corrupt").parquet(out)
    good = read_existing(spark, f"{out}/is_corrupt=false", kept).select(*schema.names)
    return good, read_existing(spark, f"{out}/is_corrupt=true", kept).select(CORRUPT, "file_name")


def scan_delimited_text(
    spark: SparkSession, path: str | list[str], names: list[str] | None = None
) -> DataFrame:
    """The same with every column as text. Without ``names`` the header names
    the columns; either way nothing is inferred from the rows."""
    if names is not None:
        return scan_delimited(spark, path, text_schema(names))
    reader = spark.read.option("header", True).option("sep", ";")
    return reader.option("encoding", "ISO-8859-1").option("inferSchema", False).csv(path)


def with_file_year(df: DataFrame) -> DataFrame:
    """Year at the end of the source file's name (or of its table folder)."""
    path = F.col("_metadata.file_path")
    year = F.regexp_extract(path, r"[_=](\d{4})(?:\.\w+)?(?:/[^/]+)?$", 1)
    return df.withColumn("dt_file_year", year.try_cast("int"))


def raw_file_glob(folder: str, data_type: str, years: Iterable[int]) -> str:
    """One glob for a statement kind over some years: files are pruned at listing."""
    return f"{folder}/{FILE_STEM[data_type]}*{{{','.join(str(y) for y in years)}}}.csv"


def year_manifest(kinds: list[str], years: Iterable[int]) -> dict[str, list[str]]:
    """Per kind, the names of its yearly tables."""
    years = list(years)
    return {kind: [f"pp_{kind}_{y}.parquet" for y in years] for kind in kinds}


def read_existing(
    spark: SparkSession, path: str, schema: StructType
) -> DataFrame:
    """A parquet read that is empty and typed when nothing is there yet. Any
    other error surfaces."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_years(
    spark: SparkSession, table: str, years: Iterable[int], schema: StructType, by: str = "dt_year"
) -> DataFrame:
    """Some years of a table partitioned by ``by``; absent years are absent."""
    df = read_existing(spark, table, schema)
    if by not in df.columns:  # nothing is there yet
        df = df.withColumn(by, F.lit(None).cast("int"))
    df = df.filter(F.col(by).isin(list(years)))
    return df if by in schema.names else df.drop(by)


def scan_yearly_files(
    spark: SparkSession, folder: str, kind: str, years: Iterable[int], schema: StructType
) -> DataFrame:
    """The same for one table per year, all existing years in one scan."""
    names = ",".join(year_manifest([kind], years)[kind])
    return read_existing(spark, f"{folder}/{{{names}}}", schema)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    skip_empty: bool = False,
) -> bool:
    """Parquet sink. With partition columns only the partitions present in
    ``df`` are replaced. Returns whether anything was written.

    ``rebalance`` lets the adaptive planner size the output files: a partition
    value that holds most of the rows is written by several tasks.
    """
    if skip_empty and df.isEmpty():
        return False
    partition_by = partition_by or []
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)
    return True


# Days of a batch that are listed one by one in a partition filter; a batch with
# more of them is bounded by its first and last day.
LISTED_DAYS = 400


def merge_new_rows(
    batch: DataFrame, target: str, keys: list[str], day: str, schema: StructType
) -> None:
    """Append the rows of a batch whose keys the target does not hold yet.

    Rows already stored stay. Of rows that repeat the keys one is kept. The
    anti-join makes a repeated batch (a retry, a second delivery, a lost
    checkpoint) add nothing, with no state to keep and no row ever too late.
    ``day`` is the partition column and one of the keys: the batch is stored
    once, and only partitions of its days are scanned.
    """
    fresh = stored(dedupe_subset(batch, keys), "batch")
    days = fresh.select(day).distinct()
    named = [r[0] for r in days.limit(LISTED_DAYS + 1).collect()]
    if not named:
        return
    known = [d for d in named if d is not None]
    if len(named) <= LISTED_DAYS:
        touched = F.col(day).isin(known) if known else F.lit(False)
    else:
        low, high = days.agg(F.min(day), F.max(day)).first()
        touched = F.col(day).between(F.lit(low), F.lit(high))
    if None in named or len(named) > LISTED_DAYS:
        touched = touched | F.col(day).isNull()
    held = read_existing(batch.sparkSession, target, schema).filter(touched).select(*keys)
    same = F.lit(True)
    for k in keys:
        same = same & fresh[k].eqNullSafe(held[k])
    (
        fresh.join(held, same, "left_anti")
        .hint("rebalance", F.col(day))
        .write.mode("append").partitionBy(day).parquet(target)
    )


PRICE_KEYS = ("id_cnpj", "id_ticker")


def append_days(
    days: DataFrame, path: str, day: str = "dt_date", keys: Iterable[str] = PRICE_KEYS
) -> None:
    """Append a file of prices to a day-partitioned table. Rows of other
    companies and tickers already stored for a day stay, and running the same
    file again changes nothing."""
    merge_new_rows(days, path, [day, *keys], day, days.schema)
