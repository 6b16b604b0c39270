"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", name: str = "ledgerwave") -> SparkSession:
    """A local session for tests and benchmarks. Clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(max(8, int(cores) if cores.isdigit() else 8)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERWAVE_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local master, where driver and executors are one process, may run
    without ``spark.checkpoint.dir``; it then gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerwave-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_root(spark: SparkSession) -> str:
    """One folder per application, so that ``clear_scratch`` touches no other's."""
    return f"{shared_folder(spark).rstrip('/')}/ledgerwave/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; never reused, so never overwritten."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage is cut,
    its size is known to the planner, and lost executors cost nothing of it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Have the files of finished exchanges deleted now. Spark deletes them when the
    driver collects its garbage, which may be long after the job that made them; events
    of a job that has just ended still hold it at first, hence the second time."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables; for the end of a job."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
