"""Table sources and sinks with explicit schemas and partitioning."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The frame over as many tasks as there are cores, where a scan of few row groups gives less; a large scan stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def write_decisions(df: DataFrame, path: str) -> None:
    """Partitioned by language, risk tier and month of validity; rows of a partition meet before they are written."""
    own = df.withColumn("valid_month", F.date_format(F.timestamp_seconds("valid_from"), "yyyy-MM"))
    own.repartition("lang", "risk_tier", "valid_month").write.mode("append").partitionBy("lang", "risk_tier", "valid_month").parquet(path)


def evolved(df: DataFrame, renamed: dict[str, str], added: dict[str, str]) -> DataFrame:
    """Renames old columns and adds missing optional ones."""
    for old, new in renamed.items():
        df = df.withColumn(new, F.coalesce(new, old)).drop(old) if new in df.columns and old in df.columns else df.withColumnRenamed(old, new)
    return df.withColumns({c: F.lit(None).cast(t) for c, t in added.items() if c not in df.columns})


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is configured, a temporary one, which only a local master can use."""
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = os.path.join(tempfile.gettempdir(), "gristmill-checkpoints")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def stored(df: DataFrame) -> DataFrame:
    """The frame written as Parquet to the shared folder and read again (columns stay prunable). The table goes when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    files, place = _files(spark, path)
    files.deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it names it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def dropped(df: DataFrame) -> None:
    """Deletes the table of a stored frame before the driver ends; nothing may read it, or be worked out from it, after that."""
    for file in df.inputFiles()[:1]:
        files, place = _files(df.sparkSession, file.rpartition("/")[0])
        files.delete(place, True)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query are dropped when the query has ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
