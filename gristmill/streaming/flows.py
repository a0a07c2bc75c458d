"""Structured Streaming flows: idempotent sinks for decisions, admissions and poison records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from gristmill.operators.serving import RECIPE, upsert_smallest_trace


def decoded(raw: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """JSON records with the schema's fields; undecodable ones keep their text in `_corrupt_record`."""
    kinds = StructType(list(schema.fields)).add("_corrupt_record", StringType())
    return raw.select(F.from_json(F.col(column), kinds, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"), F.col(column).alias("raw_")).select("r.*", "raw_")


def upsert_sink(spark: SparkSession, path: str, dead: str):
    """foreachBatch: poison records to their own table, the rest upserted; replaying a batch changes nothing.

    Each batch writes a new version beside the last one and only then points to it, so a failed batch leaves the old table.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # two sinks read it, and the records are decoded once
        try:
            store(batch, number)
        finally:
            batch.unpersist()

    def store(batch: DataFrame, number: int) -> None:
        batch.filter("_corrupt_record is not null").select("raw_").write.mode("overwrite").parquet(f"{dead}/batch={number}")
        good = batch.filter("_corrupt_record is null").drop("_corrupt_record", "raw_")
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
        done = sorted(int(f.getPath().getName()[1:]) for f in (fs.listStatus(fs_path) if fs.exists(fs_path) else []) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")))
        before = [v for v in done if v < number]
        target = spark.read.parquet(f"{path}/v{before[-1]}") if before else good.limit(0)
        upsert_smallest_trace(target, good).write.mode("overwrite").parquet(f"{path}/v{number}")

    return write


def current(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [int(f.getPath().getName()[1:]) for f in fs.listStatus(fs_path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return spark.read.parquet(f"{path}/v{max(done)}")


def run_available(raw: DataFrame, schema: StructType, path: str, dead: str, checkpoint: str) -> None:
    """Works off what a source offers now, then stops."""
    spark = raw.sparkSession
    decoded(raw, schema).writeStream.foreachBatch(upsert_sink(spark, path, dead)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_new(target: DataFrame, batch: DataFrame, keys=RECIPE) -> DataFrame:
    """The batch's rows, once each, whose keys the table does not hold."""
    return batch.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
