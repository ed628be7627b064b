"""Written tables in general."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunemill.session import scratch_path


def file_system_path(spark: SparkSession, path: str):
    """The file system of `path` and the path in it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
