"""Binary files written and read by Spark, so that any store Spark knows will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_files(df: DataFrame, path: str, compression: str = "none") -> None:
    """One file for each row of df's binary column ``content``, through Spark's commit protocol.

    Spark has no writer for raw bytes; the text writer puts a row's bytes and
    one line feed, so each file ends with a line feed that isn't content.
    """
    df.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option(
        "compression", compression).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """path, content of each file; the line feed at the end is still there."""
    return spark.read.format("binaryFile").load(path).select("path", "content")
