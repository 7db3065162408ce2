"""Samples by index (U2): length, any item, any range, and many at once.

``write`` stores samples so that a place tells where it is: every file holds
``rows_per_file`` consecutive places of one split, in order, in a folder named
after the file's number, so a place's folder is a division, and the statistics
of the file's row groups tell which of them holds it.  A small index (one row a
file: number, first and last place, rows) gives the length without a scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_FILE = 65_536
INDEX = "split string, part long, first long, last long, rows long, rows_per_file long"


def write(df: DataFrame, path: str, pos: str = "split_pos", split: str = "split", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write samples and their index under ``path``; ``pos`` numbers the rows of each split from 0.

    One shuffle, by file.  A row group is at most about 8 MB, so that one item costs no more than that.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    parts = df.withColumn("split", F.col(split)).withColumn("place", F.col(pos).cast("long")).withColumn(
        "part", F.expr(f"cast(place as bigint) div {int(rows_per_file)}"))
    parts.repartition("split", "part").sortWithinPartitions("split", "part", "place").write.partitionBy("split", "part").option(
        "parquet.block.size", 8 << 20).parquet(f"{path}/rows")
    schema = T.StructType([f for f in parts.schema.fields if f.name not in ("split", "part")])
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(f"{path}/schema")
    held = _rows(spark, path).groupBy("split", "part").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.count(F.lit(1)).alias("rows"))
    held.withColumn("rows_per_file", F.lit(int(rows_per_file)).cast("long")).write.parquet(f"{path}/index")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType.fromJson(_json(spark.read.text(f"{path}/schema").first()["value"]))
    fields = [*schema.fields, T.StructField("split", T.StringType()), T.StructField("part", T.LongType())]
    return spark.read.schema(T.StructType(fields)).parquet(f"{path}/rows")


def _json(text: str) -> dict:
    import json  # noqa: PLC0415

    return json.loads(text)


class Samples:
    """The samples of one split, as a sequence: ``len(s)``, ``s[i]`` a Row, ``s[a:b]`` a DataFrame."""

    def __init__(self, spark: SparkSession, path: str, split: str) -> None:
        self.spark, self.path, self.split = spark, path.rstrip("/"), split
        index = spark.read.schema(INDEX).parquet(f"{self.path}/index").where(F.col("split") == split)
        total = index.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), F.max("rows_per_file").alias("size")).first()
        self.n, self.size = int(total["n"]), int(total["size"] or ROWS_PER_FILE)

    def __len__(self) -> int:
        return self.n

    def rows(self, start: int, stop: int) -> DataFrame:
        """Places start .. stop - 1: only the folders that hold them are listed, only their row groups read."""
        rows = _rows(self.spark, self.path).where((F.col("split") == self.split) & F.col("part").between(start // self.size, max(stop - 1, start) // self.size))
        return rows.where((F.col("place") >= start) & (F.col("place") < stop)).drop("part")

    def __getitem__(self, at: int | slice) -> Row | DataFrame:
        if isinstance(at, slice):
            start, stop, step = at.indices(self.n)
            if step != 1:
                raise ValueError("ranges have step 1")
            return self.rows(start, max(stop, start))
        if not -self.n <= at < self.n:
            raise IndexError(at)
        at %= self.n
        return self.rows(at, at + 1).first()


def lookup(spark: SparkSession, path: str, places: DataFrame, split: str = "split", place: str = "place") -> DataFrame:
    """The samples at the given places of any splits; places that don't exist give no row, repeated ones repeat.

    Joined on the file's number and the place, so a shuffle moves the samples of files that are asked for only
    (where the list of these is short, folders are pruned before the scan).  Columns of ``places`` come first.
    """
    path = path.rstrip("/")
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    size = index.agg(F.max("rows_per_file").alias("size")).first()["size"] or ROWS_PER_FILE
    asked = places.withColumn("_split", F.col(split)).withColumn("_place", F.col(place).cast("long")).withColumn("_part", F.expr(f"_place div {int(size)}"))
    files = asked.select("_split", "_part").distinct().limit(1001).collect()
    rows = _rows(spark, path)
    if len(files) <= 1000:
        rows = rows.where(F.col("part").isin(sorted({r["_part"] for r in files if r["_part"] is not None})) & F.col("split").isin(
            sorted({r["_split"] for r in files if r["_split"] is not None})))
    rows = rows.select(F.struct(*[c for c in rows.columns if c not in ("split", "part", "place")]).alias("sample"), "split", "part", "place").select(
        "sample", F.col("split").alias("_s"), F.col("part").alias("_f"), F.col("place").alias("_p"))
    found = asked.join(rows, (F.col("_split") == F.col("_s")) & (F.col("_part") == F.col("_f")) & (F.col("_place") == F.col("_p")))
    return found.select(*[F.col(c) for c in places.columns], "sample")
