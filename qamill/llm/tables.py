"""Writing intermediate tables to the shared folder, a filter for large joins, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qamill.session import scratch_dir
from qamill.sources import fs


#: Lets Spark remove the shuffle files of a query as soon as it ends, not when the driver happens to collect its garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Size, in 64-bit words, of the table that lets the keys needed pass a scan (and others that share their bits).
PASS_WORDS = 1 << 15


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: later uses don't repeat its work.
    The shuffle files of the writing go with its end."""
    path = scratch_dir(spark, name)
    was = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if was is None:
            spark.conf.unset(FILE_CLEANUP)
        else:
            spark.conf.set(FILE_CLEANUP, was)
    return spark.read.schema(df.schema).parquet(path)


def constant(numbers: list[int], kind: str) -> Column:
    """An array of numbers as one constant of the plan."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast(f"array<{kind}>")


def passing(ids: DataFrame, *columns: str | Column) -> Column:
    """Whether the values of columns may be a row of ids; PASS_WORDS numbers at most reach the driver.

    Never false for a row of ids (columns in its order and of its types), so a join
    need only read the rows that pass.
    """
    def place(cols) -> Column:
        return F.xxhash64(*cols).bitwiseAND(F.lit(PASS_WORDS * 64 - 1))
    bits = ids.select(place(ids.columns).alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    table = [0] * PASS_WORDS
    for r in bits.toLocalIterator():
        table[r["w"]] = r["bits"]
    at = place(columns or ids.columns)
    word = F.get(constant(table, "bigint"), F.shiftright(at, 6).cast("int"))
    return F.lit(0).cast("long") != word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int")))


def released(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove tables that ``staged`` wrote, once nothing that is still to run reads them."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            fs.remove(spark, path)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b: long) as (node, label), label the smallest node reachable.

    Alternating large-star and small-star steps; every step is a partial
    aggregation and a join, written to the shared folder, until nothing
    changes.  Nodes without an edge to another node don't appear.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        # (u, v): u sees v.  Large: all neighbours, those above u move to the least.
        # Small: neighbours below u, and u itself, move to the least.
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.join(least, "u")
        if large:
            moved = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            moved = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
                least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return moved.where("a <> b").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e = staged(spark, edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    was = mark(e)
    while was[0]:
        last, e = e, staged(spark, star(star(e, True), False), "edges")
        now = mark(e)
        released(spark, last)
        if tuple(now) == tuple(was):
            break
        was = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
