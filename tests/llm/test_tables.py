import glob

import corpus_pipeline
from helpers import documents, sentence
from pyspark.sql import functions as F

from qamill.llm.tables import FILE_CLEANUP, passing, staged
from qamill.session import scratch_dir


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_staged_leaves_no_shuffle_files(spark):
    before, was = shuffle_files(spark), spark.conf.get(FILE_CLEANUP, None)
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.max("id").alias("m"))
    both = staged(spark, grouped.join(spark.range(50).repartition(3, "id"), F.col("k") == F.col("id")), "both")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(FILE_CLEANUP, None) == was
    assert sorted((r.k, r.m) for r in both.collect()) == sorted((k, max(range(k, 1000, 7))) for k in range(7))


def test_passing_lets_every_key_through(spark):
    ids = spark.range(500).select((F.col("id") * 977).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("b"))
    assert ids.where(passing(ids)).count() == 500
    others = spark.range(10_000).select((-F.col("id") - 1).alias("x"), F.col("id").alias("y"))
    assert others.where(passing(ids, "x", "y")).count() < 100
    assert others.where(passing(ids.where("false"), "x", "y")).count() == 0


def test_quality_stage_writes_no_texts_beside_the_rows(spark, tmp_path):
    import random
    rng = random.Random(3)
    docs = documents(spark, [(i, sentence(rng, 80)) for i in range(20)])
    spark.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    there = scratch_dir(spark, "counted").replace("file:", "").rsplit("-", 1)[0]
    before = set(glob.glob(f"{there}-*"))
    got = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and got.count() == 20
    for path in set(glob.glob(f"{there}-*")) - before:
        counted = spark.read.parquet(path)
        assert set(counted.columns) == {"doc_id", "lang", "quality_counts"} and counted.count() <= 6
