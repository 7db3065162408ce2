import os

import pytest
from pyspark.sql import functions as F

from qamill.operators import samples as S


@pytest.fixture(scope="module")
def written(spark):
    from qamill.session import scratch_dir

    path = scratch_dir(spark, "samples")
    df = spark.range(1000).select(F.when(F.col("id") < 700, "training").otherwise("validation").alias("split"), "id",
                                  F.when(F.col("id") < 700, F.col("id")).otherwise(F.col("id") - 700).alias("split_pos"),
                                  F.array(F.col("id"), F.col("id") + 1).alias("input_ids"))
    S.write(df.repartition(7), path, rows_per_file=100)
    return path


def test_sequence(spark, written):
    t, v = S.Samples(spark, written, "training"), S.Samples(spark, written, "validation")
    assert (len(t), len(v), len(S.Samples(spark, written, "none"))) == (700, 300, 0)
    assert t[0]["id"] == 0 and t[699]["id"] == 699 and t[-1]["id"] == 699 and v[5]["input_ids"] == [705, 706] and v[-300]["id"] == 700
    for i in (700, -701):
        with pytest.raises(IndexError):
            t[i]
    assert sorted(r["id"] for r in t[95:205].collect()) == list(range(95, 205))
    assert t[10:10].count() == 0 and t[690:9999].count() == 10 and v[-3:].count() == 3
    with pytest.raises(ValueError):
        t[::2]


def test_an_item_reads_one_file(spark, written):
    """The plan lists one file for an item, two for a range over a border; the file's rows are in order of place."""
    t = S.Samples(spark, written, "training")

    def read(df):
        plan = df._jdf.queryExecution().executedPlan()
        return plan.toString(), len(df.inputFiles()) and sum(f["n"] for f in df.select(F.input_file_name().alias("f")).distinct().agg(F.count("*").alias("n")).collect())

    for df, files in ((t.rows(250, 251), 1), (t.rows(199, 201), 2), (t.rows(0, 700), 7)):
        plan, n = read(df)
        assert n == files and "PartitionFilters: [isnotnull(split" in plan and "PushedFilters: [IsNotNull(place)" in plan
    root = written.replace("file:", "")
    assert all(len([f for f in os.listdir(f"{root}/rows/split=training/{d}") if f.endswith(".parquet")]) == 1 for d in os.listdir(f"{root}/rows/split=training"))


def test_lookup(spark, written):
    places = spark.createDataFrame([("training", 3, "a"), ("training", 3, "b"), ("validation", 299, "c"), ("validation", 300, "d"), ("training", -1, "e"),
                                    (None, 1, "f"), ("training", None, "g")], "split string, place long, sample_of string")
    got = sorted((r["sample_of"], r["sample"]["id"], r["sample"]["split_pos"]) for r in S.lookup(spark, written, places).collect())
    assert got == [("a", 3, 3), ("b", 3, 3), ("c", 999, 299)]


def test_empty(spark, tmpdir_shared):
    S.write(spark.range(0).select(F.lit("x").alias("split"), F.col("id").alias("split_pos")), tmpdir_shared)
    assert len(S.Samples(spark, tmpdir_shared, "x")) == 0 and S.Samples(spark, tmpdir_shared, "x")[0:5].count() == 0
