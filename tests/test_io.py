import os

from pyspark.sql import types as T

from qamill.sources import io


def test_csv_quoting_like_pandas(spark, tmpdir_shared):
    df = spark.createDataFrame([('a,"b"\nc', None), ("", "x")], "t string, u string").coalesce(1)
    io.write_csv(df, tmpdir_shared)
    part = [f for f in os.listdir(tmpdir_shared) if f.endswith(".csv")][0]
    text = open(os.path.join(tmpdir_shared, part), encoding="utf-8").read()
    assert text == 't,u\n"a,""b""\nc",\n,x\n'


def test_jsonl_keeps_nulls(spark, tmpdir_shared):
    df = spark.createDataFrame([(1, None)], "id bigint, question string").coalesce(1)
    io.write_jsonl(df, tmpdir_shared)
    part = [f for f in os.listdir(tmpdir_shared) if f.endswith(".json")][0]
    assert open(os.path.join(tmpdir_shared, part)).read().strip() == '{"id":1,"question":null}'


def test_arrow_roundtrip(spark, tmpdir_shared):
    df = spark.createDataFrame([(i, f"q{i}") for i in range(50)], "id bigint, question string")
    shards = io.write_arrow(df.repartition(3), tmpdir_shared, "train").collect()
    assert sum(r["rows"] for r in shards) == 50
    back = io.read_arrow(spark, tmpdir_shared, "train")
    assert back.schema == T.StructType([T.StructField("id", T.LongType()),
                                        T.StructField("question", T.StringType())])
    assert sorted(back.collect()) == sorted(df.collect())
    assert back.rdd.getNumPartitions() == len(shards)


def test_list_tree_lists_without_reading(spark, tmpdir_shared):
    from qamill.sources import fs

    df = spark.createDataFrame([(i, f"q{i}") for i in range(20)], "id bigint, question string")
    io.write_jsonl(df.repartition(3), f"{tmpdir_shared}/pub", partition_by=())
    listing = fs.list_tree(spark, f"{tmpdir_shared}/pub", "*.json").collect()
    assert len(listing) == 3 and all(r["length"] > 0 for r in listing)
    assert sum(os.path.getsize(r["path"].replace("file:", "")) for r in listing) == \
        sum(r["length"] for r in listing)


def test_arrow_scan_path_with_space(spark, tmpdir_shared):
    df = spark.createDataFrame([(i, f"q{i}") for i in range(10)], "id bigint, question string")
    root = f"{tmpdir_shared}/my data"
    io.write_arrow(df.repartition(2), root, "train").collect()
    back = io.read_arrow(spark, root, "train")
    assert sorted(back.collect()) == sorted(df.collect())


def test_arrow_scan_shards_grow_in_number(spark, tmpdir_shared):
    from qamill.plans import extra
    from qamill.sources import fs

    docs = spark.range(4000).selectExpr("id as doc_id", "concat('q\\n', id) as text", "'en' as lang", "'s' as source", "1L as n_chars")
    docs.repartition(9).write.parquet(f"{tmpdir_shared}/documents.parquet")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, "4096")
    try:
        out = extra.q_arrow_scan(spark, tmpdir_shared)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert out.rdd.getNumPartitions() >= 9 and out.count() == 4000
    assert out.select("id").distinct().count() == 4000
