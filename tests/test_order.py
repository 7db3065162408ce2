import pytest
from pyspark.sql import functions as F

from qamill.operators import order as O


def _ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "id")


def _sizes(df, col="split"):
    c = {r[col]: r["count"] for r in df.groupBy(col).count().collect()}
    return c


@pytest.mark.parametrize("n,expected", [(0, (0, 0, 0)), (1, (0, 0, 1)), (4, (2, 0, 2)), (5, (3, 1, 1)),
                                        (7, (4, 1, 2)), (10, (6, 2, 2)), (11, (6, 2, 3))])
def test_split_sizes(spark, n, expected):
    sp = O.split_positional(_ids(spark, n), "id")
    c = _sizes(sp)
    assert (c.get("training", 0), c.get("validation", 0), c.get("evaluation", 0)) == expected
    assert tuple(O.split_sizes(n)) == expected


def test_positions_exact_and_disjoint(spark):
    for n in (0, 1, 2, 3, 17, 64, 200):
        sp = O.split_positional(_ids(spark, n), "id")
        pos = sorted(r["pos"] for r in sp.select("pos").collect())
        assert pos == list(range(n))
        if n:
            ref = [r["id"] for r in _ids(spark, n).select("id", O.shuffle_key("id").alias("h"))
                   .orderBy("h", "id").collect()]
            got = [r["id"] for r in sp.orderBy("pos").collect()]
            assert got == ref


def test_independent_of_partitioning(spark):
    a = O.split_positional(_ids(spark, 300).repartition(7), "id").select("id", "pos", "split")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    b = O.split_positional(_ids(spark, 300).coalesce(1), "id").select("id", "pos", "split")
    rows_b = sorted(b.collect())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(a.collect()) == rows_b


def test_seed_changes_order(spark):
    a = [r["id"] for r in O.hashed_rank(_ids(spark, 50), "id", 42).orderBy("pos").collect()]
    b = [r["id"] for r in O.hashed_rank(_ids(spark, 50), "id", 7).orderBy("pos").collect()]
    assert sorted(a) == sorted(b) and a != b


@pytest.mark.parametrize("m,expected", [(0, (0, 0, 0)), (2, (0, 0, 2)), (3, (1, 1, 1)), (7, (2, 2, 3)),
                                        (8, (2, 2, 4))])
def test_chunk_sizes(spark, m, expected):
    df = spark.range(m).select(F.col("id").alias("p"))
    out = df.select(O.chunk_column(F.col("p"), F.lit(m), 3).alias("b"))
    c = {r["b"]: r["count"] for r in out.groupBy("b").count().collect()}
    assert (c.get(1, 0), c.get(2, 0), c.get(3, 0)) == expected


@pytest.mark.parametrize("n,expected", [(0, (0, 0)), (1, (0, 1)), (4, (3, 1)), (5, (4, 1)), (9, (7, 2))])
def test_retraining_split_in_stored_order(spark, n, expected):
    df = spark.range(n).select((F.col("id") * 10).alias("id"))
    sp = O.split_positional(df, "id", fractions=O.RETRAIN_FRACTIONS, rest="validation", order=["id"])
    rows = sorted(sp.select("id", "pos", "split").collect(), key=lambda r: r["pos"])
    assert [r["id"] for r in rows] == [i * 10 for i in range(n)]
    c = _sizes(sp)
    assert (c.get("training", 0), c.get("validation", 0)) == expected


def test_batches_cover_and_reshuffle(spark):
    df = _ids(spark, 21)
    e0 = O.batches(df, "id", 8, epoch=0).orderBy("batch_id").collect()
    e1 = O.batches(df, "id", 8, epoch=1).orderBy("batch_id").collect()
    assert [r["n_rows"] for r in e0] == [8, 8, 5]
    assert sorted(i for r in e0 for i in r["ids"]) == list(range(21))
    assert [i for r in e0 for i in r["ids"]] != [i for r in e1 for i in r["ids"]]
    val = O.batches(df.withColumn("p", F.col("id")), "id", 8, shuffle=False, pos="p").orderBy("batch_id")
    assert [i for r in val.collect() for i in r["ids"]] == list(range(21))


def test_shards_and_sample(spark):
    df = _ids(spark, 9).withColumn("p", F.col("id"))
    sh = O.shard(df, "p", 2)
    assert _sizes(sh, "shard") == {0: 5, 1: 4}
    s = O.sample_n(_ids(spark, 25), "id", 10).collect()
    assert len(s) == 10 and len({r["id"] for r in s}) == 10
    assert len(O.sample_n(_ids(spark, 4), "id", 10).collect()) == 4


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 10, 13, 97, 100, 1000, 1021])
def test_permuted_is_a_permutation(spark, n):
    a, b = O.grid(n)
    assert a * b >= n
    df = spark.range(n).select("id", *[O.permuted(F.col("id"), n, e, s).alias(f"p{e}_{s}") for e in (0, 1) for s in (42, 7)])
    rows = df.collect()
    for c in df.columns[1:]:
        assert sorted(r[c] for r in rows) == list(range(n))
    if n >= 97:
        orders = {tuple(r[c] for r in rows) for c in df.columns}
        assert len(orders) == len(df.columns)
        # No place, and no step between neighbours, stands out.
        for c in df.columns[1:]:
            p = [r[c] for r in rows]
            steps = [(y - x) % n for x, y in zip(p, p[1:])]
            assert max(steps.count(s) for s in set(steps)) <= max(8, n // 20)


def test_grid_leaves_few_over():
    for n in (10**6, 10**9 + 7, 10**12 + 39, 999_999_999_989):
        a, b = O.grid(n)
        assert 0 <= a * b - n < 64 and a <= b <= 5 * a


def test_batches_permuted_has_one_exchange(spark):
    df = spark.range(1000).select("id", F.col("id").alias("split_pos"))
    out = O.batches_permuted(df, "id", 1000, size=8, epochs=(0, 1, 2))
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "Window" not in plan and "Join" not in plan
    executed = out._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1
    rows = out.collect()
    assert len(rows) == 3 * 125 and all(r["n_rows"] == 8 for r in rows)
    for e in range(3):
        assert sorted(i for r in rows if r["epoch"] == e for i in r["ids"]) == list(range(1000))
    short = O.batches_permuted(spark.range(11).select("id", F.col("id").alias("split_pos")), "id", 11, size=8).collect()
    assert sorted(r["n_rows"] for r in short) == [3, 8]


def test_null_and_repeated_keys(spark):
    rows = [(None, "b"), (None, "a"), ("", "c"), ("x", "d"), ("x", None), ("x", "d"), ("y", "e")]
    df = spark.createDataFrame(rows, "key string, text string")
    a = O.hashed_rank(df, "key", ties=["text"]).collect()
    b = O.hashed_rank(df.orderBy(F.desc("text")).repartition(3), "key", ties=["text"]).collect()
    assert sorted(r["pos"] for r in a) == list(range(7)) and {r["n_total"] for r in a} == {7}
    at = lambda some: sorted((r["pos"], r["key"], r["text"]) for r in some)
    assert at(a) == at(b)
