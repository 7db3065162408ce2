import numpy as np
import pytest
from pyspark.sql import functions as F

from qamill.operators import profile as P


def test_box_matches_numpy(spark):
    vals = [1, 2, 2, 3, 5, 8, 13, 21, 34, 100]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    for method, npm in (("linear", "linear"), ("hazen", "hazen")):
        b = P.box_stats(df, "x", method=method).first()
        q = np.percentile(vals, [25, 50, 75], method=npm)
        assert b["q1"] == pytest.approx(q[0]) and b["median"] == pytest.approx(q[1])
        assert b["q3"] == pytest.approx(q[2])
    b = P.box_stats(df, "x").first()
    assert b["n_outliers"] == 1 and b["whisker_high"] == 34 and b["whisker_low"] == 1


def test_histogram_at_most_30_bins(spark):
    df = spark.range(1000).select((F.col("id") % 97).alias("x"))
    h = P.histogram(df, "x", 30).collect()
    assert len(h) <= 30 and sum(r["n"] for r in h) == 1000
    same = P.histogram(spark.range(5).select(F.lit(3).alias("x")), "x", 30).collect()
    assert len(same) == 1 and same[0]["n"] == 5


def test_keyword_unicode_case_and_null(spark):
    df = spark.createDataFrame([("ÉTAT civil",), ("rien",), (None,)], "question string")
    assert P.explore(df, keyword="état").count() == 1
    assert P.explore(df, keyword="").count() == 3
    assert P.explore(df, keyword="ÉT.T").count() == 1
    c = P.explore_counts(df, keyword="état").first()
    assert (c["shown"], c["total"]) == (1, 3)
    # type selection is case-sensitive and ignored when the column is missing
    assert P.explore(df, types=("x",)).count() == 3


def test_missing_and_distinct(spark):
    df = spark.createDataFrame([("Symptoms",), ("dietary",), (None,), ("x",)], "question_type string")
    miss = sorted(r[0] for r in P.missing_values(df, "question_type").collect())
    assert miss == ["complications", "genetic changes"]
    assert P.distinct_values(df, include_null=True).count() == 4
    assert P.distinct_values(df, include_null=False).count() == 3


def test_distribution_share(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "t string")
    d = {r["t"]: (r["n"], r["share"]) for r in P.distribution(df, "t").collect()}
    assert d == {"a": (2, 0.5), "b": (1, 0.25), None: (1, 0.25)}
    assert None not in {r["t"] for r in P.distribution(df, "t", include_null=False).collect()}


def test_history_defaults_and_order(spark):
    rows = [("v1", 5, "2024-01-02T00:00:00.000000Z"), ("v2", None, "2024-01-01T00:00:00Z"),
            ("v10", 3, None)]
    meta = spark.createDataFrame(rows, "version_tag string, record_count bigint, timestamp string")
    h = P.history(meta).orderBy("seq").collect()
    assert [r["version"] for r in h] == ["v2", "v1", "v10"]
    assert [r["records"] for r in h] == [0, 5, 3]


def test_dropped_rows(spark):
    meta = spark.createDataFrame([(1, 2, 3, 4, 10)], ", ".join(f"{k} bigint" for k in P.DROP_KEYS))
    got = {r["type"]: r["count"] for r in P.dropped_rows(meta).collect()}
    assert got == dict(zip(P.DROP_KEYS, [1, 2, 3, 4, 10]))


def test_history_does_not_depend_on_session_time_zone(spark):
    rows = [("v1", 5, "2024-03-10T10:30:00.250000Z"), ("v2", 1, "2024-01-01T00:00:00Z")]
    meta = spark.createDataFrame(rows, "version_tag string, record_count bigint, timestamp string")
    utc = sorted(P.history(meta).collect())
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = sorted(P.history(meta).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other
    assert str(utc[0]["timestamp"]) == "2024-03-10 10:30:00.250000"


def test_history_from_metadata_folders(spark, tmpdir_shared):
    import json
    import os

    from qamill.operators.versions import metadata_documents

    docs = {"v1": {"version": "v1", "timestamp": "2024-01-02T00:00:00.000001Z", "record_count": 4,
                   "archived_files": ["a.json"]},
            "v10": {"version": "v10", "timestamp": "2024-01-03T00:00:00Z", "archived_files": []},
            "v2": {"version": "v2", "timestamp": "2024-01-01T12:00:00Z", "record_count": 2,
                   "archived_files": []},
            "vtmp": {"version": "vtmp", "timestamp": "2024-01-05T00:00:00Z", "record_count": 9}}
    for d, doc in docs.items():
        os.makedirs(f"{tmpdir_shared}/{d}")
        with open(f"{tmpdir_shared}/{d}/metadata.json", "w") as f:
            json.dump(doc, f, indent=2)
    os.makedirs(f"{tmpdir_shared}/v3")          # a version without metadata
    meta = metadata_documents(spark, tmpdir_shared)
    assert sorted(r["version"] for r in meta.collect()) == [1, 2, 10]
    h = P.history(meta).orderBy("seq").collect()
    assert [(r["version"], r["records"]) for r in h] == [("v2", 2), ("v1", 4), ("v10", 0)]


def test_box_continuous_against_numpy(spark):
    """Quartiles of groups small and large, with ties, nulls and NaN, at the sketch's least accuracy."""
    import numpy as np
    import pytest
    rng = np.random.default_rng(5)
    groups = {"normal": rng.normal(size=6000), "ties": rng.integers(0, 4, 5000).astype(float), "one": np.array([7.0]), "two": np.array([1.0, 2.0]),
              "skewed": rng.exponential(size=5003) ** 3, None: rng.uniform(size=101)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("one", None), ("two", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double")
    box = P.box_continuous(df, "x", ["g"], accuracy=100)
    got = {r["g"]: r for r in box.collect()}
    assert got.keys() == groups.keys()
    for g, v in groups.items():
        r = got[g]
        q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        assert [r["n"], r["min"], r["max"]] == [len(v), v.min(), v.max()]
        assert [r["q1"], r["median"], r["q3"]] == pytest.approx([q1, q2, q3])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = v[(v >= low) & (v <= high)]
        assert (r["n_outliers"], r["whisker_low"], r["whisker_high"]) == (len(v) - len(inside), inside.min(), inside.max())
        points = P.box_outliers(df, "x", box, ["g"]).where("g <=> " + (f"'{g}'" if g else "null")).count()
        assert points == r["n_outliers"]
    whole = P.box_continuous(df.where("g = 'skewed'"), "x", accuracy=100).first()
    assert whole["median"] == pytest.approx(np.median(groups["skewed"]))
    assert P.box_outliers(df.where("g = 'skewed'"), "x", P.box_continuous(df.where("g = 'skewed'"), "x")).count() == whole["n_outliers"]


def test_rows_of_a_group_are_not_gathered_for_its_box(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1009).cast("double").alias("x"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        box = P.box_continuous(df, "x", ["g"], whisker=0.25)
        for out in (box, P.box_outliers(df, "x", box, ["g"])):
            out.collect()
            assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
