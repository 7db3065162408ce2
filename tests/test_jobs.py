"""End-to-end jobs on the smallest driver tables."""
import os

from pyspark.sql import functions as F

from qamill.operators import versions as V
from qamill.plans import jobs, standins
from qamill.sources import fs, io
from qamill.streaming.replay import start_replay, word_count_score

SF = "/root/testdata/sf0.001"


def test_offline_feed_report(spark, tmpdir_shared):
    out = f"{tmpdir_shared}/offline"
    res = jobs.offline_prepare(spark, standins.qa_docs(spark, SF), out)
    n = res.final_records
    assert res.split_counts == {"training": int(n * 0.6), "validation": int(n * 0.2),
                                "testing": n - int(n * 0.6) - int(n * 0.2)}
    assert res.dropped["total_dropped"] == sum(v for k, v in res.dropped.items() if k != "total_dropped")
    assert not os.path.exists(f"{out}/_staging")
    meta = io.read_meta(spark, f"{out}/metadata", io.META_OFFLINE).first()
    assert meta["final_records"] == n and meta["split_counts"]["testing"] == res.split_counts["testing"]
    prod = spark.read.schema("id bigint, batch int").json(f"{out}/production")
    assert prod.count() == res.split_counts["testing"]

    feed = f"{tmpdir_shared}/feed"
    jobs.training_feed(spark, out, feed, max_len=64, epochs=2)
    samples = spark.read.parquet(f"{feed}/samples")
    assert samples.count() == res.split_counts["training"] + res.split_counts["validation"]
    assert samples.where(F.size("input_ids") != 64).count() == 0
    plan = spark.read.parquet(f"{feed}/batches")
    for e in (0, 1):
        ids = [i for r in plan.where(f"split = 'training' and epoch = {e}").collect() for i in r["ids"]]
        assert len(ids) == len(set(ids)) == res.split_counts["training"]

    rep = f"{tmpdir_shared}/report"
    jobs.report(spark, out, rep, keyword="e")
    assert {r["type"] for r in spark.read.parquet(f"{rep}/dropped").collect()} >= {"total_dropped"}
    box = spark.read.parquet(f"{rep}/length_box").collect()
    assert {r["split"] for r in box} == {"training", "validation", "evaluation"}
    for split in jobs.SPLITS:   # one export, sample and count per split
        assert len(fs.list_files(spark, f"{rep}/explore_csv/split={split}", ".csv")) >= 1
    assert spark.read.parquet(f"{rep}/explore_sample").groupBy("split").count().where("count = 10").count() == 3
    assert spark.read.parquet(f"{rep}/explore_counts").count() == 3


def test_retraining_feed_carries_version(spark, tmpdir_shared):
    drop, base, arch = f"{tmpdir_shared}/drop", f"{tmpdir_shared}/base", f"{tmpdir_shared}/archive"
    os.makedirs(drop)
    with open(f"{drop}/a.json", "w") as f:
        f.write("\n".join('{"question":"q%d w","answer":"a %d"}' % (i, i) for i in range(10)) + "\n")
    V.ingest_dir(spark, drop, base, arch)
    v = jobs.retraining_feed(spark, base, f"{tmpdir_shared}/feed", max_len=8, epochs=1)
    s = spark.read.parquet(f"{tmpdir_shared}/feed/samples")
    assert v == 1 and s.where("version = 1").count() == 10
    split = {r["record_id"]: r["split"] for r in s.collect()}
    # stored order: the first 8 lines train, the last 2 validate
    assert sorted(k for k, x in split.items() if x == "validation") == ["a.json|10|0", "a.json|9|0"]


def test_replay_scores_in_order(spark, tmpdir_shared):
    src = f"{tmpdir_shared}/src"
    df = spark.createDataFrame([(i, f"word {'x ' * i}") for i in range(6)], "pos bigint, question string")
    df.coalesce(2).write.json(src)

    def flaky(payload):
        import json
        qs = payload.map(lambda p: json.loads(p)["question"])
        if qs.str.contains("x x x x x").any():
            raise ValueError("boom")
        return word_count_score(payload)

    q = start_replay(spark, src, "pos bigint, question string", flaky, f"{tmpdir_shared}/out",
                     f"{tmpdir_shared}/ck", available_now=True)
    q.awaitTermination()
    rows = sorted(spark.read.parquet(f"{tmpdir_shared}/out").collect())
    assert [r["pos"] for r in rows] == list(range(6))
    assert [r["status"] for r in rows] == ["ok"] * 5 + ["error"]
    assert rows[2]["response"] == "3" and rows[5]["error"].startswith("ValueError")


def test_cli_land_and_offline(spark, tmpdir_shared):
    from qamill.plans import cli

    src = f"{tmpdir_shared}/raw"
    standins.qa_docs(spark, SF).drop("id").write.json(src)
    cli.main(["land", "--src", src, "--format", "json", "--dest", f"{tmpdir_shared}/snap"])
    snap = spark.read.parquet(f"{tmpdir_shared}/snap")
    assert snap.select("id").distinct().count() == snap.count() == 200
    cli.main(["offline", "--raw", f"{tmpdir_shared}/snap", "--out", f"{tmpdir_shared}/out"])
    meta = io.read_meta(spark, f"{tmpdir_shared}/out/metadata", io.META_OFFLINE).first()
    assert meta["initial_records"] == 200


def test_retraining_feed_on_tracked_folders(spark, tmpdir_shared):
    base = f"{tmpdir_shared}/transformed"
    os.makedirs(f"{base}/v2")
    os.makedirs(f"{base}/v1")
    with open(f"{base}/version_tracker.txt", "w") as f:
        f.write("2")
    with open(f"{base}/v2/retraining_data.json", "w") as f:
        f.write("\n".join('{"question":"q%d","answer":"a%d","question_type":"causes"}' % (i, i)
                          for i in range(5)) + "\n")
    v = jobs.retraining_feed(spark, base, f"{tmpdir_shared}/feed", max_len=8, epochs=1)
    s = spark.read.parquet(f"{tmpdir_shared}/feed/samples")
    assert v == 2 and s.count() == 5
    assert {r["split"]: r["count"] for r in s.groupBy("split").count().collect()} == {
        "training": 4, "validation": 1}


def test_small_and_text_keyed_inputs(spark, tmpdir_shared):
    want = {0: (0, 0, 0), 1: (0, 0, 1), 3: (1, 0, 2), 4: (2, 0, 2)}
    for n, sizes in want.items():
        out = f"{tmpdir_shared}/o{n}"
        raw = spark.createDataFrame([(f"k{i}", None, "symptoms", f"q{i}", None, "a") for i in range(n)],
                                    "key string, synonyms string, question_type string, question string, question_focus string, answer string")
        r = jobs.offline_prepare(spark, raw, out, key="key")
        assert tuple(r.split_counts[s] for s in ("training", "validation", "testing")) == sizes
        got = [x["key"] for s in ("training", "validation", "evaluation") for x in jobs.read_split(spark, out, s).collect()]
        assert sorted(got) == [f"k{i}" for i in range(n)]


def test_rows_that_share_a_key_are_encoded_alike(spark):
    from qamill.operators import encode as E
    df = spark.createDataFrame([(1, "a b c"), (1, "d e"), (2, "a")], "id bigint, prompt string")
    vocab = E.build_vocab(df, "prompt")
    one, two = (sorted(tuple(r["input_ids"]) for r in E.encode(df, vocab, max_len=4, method=m).collect()) for m in ("map", "join"))
    assert one == two and len(one) == 3 and all(len(x) == 4 for x in one)


def test_scorer_sees_each_record_once(spark, tmpdir_shared):
    import os as _os
    from qamill.streaming.replay import score
    seen = f"{tmpdir_shared}/seen"
    _os.makedirs(seen)

    def scorer(payload):
        assert len(payload) == 1
        open(f"{seen}/{abs(hash(payload.iloc[0]))}-{len(_os.listdir(seen))}", "w").close()
        if "3" in payload.iloc[0]:
            raise ValueError("three")
        return payload
    df = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "pos bigint, payload string").coalesce(1)
    rows = score(df, scorer).collect()
    assert [r["status"] for r in rows] == ["ok"] * 3 + ["error"] + ["ok"] * 2 and len(_os.listdir(seen)) == 6


def test_report_of_a_tracked_version(spark, tmpdir_shared):
    import json
    for v in (1, 2):
        os.makedirs(f"{tmpdir_shared}/b/v{v}")
        with open(f"{tmpdir_shared}/b/v{v}/retraining_data.json", "w") as f:
            f.write("".join(json.dumps({"question": f"q {i}", "answer": "a", "question_type": "t"}) + "\n" for i in range(v)))
        with open(f"{tmpdir_shared}/b/v{v}/metadata.json", "w") as f:
            json.dump({"version": f"v{v}", "timestamp": "2024-01-01T00:00:00Z", "record_count": v, "archived_files": ["x"],
                       "dropped": {"missing_question": v}}, f)
    assert jobs.version_report(spark, f"{tmpdir_shared}/b", f"{tmpdir_shared}/r1", version=1) == 1
    assert jobs.version_report(spark, f"{tmpdir_shared}/b", f"{tmpdir_shared}/r2") == 2
    for v in (1, 2):
        assert spark.read.parquet(f"{tmpdir_shared}/r{v}/types").first()["n"] == v
        assert tuple(spark.read.parquet(f"{tmpdir_shared}/r{v}/dropped").first()) == ("missing_question", v)
        assert spark.read.parquet(f"{tmpdir_shared}/r{v}/history").count() == 2


def test_feed_counts_unknown_words(spark, tmpdir_shared):
    row = lambda i, q: (i, q, "c", i)
    df = lambda rows: spark.createDataFrame(rows, "id long, question string, answer string, split_pos long")
    for most, fewer in ((None, 0), (2, 1)):
        out = f"{tmpdir_shared}/feed{most}"
        jobs.feed(spark, df([row(0, "a a b")]), df([row(1, "a zzz")]), out, style="short", max_vocab=most)
        got = {r.split: r for r in spark.read.parquet(f"{out}/unknown").collect()}
        assert got["validation"].unknown >= 1 and (got["training"].unknown > 0) == bool(fewer)
        assert got["training"].words == got["validation"].words + 1
