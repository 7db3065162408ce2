import os

from qamill.operators import versions as V
from qamill.plans import extra as X
from qamill.sources import dropdir
from qamill.streaming.ingest import run_ingest_once

FILES = {
    "arr_pretty.json": '[{"question":"q1","answer":"a1"},\n {"question":"q2","answer":"a2","symptoms":"x"}]\n',
    "jl.json": '{"question":"q3","answer":"a3"}\n\n{"question":"q4","answer":"a4","timestamp":"t"}\nBAD\n',
    "single.json": '{"question":"q5","answer":"a5"}\n',
    "single_pretty.json": '{\n "question":"q6"\n}\n',
    "arr_line.json": '[{"question":"q7","answer":"a7","question_type":"Symptoms"}]',
    "badfirst.json": 'oops\n{"question":"q8","answer":"  "}\n{"question":"q9","answer":"a9"}\n',
    "lists.json": "[1]\n[2]\n",
    "strict.json": '{"a":1} x\n{"a":1},{"a":2}\n{"question":"q10","answer":"a10","question":"dup"}\n',
    "emptyarr.json": "[]\n",
    "blanks.json": "\n\n",
    "x.txt": "hi\n",
    "x.JSON": '[{"question":"u","answer":"v"}]\n',
}


def _write(d, files):
    os.makedirs(d, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)


def test_scan_kinds_and_quarantine(spark, tmpdir_shared):
    drop = f"{tmpdir_shared}/drop"
    _write(drop, FILES)
    lst = dropdir.list_files(spark, drop)
    paths = [r["path"] for r in lst.collect()]
    assert sorted(p.rsplit("/", 1)[-1] for p in paths) == sorted(
        n for n in FILES if n.endswith(".json"))
    res = dropdir.scan(spark, paths, lst)
    kinds = {r["name"]: (r["kind"], r["records"], r["ingest"]) for r in res.files.collect()}
    assert kinds["arr_pretty.json"] == ("array_whole", 2, True)
    assert kinds["arr_line.json"] == ("array_line", 1, True)
    assert kinds["jl.json"] == ("jsonl", 2, True)
    assert kinds["badfirst.json"] == ("jsonl", 2, True)
    assert kinds["single.json"][2] is False and kinds["single_pretty.json"][2] is False
    assert kinds["emptyarr.json"][1] == 0 and kinds["blanks.json"][1] == 0
    rows = [(r["name"], r["line_no"], r["reason"]) for r in res.quarantine.collect()]
    # files left in place are reported without a line
    assert sorted(r[0] for r in rows if r[1] is None and r[2] == "single_object_file") == ["single.json", "single_pretty.json"]
    q = sorted(r for r in rows if r[1] is not None)
    assert q == [("badfirst.json", 1, "invalid_json"), ("jl.json", 4, "invalid_json"),
                 ("lists.json", 1, "not_an_object"), ("lists.json", 2, "not_an_object"),
                 ("strict.json", 1, "invalid_json"), ("strict.json", 2, "invalid_json")]


def test_ingest_versions_archive_and_latest(spark, tmpdir_shared):
    drop, base, arch = f"{tmpdir_shared}/drop", f"{tmpdir_shared}/base", f"{tmpdir_shared}/archive"
    _write(drop, FILES)
    r = V.ingest_dir(spark, drop, base, arch)
    assert r.version == 1 and r.record_count == 7
    left = sorted(os.listdir(drop))
    assert left == ["single.json", "single_pretty.json", "x.JSON", "x.txt"]
    df, v = V.read_version(spark, base)
    got = {(x["question"], x["answer"]) for x in df.collect()}
    assert ("dup", "a10") in got and ("q8", "  ") not in got and len(got) == 7
    assert "symptoms" not in df.columns and "timestamp" not in df.columns
    # nothing new -> no version (V5)
    r2 = V.ingest_dir(spark, drop, base, arch)
    assert r2.version is None and V.next_version(spark, base) == 2
    _write(drop, {"more.json": '{"question":"n1","answer":"m1"}\n{"question":"n2","answer":"m2"}\n'})
    r3 = V.ingest_dir(spark, drop, base, arch)
    assert r3.version == 2 and r3.record_count == 2
    assert [x["version"] for x in V.versions(spark, base).collect()] == [1, 2]
    assert sorted(os.listdir(f"{arch}/v2")) == ["more.json"]


def test_crash_before_manifest_is_repaired(spark, tmpdir_shared):
    drop, base, arch = f"{tmpdir_shared}/drop", f"{tmpdir_shared}/base", f"{tmpdir_shared}/archive"
    _write(drop, {"a.json": '[{"question":"q","answer":"a"}]'})
    # a crashed attempt left data for version 1 but no manifest row
    os.makedirs(f"{base}/data/version=1")
    with open(f"{base}/data/version=1/part-0.json", "w") as f:
        f.write('{"question":"stale","answer":"x"}\n')
    r = V.ingest_dir(spark, drop, base, arch)
    assert r.version == 1
    df, _ = V.read_version(spark, base, 1)
    assert [x["question"] for x in df.collect()] == ["q"]


def test_archive_of_committed_files_is_finished(spark, tmpdir_shared):
    drop, base, arch = f"{tmpdir_shared}/drop", f"{tmpdir_shared}/base", f"{tmpdir_shared}/archive"
    _write(drop, {"a.json": '[{"question":"q","answer":"a"}]'})
    stat = os.stat(f"{drop}/a.json")
    V.ingest_dir(spark, drop, base, arch)
    # the very same file is there as if the move had not happened (crash after manifest)
    os.rename(f"{arch}/v1/a.json", f"{drop}/a.json")
    os.utime(f"{drop}/a.json", ns=(stat.st_atime_ns, stat.st_mtime_ns))
    r = V.ingest_dir(spark, drop, base, arch)
    assert r.version is None
    assert os.listdir(drop) == [] and V.next_version(spark, base) == 2
    assert os.listdir(f"{arch}/v1") == ["a.json"]


def test_a_name_used_again_is_a_new_file(spark, tmpdir_shared):
    drop, base, arch, ck = (f"{tmpdir_shared}/{x}" for x in ("drop", "base", "archive", "ckpt"))
    for n in (1, 2, 3):
        _write(drop, {"day.json": "".join(f'{{"question":"q{n}{k}","answer":"a"}}\n' for k in range(n + 1))})
        run_ingest_once(spark, drop, base, arch, ck)
        assert os.listdir(drop) == []
        with open(f"{arch}/v{n}/day.json") as f:
            assert len(f.readlines()) == n + 1
    assert [(r["version"], r["record_count"]) for r in V.versions(spark, base).collect()] == [(1, 2), (2, 3), (3, 4)]


def test_archive_never_overwrites(spark, tmpdir_shared):
    from qamill.sources import fs
    _write(f"{tmpdir_shared}/a", {"x.json": "1"})
    _write(f"{tmpdir_shared}/b", {"x.json": "2"})
    fs.move(spark, f"{tmpdir_shared}/a/x.json", f"{tmpdir_shared}/to")
    fs.move(spark, f"{tmpdir_shared}/b/x.json", f"{tmpdir_shared}/to")
    fs.move(spark, f"{tmpdir_shared}/b/x.json", f"{tmpdir_shared}/to")     # gone: nothing to do
    assert sorted(open(f"{tmpdir_shared}/to/{n}").read() for n in os.listdir(f"{tmpdir_shared}/to") if not n.endswith(".crc")) == ["1", "2"]


def test_odd_values_names_and_keys(spark, tmpdir_shared):
    drop, base, arch, q = (f"{tmpdir_shared}/{x}" for x in ("drop", "base", "archive", "quarantine"))
    spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    _write(drop, {
        "a[1].json": '[{"question":"q1","answer":"a"},{"question":"","answer":"a"},{"question":null,"answer":"a"},{"question":5,"answer":"a"}]',
        "b{2}*?.json": '{"question":"q2","Question":"Q2","answer":"a","source_file":"s","version":7,"question":"q3"}\n{"question":"q4","answer":["x"]}\n',
        "object.json": '{"question":"left","answer":"here"}\n',
    })
    r = V.ingest_dir(spark, drop, base, arch, quarantine_path=q)
    assert (r.version, r.record_count) == (1, 4)
    df, _ = V.read_version(spark, base)
    got = {x["question"]: x for x in df.collect()}
    assert set(got) == {"q1", "5", "q3", "q4"} and got["q4"]["answer"] == '["x"]'
    odd = got["q3"]
    assert (odd["Question__2"], odd["source_file__2"], odd["version__2"], odd["version"]) == ("Q2", "s", 7, 1)
    assert odd["source_file"] == "b{2}*?.json"
    assert os.listdir(drop) == ["object.json"]
    rows = spark.read.schema("name string, line_no long, reason string").json(f"{q}/version=1").collect()
    assert [tuple(x) for x in rows] == [("object.json", None, "single_object_file")]


def test_all_bad_files_are_reported(spark, tmpdir_shared):
    drop, base, arch, q = (f"{tmpdir_shared}/{x}" for x in ("drop", "base", "archive", "quarantine"))
    _write(drop, {"bad.json": "oops\nagain\n", "one.json": "{}\n"})
    for _ in range(2):
        r = V.ingest_dir(spark, drop, base, arch, quarantine_path=q)
        assert r.version is None and sorted(os.listdir(drop)) == ["bad.json", "one.json"]
        rows = spark.read.schema("name string, line_no long, reason string").json(f"{q}/version=0").collect()
        assert sorted(map(tuple, rows), key=str) == [("bad.json", 1, "invalid_json"), ("bad.json", 2, "invalid_json"),
                                                     ("one.json", None, "single_object_file")]


def test_list_splitter():
    import json
    from qamill.sources.jsonlist import Splitter

    def run(text):
        s, out = Splitter(), []
        for line in text.split("\n"):
            out += s.feed(line)
        return s.verdict, out
    value = [{"a": "x,[]{}\"\\", "b": [1, {"c": []}]}, 1, "s,", None, [], {}]
    for indent in (None, 0, 1):
        verdict, out = run("\n " + json.dumps(value, indent=indent) + " \n\n")
        assert verdict == "ARRAY" and [json.loads(x) for x in out] == value
    assert run("[]") == ("ARRAY", []) and run("[\n]") == ("ARRAY", [])
    assert run('{"a": [\n1]}') == ("OBJECT", [])
    for bad in ("[1,]", "[,1]", "[1 2]", "[1]]", "[1] x", "[1", '["a]', "[1}", "{]", "oops", "", "[[1]\n[2]]"):
        assert run(bad)[0] == "NONE", bad


def test_stream_takes_only_new_files(spark, tmpdir_shared):
    drop, base, arch, ck = (f"{tmpdir_shared}/drop", f"{tmpdir_shared}/base",
                            f"{tmpdir_shared}/archive", f"{tmpdir_shared}/ckpt")
    _write(drop, {"a.json": '[{"question":"q1","answer":"a1"}]'})
    run_ingest_once(spark, drop, base, arch, ck)
    _write(drop, {"b.json": '{"question":"q2","answer":"a2"}\n{"question":"q3","answer":"a3"}\n'})
    run_ingest_once(spark, drop, base, arch, ck)
    run_ingest_once(spark, drop, base, arch, ck)          # nothing new: no version
    man = {r["version"]: (r["record_count"], tuple(r["archived_files"]))
           for r in V.manifest(spark, base).collect()}
    assert man == {1: (1, ("a.json",)), 2: (2, ("b.json",))}
    allv = V.read_all(spark, base)
    assert sorted((r["question"], r["version"]) for r in allv.collect()) == [
        ("q1", 1), ("q2", 2), ("q3", 2)]


def test_version_order_is_numeric(spark, tmpdir_shared):
    base, arch = f"{tmpdir_shared}/base", f"{tmpdir_shared}/archive"
    for i in range(1, 12):
        drop = f"{tmpdir_shared}/drop{i}"
        _write(drop, {f"f{i}.json": f'[{{"question":"q{i}","answer":"a"}}]'})
        V.ingest_dir(spark, drop, base, arch)
    assert [r["version"] for r in V.versions(spark, base).collect()] == list(range(1, 12))
    df, v = V.read_version(spark, base)
    assert v == 11 and df.first()["question"] == "q11"


def test_subfolders_are_not_scanned(spark, tmpdir_shared):
    drop = f"{tmpdir_shared}/drop"
    _write(drop, {"top.json": '[{"question":"a","answer":"b"}]'})
    _write(f"{drop}/sub", {"inner.json": '[{"question":"c","answer":"d"}]'})
    names = [r["path"].rsplit("/", 1)[-1] for r in dropdir.list_files(spark, drop).collect()]
    assert names == ["top.json"]


def test_replayed_batch_is_not_committed_twice(spark, tmpdir_shared):
    drop, base, arch = f"{tmpdir_shared}/drop", f"{tmpdir_shared}/base", f"{tmpdir_shared}/archive"
    _write(drop, {"a.json": '[{"question":"q","answer":"a"}]'})
    lst = dropdir.list_files(spark, drop)
    paths = [r["path"] for r in lst.collect()]
    r1 = V.ingest_paths(spark, paths, base, arch, batch_id=7, listing=lst)
    assert r1.version == 1
    # the stream restarts and replays micro-batch 7 with the same file list
    r2 = V.ingest_paths(spark, paths, base, arch, batch_id=7)
    assert r2.version is None and V.next_version(spark, base) == 2


def test_single_object_option(spark, tmpdir_shared):
    drop, base, arch = f"{tmpdir_shared}/drop", f"{tmpdir_shared}/base", f"{tmpdir_shared}/archive"
    _write(drop, {"one.json": '{"question":"q1","answer":"a1"}\n',
                  "pretty.json": '{\n "question": "q2",\n "answer": "a2"\n}\n'})
    r = V.ingest_dir(spark, drop, base, arch, single_object="ingest")
    assert r.version == 1 and r.record_count == 2
    df, _ = V.read_version(spark, base)
    assert sorted(x["question"] for x in df.collect()) == ["q1", "q2"]
    assert os.listdir(drop) == []


def test_file_names_with_space_percent_plus_and_accents(spark, tmpdir_shared):
    drop, base, arch = f"{tmpdir_shared}/drop", f"{tmpdir_shared}/base", f"{tmpdir_shared}/archive"
    _write(drop, {"with space.json": '[{"question":"a","answer":"b"}]\n',
                  "é%x+y.json": '{"question":"c","answer":"d"}\n{"question":"e","answer":"f"}\n',
                  "pretty  one.json": '[\n {"question":"g","answer":"h"}\n]\n'})
    r = V.ingest_dir(spark, drop, base, arch)
    assert r.version == 1 and r.record_count == 4
    assert {x["name"]: x["records"] for x in r.files} == {
        "with space.json": 1, "é%x+y.json": 2, "pretty  one.json": 1}
    assert os.listdir(drop) == []
    assert sorted(os.listdir(f"{arch}/v1")) == sorted(["with space.json", "é%x+y.json", "pretty  one.json"])


def test_big_array_files_grow_in_number_not_size(spark, monkeypatch):
    """ingest_big_array: a file holds one range of ids, and all rows come back."""
    files = []
    publish = X.dropgen._publish
    monkeypatch.setattr(X.dropgen, "_publish", lambda *a: files.extend(publish(*a)) or files)
    monkeypatch.setattr(X, "BIG_IDS", 20, raising=False)
    sf = "/root/testdata/sf0.001"
    got = X.q_ingest_big_array(spark, sf).collect()
    ids = [r.id for r in X.S.qa_docs(spark, sf).select("id").collect()]
    assert len(files) == len({i // 20 for i in ids}) > 1
    assert len(got) == X.BIG_COPIES and len({(r.n, r.chars) for r in got}) == 1


def test_keys_of_any_kind(spark, tmpdir_shared):
    drop, base, arch = (f"{tmpdir_shared}/{x}" for x in ("drop", "base", "archive"))
    _write(drop, {"a.json": '{"question":"q","answer":"a","it\'s":1,"c: d":2,"a,b":{"x":[1]},"`t`":"","":3,"\'\\"]":4,"x.y":null,"$":5}\n{"question":"other","answer":"a"}\n'})
    assert V.ingest_dir(spark, drop, base, arch).record_count == 2
    row = V.read_all(spark, base).where("question = 'q'").collect()[0].asDict()
    assert {k: row[k] for k in ("it's", "c: d", "a,b", "`t`", "_", "'\"]", "x.y", "$")} == {
        "it's": 1, "c: d": 2, "a,b": '{"x":[1]}', "`t`": "", "_": 3, "'\"]": 4, "x.y": None, "$": 5}


def test_read_all_is_one_pruned_scan(spark, tmpdir_shared):
    """200 versions, one scan; what isn't committed isn't read; types widen, and names keep the first spelling."""
    base = f"{tmpdir_shared}/base"
    drop, arch = f"{tmpdir_shared}/drop", f"{tmpdir_shared}/archive"
    for k, x in enumerate(("1", "2.5", '"t"')):
        _write(drop, {f"f{k}.json": f'{{"question":"q","answer":"a","{"X" if k else "x"}":{x},"only{k}":true}}\n' * 2})
        V.ingest_dir(spark, drop, base, arch)
    man = V.manifest(spark, base).where("version = 3").collect()[0].asDict()
    for v in range(4, 204):
        if v < 203:
            man["version"] = v
            os.makedirs(f"{base}/_manifest/version={v}")
            with open(f"{base}/_manifest/version={v}/part-0.json", "w") as f:
                import json
                f.write(json.dumps({k: x for k, x in man.items()}) + "\n")
        os.makedirs(f"{base}/data/version={v}")
        with open(f"{base}/data/version={v}/part-0.json", "w") as f:
            f.write('{"question":"q","answer":"a","x":"s"}\n')
    df = V.read_all(spark, base)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan and "PartitionFilters: [version" in plan
    rows = df.collect()
    assert len(rows) == 205 and {r["version"] for r in rows} == set(range(1, 203))
    assert {r["x"] for r in rows} == {"1", "2.5", "t", "s"} and {"only0", "only1", "only2"} <= set(df.columns) and "X" not in df.columns


def test_files_of_other_suffixes_are_reported(spark, tmpdir_shared):
    drop, base, arch, q = (f"{tmpdir_shared}/{x}" for x in ("drop", "base", "archive", "quarantine"))
    _write(drop, {"a.json": '[{"question":"q","answer":"a"}]', "x.txt": "hi", "x.JSON": "[]", "notes.json.bak": "1"})
    assert V.ingest_dir(spark, drop, base, arch, quarantine_path=q).version == 1
    rows = spark.read.schema("name string, line_no long, reason string, raw string").json(f"{q}/version=1").collect()
    assert sorted(tuple(r) for r in rows) == [(n, None, "other_suffix", None) for n in ("notes.json.bak", "x.JSON", "x.txt")]
    assert sorted(os.listdir(drop)) == ["notes.json.bak", "x.JSON", "x.txt"]


def test_lines_stay_in_place_for_their_numbers(spark, tmpdir_shared):
    os.makedirs(f"{tmpdir_shared}/drop")
    with open(f"{tmpdir_shared}/drop/a.json", "w") as f:
        f.write("\n".join(['{"question":"q","answer":"a"}', "", "bad", '{"question":"r","answer":"b"}']))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = dropdir._stage_lines(spark, [f"{tmpdir_shared}/drop/a.json"], f"{tmpdir_shared}/st")
        assert sorted(r["line_no"] for r in lines.collect()) == [1, 3, 4]
        assert "SortMergeJoin" not in lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
