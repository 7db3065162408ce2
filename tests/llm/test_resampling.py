import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from helpers import LOWER, documents, sentence, texts

from qamill.llm import resampling as R

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, low, high):
    w = WORDS.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + n]) for n in range(low, high + 1) for i in range(len(w) - n + 1)]


def expected(rows, target, low=1, high=1, buckets=10_000, percent=10, least=20, seed="2024"):
    """doc_id, n_features, weight, score, rank of every row, computed plainly."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(map(bucket, runs(x, low, high)[1]))
    for x in target:
        t.update(map(bucket, runs(x, low, high)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for i, x in rows:
        n, f = runs(x, low, high)
        weight = sum(gain[bucket(y)] for y in f) // len(f) if f else 0
        h = None if i is None else int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, n])
    may = sorted((r for r in out if r[5] >= least and r[0] is not None), key=lambda r: (-r[3], r[0], r[1], r[2]))
    for k, r in enumerate(may[:percent * len(may) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


def got(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def corpus():
    rng = random.Random(3)
    odd = ["Ünïcode, ÉÀ ſ K 日本語 x\x00y tab\tz", "a" * 5000, "- . , ;", "😀 B9-c_d'e"]
    rows = texts() + [(200 + k, x) for k, x in enumerate(odd)] + [(None, "some words " * 30), (9, "x y z w v"), (None, None)]
    return rows + [(1000 + i, sentence(rng, rng.randrange(15, 60), 300)) for i in range(300)] + [(1001, "twice " * 40), (1001, "twice " * 40)]


def target(spark, rows):
    return spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "item_id long, text string")


@pytest.mark.parametrize("kw", [{}, {"low": 1, "high": 3, "buckets": 97, "percent": 35}, {"low": 2, "high": 2, "least": 0, "percent": 100}])
def test_against_a_plain_version(spark, kw):
    rows, aim = corpus(), [sentence(random.Random(9), 50, 300), None, "", "X y z W v"]
    names = {"low": "shortest", "high": "longest", "least": "min_words"}
    found = R.resampled(spark, documents(spark, rows), target(spark, aim), **{names.get(k, k): v for k, v in kw.items()})
    assert got(found) == expected(rows, aim, **kw)


def test_long_texts_in_stretches(spark, monkeypatch):
    """Stretches change nothing, also for runs over their ends and words longer than a stretch."""
    for chunk in (1, 7, 64):
        monkeypatch.setattr(R, "CHUNK", chunk)
        for text in ("one two  three, four five " * 9, "x" * 300 + " y " + "é" * 80, "", "...", "a"):
            for low, high in ((1, 1), (1, 3), (3, 4)):
                n, f = runs(text, low, high)
                count = Counter(zlib.crc32(x.encode()) % 50 for x in f)
                assert R.Hasher(low, high, 50).count(text) == (n, dict(count))


def test_empty_tables(spark):
    assert R.resampled(spark, documents(spark, []), target(spark, ["a b"])).count() == 0
    rows = [(1, "a " * 25), (2, None), (3, "b " * 25)]
    assert got(R.resampled(spark, documents(spark, rows), target(spark, []), percent=50)) == expected(rows, [], percent=50)


def test_columns_that_clash(spark):
    rows = [(i, f"word{i} " * 30) for i in range(20)]
    df = documents(spark, rows)
    for name in ("weight", "score", "rank", "n_words", "n_features", "buckets", "counts"):
        df = df.withColumn(name, df.label)
    aim = target(spark, ["word3"]).withColumn("doc_id", R.F.lit("x"))
    assert got(R.resampled(spark, df, aim)) == expected(rows, ["word3"])


def test_query(spark, tmp_path):
    rows, aim = corpus()[:80], [sentence(random.Random(2), 30, 300)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    target(spark, aim).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = R.op13_importance_resampling(spark, str(tmp_path))
    assert out.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert got(out) == expected(rows, aim)
