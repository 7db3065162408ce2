import math
from collections import Counter

import pytest
from helpers import WORD, documents, texts
from pyspark.sql import functions as F

from qamill.llm import quality as Q


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    many = Counter(windows)
    places = {i + j for i, x in enumerate(windows) if many[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(places), len(lines))


def test_counts(spark):
    rows = texts() + [(900, "# $$ a<b>\n*\n\n x | &&% é€😀\n*"), (901, "a b a b a b a"), (902, "a b"), (None, "no id")]
    got = {r.doc_id: tuple(r.quality_counts)[:6] for r in Q.measured(documents(spark, rows)).collect()}
    assert got == {i: counts(t) for i, t in rows}


def exact(k, n, p):
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)) for j in range(k + 1))


def test_binomial_tail(spark):
    cases = [(0, 10, 0.1), (3, 10, 0.1), (10, 10, 0.1), (0, 5000, 0.002), (4, 5000, 0.002), (2500, 1_000_000, 0.003)]
    for k, n, p in cases:
        got = spark.range(1).select(Q.tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        assert got == pytest.approx(exact(k, n, p) if k < n else 1.0, rel=1e-6)


def labelled(spark, n=400, bad_good=0):
    """Good documents of plain words (the first bad_good of them full of signs), and bad ones full of signs."""
    plain = [(i, " ".join(f"word{(i * 7 + j) % 977}x{j % 5}" for j in range(60)) + (" ###" * 40 if i < bad_good else "")) for i in range(n)]
    junk = [(n + i, " ".join(f"w{(i * 3 + j) % 977}###" for j in range(60))) for i in range(50)]
    docs = documents(spark, plain + junk).withColumn("lang", F.lit("en"))
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in plain] + [(i, 0, 1) for i, _ in junk] + [(None, 1, 0), (5, None, None), (10**9, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def chosen(spark, docs, labels, **kw):
    counted = Q.measured(docs.select("doc_id", "lang", "text")).drop("text")
    return counted, Q.cutoffs(spark, counted, labels, "lang", **kw)


def test_cutoffs_follow_the_exact_bound(spark):
    docs, labels = labelled(spark, bad_good=2)
    assert exact(2, 400, 0.04) < 0.02
    _, cut = chosen(spark, docs, labels, alpha=0.04, delta=0.02)
    # Two good documents have more signs than words; that many rejections are within the bound at every level.
    assert cut.first()["quality_cutoffs"] == {r: g[-1] for r, (_, _, g) in Q.RULES.items()}
    docs, labels = labelled(spark, bad_good=40)
    _, cut = chosen(spark, docs, labels, alpha=0.04, delta=0.02)
    assert cut.collect() == []  # forty are too many already at the first level


def test_sequence_ends_at_the_first_level_that_fails(spark):
    """Good documents with a sign every third word: levels whose cutoff leaves them alone pass, the next one ends the sequence."""
    docs, labels = labelled(spark)
    signs = docs.withColumn("text", F.when(F.col("doc_id") < 100, F.concat("text", F.lit(" " + "#" * 20))).otherwise(F.col("text")))
    _, cut = chosen(spark, signs, labels, alpha=0.04, delta=0.02)
    got = cut.first()["quality_cutoffs"]
    share = 20 / 61
    last = max(i for i, c in enumerate(Q.RULES["symbols_per_word"][2]) if c >= share)
    assert got == {r: g[last] for r, (_, _, g) in Q.RULES.items()}


def test_how_many_labels_are_enough(spark):
    """437 good documents at 1 % and four strata; equal texts are one label."""
    for n, enough in ((437, True), (436, False)):
        docs, labels = labelled(spark, n)
        _, cut = chosen(spark, docs, labels, alpha=0.01, delta=0.05 / 4)
        assert (cut.count() == 1) == enough
    docs, labels = labelled(spark, 500)
    same = docs.withColumn("text", F.when(F.col("doc_id") < 100, F.lit("one text of some words " * 1 + " ".join(f"u{i}" for i in range(60)))).otherwise(F.col("text")))
    assert chosen(spark, same, labels, alpha=0.01, delta=0.05 / 4)[1].count() == 0


def test_judged(spark):
    docs, labels = labelled(spark)
    counted, cut = chosen(spark, docs, labels, alpha=0.2, delta=0.1)
    kept = {r.doc_id: r.quality_kept for r in Q.judged(spark, counted, cut, "lang").collect()}
    assert all(kept[i] for i in range(400)) and not any(kept[400 + i] for i in range(50))


def test_too_few_labels_empty_tables_and_nulls(spark, tmp_path):
    rows = texts()[:30] + [(None, "x " * 60), (3, "again"), (3, "again")]
    for name, docs, labels in (("a", rows, [(20, 1, 0), (20, 0, 0)]), ("b", rows, []), ("c", [], [(1, 1, 0)])):
        d = f"{tmp_path}/{name}"
        documents(spark, docs).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        got = Q.op6_risk_controlled_quality(spark, d).collect()
        want = sorted(((str(i), *counts(t)[:5]) for i, t in docs))
        assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
        assert all(r.kept == (not r.base_failed) and r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)
