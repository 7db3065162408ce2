"""Quality rules whose cutoffs are chosen under risk control.

Counts of every text are made with Spark functions.  Each rule rejects a
document whose measure is beyond a cutoff, and a level of strictness holds one
cutoff for every rule.  Labelled documents (labels: quality 1 is good) are the
holdout.  Per stratum (lang), the levels are tested from the most lenient on:
the hypothesis "the rules of this level together reject more than ALPHA of the
good documents" is rejected if the exact binomial probability of so few
rejections is at most DELTA / strata.  The first level that fails ends the
sequence, and the last that passed is used; none passes where good documents
are too few (437 are needed at 1 % and 4 strata).  With probability 1 - DELTA,
at most a share ALPHA of the good documents of every stratum is rejected: the
sequence in fixed order needs no correction for its levels, strata are
corrected for by Bonferroni.  Equal texts of a stratum count as one label, as
copies say nothing new.

Cases: null or empty text: no words, base_failed.  Null lang is a stratum of
its own.  A doc_id labelled several times is good if any label says so.
Labels with null doc_id or quality, and labels without a document, count for
nothing.  Repeated rows are judged row by row.  Without labels, no level
passes.  Very long texts: a text is one row's work, in memory of some 100 bytes
a word.  Empty table: no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from qamill.llm.columns import covered, let, words
from qamill.llm.tables import staged

ALPHA, DELTA = 0.01, 0.05
MIN_WORDS = 50
#: Rows of cutoffs that are sent to every task; more are joined by a shuffle.
BROADCAST_ROWS = 10_000

#: Rule: (measure of the counts, +1 if large values are bad, its cutoff at each level, from lenient to strict).
RULES: dict[str, tuple[str, int, tuple[float, ...]]] = {
    "symbols_per_word": ("n_symbols / n_words", 1, (1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05)),
    "dup_line_share": ("n_dup_lines / n_lines", 1, (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    "repeat_share": ("n_repeat_words / n_words", 1, (0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)),
    "long_words": ("word_chars / n_words", 1, (30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0, 11.0, 10.0)),
    "short_words": ("word_chars / n_words", -1, (1.0, 1.2, 1.5, 1.8, 2.0, 2.3, 2.5, 3.0, 3.5)),
}
LEVELS = 9


def _repeated(w: Column) -> Column:
    """Words in 3-word windows that are found twice or more: windows are sorted by hash, and
    those equal to a neighbour are marked."""
    hashes = F.transform(w, lambda x: F.xxhash64(x))
    windows = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.struct(
        F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)).alias("h"), i.alias("at")))
    twin = lambda s: F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                              | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
    places = let(let(hashes, lambda h: F.array_sort(windows(h))), twin)
    return F.when(F.size(w) >= 3, covered(F.sort_array(F.transform(places, lambda x: x["at"])), 3)).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with a struct column ``quality_counts`` of whole-text counts."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumn("quality_words", words(F.col(text).cast("string"))).withColumn("quality_lines", lines)
    return out.withColumn("quality_counts", F.struct(
        F.size("quality_words").cast("long").alias("n_words"),
        F.length(F.array_join("quality_words", "")).cast("long").alias("word_chars"),
        (F.octet_length(body) - F.octet_length(F.regexp_replace(body, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("quality_lines") - F.size(F.array_distinct("quality_lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("quality_words")).alias("n_repeat_words"),
        F.size("quality_lines").cast("long").alias("n_lines"),
        F.xxhash64(body).alias("text_key"),
    )).drop("quality_words", "quality_lines")


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (c["n_repeat_words"] * 100 > c["n_words"] * 50)


def _measures(c: Column) -> dict[str, Column]:
    out = {}
    for rule, (measure, _, _) in RULES.items():
        over, under = measure.split(" / ")
        out[rule] = F.when(c[under] > 0, c[over] / c[under]).otherwise(F.lit(0.0))
    return out


def tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), summed term by term from logarithms."""
    step = lambda acc, i: F.struct(
        (acc["log"] + F.log((n - i) / (i + 1)) + math.log(p / (1 - p))).alias("log"), (acc["sum"] + F.exp(acc["log"])).alias("sum"))
    first = F.struct((n * math.log(1 - p)).cast("double").alias("log"), F.lit(0.0).alias("sum"))
    return F.when(k >= n, F.lit(1.0)).otherwise(F.aggregate(F.sequence(F.lit(0).cast("long"), k), first, step, lambda acc: acc["sum"]))


def labelled_good(labels: DataFrame) -> DataFrame:
    """labelled_id of the documents labelled as good."""
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("labelled_id")).agg(
        F.max("quality").alias("q")).where("q = 1").select("labelled_id")


def cutoffs(spark: SparkSession, counted: DataFrame, labels: DataFrame, stratum: str, alpha: float = ALPHA, delta: float = DELTA,
            strata: int | None = None) -> DataFrame:
    """stratum, and a map of rule to cutoff, of the strata where a level passed.  counted: doc_id, stratum, quality_counts.
    strata: how many there are in all, where counted holds no more than the labelled documents."""
    good = labelled_good(labels)
    c = F.col("quality_counts")
    held = counted.join(good, counted["doc_id"] == good["labelled_id"], "left_semi").where(~base_failed(c))
    # How many levels, from the lenient end, leave the document alone.
    alone = F.least(*[sum(((value * RULES[rule][1] <= x * RULES[rule][1]).cast("int") for x in RULES[rule][2]), F.lit(0))
                      for rule, value in _measures(c).items()])
    each = held.select(F.col(stratum).alias("stratum"), c["text_key"].alias("text"), alone.alias("alone")).distinct()
    seen = each.groupBy("stratum", "alone").agg(F.count(F.lit(1)).alias("k"))
    # One row per stratum and level.
    total = seen.groupBy("stratum").agg(
        F.sum("k").alias("n"), F.map_from_entries(F.collect_list(F.struct("alone", "k"))).alias("by_level"))
    if strata is None:
        strata = counted.select(F.col(stratum).alias("stratum")).distinct().count()
    tested = total.select("stratum", "n", "by_level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level"))
    # Rejected at this level: documents that so many levels, or fewer, leave alone.
    tested = tested.withColumn("k", F.aggregate(
        F.map_values(F.map_filter("by_level", lambda a, _: a <= F.col("level"))), F.lit(0).cast("long"), lambda acc, x: acc + x))
    # Beyond the expected number no test can pass, and its sum need not be made.
    p = F.when(F.col("k") <= F.col("n") * alpha, tail(F.col("k"), F.col("n"), alpha)).otherwise(F.lit(1.0))
    passed = tested.withColumn("ok", F.min((p <= delta / max(strata, 1)).cast("int")).over(
        W.partitionBy("stratum").orderBy("level"))).where("ok = 1")
    last = passed.groupBy("stratum").agg(F.max("level").alias("level"))
    chosen = F.map_from_arrays(F.array(*[F.lit(r) for r in RULES]), F.array(*[
        F.get(F.array(*[F.lit(x) for x in grid]), F.col("level")) for _, _, grid in RULES.values()]))
    return last.select("stratum", chosen.alias("quality_cutoffs"))


def judged(spark: SparkSession, counted: DataFrame, chosen: DataFrame, stratum: str) -> DataFrame:
    """counted with boolean columns base_failed and quality_kept."""
    chosen = staged(spark, chosen.withColumnRenamed("stratum", "quality_stratum"), "cutoffs")
    chosen = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
    c = F.col("quality_counts")
    beyond = F.lit(False)
    for rule, value in _measures(c).items():
        sign = RULES[rule][1]
        beyond = beyond | F.coalesce(value * sign > F.col("quality_cutoffs")[rule] * sign, F.lit(False))
    out = counted.join(chosen, F.col(stratum).eqNullSafe(F.col("quality_stratum")), "left")
    return out.withColumn("base_failed", base_failed(c)).withColumn("quality_kept", ~(base_failed(c) | beyond)).drop(
        "quality_stratum", "quality_cutoffs")


def op6_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    counted = staged(spark, measured(docs).drop("text"), "counted")
    chosen = cutoffs(spark, counted, spark.read.parquet(f"{sf_dir}/labels.parquet"), "lang")
    c = F.col("quality_counts")
    return judged(spark, counted, chosen, "lang").select(
        "doc_id", *[c[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed", F.col("quality_kept").alias("kept"))


def _oracle() -> str:
    rules = ",\n  ".join(
        f"('{r}', {i}, {s}, {c!r})" for r, (_, s, g) in RULES.items() for i, c in enumerate(g))
    values = "\n  UNION ALL ".join(
        f"SELECT r, '{r}' AS rule, CASE WHEN {m.split(' / ')[1]} > 0 THEN {m.replace(' / ', '::DOUBLE / ')} ELSE 0.0 END AS v FROM c" for r, (m, _, _) in RULES.items())
    return rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS x FROM documents),
w AS (SELECT r, doc_id, lang, x, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda a: a <> '') AS w,
  list_filter(string_split(x, chr(10)), lambda a: regexp_matches(a, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS k FROM g) WHERE k > 1),
p AS (SELECT r, count(DISTINCT i + j) AS n FROM d, (SELECT unnest([0, 1, 2]) AS j) GROUP BY r),
c AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM (
  SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(x) - length(regexp_replace(x, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines, w.r AS r, x FROM w LEFT JOIN p ON w.r = p.r)),
v AS ({values}),
rules(rule, level, sign, cutoff) AS (VALUES {rules}),
rejected AS (SELECT r, level, bool_or(v * sign > cutoff * sign) AS rejected FROM v JOIN rules USING (rule) GROUP BY r, level),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1),
held AS (SELECT lang, x, level, any_value(rejected) AS rejected FROM c JOIN rejected USING (r) SEMI JOIN good USING (doc_id)
  WHERE NOT base_failed GROUP BY lang, x, level),
k AS (SELECT lang, level, count(*) AS n, count(*) FILTER (rejected) AS k FROM held GROUP BY lang, level),
s AS (SELECT *, {ALPHA!r} AS a, {DELTA!r} / (SELECT count(*) FROM (SELECT DISTINCT lang FROM documents)) AS e FROM k),
q AS (SELECT *, CASE WHEN k > n * a THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda j:
  exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(a) + (n - j) * ln(1 - a)))) END AS pv FROM s),
ok AS (SELECT lang, max(level) AS level FROM (
  SELECT *, min((pv <= e)::INT) OVER (PARTITION BY lang ORDER BY level) AS good FROM q) WHERE good = 1 GROUP BY lang)
SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(z.rejected, FALSE) AS kept
FROM c LEFT JOIN ok ON ok.lang IS NOT DISTINCT FROM c.lang LEFT JOIN rejected z ON z.r = c.r AND z.level = ok.level
"""


ORACLE = _oracle()
