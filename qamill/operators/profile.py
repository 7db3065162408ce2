"""Dataset report numbers: distributions, lengths, box, histogram, missing
types, history, explorer (A3-A12, P6, P7, P9, R6, R7).

Everything is an aggregate with map-side partial aggregation.  Quantiles are
computed from the *value histogram* (one row per distinct value), so memory
is bounded by the number of distinct lengths, never by the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qamill.functions.text import keyword_match, word_count
from qamill.session import scratch_dir

# Question types the retraining report expects to see (A10).
EXPECTED_TYPES: tuple[str, ...] = ("symptoms", "complications", "dietary", "genetic changes")

# The offline metadata's drop counters, in their written order (A4).
DROP_KEYS: tuple[str, ...] = (
    "missing_question", "missing_answer", "blank_question", "blank_answer", "total_dropped")


def with_total(grouped: DataFrame, count_col: str, by: Sequence[str] = (),
               out: str = "_total") -> DataFrame:
    """Attach the (per-group) sum of ``count_col`` to an *aggregated* frame
    (one row per distinct value), with a window over that small frame.
    """
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return grouped.withColumn(out, F.sum(count_col).over(w))


def distribution(df: DataFrame, column: str = "question_type", include_null: bool = True,
                 by: Sequence[str] = ()) -> DataFrame:
    """Rows per value with their share of all rows; case-sensitive (A5)."""
    src = df if include_null else df.where(F.col(column).isNotNull())
    g = src.groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))
    g = with_total(g, "n", by)
    return g.select(*by, column, "n", (F.col("n") / F.col("_total")).alias("share"))


def distinct_values(df: DataFrame, column: str = "question_type", include_null: bool = True) -> DataFrame:
    """Distinct values, with null (offline form) or without (retraining form)."""
    d = df.select(column).distinct()
    return d if include_null else d.where(F.col(column).isNotNull())


def missing_values(df: DataFrame, column: str = "question_type",
                   expected: Iterable[str] = EXPECTED_TYPES, by: Sequence[str] = ()) -> DataFrame:
    """Expected values absent from the data, compared lower-cased (A10).

    With ``by``, one answer per group.  The expected list is exploded per group
    (no cartesian product) and anti-joined with the present values.
    """
    exp = F.explode(F.array(*[F.lit(e) for e in expected])).alias("missing_type")
    if by:
        groups = df.select(*by).distinct().select(*by, exp)
    else:
        groups = df.sparkSession.range(1).select(exp)
    present = df.select(*by, F.lower(F.col(column)).alias("missing_type")).distinct()
    return groups.join(present, [*by, "missing_type"], "left_anti")


def with_word_count(df: DataFrame, column: str = "question", out: str = "question_length") -> DataFrame:
    """Add the number of whitespace-separated words."""
    return df.withColumn(out, word_count(column))


def _value_histogram(df: DataFrame, x: str, by: Sequence[str]) -> DataFrame:
    vals = df.where(F.col(x).isNotNull()).groupBy(*by, x).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*by).orderBy(x) if by else Window.orderBy(x)
    wn = Window.partitionBy(*by) if by else Window.partitionBy()
    return (vals.withColumn("_cum", F.sum("_c").over(w))
            .withColumn("_n", F.sum("_c").over(wn)))


def box_stats(df: DataFrame, x: str = "question_length", by: Sequence[str] = (),
              method: str = "linear") -> DataFrame:
    """Box summary: min, quartiles, max, fences, whiskers, outliers.

    ``linear`` is the usual type-7 quantile (position ``(n-1)q``);
    ``hazen`` is position ``qn + 0.5`` clamped to ``[1, n]``.  Interpolation:
    ``lo + (hi - lo) * frac``.  Everything is computed on the value histogram
    (one row per distinct value and group): quartiles and fences as window
    columns over it, then one aggregate per group.  Whiskers are the extreme
    values inside the fences; outliers are the rows outside.
    """
    if method not in ("linear", "hazen"):
        raise ValueError(method)
    h = _value_histogram(df, x, by)
    grp = Window.partitionBy(*by) if by else Window.partitionBy()
    n = F.col("_n").cast("double")
    qs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    for name, q in qs.items():
        if method == "linear":
            p = (n - 1) * F.lit(q)
        else:
            p = F.least(F.greatest(n * F.lit(q) + F.lit(0.5), F.lit(1.0)), n) - F.lit(1.0)
        lo = F.min(F.when(F.col("_cum") >= F.floor(p) + 1, F.col(x))).over(grp).cast("double")
        hi = F.min(F.when(F.col("_cum") >= F.ceil(p) + 1, F.col(x))).over(grp).cast("double")
        h = h.withColumn(name, lo + (hi - lo) * (p - F.floor(p)))
    h = (h.withColumn("iqr", F.col("q3") - F.col("q1"))
         .withColumn("lower_fence", F.col("q1") - F.lit(1.5) * F.col("iqr"))
         .withColumn("upper_fence", F.col("q3") + F.lit(1.5) * F.col("iqr")))
    inside = (F.col(x) >= F.col("lower_fence")) & (F.col(x) <= F.col("upper_fence"))
    return h.groupBy(*by).agg(
        F.first("_n").alias("n"),
        F.min(x).cast("double").alias("min"),
        *[F.first(c).alias(c) for c in ("q1", "median", "q3")],
        F.max(x).cast("double").alias("max"),
        *[F.first(c).alias(c) for c in ("iqr", "lower_fence", "upper_fence")],
        F.min(F.when(inside, F.col(x))).cast("double").alias("whisker_low"),
        F.max(F.when(inside, F.col(x))).cast("double").alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_c"))), F.lit(0)).cast("bigint").alias("n_outliers"))


#: Groups up to which a row for each is sent to every task.
FEW_GROUPS = 100_000


def _beside_all(small: DataFrame) -> DataFrame:
    """One row a group, computed once and written; broadcast when these are few, so that the rows of a group stay where they are."""
    path = scratch_dir(small.sparkSession, "groups")
    small.write.parquet(path)
    small = small.sparkSession.read.parquet(path)
    return F.broadcast(small) if small.count() <= FEW_GROUPS else small


#: Accuracy of the quantile sketch: its ranks are off by n / ACCURACY at most.
ACCURACY = 10_000


def box_continuous(df: DataFrame, x: str, by: Sequence[str] = (), whisker: float = 1.5, accuracy: int = ACCURACY) -> DataFrame:
    """``box_stats`` (linear) for a column with any number of distinct values.

    A mergeable quantile sketch brackets each quartile: it is asked for ranks
    eight errors below and above (a group of fewer than ``accuracy`` rows is one
    bracket).  One exact pass then counts the rows below each bracket and the
    values inside, about 16 / accuracy of the rows, among which the quartile is
    found by rank; a bracket that misses its rank stops the query.  A last pass
    takes whiskers and counts outliers.  Null and NaN values are left out.
    """
    groups = list(by) or ["_g"]
    rows = df if by else df.withColumn("_g", F.lit(0))
    v = F.col(x).cast("double")
    src = rows.select(*groups, v.alias("_x")).where(v.isNotNull() & ~F.isnan(v))
    qs = (0.25, 0.5, 0.75)
    off = 8.0 / accuracy
    ends = [max(0.0, min(1.0, q + s * off)) for q in qs for s in (-1, 1)]
    sketch = src.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("min"), F.max("_x").alias("max"),
                                      F.percentile_approx("_x", [float(e) for e in ends], accuracy).alias("_ends"))
    sketch = _beside_all(sketch)
    brackets = sketch.select(*groups, F.array(*[F.struct(
        F.lit(j).alias("j"), F.lit(q).alias("q"), F.when(F.col("n") < accuracy, F.col("min")).otherwise(F.get("_ends", F.lit(2 * j))).alias("lo"),
        F.when(F.col("n") < accuracy, F.col("max")).otherwise(F.get("_ends", F.lit(2 * j + 1))).alias("hi")) for j, q in enumerate(qs)]).alias("_b"))
    same = [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in groups]

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        """left with right's columns of the same group (a null group is one, too)."""
        extra = [c for c in right.columns if c not in groups]
        return left.alias("l").join(right.alias("r"), same).select("l.*", *[F.col(f"r.{c}") for c in extra])

    placed = beside(src, brackets).select(*groups, "_x", F.explode("_b").alias("b")).where(F.col("_x") <= F.col("b.hi"))
    # A null value stands for all rows below the bracket.
    inside = placed.groupBy(*groups, "b.j", "b.q", F.when(F.col("_x") >= F.col("b.lo"), F.col("_x")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    ranked = beside(inside.withColumn("cum", F.sum("c").over(Window.partitionBy(*groups, "j").orderBy(F.asc_nulls_first("v")))), sketch.select(*groups, "n"))
    p = (F.col("n") - 1).cast("double") * F.col("q")
    at = lambda rank: F.min(F.when(F.col("v").isNotNull() & (F.col("cum") >= rank + 1), F.col("v")))
    found = ranked.groupBy(*groups, "j").agg(at(F.floor(p)).alias("lo"), at(F.ceil(p)).alias("hi"), F.first(p - F.floor(p)).alias("part"),
                                               (F.coalesce(F.max(F.when(F.col("v").isNull(), F.col("c"))), F.lit(0)) <= F.min(F.floor(p))).alias("ok"))
    names = ("q1", "median", "q3")
    value = F.when(F.col("ok") & F.col("hi").isNotNull(), F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).otherwise(
        F.raise_error(F.lit("a quartile is outside its bracket")))
    wide = found.withColumn("value", value).groupBy(*groups).agg(
        *[F.max(F.when(F.col("j") == j, F.col("value"))).alias(name) for j, name in enumerate(names)])
    box = beside(sketch.select(*groups, "n", "min", "max"), wide)
    box = (box.withColumn("iqr", F.col("q3") - F.col("q1"))
           .withColumn("lower_fence", F.col("q1") - F.lit(whisker) * F.col("iqr"))
           .withColumn("upper_fence", F.col("q3") + F.lit(whisker) * F.col("iqr")))
    within = (F.col("_x") >= F.col("lower_fence")) & (F.col("_x") <= F.col("upper_fence"))
    box = _beside_all(box)
    edges = beside(src, box.select(*groups, "lower_fence", "upper_fence")).groupBy(*groups).agg(
        F.min(F.when(within, F.col("_x"))).alias("whisker_low"), F.max(F.when(within, F.col("_x"))).alias("whisker_high"),
        F.count_if(~within).alias("n_outliers"))
    return beside(box, edges).select(*by, "n", "min", *names, "max", "iqr", "lower_fence", "upper_fence", "whisker_low", "whisker_high", "n_outliers")


def box_outliers(df: DataFrame, x: str, box: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``df`` whose value lies outside the fences of ``box`` (one row a group): the points of the box plot."""
    groups = list(by) or ["_g"]
    fences = _beside_all((box if by else box.withColumn("_g", F.lit(0))).select(*groups, F.col("lower_fence").alias("_low"), F.col("upper_fence").alias("_high")))
    rows = (df if by else df.withColumn("_g", F.lit(0))).alias("l")
    v = F.col(f"l.{x}").cast("double")
    same = [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in groups]
    beside = rows.join(fences.alias("r"), same)
    return beside.where(~F.isnan(v) & ((v < F.col("_low")) | (v > F.col("_high")))).select(*[F.col(f"l.`{c}`") for c in df.columns])


def histogram(df: DataFrame, x: str = "question_length", max_bins: int = 30,
              by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram with at most ``max_bins`` bins.

    ``width = (max - min) / max_bins``; ``bin = least(max_bins-1, floor((x-min)/width))``;
    all values in one bin when ``max = min``.  Only non-empty bins are returned.
    """
    src = df.where(F.col(x).isNotNull())
    # Histogram of distinct values first (partial aggregation), then bins:
    # the ranges are windows over that small frame.
    vals = src.groupBy(*by, x).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    vals = (vals.withColumn("_lo", F.min(x).over(w).cast("double"))
                .withColumn("_hi", F.max(x).over(w).cast("double")))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(max_bins))
    b = (F.when(F.col("_hi") == F.col("_lo"), F.lit(0))
         .otherwise(F.least(F.lit(max_bins - 1),
                            F.floor((F.col(x).cast("double") - F.col("_lo")) / width).cast("int"))))
    binned = (vals.withColumn("bin", b.cast("int"))
              .withColumn("_w", F.when(F.col("_hi") == F.col("_lo"), F.lit(0.0)).otherwise(width)))
    out = binned.groupBy(*by, "bin").agg(
        F.sum("_c").cast("bigint").alias("n"),
        F.first("_lo").alias("_lo"), F.first("_w").alias("_w"))
    return out.select(*by, "bin",
                      (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_low"),
                      (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_high"),
                      "n")


def explore(df: DataFrame, types: Sequence[str] = (), keyword: str = "",
            type_column: str = "question_type", text_column: str = "question",
            literal: bool = False) -> DataFrame:
    """Explorer filter (P6, P7): exact, case-sensitive type selection and a
    case-insensitive keyword search; an empty selection / keyword is no filter.
    A missing type column (P9) means the type selection is ignored.
    """
    out = df
    if types and type_column in df.columns:
        out = out.where(F.col(type_column).isin(*list(types)))
    if keyword:
        out = out.where(keyword_match(text_column, keyword, literal))
    return out


def explore_counts(df: DataFrame, types: Sequence[str] = (), keyword: str = "",
                   type_column: str = "question_type", text_column: str = "question",
                   literal: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """"Showing m / n records": one aggregate over the unfiltered table (A12), per group of ``by``."""
    pred = F.lit(True)
    if types and type_column in df.columns:
        pred = pred & F.coalesce(F.col(type_column).isin(*list(types)), F.lit(False))
    if keyword:
        pred = pred & keyword_match(text_column, keyword, literal)
    return df.groupBy(*by).agg(F.count_if(pred).alias("shown"), F.count(F.lit(1)).alias("total"))


def dropped_rows(meta: DataFrame, keys: Sequence[str] = DROP_KEYS) -> DataFrame:
    """The drop counters as ``(type, count)`` rows, total included (A4)."""
    m = F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k).cast("bigint"))])
    return meta.select(F.explode(m).alias("type", "count"))


def history(meta: DataFrame, version: str = "version_tag", records: str = "record_count",
            timestamp: str = "timestamp") -> DataFrame:
    """Record counts over versions (A11): one row per version with metadata,
    missing count -> 0, ISO time parsed (UTC), ``seq`` = order by time with
    missing times last.  The frame has one row per version (small).
    """
    # ISO text in UTC ("...Z") read as its UTC wall clock, whatever the
    # session time zone; malformed text -> null.
    ts = F.col(timestamp).try_cast("timestamp_ntz")
    h = meta.select(F.col(version).alias("version"),
                    F.coalesce(F.col(records).cast("bigint"), F.lit(0).cast("bigint")).alias("records"),
                    ts.alias("timestamp"))
    w = Window.orderBy(F.col("timestamp").asc_nulls_last(), F.col("version"))
    return h.withColumn("seq", F.row_number().over(w).cast("int"))


def latest_version(versions: DataFrame, column: str = "version") -> DataFrame:
    """Highest version number, 0 when there is none."""
    return versions.agg(F.coalesce(F.max(column), F.lit(0)).cast("int").alias("latest_version"))
