"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct 5-word shingles.  Its sketch has M registers;
register i holds floor(1 - log_b(x_i)), clamped to 16 bits, where x_i is the
least of independent exponential variables that the set's members draw: an
exponentially spaced, truncated minimum.  The register-wise maximum of two
sketches is the sketch of the union (``merge_sketches``).  Members draw from
one Poisson stream whose points fall on random registers, so only a few points
per member are looked at.

Bands of ROWS registers propose candidates, a likelihood estimate over the
registers of both sketches (Jaccard given the two set sizes) drops hopeless
ones, and the rest are verified on their full sets.  Within a band value all
documents are compared with one leader first (another one for each band value),
so a large group of copies costs a row per copy and band, not its square.
Documents of a band value that are still in different components after that
are compared pair by pair if they are few (SMALL); those of larger band values
go through an exact set-similarity join (rarest shingles first; prefix, length
and positional filters), in which documents that merely share much text with
many others meet hardly anyone.

With threshold 0.75, 40 bands of 5 registers miss a pair at the threshold with
probability 2e-5, and at 0.8 with 1e-7.

Cases: null or empty text, or one without words: empty set, linked with
nothing.  Equal texts, rows repeated whole, rows sharing a doc_id: linked by
their sets.  Null doc_id: the row is returned, and never names a component
unless all doc_ids of the component are null.  Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from qamill.llm import hashing as H
from qamill.llm.tables import components, passing, released, staged
from qamill.session import ship_package

SHINGLE = 5
BANDS, ROWS = 40, 5
M = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65535
THRESHOLD = (75, 100)
#: Candidates whose likelihood at the threshold is e**-LOG_RATIO of the best are dropped.
LOG_RATIO = 25.0
#: Documents left in one band value that are compared pair by pair.
SMALL = 16


def sketches(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """SetSketch registers (rows x M, uint16) of each row's set of 64-bit values."""
    rows = len(bounds) - 1
    least = np.full(rows * M, np.inf)
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(bounds))
    seeds, x = values, np.zeros(len(values))
    step = 0
    while len(seeds):
        step += 1
        u = H.mix64(seeds ^ H.mix64(np.array([step], dtype=H.U64)))
        x += -np.log(((u >> H.U64(12)).astype(np.float64) + 0.5) * 2.0 ** -52) / (M * RATE)
        np.minimum.at(least, row * M + ((u & H.U64(4095)).astype(np.int64) * M >> 12), x)
        go = x < least.reshape(rows, M).max(axis=1)[row]
        seeds, row, x = seeds[go], row[go], x[go]
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(least) / np.log(BASE))
    return np.clip(np.where(np.isinf(least), 0, k), 0, TOP).astype(np.uint16).reshape(rows, M)


def merge_sketches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def _log_likelihood(j, above, below, equal, u, v):
    """Log-likelihood of Jaccard j for register counts, set shares u and v (u + v = 1)."""
    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    hi, lo = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    return (above * np.log(np.maximum(hi, tiny)) + below * np.log(np.maximum(lo, tiny))
            + equal * np.log(np.maximum(1 - hi - lo, tiny)))


def joint_estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood Jaccard of sketch pairs (rows x M) with set sizes, and the
    log-likelihood lost at THRESHOLD (0 if the estimate is above it)."""
    above, below = (a > b).sum(1), (a < b).sum(1)
    equal = M - above - below
    u = na / (na + nb)
    v = 1 - u
    lo, hi = np.zeros(len(u)), np.minimum(na, nb) / np.maximum(na, nb)
    for _ in range(40):  # concave in j
        s, t = lo + (hi - lo) * 0.382, lo + (hi - lo) * 0.618
        left = _log_likelihood(s, above, below, equal, u, v) > _log_likelihood(t, above, below, equal, u, v)
        hi, lo = np.where(left, t, hi), np.where(left, lo, s)
    j = (lo + hi) / 2
    want = THRESHOLD[0] / THRESHOLD[1]
    lost = (_log_likelihood(j, above, below, equal, u, v)
            - _log_likelihood(np.minimum(want, np.minimum(na, nb) / np.maximum(na, nb)), above, below, equal, u, v))
    return j, np.where(j >= want, 0.0, lost)


def _rows(batches, with_sets: bool):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for a, b, buf, offs in H.text_slices(ids, texts):
            starts, ends, bounds = H.word_spans(buf, offs, H.SPACE)
            sh, sb = H.shingles(H.word_hashes(buf, starts, ends), bounds, SHINGLE)
            sh, sb = H.distinct_by_row(sh, sb)
            keys = pa.array(H.set_keys(sh, sb), pa.binary())
            if with_sets:
                yield pa.RecordBatch.from_arrays([keys, H.long_lists(sh, sb)], names=["set_key", "members"])
            else:
                registers = sketches(sh, sb)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(np.diff(sb)), keys,
                     pa.array([r.tobytes() for r in registers], pa.binary())],
                    names=["doc_id", "n_shingles", "set_key", "sketch"])


def sketch_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits), sketch of every document; two passes need no shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lambda it: _rows(it, False), "doc_id long, n_shingles long, set_key binary, sketch binary")


def _shingle_sets(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lambda it: _rows(it, True), "set_key binary, members array<long>")


def _hopeful() -> Column:
    @F.pandas_udf(T.BooleanType())
    def hopeful(a: pd.Series, b: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        one, two = (np.frombuffer(b"".join(s), dtype=np.uint16).reshape(-1, M) for s in (a, b))
        return pd.Series(joint_estimate(one, two, na.to_numpy(float), nb.to_numpy(float))[1] <= LOG_RATIO)
    return hopeful


def _sets(spark: SparkSession, docs: DataFrame, classes: DataFrame, needed: DataFrame) -> DataFrame:
    """class, members of the classes needed, from their documents' texts."""
    needed = classes.select("class", "set_key", "doc_id").join(needed, "class")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").alias("d").join(
        needed.select(F.col("doc_id").alias("needed_id")).distinct(), F.expr("d.doc_id <=> needed_id"), "left_semi")
    return staged(spark, _shingle_sets(texts).join(needed.select("set_key", "class"), "set_key")
                  .dropDuplicates(["class"]).select("class", "members"), "sets")


def _reach(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) those whose sets reach the threshold: 100 i >= 75 (na + nb - i)."""
    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("members").alias("ma")), "a").join(
        sets.select(F.col("class").alias("b"), F.col("members").alias("mb")), "b")
    return both.where(F.size(F.array_intersect("ma", "mb")) * (THRESHOLD[1] + THRESHOLD[0])
                      >= (F.size("ma") + F.size("mb")) * THRESHOLD[0]).select("a", "b")


def verified(spark: SparkSession, docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of pairs (a, b) of class ids, a staged table, those whose full sets reach the threshold; staged."""
    used = pairs.select("a").union(pairs.select(F.col("b").alias("a"))).distinct()
    # Sketches of the classes that pairs may name; the others are not shuffled.
    near = classes.where(passing(used, "class"))
    side = lambda c: near.select(F.col("class").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("na", "nb") * THRESHOLD[1] >= F.greatest("na", "nb") * THRESHOLD[0])
    hopeful = staged(spark, sized.where(_hopeful()("sa", "sb", "na", "nb")).select("a", "b"), "candidates")
    needed = hopeful.select(F.col("a").alias("class")).union(hopeful.select(F.col("b").alias("class"))).distinct()
    sets = _sets(spark, docs, classes, needed)
    out = staged(spark, _reach(hopeful, sets), "links")
    released(spark, hopeful, sets)
    return out


def similar_sets(spark: SparkSession, sets: DataFrame) -> DataFrame:
    """All pairs (a, b) of different labels among sets (class, label, members) that reach the threshold, exactly.

    Members are ordered by how many sets hold them, rarest first; two similar
    sets share one of their first n - ceil(0.75 n) + 1.  A member's place in
    both bounds what can still be common.  Of the sets that hold a member,
    those of the commonest label are looked up, never looking: every pair of
    different labels has a set that isn't of it.
    """
    part, whole = THRESHOLD
    n = F.size("members")
    each = sets.select("class", "label", n.alias("n"), F.explode("members").alias("member"))
    count = each.groupBy("member").agg(F.count(F.lit(1)).alias("held"))
    place = F.row_number().over(W.partitionBy("class").orderBy("held", "member"))
    ranked = each.join(count, "member").withColumn("place", place).where(
        (F.col("held") > 1) & (F.col("place") <= F.col("n") - F.ceil(F.col("n") * part / whole) + 1))
    ranked = staged(spark, ranked.select("class", "label", "n", "member", "place"), "prefixes")
    common = ranked.groupBy("member", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("member").agg(
        F.max_by("label", F.struct("k", "label")).alias("common"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    looking = ranked.join(common, "member").where("label <> common").select(
        "member", *[F.col(c).alias(f"{c}a") for c in ("class", "label", "n", "place")])
    found = ranked.select("member", *[F.col(c).alias(f"{c}b") for c in ("class", "label", "n", "place")])
    left = F.least(F.col("na") - F.col("placea"), F.col("nb") - F.col("placeb")) + 1
    pairs = looking.join(found, (looking["member"] == found["member"]) & (F.col("labela") != F.col("labelb"))
                         & (F.least("na", "nb") * whole >= F.greatest("na", "nb") * part)
                         & (left * (part + whole) >= (F.col("na") + F.col("nb")) * part))
    pairs = pairs.select(F.least("classa", "classb").alias("a"), F.greatest("classa", "classb").alias("b")).distinct()
    return _reach(staged(spark, pairs, "candidates"), sets.select("class", "members"))


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept, per row of docs."""
    ship_package(spark)
    sketched = staged(spark, sketch_documents(docs), "sketched")
    # One class for each distinct set: copies go no further.
    classes = staged(spark, sketched.where("n_shingles > 0").dropDuplicates(["set_key"])
                     .withColumn("class", F.monotonically_increasing_id()), "classes")
    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        i, F.substring("sketch", i * (2 * ROWS) + 1, F.lit(2 * ROWS))))
    # From here on the sketches are those of the classes alone.
    named = staged(spark, sketched.drop("sketch"), "sizes")
    released(spark, sketched)
    banded = classes.select("class", F.explode(band).alias("bucket"))
    leaders = banded.groupBy("bucket").agg(
        F.min(F.col("class").bitwiseXOR(F.col("bucket"))).alias("x"), F.count(F.lit(1)).alias("k")).where("k > 1")
    leaders = leaders.select("bucket", F.col("x").bitwiseXOR(F.col("bucket")).alias("leader"))
    members = staged(spark, banded.join(leaders, "bucket"), "buckets")
    stars = members.where("class <> leader").select(F.least("class", "leader").alias("a"), F.greatest("class", "leader").alias("b")).distinct()
    stars = staged(spark, stars, "stars")
    links = verified(spark, docs, classes, stars)
    released(spark, stars)
    labels = staged(spark, components(spark, links), "labels")
    # What the leaders left apart: members of a band value in different components.
    placed = members.where("class <> leader").join(labels.withColumnRenamed("node", "class"), "class", "left").select(
        "bucket", "class", F.coalesce("label", "class").alias("label"))
    mixed = placed.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("k")).where(
        "x < y").select("bucket", "k")
    apart = staged(spark, placed.join(mixed, "bucket"), "apart")
    released(spark, members)
    few, many = apart.where(F.col("k") <= SMALL), apart.where(F.col("k") > SMALL).select("class", "label").distinct()
    pairs = few.select("bucket", F.col("class").alias("a"), F.col("label").alias("la")).join(
        few.select("bucket", F.col("class").alias("b"), F.col("label").alias("lb")), "bucket").where("a < b and la <> lb").select("a", "b").distinct()
    pairs = staged(spark, pairs, "pairs")
    more = verified(spark, docs, classes, pairs)
    released(spark, pairs)
    if not many.isEmpty():
        many = staged(spark, many.join(_sets(spark, docs, classes, many.select("class")), "class"), "sets")
        more = staged(spark, more.union(similar_sets(spark, many)), "links")
    if not more.isEmpty():
        labels = staged(spark, components(spark, links.union(more)), "labels")
    named = named.join(
        classes.select("set_key", "class").join(labels.withColumnRenamed("node", "class"), "class", "left")
        .select("set_key", F.coalesce("label", "class").alias("label")), "set_key", "left")
    least = named.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    return named.join(least, "label", "left").select(
        "doc_id", "n_shingles", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
