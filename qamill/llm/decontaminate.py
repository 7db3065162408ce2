"""Benchmark decontamination by winnowing.

Of every GUARD consecutive k-grams of words the least hash is kept (all of the
least, if several are equal).  Two texts that share WINDOW = K + GUARD - 1
words in a row therefore share a fingerprint, whatever stands around them.
Document and benchmark fingerprints are joined, and each hit is extended: all
windows of WINDOW words that hold the fingerprint are compared by their own
64-bit hashes, which travel with it.  Items of fewer words than WINDOW are one
window; documents are probed for windows of those lengths at every place.

Before the join, a bit table of fixed size (2 MB), filled from the benchmark's
fingerprints, drops most fingerprints of the documents that cannot join.  It
fills up as the benchmark grows, and then drops less; the join decides.

Cases: null or empty texts, or texts without words: no words, nothing hit.
Repeated rows are judged row by row; several rows of one item_id count as one
item; a null item_id hits words, but isn't listed; ids may be of any type and are
listed as strings.  Very long texts: a slice of their own, some 100 bytes of memory a word.  Empty benchmark: nothing
hit.  Empty documents: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qamill.llm import hashing as H
from qamill.llm.tables import staged
from qamill.session import ship_package

WINDOW, K = 10, 5
GUARD = WINDOW - K + 1
BITS = 24
_WINNOWED = H.U64(0x5851F42D4C957F2D)


def winnow(grams: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Which k-grams are kept; whole[i]: grams i .. i+GUARD-1 are of one row."""
    kept = np.zeros(len(grams), dtype=bool)
    m = len(whole)
    if not m:
        return kept
    least = grams[:m].copy()
    for d in range(1, GUARD):
        np.minimum(least, grams[d:d + m], out=least)
    for d in range(GUARD):
        kept[d:d + m] |= whole & (grams[d:d + m] == least)
    return kept


def _passes(keys: np.ndarray, table: np.ndarray | None) -> np.ndarray:
    if table is None:
        return np.ones(len(keys), dtype=bool)
    ok = np.ones(len(keys), dtype=bool)
    for j in range(3):
        p = (keys >> H.U64(20 * j)) & H.U64((1 << BITS) - 1)
        ok &= (table[(p >> H.U64(6)).astype(np.int64)] >> (p & H.U64(63))) & H.U64(1) == 1
    return ok


def _probe_rows(batches, table, short: list[int] | None):
    """short: lengths to look for everywhere; None: rows under WINDOW words are one window (items)."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for a, b, buf, offs in H.text_slices(ids, texts):
            starts, ends, bounds = H.word_spans(buf, offs, H.NOT_ALNUM)
            words = H.word_hashes(buf, starts, ends)
            n = np.diff(bounds)
            row = np.repeat(np.arange(len(n)), n)
            whole = (row[:len(row) - WINDOW + 1] == row[WINDOW - 1:]) if len(row) >= WINDOW else np.zeros(0, bool)
            grams = H.window_hashes(words, K)
            wins = np.zeros(len(words) + GUARD, dtype=H.U64)
            if len(whole):
                wins[:len(whole)] = np.where(whole, H.window_hashes(words, WINDOW), H.U64(0))
            at = np.flatnonzero(winnow(grams, whole))
            keys = grams[at] ^ _WINNOWED
            ok = _passes(keys, table)
            at, keys = at[ok], keys[ok]
            # ctx[d]: the window that starts GUARD - 1 - d words before the k-gram.
            back = at[:, None] - (GUARD - 1) + np.arange(GUARD)[None, :]
            ctx = np.where((back >= 0) & (row[np.maximum(back, 0)] == row[at][:, None]), wins[np.maximum(back, 0)], H.U64(0))
            found = [(at, keys, np.full(len(at), WINDOW), ctx)]
            for m in range(1, WINDOW) if short is None else short:
                if short is None:
                    p = bounds[:-1][n == m]
                else:
                    p = np.flatnonzero(row[:max(len(row) - m + 1, 0)] == row[m - 1:])
                if len(p):
                    g = H.window_hashes(words, m)[p]
                    ok = _passes(g, table)
                    p, g = p[ok], g[ok]
                    c = np.zeros((len(p), GUARD), dtype=H.U64)
                    c[:, GUARD - 1] = g
                    found.append((p, g, np.full(len(p), m), c))
            at, keys, size, ctx = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(row[at], kind="stable") if len(at) else np.zeros(0, np.int64)
            at, keys, size, ctx = at[order], keys[order], size[order], ctx[order]
            per = np.concatenate([[0], np.cumsum(np.bincount(row[at], minlength=len(n)) if len(at) else np.zeros(len(n), np.int64))])
            where = pa.ListArray.from_arrays(pa.array(per, pa.int32()), pa.array((at - bounds[:-1][row[at]]).astype(np.int32) if len(at) else np.zeros(0, np.int32)))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.array(n.astype(np.int64)), H.long_lists(keys, per), where,
                 pa.ListArray.from_arrays(pa.array(per, pa.int32()), pa.array(size.astype(np.int32))),
                 H.long_lists(ctx.reshape(-1), per * GUARD)],
                names=["id", "n_words", "keys", "at", "sizes", "ctx"])


_SCHEMA = "id long, n_words long, keys array<long>, at array<int>, sizes array<int>, ctx array<long>"


def _probes(df: DataFrame, table, short) -> DataFrame:
    return df.mapInArrow(lambda it: _probe_rows(it, table, short), _SCHEMA)


def _exploded(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*more, F.posexplode("keys").alias("i", "key"), "at", "sizes", "ctx").select(
        *more, "key", F.element_at("sizes", F.col("i") + 1).alias("size"), F.element_at("at", F.col("i") + 1).alias("at"),
        F.slice("ctx", F.col("i") * GUARD + 1, GUARD).alias("ctx"))


def _table(items: DataFrame) -> np.ndarray:
    """The bit table of the items' keys: at most 2**18 words come to the driver, whatever the benchmark's size."""
    place = F.explode(F.array(*[F.expr(f"shiftrightunsigned(key, {20 * j}) & {(1 << BITS) - 1}L") for j in range(3)]))
    bits = items.select(place.alias("p")).groupBy(F.expr("shiftright(p, 6)").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    table = np.zeros(1 << (BITS - 6), dtype=np.int64)
    for r in bits.toLocalIterator():
        table[r["w"]] = r["bits"]
    return table.view(H.U64)


def covered(spans: Column) -> Column:
    """How many places an array of (at, size) spans covers."""
    step = lambda acc, x: F.struct(
        F.greatest(acc["end"], x["at"] + x["size"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), x["at"] + x["size"] - F.greatest(x["at"], acc["end"]))).alias("n"))
    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("end"), F.lit(0).cast("int").alias("n")), step, lambda acc: acc["n"].cast("long"))


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, item_ids (sorted as strings), spans (at, size of hit windows, in words)."""
    ship_package(spark)
    # Ids of any type, as the strings they are listed as; a hash names them on the way.
    name = F.col("item_id").cast("string")
    named = benchmark.select(F.xxhash64(name).alias("id"), name.alias("item_id"), F.col("text").cast("string").alias("text"))
    items = staged(spark, _exploded(_probes(named.select("id", "text"), None, None), "id").join(named.select("id", "item_id").distinct(), "id")
                   .select("item_id", "key", "size", F.col("ctx").alias("item_ctx")).distinct(), "items")
    short = sorted(r[0] for r in items.where(F.col("size") < WINDOW).select("size").distinct().collect())  # 9 at most
    probed = staged(spark, _probes(docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")), _table(items), short)
        .withColumn("row", F.monotonically_increasing_id()), "probed")
    hits = _exploded(probed.where(F.size("keys") > 0), "row").join(items, ["key", "size"]).select(
        "row", "item_id", "size", "at", F.filter(F.sequence(F.lit(0), F.lit(GUARD - 1)), lambda d: (
            F.element_at("ctx", d + 1) == F.element_at("item_ctx", d + 1)) & (F.element_at("ctx", d + 1) != 0)).alias("same"))
    hits = hits.where(F.size("same") > 0).select("row", "item_id", F.transform("same", lambda d: F.struct(
        (F.col("at") - (GUARD - 1) + d).alias("at"), F.col("size").alias("size"))).alias("spans"))
    spans = hits.select("row", F.explode("spans").alias("s")).groupBy("row").agg(F.collect_set("s").alias("spans"))
    listed = hits.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    return probed.select("row", F.col("id").alias("doc_id"), "n_words").join(spans, "row", "left").join(listed, "row", "left").select(
        "doc_id", "n_words", F.coalesce(covered(F.col("spans")), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "spans")


def op9_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
h AS (SELECT DISTINCT doc_id, item_id, k, i FROM dw JOIN bw USING (k, g)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
