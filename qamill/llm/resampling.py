"""Importance resampling of documents towards a target distribution.

An untrained pre-tokeniser (a ``Split`` on a regular expression, over
ASCII-lowered text) gives words with their offsets.  Features are runs of
``shortest`` to ``longest`` consecutive words joined by one space; a window of
two offsets cuts each run out of the joined words.  A feature's bucket is the
CRC-32 of its UTF-8 bytes modulo ``buckets``.  With s of S features of all
documents and t of T features of all target texts in a bucket, its gain is
floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))); a document's weight is
the floored mean gain of its features, and Gumbel noise from a hash of seed and
doc_id turns the weights' order into a draw without replacement.

Documents are tokenised once, into counts per bucket, which are staged; the two
histograms are sums of these (``buckets`` numbers reach the driver and go to
every task).  Scores are whole numbers in a range fixed by the formula (weights
below 10^5 in size, noise from -3,200 to 23,000), so the rank of a score starts
at the count of higher scores, from a table of at most 230,000 rows; ties are
ranked inside their score.  The noise spreads documents: no score holds more
than 1 in 2,700 of them in expectation, whatever their texts and weights are.

Cases: null, empty or wordless texts: no features, weight 0, not drawn.  A null
doc_id: no score, not drawn, and not counted among those drawn from, though its
features count.  Rows that repeat a doc_id are rows of their own, with the same
noise; ties go to the smaller doc_id, then to fewer features, then to the
smaller weight.  Very long texts are tokenised in stretches of CHUNK
characters, cut at separators.  Empty table: no rows; empty target: T = 0.
Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import gc
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from qamill.llm.tables import staged
from qamill.session import ship_package

#: Words: digits, letters a-z, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
MIN_WORDS = 20
SEED = "2024"
CHUNK = 1 << 20
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_CUT = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_KNOWN = 1 << 18
_BATCH = 1 << 16

FEATURES = "doc_id long, n_words long, n_features long, buckets array<int>, counts array<int>"


def stretches(text: str) -> Iterator[str]:
    """text in parts of about CHUNK characters, cut at separators: words stay whole."""
    a = 0
    while len(text) - a > CHUNK:
        m = _CUT.search(text, a + CHUNK)
        if m is None:
            break
        yield text[a:m.end()]
        a = m.end()
    yield text[a:] if a else text


class Hasher:
    """Counts per bucket of one text after another; one in each task."""

    def __init__(self, shortest: int, longest: int, buckets: int) -> None:
        from tokenizers import Regex, pre_tokenizers  # noqa: PLC0415

        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self.shortest, self.longest, self.buckets = shortest, longest, buckets
        self.known: dict[str, int] = {}

    def bucket(self, feature: str) -> int:
        b = self.known.get(feature)
        if b is None:
            if len(self.known) >= _KNOWN:
                self.known.clear()
            b = self.known[feature] = zlib.crc32(feature.encode()) % self.buckets
        return b

    def _runs(self, words: list[str], fresh: int) -> Counter:
        """Runs that end in the last ``fresh`` words, each cut out by its pair of offsets in the joined words."""
        if self.longest == 1:
            return Counter(words[len(words) - fresh:])
        line = " ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        starts = [0, *ends[:-1]]
        out: Counter = Counter()
        for n in range(self.shortest, self.longest + 1):
            first = max(len(words) - fresh - n + 1, 0)
            out.update(line[a:b - 1] for a, b in zip(starts[first:], ends[first + n - 1:], strict=False))
        return out

    def count(self, text: str) -> tuple[int, dict[int, int]]:
        """Number of words, and features of each bucket."""
        n_words, kept, out = 0, [], {}
        for part in stretches(text.translate(_LOWER)):
            fresh = [w for w, _ in self.split.pre_tokenize_str(part)]
            n_words += len(fresh)
            words = kept + fresh
            for feature, n in self._runs(words, len(fresh)).items():
                b = self.bucket(feature)
                out[b] = out.get(b, 0) + n
            kept = words[max(len(words) - self.longest + 1, 0):] if self.longest > 1 else []
        return n_words, out


def features(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 1, longest: int = 1,
             buckets: int = BUCKETS) -> DataFrame:
    """FEATURES of every row of docs."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(shortest, longest, buckets)
        gc.freeze()
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                words, ids, counts, at = [], [], [], [0]
                for t in part.column(1):
                    n, found = hasher.count(t.as_py() or "")
                    words.append(n)
                    ids.extend(found)
                    counts.extend(found.values())
                    at.append(len(ids))
                sums = np.add.reduceat(np.array([*counts, 0], dtype=np.int64), at[:-1]) if len(at) > 1 else np.zeros(0, np.int64)
                sums[np.diff(at) == 0] = 0
                ends = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words, pa.int64()), pa.array(sums, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))], names=["doc_id", "n_words", "n_features", "buckets", "counts"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, FEATURES)


def histogram(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of each bucket over all rows: every partition adds its counts up, and these sums are added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            ids = np.asarray(b.column(0).flatten())
            np.add.at(total, ids, np.asarray(b.column(1).flatten()))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    sums = found.select("buckets", "counts").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket from the two histograms, in doubles."""
    size = float(len(documents))
    big_s, big_t = float(documents.sum()) + size, float(target.sum()) + size
    return np.array([math.floor(1000 * math.log((float(t) + 1) * big_s / ((float(s) + 1) * big_t)))
                     for s, t in zip(documents.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight: floored mean gain of each row's features, 0 without any."""
    table = found.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, n = b.column(3), np.asarray(b.column(2))
            sums = np.concatenate([[0], np.cumsum(table.value[np.asarray(lists.flatten())] * np.asarray(b.column(4).flatten()))])
            at = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).astype(np.int64)
            mean = (sums[at[1:]] - sums[at[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(mean, pa.int64())],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return found.select("doc_id", "n_words", "n_features", "buckets", "counts").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(key: str, seed: str):
    """floor(-1000 ln(-ln(u))) of a number u from the hash of seed and key, in doubles."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resampled(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = MIN_WORDS, shortest: int = 1,
              longest: int = 1, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of docs (doc_id, text); rank is null for rows that
    aren't drawn.  target holds texts in column text.  percent of the rows with min_words words are drawn."""
    found = staged(spark, features(spark, docs, shortest=shortest, longest=longest, buckets=buckets), "features")
    aim = features(spark, target.withColumn("doc_id", F.lit(0)), shortest=shortest, longest=longest, buckets=buckets)
    gain = gains(histogram(found, buckets), histogram(aim, buckets))
    rows = staged(spark, weighted(found, gain).withColumn("score", F.col("weight") + noise("doc_id", seed)), "scored")
    may = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    # Rows of each score, and of all higher ones: a table bounded by the range of scores.
    each = rows.where(may).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = each.select("score", (F.sum("n").over(W.orderBy(F.desc("score"))) - F.col("n")).alias("above"))
    draw = percent * (each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]) // 100
    above = staged(spark, above.where(F.col("above") < draw), "above")
    least = above.agg(F.min("score").alias("least")).first()["least"]
    if least is None:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    reach = may & (F.col("score") >= least)
    place = F.row_number().over(W.partitionBy("score").orderBy("doc_id", "n_features", "weight")) + F.col("above")
    drawn = rows.where(reach).join(F.broadcast(above), "score").withColumn("rank", F.when(place <= draw, place.cast("long")))
    columns = [*rows.columns, "rank"]
    return drawn.select(*columns).union(rows.where(~F.coalesce(reach, F.lit(False))).withColumn("rank", F.lit(None).cast("long")).select(*columns))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of documents drawn towards the texts of benchmark: doc_id, n_features, weight, score, rank per document."""
    out = resampled(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
