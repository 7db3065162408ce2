"""Global positions, positional splits, chunks, samples, batches and shards
(R1-R5, T5, T6).

Exact 0-based positions over a whole table are computed without ever putting
the table in one partition:

* ``hashed_rank`` (seeded shuffle, R1/T5): the order key is
  ``md5(seed|key)``.  Its first hex digits form a *bucket* that is uniform by
  construction.  Pass 1 counts rows per bucket (partial aggregation, at most
  16**digits rows come out); a window over those few rows gives each bucket's
  offset; pass 2 ranks rows inside their bucket (a window partitioned by the
  bucket) and adds the broadcast offset.  Both passes are deterministic, so the
  frame needs no materialisation between them.
* ``ordered_rank`` (stored order, R4): range partitioning by the order key,
  a local index inside each sorted partition, materialised once with a
  reliable ``checkpoint()`` (range bounds come from sampling and must not be
  recomputed), then per-partition offsets as above.

* ``permuted`` (epoch order, T5): rows that have a position compute their place
  in an epoch from it alone, by a keyed Feistel permutation of 0..n-1: no
  shuffle, sort or count for an epoch.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qamill.session import checkpoint_dir

DEFAULT_SEED = 42
# Offsets side of the rank join: at most 16**BUCKET_DIGITS rows per group.
BUCKET_DIGITS = 4


def shuffle_key(key: str | Column, seed: int | str = DEFAULT_SEED) -> Column:
    """``md5('<seed>|' || key)``: the seeded order of R1 (same text in DuckDB); a null key as an empty one."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(k.cast("string"), F.lit(""))))


def _offsets(counts: DataFrame, part: Sequence[str], bucket: str, n: str) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(bucket) if part else Window.orderBy(bucket)
    tot = Window.partitionBy(*part) if part else Window.partitionBy()
    return counts.select(
        *part, bucket,
        (F.sum(n).over(w) - F.col(n)).alias("_off"),
        F.sum(n).over(tot).alias("_total"))


def bucket_of(key: str | Column, seed: int | str = DEFAULT_SEED,
              bucket_digits: int = BUCKET_DIGITS) -> Column:
    """The rank bucket of a key: the first hex digits of its shuffle key."""
    return F.conv(F.substring(shuffle_key(key, seed), 1, bucket_digits), 16, 10).cast("int")


def hashed_rank(df: DataFrame, key: str, seed: int | str = DEFAULT_SEED, out: str = "pos",
                partition_by: Sequence[str] = (), total: str | None = "n_total",
                bucket_digits: int = BUCKET_DIGITS, counts: DataFrame | None = None,
                ties: Sequence[str] = ()) -> DataFrame:
    """Add ``out`` = 0-based position in the order ``(md5(seed|key), key, *ties)``.

    A null key is a key like any other, and comes before the empty one.  Rows
    that share a key go by the columns ``ties``; rows equal in those too are
    told apart by nothing, so name all columns where keys may repeat.

    With ``partition_by`` the positions restart in each group.  ``total`` adds
    the group size (needed by positional splits).  The extra side is
    ``groups x 16**bucket_digits`` rows at most; without groups it is broadcast.
    ``counts`` (``partition_by`` + ``_b``, ``_n``) may be given when an
    earlier pass already counted the rows per bucket (saves a scan).
    """
    part = list(partition_by)
    h = shuffle_key(key, seed)
    keyed = df.withColumn("_h", h).withColumn(
        "_b", F.conv(F.substring("_h", 1, bucket_digits), 16, 10).cast("int"))
    if counts is None:
        counts = keyed.groupBy(*part, "_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(counts, part, "_b", "_n")
    local = F.row_number().over(Window.partitionBy(*part, "_b").orderBy("_h", key, *ties)) - 1
    # Without groups the offsets are 16**bucket_digits rows at most; with groups Spark decides by their size.
    side = offsets if part else F.broadcast(offsets)
    ranked = (keyed.withColumn("_r", local)
              .join(side, [*part, "_b"])
              .withColumn(out, (F.col("_off") + F.col("_r")).cast("bigint")))
    if total:
        ranked = ranked.withColumn(total, F.col("_total").cast("bigint"))
    return ranked.drop("_h", "_b", "_r", "_off", "_total")


def ordered_rank(df: DataFrame, order: Sequence[str], out: str = "pos",
                 total: str | None = "n_total", num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position in the stored order ``order``.

    One range shuffle; the ranked frame is checkpointed to the shared
    ``spark.checkpoint.dir`` so the count pass and the offset join see the
    same partitions.  The offsets side has one row per range partition.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parted = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_p", F.spark_partition_id())
              .withColumn("_r", F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition << 33) + index inside partition.
    parted = parted.withColumn("_r", F.col("_r") - F.shiftleft(F.col("_p").cast("bigint"), 33))
    stable = parted.checkpoint(eager=True)
    counts = stable.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(counts, [], "_p", "_n")
    ranked = (stable.join(F.broadcast(offsets), "_p")
              .withColumn(out, (F.col("_off") + F.col("_r")).cast("bigint")))
    if total:
        ranked = ranked.withColumn(total, F.col("_total").cast("bigint"))
    return ranked.drop("_p", "_r", "_off", "_total")


def split_boundaries(n: Column, fractions: Mapping[str, float]) -> list[tuple[str, Column]]:
    """Cumulative upper bounds: ``int(n * f)`` per named split, in order."""
    bounds, acc = [], F.lit(0).cast("bigint")
    for name, frac in fractions.items():
        acc = acc + F.floor(n.cast("double") * F.lit(float(frac))).cast("bigint")
        bounds.append((name, acc))
    return bounds


def split_column(pos: Column, n: Column, fractions: Mapping[str, float], rest: str) -> Column:
    """``case`` over positions: first ``int(n*f1)`` rows -> split 1, ... rest -> ``rest``."""
    expr = None
    for name, bound in split_boundaries(n, fractions):
        expr = F.when(pos < bound, F.lit(name)) if expr is None else expr.when(pos < bound, F.lit(name))
    return expr.otherwise(F.lit(rest)) if expr is not None else F.lit(rest)


OFFLINE_FRACTIONS = {"training": 0.6, "validation": 0.2}
RETRAIN_FRACTIONS = {"training": 0.8}


def split_positional(df: DataFrame, key: str, fractions: Mapping[str, float] = OFFLINE_FRACTIONS,
                     rest: str = "evaluation", seed: int | str | None = DEFAULT_SEED,
                     order: Sequence[str] | None = None, out: str = "split",
                     counts: DataFrame | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Seeded shuffle then positional split (R1 + R2), or a split in stored
    order when ``order`` is given (R4).

    Adds ``pos`` (global position), ``n_total``, ``split`` and ``split_pos``
    (position inside the split).
    """
    if order is not None:
        ranked = ordered_rank(df, order)
    else:
        ranked = hashed_rank(df, key, seed, counts=counts, ties=ties)
    pos, n = F.col("pos"), F.col("n_total")
    starts = F.lit(0).cast("bigint")
    start_expr = None
    for name, bound in split_boundaries(n, fractions):
        start_expr = (F.when(pos < bound, starts) if start_expr is None
                      else start_expr.when(pos < bound, starts))
        starts = bound
    start_expr = start_expr.otherwise(starts) if start_expr is not None else F.lit(0)
    return (ranked.withColumn(out, split_column(pos, n, fractions, rest))
            .withColumn("split_pos", (pos - start_expr).cast("bigint")))


def split_sizes(n: int, fractions: Mapping[str, float] = OFFLINE_FRACTIONS) -> list[int]:
    """Sizes of the named splits and the rest for ``n`` rows (driver-side helper)."""
    sizes = [int(n * f) for f in fractions.values()]
    return sizes + [n - sum(sizes)]


def chunk_column(pos: Column, m: Column, k: int = 3) -> Column:
    """1-based chunk of a 0-based position among ``m`` rows cut into ``k``
    chunks of ``m // k``; the last chunk takes the remainder (R3).

    Not ``ntile``: that gives the extra rows to the first chunks.
    """
    size = F.floor(m / F.lit(k)).cast("bigint")
    idx = F.when(size == 0, F.lit(k - 1)).otherwise(F.least(F.lit(k - 1), F.floor(pos / size)))
    return (idx + 1).cast("int")


def chunk(df: DataFrame, pos: str = "split_pos", n: str = "split_size", k: int = 3,
          out: str = "batch") -> DataFrame:
    """Add ``out`` = production batch 1..k."""
    return df.withColumn(out, chunk_column(F.col(pos), F.col(n), k))


def sample_by(df: DataFrame, key: str, group: str, values: Sequence, n: int = 10, seed: int | str = DEFAULT_SEED) -> DataFrame:
    """``sample_n`` of each of a few known groups."""
    parts = [sample_n(df.where(F.col(group) == v), key, n, seed) for v in values]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sample_n(df: DataFrame, key: str, n: int = 10, seed: int | str = DEFAULT_SEED) -> DataFrame:
    """``min(n, rows)`` rows in a seeded random order.

    A top-k on the hash (each partition keeps its best ``n``), not a full sort.
    The limit is the feature: a display sample.
    """
    return (df.withColumn("_h", shuffle_key(key, seed))
            .orderBy("_h", key).limit(n).drop("_h"))


def batches(df: DataFrame, key: str, size: int = 8, epoch: int = 0, shuffle: bool = True,
            seed: int | str = DEFAULT_SEED, pos: str | None = None,
            partition_by: Sequence[str] = ()) -> DataFrame:
    """Group rows into batches of ``size`` (T5): ``(batch_id, ids, n_rows)``.

    ``shuffle=True`` orders rows by ``md5(seed|epoch|key)`` (a new order per
    epoch); otherwise by the stored position ``pos``.  The last short batch is
    kept.  Each group holds at most ``size`` rows.
    """
    part = list(partition_by)
    if shuffle:
        ranked = hashed_rank(df, key, f"{seed}|{epoch}", out="_bpos",
                             partition_by=part, total=None)
    else:
        if pos is None:
            raise ValueError("an unshuffled batch order needs a position column")
        ranked = df.withColumn("_bpos", F.col(pos))
    grouped = (ranked.withColumn("batch_id", F.floor(F.col("_bpos") / F.lit(size)).cast("bigint"))
               .groupBy(*part, "batch_id")
               .agg(F.sort_array(F.collect_list(F.struct("_bpos", key))).alias("_items")))
    return grouped.select(
        *part, F.lit(epoch).cast("int").alias("epoch"), "batch_id",
        F.transform("_items", lambda x: x[key]).alias("ids"),
        F.size("_items").alias("n_rows"))


# ---------------------------------------------------- epochs by permutation --

ROUNDS = 6
_PRIME = (1 << 31) - 1


def grid(n: int) -> tuple[int, int]:
    """(a, b) near the square root of n with a * b >= n and the least a * b - n: of the 100,000 widths from
    sqrt(n) downwards, to half of it, the largest that leaves the fewest places over."""
    s = math.isqrt(max(n, 1))
    widths = range(s, max((s + 1) // 2, s - 100_000, 1) - 1, -1)
    a = min(widths, key=lambda w: (-(-n // w) * w - n, -w))
    return a, -(-n // a)


def round_keys(seed: int | str, epoch: int) -> list[tuple[int, int]]:
    """A multiplier and a summand below 2^30 for each round of an epoch."""
    digest = [hashlib.sha256(f"{seed}|{epoch}|{i}".encode()).digest() for i in range(ROUNDS)]
    return [(int.from_bytes(d[:4], "big") >> 2 | 1, int.from_bytes(d[4:8], "big") >> 2) for d in digest]


def permuted(pos: Column, n: int, epoch: int, seed: int | str = DEFAULT_SEED) -> Column:
    """The place of position ``pos`` among 0..n-1 in an epoch: a permutation of 0..n-1 for each (seed, epoch).

    A place is a cell (row, column) of an a x b grid.  In turns, a round moves
    the row by a number made from the column, and the column by one made from
    the row, so each round can be undone.  Cells beyond n are walked on from;
    as they are a * b - n, so many further steps always end below n.
    """
    if n < 1:
        return pos
    a, b = grid(n)
    keys = F.array(*[F.struct(F.lit(i % 2 == 0).alias("rows"), F.lit(m).cast("long").alias("m"), F.lit(k).cast("long").alias("k"))
                     for i, (m, k) in enumerate(round_keys(seed, epoch))])
    made = lambda x, c: F.shiftright((x * c["m"] + c["k"]) % _PRIME, 3)

    def turn(at: Column, c: Column) -> Column:
        return F.when(c["rows"], F.struct(((at["r"] + made(at["c"], c)) % a).alias("r"), at["c"].alias("c"))).otherwise(
            F.struct(at["r"].alias("r"), ((at["c"] + made(at["r"], c)) % b).alias("c")))

    def step(x: Column) -> Column:
        start = F.struct(F.floor(x / b).cast("long").alias("r"), (x % b).alias("c"))
        return F.aggregate(keys, start, turn, lambda at: at["r"] * b + at["c"])

    place = step(pos.cast("long"))
    left = a * b - n
    if not left:
        return place
    return F.aggregate(F.sequence(F.lit(1), F.lit(left)), place, lambda x, _: F.when(x < n, x).otherwise(step(x)))


def batches_permuted(df: DataFrame, key: str, n: int, pos: str = "split_pos", size: int = 8, epochs: Sequence[int] = (0,),
                     seed: int | str = DEFAULT_SEED) -> DataFrame:
    """Batches of ``size`` rows for each epoch (T5): ``(epoch, batch_id, ids, n_rows)``.

    ``df`` holds the positions 0..n-1 in ``pos``, each once; each row computes its
    own place, and the only shuffle is that of (place, key) to the batches.
    """
    places = F.array(*[F.struct(F.lit(int(e)).cast("int").alias("epoch"), permuted(F.col(pos), n, int(e), seed).alias("at")) for e in epochs])
    each = df.select(F.col(key), F.explode(places).alias("p")).select(F.col(key), "p.epoch", "p.at")
    items = F.sort_array(F.collect_list(F.struct("at", key)))
    return each.groupBy("epoch", F.expr(f"at div {int(size)}").alias("batch_id")).agg(items.alias("_items")).select(
        "epoch", "batch_id", F.transform("_items", lambda x: x[key]).alias("ids"), F.size("_items").alias("n_rows"))


def shard(df: DataFrame, pos: str = "split_pos", workers: int = 2, out: str = "shard") -> DataFrame:
    """Worker shard ``pos % workers`` (T6): each worker gets every W-th row."""
    return df.withColumn(out, (F.col(pos) % F.lit(workers)).cast("int"))
