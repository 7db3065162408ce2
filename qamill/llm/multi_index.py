"""Nearest neighbours by an inverted multi-index.

Vectors are cut in two halves, and each half has a codebook of its own (k-means
on a sample of at most FIT vectors, taken by hash of the id).  An entry's cell is
the pair of its halves' centroids; all vectors are entries.  A query ranks each
half's centroids by distance (minus the inner product, as that is the nearness
searched for) and walks pairs of centroids in the order of the summed distance
with a heap, until the cells it has passed hold enough entries; these are ranked
by the inner product of the whole vectors, in double precision.

How many entries are enough is measured, not set: for at most PILOT queries
(by hash of the id) the true neighbours are found by comparing all vectors in
blocks, and the budget is the number of entries that cells up to the neighbour's
hold, for RECALL of these neighbours.  It is at least the number asked for and one more.

Cells, in order, are packed into blocks of about BLOCK entries; a larger cell is
dealt over several blocks by hash of the id.  Queries are dealt in groups of
about GROUP.  A task holds one block and one group; a query goes to a block once,
with the block's cells it walked, and leaves its nearest of the block.  Tables of
k x k cells (counts, blocks) and the codebooks go to every task: their size is
fixed by k, which grows with the square root of the number of vectors, up to
MOST centroids a half.

Cases: vectors that are null, zero, or hold null or non-finite components take no
part, nor do those of another length than most have (ties: the longest), nor rows
with a null id.  Rows that repeat an id count once, with their least vector.
Equal vectors tie, and go by id.  Fewer candidates than asked for: all of them.
Empty table: no rows.  Other columns aren't looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from qamill.llm.tables import staged
from qamill.session import ship_package

NEAREST = 20
QUERY_EVERY = 20
FIT = 20_000
ROUNDS = 12
PILOT = 256
RECALL = 0.96
BLOCK = 8192
GROUP = 4096
MOST = 256
#: Rounding of a matrix product, beyond which two nearnesses surely differ in order.
SLACK = 1e-9
FOUND = "query_id long, vec_id long, score double"


def usable(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vector: array<double>) of the rows that take part, an id once."""
    v = F.col(embedding).cast("array<double>")
    ok = F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("vector", lambda x: x != 0)
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vector")).where(ok)
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def sample(rows: DataFrame, n: int) -> np.ndarray:
    """At most n vectors, those with the least hash of the id."""
    few = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).select("vector").collect()
    return np.array([r["vector"] for r in few])


def centroids_of(x: np.ndarray, k: int) -> np.ndarray:
    """At most k centroids of the rows of x: Lloyd's rounds from spread-out distinct rows."""
    if not x.shape[1]:
        return np.zeros((1, 0))
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(7)
    c = distinct[np.sort(rng.permutation(len(distinct))[:k])]
    for _ in range(ROUNDS):
        own = nearest_centroid(x, c)
        n = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def nearest_centroid(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1)[None, :] - 2 * (x @ c.T), axis=1)


def cells_of(x: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Cell of each vector: first half's centroid times the number of the second's, plus the second half's centroid."""
    h = books[0].shape[1]
    return nearest_centroid(x[:, :h], books[0]) * len(books[1]) + nearest_centroid(x[:, h:], books[1])


def walk(query: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> Iterator[int]:
    """Cells in the order of summed distance: the frontier of pairs is a heap."""
    h = books[0].shape[1]
    d1, d2 = -(books[0] @ query[:h]), -(books[1] @ query[h:])
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2, k2 = d1[o1].tolist(), d2[o2].tolist(), len(o2)
    o1, o2 = o1.tolist(), o2.tolist()
    heap = [(s1[0] + s2[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield o1[i] * k2 + o2[j]
        # A pair enters from its left neighbour, or from above in the first column: once.
        if j + 1 < len(s2):
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(s1):
            heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))


def walked(query: np.ndarray, books: tuple[np.ndarray, np.ndarray], counts: list[int], enough: int) -> list[int]:
    """Cells with entries that the query passes until they hold ``enough``."""
    out, seen = [], 0
    for cell in walk(query, books):
        if counts[cell]:
            out.append(cell)
            seen += counts[cell]
            if seen >= enough:
                break
    return out


def in_order(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, each summed from the first component to the last."""
    return np.add.accumulate(q * v, axis=1)[:, -1]


def best_of(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, nearest: int, allowed=None) -> list[tuple]:
    """The nearest rows of x for each query: (query_id, vec_id, score); ties to smaller ids.
    allowed(i): which rows query i may have."""
    out = []
    for a in range(0, len(q), 256):
        near = q[a:a + 256] @ x.T
        for i, row in enumerate(near):
            may = ids != q_ids[a + i]
            if allowed is not None:
                may &= allowed(a + i)
            at = np.flatnonzero(may)
            if not len(at):
                continue
            if len(at) > nearest:
                some = row[at]
                least = np.partition(some, len(at) - nearest)[len(at) - nearest]
                at = at[some >= least - SLACK * max(1.0, abs(least))]
            score = in_order(np.broadcast_to(q[a + i], (len(at), q.shape[1])), x[at])
            for j in np.lexsort((ids[at], -score))[:nearest]:
                out.append((int(q_ids[a + i]), int(ids[at[j]]), float(score[j])))
    return out


def matrix(column, d: int) -> np.ndarray:
    """Rows of an Arrow list column as a matrix of d columns."""
    return np.asarray(column.flatten()).reshape(len(column), d)


def _ranked(found: DataFrame, nearest: int) -> DataFrame:
    """found with rank from 1, the nearest of each query."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)


def budget_of(rows: DataFrame, pilot: list, books, counts: list[int], nearest: int, recall: float) -> int:
    """Entries to pass so that a share ``recall`` of the pilot queries' true neighbours is among them."""
    q_ids, q = np.array([r["vec_id"] for r in pilot]), np.array([r["vector"] for r in pilot])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        for b in batches:
            x = matrix(b.column(1), q.shape[1])
            cell = dict(zip(b.column(0).to_pylist(), cells_of(x, books).tolist(), strict=True))
            for i, v, score in best_of(q_ids, q, np.asarray(b.column(0)), x, nearest):
                best.setdefault(i, []).append((-score, v, cell[v]))
            best = {i: sorted(found)[:nearest] for i, found in best.items()}
        out = [(i, v, -score, c) for i, found in best.items() for score, v, c in found]
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], kind) for j, kind in enumerate(kinds)],
                                         names=["query_id", "vec_id", "score", "cell"])

    true = rows.mapInArrow(exact, f"{FOUND}, cell int")
    wanted: dict[int, list[int]] = {}
    for r in _ranked(true, nearest).select("query_id", "cell").collect():
        wanted.setdefault(r["query_id"], []).append(r["cell"])
    passed = []
    for i, vector in zip(q_ids.tolist(), q, strict=True):
        seen, at = 0, {}
        left = set(wanted.get(i, ()))
        for cell in walk(vector, books):
            if not left:
                break
            seen += counts[cell]
            if cell in left:
                at[cell] = seen
                left.discard(cell)
        passed += [at[c] for c in wanted.get(i, ())]
    passed.sort()
    return passed[min(math.ceil(recall * len(passed)), len(passed)) - 1] if passed else 0


def packed(counts: list[int], block: int) -> tuple[np.ndarray, np.ndarray]:
    """First block of each cell, and how many blocks it is dealt over: no block is planned for more than ``block`` entries."""
    first, parts, at, after, room = [], [], 0, 1, block
    for c in counts:
        if c > block:
            parts.append(-(-c // block))
            first.append(after)
            after += parts[-1]
            continue
        if c > room:
            at, after, room = after, after + 1, block
        first.append(at)
        parts.append(1)
        room -= c
    return np.array(first), np.array(parts)


def neighbours(spark: SparkSession, df: DataFrame, is_query: Column, nearest: int = NEAREST, k: int | None = None, recall: float = RECALL,
               block: int = BLOCK, group: int = GROUP, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``nearest`` rows of df for each row whose vec_id meets is_query (of column vec_id)."""
    ship_package(spark)
    rows = staged(spark, usable(df, vec_id, embedding), "vectors")
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).orderBy(
        F.desc("n"), F.desc("d")).limit(1).collect()
    if not sizes or not sizes[0]["q"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n, n_queries = sizes[0]
    rows = rows.where(F.size("vector") == d)
    k = k or int(min(max(math.sqrt(n / 8), 4), MOST))
    some = sample(rows, FIT)
    books = (centroids_of(some[:, :d // 2], k), centroids_of(some[:, d // 2:], k))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells_of(matrix(b.column(1), d), books), pa.int32())], names=["vec_id", "vector", "cell"])

    index = staged(spark, rows.mapInArrow(cells, "vec_id long, vector array<double>, cell int"), "index")
    n_cells = len(books[0]) * len(books[1])
    counts = [0] * n_cells
    for r in index.groupBy("cell").count().collect():
        counts[r["cell"]] = r["count"]
    queries = rows.where(is_query)
    pilot = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PILOT).collect()
    enough = max(budget_of(rows, pilot, books, counts, nearest, recall), nearest + 1)
    first, parts = packed(counts, block)
    n_groups = max(-(-n_queries // group), 1)
    place = spark.sparkContext.broadcast((books, counts, first, parts))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, counts, first, parts = place.value
        for b in batches:
            for a in range(0, b.num_rows, 64):
                out: list[tuple] = []
                part = b.slice(a, 64)
                for i, q in zip(part.column(0).to_pylist(), matrix(part.column(1), d), strict=True):
                    of: dict[int, list[int]] = {}
                    for c in walked(q, books, counts, enough):
                        for at in range(parts[c]):
                            of.setdefault(int(first[c]) + at, []).append(c)
                    out += [(i, q, at, found) for at, found in of.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.list_(pa.float64())), pa.array([r[2] for r in out], pa.int32()),
                     pa.array([r[3] for r in out], pa.list_(pa.int32()))], names=["query_id", "vector", "block", "cells"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, first, parts = place.value
        for b in batches:
            ids, cell = np.asarray(b.column(0)).astype(np.uint64), np.asarray(b.column(2))
            salt = ((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts[cell]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first[cell] + salt, pa.int32())], names=["vec_id", "vector", "cell", "block"])

    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame([], columns=names).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        cell, mine = right["cell"].to_numpy(), left["cells"].tolist()

        def walked_to(i: int) -> np.ndarray:
            table = np.zeros(n_cells, dtype=bool)
            table[mine[i]] = True
            return table[cell]

        best = best_of(left["query_id"].to_numpy(), np.stack(left["vector"].to_list()), right["vec_id"].to_numpy(),
                       np.stack(right["vector"].to_list()), nearest, walked_to)
        return pd.DataFrame(best, columns=names).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    asked = queries.mapInArrow(probes, "query_id long, vector array<double>, block int, cells array<int>").withColumn(
        "part", F.pmod(F.xxhash64("query_id"), F.lit(n_groups)).cast("int"))
    entries = index.mapInArrow(placed, "vec_id long, vector array<double>, cell int, block int").withColumn(
        "part", F.explode(F.expr(f"sequence(0, {n_groups - 1})")))
    found = asked.groupBy("block", "part").cogroup(entries.groupBy("block", "part")).applyInPandas(search, FOUND)
    return _ranked(found, nearest).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op12_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of embeddings for every row whose vec_id is divisible by 20: query_id, rank, vec_id, score."""
    return neighbours(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % QUERY_EVERY == 0)
