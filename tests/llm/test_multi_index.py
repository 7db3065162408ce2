import math
from functools import reduce
from operator import add

import numpy as np
import pytest

from qamill.llm import multi_index as M

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, vector int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "clash", 2) for i, v in rows], SCHEMA)


def corpus(n=3000, d=16, seed=1):
    """Random directions, families of near copies, and copies of one vector."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for a in range(0, n // 3, 12):
        x[a:a + 12] = x[a] + 0.05 * rng.normal(size=(12, d))
    x[-200:] = x[-1]
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, v.astype(np.float32)) for i, v in enumerate(x)]


def exact(rows, every=20, nearest=20):
    """{query_id: [(vec_id, score)]}: all candidates compared."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            s = np.add.accumulate(x * q, axis=1)[:, -1]
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:nearest]
            out[int(i)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def search(spark, rows, every=20, **kw):
    return got(M.neighbours(spark, frame(spark, rows), M.F.col("vec_id") % every == 0, **kw))


def recall(found, true):
    hits = sum(len({v for v, _ in found[q]} & {v for v, _ in t}) for q, t in true.items())
    return hits / sum(map(len, true.values()))


@pytest.mark.parametrize("kw", [{}, {"block": 100, "group": 30}])
def test_recall_and_scores(spark, kw):
    rows = corpus()
    found, true = search(spark, rows, **kw), exact(rows)
    assert found.keys() == true.keys()
    assert recall(found, true) >= 0.9
    known = dict(rows)
    for q, some in found.items():
        assert len(some) == 20 and q not in {v for v, _ in some}
        assert some == sorted(some, key=lambda r: (-r[1], r[0]))
        for v, score in some:
            assert score == reduce(add, (float(a) * float(b) for a, b in zip(known[q], known[v], strict=True)))


def test_all_cells_walked_is_exact(spark):
    """With every true neighbour of the pilot wanted, and all queries in it, nothing is missed: also ties and lengths."""
    rng = np.random.default_rng(4)
    rows = [(int(i) - 300, v * rng.uniform(0.1, 5)) for i, v in corpus(900, 7, 2)]
    assert search(spark, rows, recall=1.0, block=64) == exact([(i, v.astype(np.float32)) for i, v in rows])


def test_few_candidates_and_odd_rows(spark):
    bad = [(0, None), (20, []), (40, [0.0, 0.0, 0.0]), (60, [1.0, None, 2.0]), (80, [1.0, math.nan, 0.0]), (100, [math.inf, 0.0, 1.0]),
           (None, [1.0, 1.0, 1.0]), (120, [1.0, 2.0])]
    good = [(140, [1, 2, 3]), (7, [1, 2, 3]), (8, [-1, 0, 0]), (9, [3, 2, 1]), (160, [0, 0, 2])]
    assert search(spark, bad + good) == exact(good)
    assert search(spark, bad) == {120: []} or search(spark, bad) == {}
    assert search(spark, []) == {}
    assert search(spark, [(1, [1.0]), (3, [2.0])]) == {}


def test_repeated_ids_and_one_component(spark):
    rows = [(20, [2]), (20, [1]), (20, [1]), (5, [3]), (5, [3]), (6, [-1])]
    assert search(spark, rows) == exact([(20, [1]), (5, [3]), (6, [-1])])


def test_walk_is_in_order_and_whole():
    rng = np.random.default_rng(3)
    books = (rng.normal(size=(7, 4)), rng.normal(size=(5, 5)))
    q = rng.normal(size=9)
    cells = list(M.walk(q, books))
    d = [-(books[0][c // 5] @ q[:4]) - books[1][c % 5] @ q[4:] for c in cells]
    assert sorted(cells) == list(range(35)) and np.all(np.diff(d) >= -1e-12)


def test_blocks():
    first, parts = M.packed([3, 0, 25, 4, 4, 4, 10, 11], 10)
    held = {}
    for c, (f, p) in enumerate(zip(first, parts)):
        for b in range(f, f + p):
            held.setdefault(b, []).append(c)
    assert parts.tolist() == [1, 1, 3, 1, 1, 1, 1, 2]
    assert all(len(c) == 1 for b, c in held.items() if parts[c[0]] > 1)
    counts = [3, 0, 25, 4, 4, 4, 10, 11]
    assert all(sum(counts[x] for x in c) <= 10 for c in held.values() if parts[c[0]] == 1)


def test_query(spark):
    out = M.op12_inverted_multi_index(spark, "/root/testdata/sf0.01")
    assert out.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    rows = [(r.vec_id, np.array(r.embedding, dtype=np.float32)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    found, true = got(out), exact(rows)
    assert found.keys() == true.keys() and recall(found, true) >= 0.9
