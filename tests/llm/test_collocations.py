import random
import re
from collections import Counter

import duckdb
import pytest
from helpers import LOWER, documents, texts

from qamill.llm import collocations as C


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def expected(rows, least, cover=80, top=2000):
    """lang, rank, phrase, a, l, r, n, score; rows: (lang, text)."""
    out = []
    for lang in sorted({x or "und" for x, _ in rows}):
        f, n = Counter(), 0
        for x, text in rows:
            if (x or "und") == lang:
                for w in pieces(text):
                    n += len(w)
                    f.update(tuple(w[i:i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
        cand = [p for p, a in f.items() if len(p) > 1 and a >= least]
        inside = {}
        for p in cand:
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside.get(p[i:i + m], 0), f[p])
        found = []
        for p in cand:
            if p in inside and 100 * inside[p] >= cover * f[p]:
                continue
            score, k = min((2000000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, left, rest) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, rest, n, -s))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, 7) for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string, phrase int")


def got(df):
    return sorted(map(tuple, df.drop("k").collect()))


def corpus():
    rng = random.Random(5)
    rows = [(rng.choice(["en", "de", None, "und"]), t) for _, t in texts()]
    phrases = ["New York City", "of the", "per se, and", "a b c d e f", "é ß\u00a0x", "the the the the the"]
    for _ in range(300):
        w = [rng.choice(phrases) if rng.random() < 0.4 else rng.choice(["the", "of", "in", "Zed", f"v{rng.randrange(40)}"]) for _ in range(rng.randrange(1, 25))]
        rows.append((rng.choice(["en", "en", "fr", None]), rng.choice([" ", "  ", "\t"]).join(w).replace("v7", "v7.").replace("v8", "!? \n v8")))
    return rows + [(None, None), ("en", ""), ("xx", " . , "), ("yy", "one two"), ("en", "\x00 a\x0bb\x0c c")] + [("dup", "same few words here")] * 9


@pytest.mark.parametrize(("least", "cover", "top"), [(3, 80, 2000), (5, 100, 7), (2, 55, 2000)])
def test_against_a_plain_version(spark, least, cover, top):
    rows = corpus()
    assert got(C.collocations(spark, frame(spark, rows), least, cover, top)) == expected(rows, least, cover, top)


def test_small_limits_change_nothing(spark, monkeypatch):
    """Stripes and counts of hashes written often."""
    rows = corpus()
    monkeypatch.setattr(C, "HELD", 50)
    monkeypatch.setattr(C, "HASHES", 300)
    assert got(C.collocations(spark, frame(spark, rows), 3)) == expected(rows, 3)


def test_a_full_table_changes_nothing(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(C, "frequent_table", lambda spark, docs, least: spark.sparkContext.broadcast(C.np.full(1 << 24, 255, C.np.uint8)))
    assert got(C.collocations(spark, frame(spark, rows), 3)) == expected(rows, 3)


def test_stretches(monkeypatch):
    """Texts in short stretches give the same phrases."""
    for chunk in (1, 2, 9, 40, 1000):
        monkeypatch.setattr(C, "CHUNK", chunk)
        for text in ("a bb  ccc\tdddd e f g h i, j k " * 5, "x" * 99 + " y", "", " ", "\t" * 50 + "z", "a.b c!d\n\ne f g h"):
            s = C.Slice([(p, 0, skip) for p, skip in C.stretches(text.encode())], ["en"])
            for m in range(1, 5):
                found = Counter(tuple(s.word(i + j) for j in range(m)) for i in s.phrases(m)[0].tolist())
                assert found == Counter(tuple(x.encode() for x in w[i:i + m]) for w in pieces(text) for i in range(len(w) - m + 1))


def test_large_counts_are_exact(spark):
    """Frequencies whose products pass 64 bits."""
    big = 9 * 10**15
    f = spark.createDataFrame([("en", "a", 1, 3 * big), ("en", "b", 1, 2 * big + 1), ("en", "a b", 2, big)], "lang string, phrase string, m int, a long")
    r = C.scored(f).collect()
    assert [(x.phrase, x.score, x.l, x.r) for x in r] == [("a b", 2000000 * big // (5 * big + 1), 3 * big, 2 * big + 1)]


def test_empty_table(spark):
    assert C.collocations(spark, frame(spark, [])).count() == 0
    assert C.collocations(spark, frame(spark, [("en", None)])).count() == 0


def test_query_and_sql(spark, tmp_path):
    rng = random.Random(8)
    some = ["New York", "city", "of the", "a,", "b", "é", *[f"w{i}" for i in range(12)]]
    rows = [(rng.choice(["en", "fr", None]), " ".join(rng.choices(some, [9, 4, 6, 3, 2, 2] + [1] * 12, k=30))) for _ in range(300)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = C.op11_stripes_collocations(spark, str(tmp_path))
    assert out.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *[(c, "bigint") for c in ("a", "l", "r", "n", "score")]]
    want = expected(rows, 30)
    assert want and got(out) == want
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.sql(C.ORACLE).fetchall()) == want


def test_repeated_rows_and_extra_columns(spark):
    df = documents(spark, [(1, "a b c"), (1, "a b c"), (None, "a b c")]).withColumn("word", C.F.lit(1)).withColumn("n", C.F.lit("x"))
    assert {r.a for r in C.collocations(spark, df.withColumn("lang", C.F.lit("l")), 3).collect()} == {3}
