import hashlib
import re

from helpers import LOWER, changed, documents, sentence

from qamill.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected(docs, items):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = {}
    for i, t in items:
        w = words(t)
        k = min(len(w), 10)
        for a in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[a:a + k]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if tuple(w[a:a + k]) in windows:
                    hit.update(range(a, a + k))
                    found |= windows[tuple(w[a:a + k])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((str(i), len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), len(hit) > 0))
    return sorted(out)


def run(spark, path, docs, items):
    documents(spark, docs).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in D.op9_winnowing_decontamination(spark, path).collect())


def test_against_windows(spark, tmp_path):
    import random
    rng = random.Random(2)
    items = [(i, sentence(rng, n, 60)) for i, n in enumerate((1, 2, 5, 9, 10, 11, 14, 40, 200))]
    items += [(20, None), (21, "..."), (22, items[7][1]), (7, items[7][1]), (None, items[8][1]), (30, "a " * 30), (31, "b b b")]
    docs = [(1, None), (2, ""), (3, ". ,"), (4, "A a a a a a a a a a a a"), (5, "b b b b"), (6, items[3][1])]
    for k, (_, t) in enumerate(items[:9]):
        docs.append((100 + k, f"{sentence(rng, 30, 60)}, {t.upper()}! {sentence(rng, 30, 60)}"))
        w = t.split()
        for n in (9, 10, 11):  # parts of every length about the window's
            docs.append((200 + 10 * k + n, f"zz {' '.join(w[3:3 + n])} zz {sentence(rng, 20, 60)}"))
        docs.append((400 + k, changed(rng, t, len(w) // 8)))
    docs += [(400, docs[20][1]), (None, docs[12][1]), (900, " ".join([items[7][1], sentence(rng, 20_000, 5000), items[8][1]]))]
    assert run(spark, str(tmp_path), docs, items) == expected(docs, items)


def test_empty_tables(spark, tmp_path):
    assert run(spark, f"{tmp_path}/a", [], [(1, "a b")]) == []
    docs = [(1, "a b"), (2, None)]
    assert run(spark, f"{tmp_path}/b", docs, []) == expected(docs, [])


def test_text_item_ids(spark):
    """Ids that are no numbers are listed as strings, in their order."""
    items = spark.createDataFrame([("b/1", "one two three"), ("a b", "one two three"), (None, "four five"), ("9", "six")], "item_id string, text string")
    docs = documents(spark, [(1, "x one two three y"), (2, "four five"), (3, "six one"), (4, "x")])
    got = {r.doc_id: (r.n_hit, r.item_ids) for r in D.contamination(spark, docs, items).collect()}
    assert got == {1: (3, ["a b", "b/1"]), 2: (2, []), 3: (1, ["9"]), 4: (0, [])}
