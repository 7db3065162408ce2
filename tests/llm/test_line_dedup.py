import random

from helpers import changed, documents, jaccard_at_least, sentence, shingles, texts

from qamill.llm import line_dedup as L


def expected(spark, rows):
    """(doc_id, line_no, row) of removed lines; rows of one doc_id are told apart by the hash of their text."""
    key = {r.text or "": r.key for r in documents(spark, rows).select("text", L.row_key().alias("key")).collect()}
    lines = []
    for i, t in rows:
        if i is not None:
            lines += [((i, k, key[t or ""]), shingles((x or "").lower())) for k, x in enumerate((t or "").split("\n"))]
    gone = set()
    for at, s in lines:
        if s and any(b < at and z and len(s & z) and jaccard_at_least(s, z) for b, z in lines):
            gone.add(at)
    return gone


def removed(spark, rows):
    got = L.removed_lines(spark, documents(spark, rows)).collect()
    assert len(got) == len(set(got))
    return {(r.doc_id, r.line_no, r.row) for r in got}


def places(found):
    return {x[:2] for x in found}


def lined(seed):
    rng = random.Random(seed)
    base = [sentence(rng, n, 80) for n in (1, 3, 5, 6, 12, 30, 60)]
    rows = []
    for i in range(60):
        some = [changed(rng, t, rng.choice((0, 0, 1, min(3, len(t.split()))))) for t in rng.sample(base, 3)]
        rows.append((1000 - i, "\n".join([*some, "", rng.choice(base).upper(), " ", sentence(rng, 9)])))
    return rows


def test_against_all_pairs(spark):
    rows = [r for r in texts()[:40] if r[0] != 8] + lined(4) + [(None, "a b c"), (8, "\n\n")]
    assert removed(spark, rows) == expected(spark, rows)


def test_many_variants_of_one_line(spark):
    rng = random.Random(6)
    base = sentence(rng, 40)
    rows = [(i, changed(rng, base, i % 9)) for i in range(120)]
    assert removed(spark, rows) == expected(spark, rows)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "A b  c"), (2, "other\na b c\nother")]
    assert places(removed(spark, rows)) == {(2, 0), (2, 1), (2, 2)} and removed(spark, rows) == expected(spark, rows)
    assert removed(spark, []) == set()


def test_rows_of_one_doc_id(spark, monkeypatch):
    """A line that stands beside a copy, at the same place of another row, still removes later ones."""
    rng = random.Random(7)
    line, other = sentence(rng, 40), sentence(rng, 40)
    rows = [(1, line), (2, line), (2, other), (2, other), (3, changed(rng, other, 1)), (4, f"{other}\n{line}")]
    for most in (L.BROADCAST_ROWS, 0):
        monkeypatch.setattr(L, "BROADCAST_ROWS", most)
        found = removed(spark, rows)
        assert found == expected(spark, rows) and len(found) == 4 and places(found) == {(2, 0), (3, 0), (4, 0), (4, 1)}


def test_no_text_is_lost(spark):
    """A line goes only if an earlier one stays or matches in turn: every text of a corpus with repeated ids is still there once."""
    rows = [(1, "A a"), (2, "A a"), (2, "B b"), (3, "B b"), (3, "C c\nD d"), (3, "D d\nC c"), (4, "E e"), (4, "E e")]
    left = [(r.doc_id, r.text) for r in L.deduplicated(spark, documents(spark, rows), drop_emptied=True).collect()]
    assert sorted(x for x in left if x[0] < 3) == [(1, "A a"), (2, "B b")] and left.count((4, "E e")) == 2
    assert sorted(line for i, t in left if i == 3 for line in t.split("\n")) == ["C c", "D d"]


def test_repeated_rows_keep_their_lines(spark):
    rows = [(1, "a b c\nd"), (1, "a b c\nd"), (1, "a b c\nd"), (2, "d")]
    left = L.deduplicated(spark, documents(spark, rows), drop_emptied=True)
    assert [(r.doc_id, r.text) for r in left.collect()] == [(1, "a b c\nd")] * 3


def test_documents_without_the_lines(spark):
    rows = [(1, "a b c\nkeep one"), (2, None), (3, "a b c"), (4, "x\n\na b c\ny\n"), (None, "a b c"), (5, "")]
    df = documents(spark, rows)
    out = L.deduplicated(spark, df)
    assert out.schema == df.schema or out.columns == df.columns
    assert {(r.doc_id, r.text) for r in out.collect()} == {(1, "a b c\nkeep one"), (2, None), (3, ""), (4, "x\n\ny\n"), (None, "a b c"), (5, "")}
    left = L.deduplicated(spark, df, drop_emptied=True).collect()
    assert {r.doc_id for r in left} == {1, 2, 4, None, 5}
    clash = df.withColumn("removed_lines", df.label).withColumn("removed_id", df.label)
    assert L.deduplicated(spark, clash).count() == 6


def test_query(spark, tmp_path):
    rows = [(1, "a b c\nd"), (2, "q\na b c\nd"), (3, None)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, L.op4_line_set_join(spark, str(tmp_path)).collect())) == [(1, 2, 0, ""), (2, 3, 2, "1,2"), (3, 1, 0, "")]
