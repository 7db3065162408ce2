import itertools

import numpy as np
from helpers import components, documents, jaccard_at_least, shingles, texts

from qamill.llm import hashing as H
from qamill.llm import near_dedup as N


def expected(rows):
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and jaccard_at_least(sets[a], sets[b])]
    least = components(sets, links)
    return {i: (len(sets[i]), least[i], least[i] == i) for i in sets}


def as_dict(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_against_all_pairs(spark):
    rows = texts()
    assert as_dict(N.near_duplicates(spark, documents(spark, rows))) == expected(rows)


def test_large_group_goes_through_the_set_join(spark):
    import random

    from helpers import changed, sentence
    rng = random.Random(5)
    base = sentence(rng, 90)
    rows = [(i, changed(rng, base, i % 12)) for i in range(90)]
    assert as_dict(N.near_duplicates(spark, documents(spark, rows))) == expected(rows)


def test_set_join_is_exact(spark):
    import random

    rng = random.Random(7)
    pool = list(range(60))
    sets = [(i, i % 4, sorted(rng.sample(pool, rng.randrange(1, 14)))) for i in range(150)]
    got = {(r.a, r.b) for r in N.similar_sets(spark, spark.createDataFrame(sets, "class long, label long, members array<long>")).collect()}
    assert got == {(a[0], b[0]) for a, b in itertools.combinations(sets, 2)
                   if a[1] != b[1] and jaccard_at_least(frozenset(a[2]), frozenset(b[2]))}


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert N.near_duplicates(spark, documents(spark, [])).collect() == []
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, None), (4, None), (None, "only here, with no id")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(spark, documents(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (4, 0, 4, True), (4, 0, 4, True), (None, 1, None, False)], key=str)


def sketch(values):
    values = np.array(sorted(values), dtype=np.uint64)
    return N.sketches(H.mix64(values), np.array([0, len(values)]))[0]


def test_sketches_merge_and_estimate():
    a, b = range(0, 3000), range(1000, 4000)
    both = sketch(set(a) | set(b))
    assert (N.merge_sketches(sketch(a), sketch(b)) == both).all()
    n = np.array([3000.0])
    estimates = []
    for shift in (0, 300, 1000, 3000):
        j, lost = N.joint_estimate(sketch(a)[None], sketch(range(shift, shift + 3000))[None], n, n)
        true = (3000 - shift) / (3000 + shift)
        estimates.append(abs(j[0] - true) < 0.15)
        assert lost[0] == 0 or true < 0.75
    assert all(estimates)


def test_words_of_many_slices(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(H, "SLICE_BYTES", 64)
    monkeypatch.setattr(H, "_PIECE", 16)
    rows = ["one two  three", None, "", "ä" * 50 + " B\tc", "Two\x0bTHREE one" * 9]
    got = []
    for _, _, buf, offs in H.text_slices(pa.array(range(5)), pa.array(rows)):
        s, e, bounds = H.word_spans(buf, offs, H.SPACE)
        h = H.word_hashes(buf, s, e)
        got += [h[x:y].tolist() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
    from helpers import LOWER, WORD
    names = {}
    for text, hashes in zip(rows, got, strict=True):
        words = WORD.findall((text or "").translate(LOWER))
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes, strict=True):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)
