import itertools
import os

import corpus_pipeline
import sentencepiece
from helpers import WORD, changed, documents, jaccard_at_least, sentence, shingles
from test_decontaminate import expected as contaminated
from test_line_dedup import expected as removed_lines
from test_line_dedup import places
from test_near_dedup import expected as near
from test_quality import counts

from qamill.llm import pieces


def corpus():
    import random
    rng = random.Random(9)
    item = sentence(rng, 30)
    base = [sentence(rng, 80) for _ in range(4)]
    shared = sentence(rng, 20)
    rows = [(1, None), (2, "too short"), (3, "again and again " * 40), (4, f"{sentence(rng, 60)} {item}")]
    n = 10
    for t in base:
        for k in (0, 0, 1, 2, 12):
            rows.append((n, f"{shared}\n{changed(rng, t, k)}\n{sentence(rng, 3)}\n"))
            n += 1
    return rows, [(1, item), (2, None)]


def expected(spark, rows, items):
    rows = [(i, t) for i, t in rows if counts(t)[0] >= 50 and 100 * counts(t)[4] <= 50 * counts(t)[0]]
    gone = places(removed_lines(spark, rows))
    rows = [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)) for i, t in rows]
    rows = [(i, t) for i, t in rows if WORD.search(t)]  # every document has words before this stage
    rows = [(i, t) for i, t in rows if near(rows)[i][2]]
    hit = {int(x[0]) for x in contaminated(rows, items) if x[-1]}
    return [(i, t) for i, t in rows if i not in hit]


def write(spark, d, rows, items):
    documents(spark, rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(10, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")


def test_run_against_brute_force(spark, tmp_path):
    rows, items = corpus()
    write(spark, str(tmp_path), rows, items)
    got = sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id)
    want = expected(spark, rows, items)
    assert [(r.doc_id, r.text) for r in got] == want and 0 < len(want) < len(rows) - 3
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary_path(pieces.VOCABULARY))
    for r in got:
        assert r.ids == sp.encode(r.text) and r.n_tokens == len(r.ids) and r.round_trip
        assert r.kept == "clash" and r.label == 5 and r.n_chars == len(r.text)


def test_null_ids_repeats_and_clashing_columns(spark, tmp_path):
    import random
    rng = random.Random(3)
    one, two = sentence(rng, 70), sentence(rng, 70, 10**6)
    rows = [(5, one), (5, one), (None, two), (None, two), (7, sentence(rng, 70, 10**6))]
    write(spark, str(tmp_path), rows, [])
    docs = documents(spark, rows)
    for c in ("ids", "decoded", "n_tokens", "round_trip", "whole", "removed_id", "quality_counts", "gone_id", "gone_key"):
        docs = docs.withColumn(c, docs.label)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["5", "7", "None"]


def test_empty_tables(spark, tmp_path):
    write(spark, str(tmp_path), [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert len(corpus_pipeline.STAGES) == 5 and os.path.exists(corpus_pipeline.__file__)
    assert WORD and itertools and jaccard_at_least and shingles
