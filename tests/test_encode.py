from qamill.operators import encode as E


import pytest


@pytest.mark.parametrize("method", ["map", "join"])
def test_encode_pad_truncate_mask(spark, method):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c d e f"), (3, "a b c d"), (4, "")],
                               "id bigint, prompt string")
    vocab = E.build_vocab(df, "prompt", max_vocab=3)
    v = {r["word"]: r["token_id"] for r in vocab.collect()}
    assert v == {"a": 2, "b": 3, "c": 4}          # by count desc, then word
    enc = {r["id"]: r for r in E.encode(df, vocab, max_len=4, method=method).collect()}
    assert enc[1]["input_ids"] == [2, 3, 4, 1] and enc[1]["attention_mask"] == [1, 1, 1, 0]
    assert enc[2]["input_ids"] == [2, 3, 4, 0] and enc[2]["attention_mask"] == [1, 1, 1, 1]
    assert enc[3]["input_ids"] == [2, 3, 4, 0]
    assert enc[4]["input_ids"] == [1, 1, 1, 1] and enc[4]["attention_mask"] == [0, 0, 0, 0]
    assert all(r["labels"] == r["input_ids"] for r in enc.values())
    masked = {r["id"]: r for r in E.encode(df, vocab, max_len=4, label_pad=-100, method=method).collect()}
    assert masked[1]["labels"] == [2, 3, 4, -100]
    pairs = E.next_token_pairs(E.encode(df, vocab, max_len=4, method=method)).where("id = 1").first()
    assert pairs["inputs"] == [2, 3, 4] and pairs["targets"] == [3, 4, 1]


def test_encoder_hook(spark):
    import pandas as pd

    def enc(texts: pd.Series) -> pd.DataFrame:
        ids = [[len(t)] * 2 for t in texts]
        return pd.DataFrame({"input_ids": ids, "attention_mask": [[1, 1]] * len(ids), "labels": ids})

    df = spark.createDataFrame([(1, "abc")], "id bigint, prompt string")
    r = E.encode_with(df, enc).first()
    assert r["input_ids"] == [3, 3]


def test_methods_agree_on_unicode_whitespace(spark):
    texts = [(1, "x\u2003y\u00a0z  w\x1cq"), (2, " lead  trail\u3000"), (3, None)]
    df = spark.createDataFrame(texts, "id bigint, prompt string")
    vocab = E.build_vocab(df, "prompt")
    a = sorted(E.encode(df, vocab, max_len=3, method="map").collect())
    b = sorted(E.encode(df, vocab, max_len=3, method="join").collect())
    assert a == b


def test_vocab_threshold_keeps_ties_by_word(spark):
    df = spark.createDataFrame([(1, "x x x y y z z w w v")], "id bigint, prompt string")
    got = [(r["word"], r["token_id"]) for r in E.build_vocab(df, "prompt", 2).orderBy("token_id").collect()]
    assert got == [("x", 2), ("w", 3)]
    assert E.build_vocab(df, "prompt", 100).count() == 5


def test_vocab_too_big_falls_back_to_shuffled_join(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "c d")], "id bigint, prompt string")
    vocab = E.build_vocab(df, "prompt")
    enc = E.encode(df, vocab, max_len=3, broadcast_limit=1)
    plan = enc._jdf.queryExecution().executedPlan().toString()
    # no broadcast of the whole vocabulary to Python; the join strategy is
    # left to Spark's own size estimates
    assert "MapInArrow" not in plan and "Generate" in plan
    ref = E.encode(df, vocab, max_len=3, method="map")
    assert sorted(enc.collect()) == sorted(ref.collect())


def test_head_and_tail_give_the_map_paths_arrays(spark):
    rows = [(1, "a b c"), (1, "d e a a"), (2, "a"), (3, None), (4, "zz a q c d")]
    df = spark.createDataFrame(rows, "id bigint, prompt string")
    vocab = E.build_vocab(df.where("id < 4"), "prompt")
    get = lambda **kw: sorted((r["id"], tuple(r["input_ids"])) for r in E.encode(df, vocab, max_len=4, **kw).collect())
    assert get(method="map") == get(broadcast_limit=1, head=2) == get(method="join")
    r = E.unknown_words(df, vocab).first()
    assert (r["words"], r["unknown"]) == (13, 2)


def test_whole_vocabulary_has_dense_ids_by_count(spark):
    df = spark.createDataFrame([(1, "x x x y y z z w w v")], "id bigint, prompt string")
    got = [(r["word"], r["token_id"]) for r in E.build_vocab(df, "prompt").orderBy("token_id").collect()]
    assert got == [("x", 2), ("w", 3), ("y", 4), ("z", 5), ("v", 6)]


def test_blocks_and_large_blocks_give_the_map_paths_arrays(spark, monkeypatch):
    """Many blocks, and one that repeated rows make so large that it is cut in parts."""
    monkeypatch.setattr(E, "BLOCK_ROWS", 4)
    rows = [(1, "same text here zz")] * 40 + [(i, " ".join(f"w{i * j % 23}" for j in range(i % 9))) for i in range(60)] + [(None, "same"), (7, None)]
    df = spark.createDataFrame(rows, "id bigint, prompt string")
    vocab = E.build_vocab(df.where("id is null or id <> 3"), "prompt")
    get = lambda **kw: sorted(map(repr, E.encode(df, vocab, max_len=5, label_pad=-100, **kw).collect()))
    want = get(method="map")
    assert len(want) == len(rows) and want == get(broadcast_limit=1, head=3) == get(broadcast_limit=1, head=0)
    assert E.encode(df.limit(0), vocab, broadcast_limit=1).count() == 0


def test_large_batches_are_encoded_in_slices():
    import pyarrow as pa

    texts = ["a b", None, "", "é" * E.SLICE_BYTES, "c"] + ["x y"] * (2 * E.SLICE_ROWS) + ["z" * (E.SLICE_BYTES // 2)] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["id", "_text"])
    parts = list(E._slices(batch, "_text"))
    assert [i for p in parts for i in p.column("id").to_pylist()] == list(range(len(texts)))
    assert max(p.num_rows for p in parts) <= E.SLICE_ROWS
    assert all(p.num_rows == 1 or sum(len(t.encode()) for t in p.column("_text").to_pylist() if t) <= E.SLICE_BYTES for p in parts)
    assert list(E._slices(batch.slice(0, 0), "_text")) == []


def test_slices_give_the_arrays_of_the_whole_batch(spark):
    df = spark.createDataFrame([(i, " ".join(f"w{j % 97}" for j in range(i % 13))) for i in range(3 * E.SLICE_ROWS)], "id bigint, prompt string").coalesce(1)
    vocab = E.build_vocab(df, "prompt")
    ids = {r["word"]: r["token_id"] for r in vocab.collect()}
    for r in E.encode(df, vocab, max_len=6, method="map").collect():
        want = [ids[f"w{j % 97}"] for j in range(r["id"] % 13)][:6]
        assert r["input_ids"] == want + [E.EOS_ID] * (6 - len(want))
