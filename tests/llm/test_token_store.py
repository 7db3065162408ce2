import zlib

import numpy as np
import pytest
from helpers import documents, texts

from qamill.llm import token_store as S


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, S.BLOCK - 1, S.BLOCK, S.BLOCK + 1, 3 * S.BLOCK + 77):
        for top in (1, 2, 300, 65536):
            ids = rng.integers(0, top, n)
            assert np.array_equal(S.decode_blocks(*S.encode_blocks(ids)), ids)
    ids = np.tile(rng.integers(0, 49408, 50), 400)
    size, n_words, words = S.encode_blocks(ids)
    assert words.nbytes < len(ids) / 2  # repeats are learned
    assert np.array_equal(S.decode_blocks(size, n_words, words), ids)


def test_blocks_stand_alone():
    ids = np.random.default_rng(2).integers(0, 5000, 3 * S.BLOCK + 5)
    size, n_words, words = S.encode_blocks(ids)
    at = np.concatenate([[0], np.cumsum(n_words)])
    for k in range(len(size)):
        assert np.array_equal(S.decode_blocks(size[k:k + 1], n_words[k:k + 1], words[at[k]:at[k + 1]]), ids[k * S.BLOCK:(k + 1) * S.BLOCK])


def test_carry_runs_through_words():
    w = S._Writer(1, 64)
    w.low[:] = np.uint64((1 << 64) - 1)
    w.words[0, :3] = [7, 0xFFFFFFFF, 0xFFFFFFFF]
    w.n[:] = 3
    w.range[:] = np.uint64(1 << 60)
    w.put(slice(0, 1), np.array([1]), np.array([1]), np.array([2]))
    assert w.words[0, :3].tolist() == [8, 0, 0]


def test_damage_is_found():
    ids = np.random.default_rng(3).integers(0, 5000, 9000)
    good = S.pack_file(3, 1, [5, None], np.array([4000, 5000]), ids)
    partition, number, docs, counts, back = S.unpack_file(good + b"\n")
    assert (partition, number, docs, counts.tolist()) == (3, 1, [5, None], [4000, 5000]) and np.array_equal(back, ids)
    bad = bytearray(good)
    bad[-200] ^= 1
    with pytest.raises(ValueError):
        S.unpack_file(bytes(bad))


def reference(text):
    tok = S._tokenizer(S.vocabulary_path(S.VOCABULARY))
    return [*tok.encode(text or "", add_special_tokens=False).ids, S.END_ID]


def test_query_against_the_library(spark, tmp_path, monkeypatch):
    rows = [*texts(), (None, "no id"), (None, None), (700, "İ ǅ é a b c \x1c don't <|endoftext|>x"), (700, "again"), (700, "again"), (-5, "negative")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(S.op10_context_mixing_ids(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    at, seen = 0, []
    for r in got:
        assert r.start == at
        at += r.n_tokens
        seen.append((str(r.doc_id), r.n_tokens, r.ids_crc32))
    want = []
    for i, t in rows:
        ids = reference(t)
        want.append((str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(seen) == sorted(want)


def test_ids_come_back_from_several_files(spark, tmp_path):
    rows = texts()[:30]
    path = str(tmp_path / "ids")
    S.write_ids(spark, documents(spark, rows), path, S.vocabulary_path(S.VOCABULARY))
    got = {r.doc_id: r.ids for r in S.read_ids(spark, path).collect()}
    assert got == {i: reference(t) for i, t in rows}


def test_word_table_starts_anew(monkeypatch):
    monkeypatch.setattr(S, "KNOWN_WORDS", 3)
    w = S.WordIds(S.vocabulary_path(S.VOCABULARY))
    for t in ("one two three four", "five one", "", "two six seven eight nine"):
        ids, per = w([t.encode()])
        assert ids.tolist() == reference(t) and per.tolist() == [len(ids)]


def test_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert S.op10_context_mixing_ids(spark, str(tmp_path)).collect() == []
