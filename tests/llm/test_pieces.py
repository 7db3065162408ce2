import random
import time

import numpy as np
import pytest
import sentencepiece
from helpers import documents, texts

from qamill.llm import pieces as P


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.vocabulary_path(P.VOCABULARY))


def test_same_ids_as_the_library(library):
    enc = P.Encoder(P.Model(P.vocabulary_path(P.VOCABULARY)))
    rng = random.Random(3)
    alphabet = " ▁  \n\t\r\x00aabcABthe ingéß中文字😀ñ0123456789.,;:<>=-_/\\|é"
    some = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(1500)]
    some += ["".join(rng.choice(enc.model.text[300:9000]) for _ in range(15)) for _ in range(200)]
    some += ["", " ", "  ", "a" * 700, " " * 45, "▁▁ ▁a", "\n\n  \n", "\nstart", " \n x\n y \n", "a\n\nb \n c", "http://a.b/c_d?e=f%20" * 9, *(t or "" for _, t in texts())]
    ids, per = enc(some)
    at = np.concatenate([[0], np.cumsum(per)])
    for k, t in enumerate(some):
        mine = ids[at[k]:at[k + 1]]
        assert mine.tolist() == library.encode(t), t[:80]
        assert P.decode_ids(enc.model, mine) == t.replace("▁", " ")


def test_long_runs_of_blanks(library):
    """Runs of blanks in n log n steps, equal to the library's."""
    enc = P.Encoder(P.Model(P.vocabulary_path(P.VOCABULARY)))
    some = [" " * n for n in (1, 2, 15, 16, 17, 31, 100, 1023, 4001)] + [" " * 777 + "word" + " " * 333 + "x", "a" * 3001]
    ids, per = enc(some)
    at = np.concatenate([[0], np.cumsum(per)])
    for k, t in enumerate(some):
        assert ids[at[k]:at[k + 1]].tolist() == library.encode(t), len(t)
    began = time.time()
    enc([" " * 100_000])
    assert time.time() - began < 30


def test_suffix_array_and_occurrences():
    model = P.Model(P.vocabulary_path(P.VOCABULARY))
    text = "▁the▁thermal▁theory" * 3
    codes = np.array([ord(c) for c in text], np.uint32)
    order = P.suffix_array(codes, 8)
    assert [text[i:i + 8] for i in order] == sorted(text[i:i + 8] for i in range(len(text)))
    ids, at = P.occurrences(model, codes)
    got = {(int(i), int(a)) for i, a in zip(ids, at, strict=True)}
    assert got == {(i, a) for i in model.id.values() for a in range(len(text)) if text.startswith(model.text[i], a)}


def test_frames(spark, library):
    rows = [*texts()[:25], (None, "no id"), (3, "again"), (3, "again")]
    df = P.decode(spark, P.encode(spark, documents(spark, rows)))
    got = df.collect()
    assert [(r.doc_id, r.text) for r in got] == rows
    for r in got:
        assert r.decoded == r.text
        assert r.ids == (None if r.text is None else library.encode(r.text))
        assert r.kept == "clash"
    assert P.decode(spark, P.encode(spark, documents(spark, []))).collect() == []
    with pytest.raises(ValueError):
        P.encode(spark, documents(spark, []), ids="label")
