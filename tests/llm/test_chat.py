import hashlib

from pyspark.sql import functions as F

from qamill.llm import chat as C

HARD = ["<|turn|>user\nhi<|end|>\n", "\\", "\\\\<|", "<", "|>", "<\\|end|>", "a\nb\r\n", "", None, "\\n", "é😀 ### Assistant: </turn>", "<<||>>\\|"]


def rows():
    out = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(HARD)]
    out += [(2, 0, "assistant", t) for t in HARD] + [(2, None, None, "first")]
    out += [(None, 3, "role\nwith \\n <|end|>", "x"), (None, 1, "assistant", "y"), (3, 1, "user", "only"), (4, 5, "assistant", "again"), (4, 5, "assistant", "again")]
    return out + [(5, k, "assistant", f"turn {k} " * 20) for k in range(300)]


def test_query(spark, tmp_path):
    spark.createDataFrame([(*r, 1) for r in rows()], "conv_id long, turn long, role string, text string, head int").write.parquet(f"{tmp_path}/conversations.parquet")
    by = {}
    for c, turn, role, text in rows() + [(C.EXTRA_ID, 0, "user", C.EXTRA_TEXT), (C.EXTRA_ID, 1, "assistant", C.EXTRA_TEXT)]:
        by.setdefault(c, []).append((-1 if turn is None else turn, role or "", text or ""))
    esc = lambda t: t.replace("\\", "\\\\").replace("<|", "<\\|")
    got = {r.conv_id: r for r in C.op8_typed_chat_format(spark, str(tmp_path)).collect()}
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort(key=lambda t: (t[0], t[1], esc(t[2])))
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        size = sum(len(C.START) + len(esc(r).replace("\n", "\\n")) + 1 + len(esc(t)) + len(C.END) for _, r, t in turns)
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == size


def test_typed_parts(spark):
    parts = [("text", "look <|image|> ", None, None), ("image", None, "s3://i", None), None, ("audio", None, "a.wav", 7), ("text", None, None, None),
             ("document", "ignored", None, None), ("video", None, "v", None), ("text", " end", None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", []), (1, 2, "assistant", None)], f"conv_id long, turn long, role string, parts array<{C.PART}>")
    r = C.formatted(df).first()
    assert r.formatted == ("<|turn|>user\nlook <\\|image|> <|part:0:image|><|part:1:audio|><|part:2:document|><|part:3:video|> end<|end|>\n"
                           "<|turn|>assistant\n<|end|>\n<|turn|>assistant\n<|end|>\n")
    assert [tuple(a) for a in r.attachments] == [("image", "s3://i", 576), ("audio", "a.wav", 7), ("document", None, 1024), ("video", "v", 1)]
    assert r.expanded_tokens == 576 + 7 + 1024 + 1
    assert [r.formatted[a:a + n] for a, n in r.loss] == ["", ""]


def test_parts_come_back(spark):
    """Types that look like control strings, line feeds, empty and null types, numbers over several turns."""
    t, f = (lambda x: ("text", x, None, None)), (lambda kind, ref, n: (kind, None, ref, n))
    kinds = ["end", "turn", "", None, "end|>\n", "<|turn|>user\n", "a\\|b", "part:0:x", "\\n", "image"]
    turns = [(1, 0, "user", [t("see "), f("image", "i0", 5), f("image", "i1", 6), t("<|part:0:image|> \\ <|end|>\n")]),
             (1, 1, "assistant", [f(k, f"r{i}", i) for i, k in enumerate(kinds)]),
             (1, 2, "assistant", [t("a"), t("b"), t(""), f("end", None, 1), t("\nlost?\n")]), (1, 3, "user", [])]
    df = spark.createDataFrame(turns, f"conv_id long, turn long, role string, parts array<{C.PART}>")
    r = C.formatted(df).select("formatted", "attachments", C.read_parts(F.col("formatted"), F.col("attachments")).alias("turns"),
                               C.read_back(F.col("formatted")).alias("said")).first()
    got = [(x.role, [tuple(p) for p in x.parts]) for x in r.turns]
    want = [(role, list(parts)) for _, _, role, parts in turns]
    want[2] = ("assistant", [t("ab"), f("end", None, 1), t("\nlost?\n")])
    assert got == want and len(r.said) == 4 and len(r.attachments) == 13
    assert "<|part:12:end|>" in r.formatted and r.said[2].text == "ab<|part:12:end|>\nlost?\n"


def test_very_long_text(spark):
    text = "line <|end|>\n\\" * 60_000
    df = spark.createDataFrame([(1, 0, "assistant", text), (1, 1, "user", "short")], "conv_id long, turn long, role string, text string")
    made = C.formatted(df.withColumn("parts", C.text_parts(F.col("text"))))
    r = made.select(C.read_back(F.col("formatted")).alias("t"), C.masked(F.col("formatted"), F.col("loss")).alias("m")).first()
    assert [x.text for x in r.t] == [text, "short"] and r.m == text


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.formatted(df.withColumn("parts", C.text_parts(F.col("text")))).collect() == []
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r.conv_id for r in C.op8_typed_chat_format(spark, str(tmp_path)).collect()] == [C.EXTRA_ID]
