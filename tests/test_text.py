from pyspark.sql import functions as F

from qamill.functions.text import PY_WS, is_blank, prompt, word_count


def _one(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(expr(F.col("t"))).collect()]


def test_whitespace_matches_python():
    assert len(PY_WS) == 29
    assert all(ch.isspace() for ch in PY_WS)
    assert all(not chr(cp).isspace() for cp in range(0x3001) if chr(cp) not in PY_WS)


def test_blank(spark):
    vals = ["", "\t\n", " 　", "\x1c\x1f", " a b ", "\x85q", None]
    got = _one(spark, vals, is_blank)
    assert got == [True, True, True, True, False, False, None]
    assert got[:6] == [v.strip() == "" for v in vals[:6]]


def test_word_count(spark):
    vals = [" a b ", "", "x y  z", None, " lead and trail　"]
    got = _one(spark, vals, word_count)
    assert got == [2, 0, 3, None, 3]
    assert got[:3] == [len(v.split()) for v in vals[:3]]


def test_prompts_are_literal(spark):
    df = spark.createDataFrame([("what {x} %s?", "{answer}")], "question string, answer string")
    short = df.select(prompt(style="short")).first()[0]
    assert short == "Question: what {x} %s?\nAnswer: {answer}"
    long = df.select(prompt(style="instruct")).first()[0]
    assert long.startswith("### Context:\n") and long.endswith("### Answer:\n{answer}\n")
    assert "### Question:\nwhat {x} %s?\n\n### Answer:" in long


def test_fixed_texts_stated_here():
    """The values that the SQL takes from the code, spelled out."""
    from qamill.functions.text import INSTRUCT_PROMPT, SHORT_PROMPT, WORD_REGEX
    from qamill.operators.clean import SAFE_TYPES
    from qamill.operators.profile import EXPECTED_TYPES
    assert INSTRUCT_PROMPT == ("### Context:\nYou are a helpful, accurate, and safety-aware medical assistant.\n\n### Instruction:\n"
                               "Answer the following medical question with factual and reliable information.\n\n"
                               "### Question:\n{question}\n\n### Answer:\n{answer}\n")
    assert SHORT_PROMPT == "Question: {question}\nAnswer: {answer}"
    assert sorted(SAFE_TYPES) == sorted((
        "causes", "complications", "considerations", "dietary", "exams and tests", "genetic changes", "how can i learn more",
        "how does it work", "how effective is it", "information", "inheritance", "outlook", "prevention", "research", "stages",
        "storage and disposal", "support groups", "susceptibility", "symptoms", "why get vaccinated"))
    assert set(EXPECTED_TYPES) == {"symptoms", "complications", "dietary", "genetic changes"}
    import re
    found = re.findall(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", WORD_REGEX), "a\u2003b c\x1cd\u3000e\u200bf")
    assert found == ["a", "b", "c", "d", "e\u200bf"]
