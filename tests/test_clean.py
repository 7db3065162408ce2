from qamill.operators import clean as C


def test_profile_counts_twice_and_removes_once(spark):
    rows = [("s", "causes", None, "f", None), ("s", "causes", "  ", "f", "ok"),
            ("s", "causes", "q", "f", "a")]
    df = spark.createDataFrame(rows, "synonyms string, question_type string, question string, "
                                     "question_focus string, answer string")
    p = C.quality_profile(df).first()
    assert (p["missing_question"], p["missing_answer"], p["blank_question"], p["blank_answer"]) == (1, 1, 1, 0)
    assert p["total_dropped"] == 3 and p["rows_removed"] == 2 and p["initial_records"] == 3


def test_allowlist_case_and_trailing_blank(spark):
    rows = [("Symptoms",), ("symptoms ",), (None,), ("treatment",), ("exams and tests",)]
    df = spark.createDataFrame(rows, "question_type string")
    got = [r[0] for r in C.allowlist(df).collect()]
    assert sorted(got) == ["Symptoms", "exams and tests"]


def test_clean_drops_columns_and_keeps_text(spark):
    df = spark.createDataFrame([(" q ", " a\n", "x", "t", 1)],
                               "question string, answer string, symptoms string, timestamp string, k int")
    out = C.clean(df)
    assert out.columns == ["question", "answer", "k"]
    assert out.first()["answer"] == " a\n"
