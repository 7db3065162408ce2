"""Column expressions for text: blanks, words, prompts, lower/strip.

All of them are native Spark expressions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour for equal results).
#
# Python's str.strip() / str.split() treat exactly these 29 code points as
# whitespace: U+0009-U+000D, U+001C-U+001F, U+0020, U+0085, U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
# ---------------------------------------------------------------------------
PY_WS_RANGES: tuple[tuple[int, int], ...] = (
    (0x09, 0x0D), (0x1C, 0x1F), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0),
    (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2028), (0x2029, 0x2029),
    (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
PY_WS_CODEPOINTS: tuple[int, ...] = tuple(
    cp for lo, hi in PY_WS_RANGES for cp in range(lo, hi + 1))
PY_WS: str = "".join(chr(cp) for cp in PY_WS_CODEPOINTS)


def _class_body(ranges) -> str:
    parts = []
    for lo, hi in ranges:
        parts.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
    return "".join(parts)


# A "word" is a maximal run of non-whitespace characters (Python str.split()).
# The same pattern text works in Java regex and in RE2.
WORD_REGEX: str = "[^" + _class_body(PY_WS_RANGES) + "]+"

# The instruction prompt of the offline training feed (T1) and
# the short prompt of the retraining feed.
INSTRUCT_PROMPT = """### Context:
You are a helpful, accurate, and safety-aware medical assistant.

### Instruction:
Answer the following medical question with factual and reliable information.

### Question:
{question}

### Answer:
{answer}
"""
SHORT_PROMPT = "Question: {question}\nAnswer: {answer}"

# What stands before, between and behind the two fields.
INSTRUCT_HEAD, INSTRUCT_MID, INSTRUCT_TAIL = INSTRUCT_PROMPT.replace("{answer}", "{question}").split("{question}")
SHORT_HEAD, SHORT_MID, _ = SHORT_PROMPT.replace("{answer}", "{question}").split("{question}")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove Python whitespace at both ends."""
    return F.btrim(_c(c), F.lit(PY_WS))


def is_blank(c) -> Column:
    """True when the text is empty after ``str.strip()``; null stays null."""
    return py_strip(c) == F.lit("")


def word_count(c) -> Column:
    """``len(text.split())`` as an int; blank -> 0, null -> null."""
    return F.regexp_count(_c(c), F.lit(WORD_REGEX))


def words(c) -> Column:
    """``text.split()`` as an array of strings, in order."""
    return F.regexp_extract_all(_c(c), F.lit(WORD_REGEX), 0)


def _as_text(c) -> Column:
    # str.format / f-strings render a missing value as "None".
    return F.coalesce(_c(c).cast("string"), F.lit("None"))


def prompt(question="question", answer="answer", style: str = "instruct") -> Column:
    """Prompt text for a question/answer pair (T1 ``instruct``, T2 ``short``).

    Plain concatenation: braces or ``%`` in the data are never interpreted.
    """
    q, a = _as_text(question), _as_text(answer)
    if style == "instruct":
        return F.concat(F.lit(INSTRUCT_HEAD), q, F.lit(INSTRUCT_MID), a, F.lit(INSTRUCT_TAIL))
    if style == "short":
        return F.concat(F.lit(SHORT_HEAD), q, F.lit(SHORT_MID), a)
    raise ValueError(f"unknown prompt style {style!r}")


def keyword_match(c, keyword: str, literal: bool = False) -> Column:
    """``str.contains(keyword, case=False, na=False)``.

    By default the keyword is a regular expression (Java dialect), matched
    case-insensitively with Unicode case folding; ``literal=True`` matches the
    plain lower-cased text instead.  Null never matches.
    """
    col = _c(c)
    if literal:
        hit = F.lower(col).contains(keyword.lower())
    else:
        hit = col.rlike("(?iu)" + keyword)
    return F.coalesce(hit, F.lit(False))
