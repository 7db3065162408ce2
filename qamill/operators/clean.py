"""Projection, quality profile, cleaning and the type allow-list.

One scan feeds the profile (a single global aggregate with map-side partial
aggregation) and the cleaning branch (three combined filters and an ``InSet``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qamill.functions.text import is_blank

# The five columns of a QA record, in their stored order.
QA_COLUMNS: tuple[str, ...] = ("synonyms", "question_type", "question", "question_focus", "answer")

# The allow-list of question types, compared lower-cased.
SAFE_TYPES: tuple[str, ...] = (
    "causes", "complications", "considerations", "dietary", "exams and tests",
    "genetic changes", "how can i learn more", "how does it work",
    "how effective is it", "information", "inheritance", "outlook",
    "prevention", "research", "stages", "storage and disposal", "support groups",
    "susceptibility", "symptoms", "why get vaccinated",
)

# Columns removed from retraining records when present (P5).
RETRAIN_DROP: tuple[str, ...] = ("symptoms", "timestamp")


def project(df: DataFrame, columns: Sequence[str] = QA_COLUMNS) -> DataFrame:
    """Keep exactly these columns in this order; a missing one is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df.select(*columns)


def profile_columns(question: str = "question", answer: str = "answer") -> list[Column]:
    """Aggregate expressions of the raw-table quality profile (A1, A2).

    The four counters are independent (one row may count twice) and
    ``total_dropped`` is their sum, exactly as the reference reports it.
    ``rows_removed`` (D5) is the number of rows the null/blank cleaning removes.
    """
    q, a = F.col(question), F.col(answer)
    mq = F.count_if(q.isNull())
    ma = F.count_if(a.isNull())
    bq = F.count_if(q.isNotNull() & is_blank(q))
    ba = F.count_if(a.isNotNull() & is_blank(a))
    removed = F.count_if(q.isNull() | a.isNull() | is_blank(q) | is_blank(a))
    return [
        F.count(F.lit(1)).alias("initial_records"),
        mq.alias("missing_question"),
        ma.alias("missing_answer"),
        bq.alias("blank_question"),
        ba.alias("blank_answer"),
        (mq + ma + bq + ba).alias("total_dropped"),
        removed.alias("rows_removed"),
    ]


def quality_profile(df: DataFrame, question: str = "question", answer: str = "answer") -> DataFrame:
    """One-row profile of the raw table, before any drop (A1, A2)."""
    return df.agg(*profile_columns(question, answer))


def kept(required: Iterable[str] = ("question", "answer")) -> Column:
    """Predicate of P2 + P3: every required column present and not blank."""
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull() & ~is_blank(c)
    return cond


def allowed(column: str = "question_type", allowed_types: Iterable[str] = SAFE_TYPES) -> Column:
    """Predicate of P4 (null type -> false)."""
    return F.coalesce(F.lower(F.col(column)).isin(*list(allowed_types)), F.lit(False))


def drop_missing_or_blank(df: DataFrame, required: Iterable[str] = ("question", "answer")) -> DataFrame:
    """Drop rows where a required column is null or blank after strip.

    The stored text is not trimmed.
    """
    return df.where(kept(required))


def drop_columns(df: DataFrame, columns: Iterable[str] = RETRAIN_DROP) -> DataFrame:
    """Remove columns if present; absent ones are ignored (P5)."""
    return df.drop(*columns)


def allowlist(df: DataFrame, column: str = "question_type",
              allowed: Iterable[str] = SAFE_TYPES) -> DataFrame:
    """Keep rows whose lower-cased type is allowed; null is dropped.

    The value is not trimmed and keeps its case in the output.
    """
    return df.where(F.lower(F.col(column)).isin(*list(allowed)))


def clean(df: DataFrame, required: Iterable[str] = ("question", "answer"),
          drop: Iterable[str] = RETRAIN_DROP) -> DataFrame:
    """Retraining cleaning: P2, P3 then P5."""
    return drop_columns(drop_missing_or_blank(df, required), drop)


def clean_allowlist(df: DataFrame, columns: Sequence[str] | None = QA_COLUMNS,
                    type_column: str = "question_type",
                    allowed: Iterable[str] = SAFE_TYPES) -> DataFrame:
    """Offline cleaning: P1 (when ``columns`` is given), P2, P3, P4."""
    if columns is not None:
        df = project(df, columns)
    return allowlist(drop_missing_or_blank(df), type_column, allowed)
