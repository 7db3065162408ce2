"""QA-shaped tables derived by Spark from the driver tables (FIXTURES.md section 2).

The driver data has no QA corpus, so these views give the operators real
input whose size grows with the tables:

* ``qa_docs``      documents -> a raw QA table with injected nulls / blanks / types
* ``qa_pairs``     conversations -> user question and the assistant's next turn
* ``qa_clean``     qa_docs after P2-P4
* ``versions``     events grouped by day -> version data and metadata rows
* ``loose_records`` events -> JSON objects with varying key sets
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qamill.operators.clean import QA_COLUMNS, SAFE_TYPES, clean_allowlist


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The question_type cycle of the qa_docs stand-in (FIXTURES.md): the allowed
# types in order of name, three of them capitalised, then four that must be dropped.
CAPITALS = ("causes", "dietary", "symptoms")
DROPPED = ("treatment", "usage", "brand names", "symptoms ")
DOC_TYPES: tuple[str, ...] = (*(t.capitalize() if t in CAPITALS else t for t in sorted(SAFE_TYPES)), *DROPPED)


def qa_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> (id, synonyms, question_type, question, question_focus, answer)."""
    d = table(spark, sf_dir, "documents")
    doc_id, text = F.col("doc_id"), F.col("text")
    first_nl = F.instr(text, "\n")
    # First line: substring_index stops at the first newline (split_part would
    # split the whole document into an array first).
    question = (F.when(doc_id % 13 == 0, F.lit(None).cast("string"))
                .when(doc_id % 17 == 0, F.lit("  \t"))
                .otherwise(F.substring_index(text, "\n", 1)))
    answer = (F.when(doc_id % 19 == 0, F.lit(None).cast("string"))
              .when(first_nl == 0, F.lit(""))
              .otherwise(F.substr(text, first_nl + 1)))
    types = F.array(*[F.lit(t) for t in DOC_TYPES])
    qtype = (F.when(doc_id % 23 == 0, F.lit(None).cast("string"))
             .otherwise(F.element_at(types, (doc_id % len(DOC_TYPES)).cast("int") + 1)))
    return d.select(
        doc_id.alias("id"),
        F.col("source").alias("synonyms"),
        qtype.alias("question_type"),
        question.alias("question"),
        F.col("lang").alias("question_focus"),
        answer.alias("answer"),
    )


def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations -> (id, question, answer): a user turn and the assistant's reply.

    Joined on the full key (conv_id, turn), so a conversation with very many
    turns spreads over many shuffle partitions.
    """
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    u = c.where(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("next_turn"), F.col("text").alias("question"))
    a = c.where(F.col("role") == "assistant").select(
        "conv_id", F.col("turn").alias("next_turn"), F.col("text").alias("answer"))
    j = u.join(a, ["conv_id", "next_turn"], "inner")
    return j.select(
        (F.col("conv_id") * 100 + F.col("next_turn") - 1).cast("bigint").alias("id"),
        "question", "answer")


def qa_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """qa_docs after P2-P4, keeping ``id`` in front of the five QA columns."""
    return clean_allowlist(qa_docs(spark, sf_dir), columns=("id",) + QA_COLUMNS)


def version_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with a ``version`` = day number (1 = first day of the table)."""
    e = table(spark, sf_dir, "events")
    day = F.unix_date(F.to_date("ts"))
    # The first day is one scalar (a global aggregate), used as a literal.
    d0 = e.agg(F.min(day).alias("d0")).first()["d0"]
    return e.withColumn("version", (day - F.lit(d0 if d0 is not None else 0) + 1).cast("int"))


def version_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version metadata documents derived from events by day.

    ``record_count`` is absent for every 5th version and the whole document
    for every 7th, to exercise the reader's defaults (A11).
    """
    v = version_rows(spark, sf_dir)
    per_day = v.groupBy("version").agg(
        F.count(F.lit(1)).alias("_n"), F.max("ts").alias("_ts"))
    return per_day.where(F.col("version") % 7 != 0).select(
        F.concat(F.lit("v"), F.col("version").cast("string")).alias("version_tag"),
        F.col("version"),
        F.date_format(F.col("_ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.when(F.col("version") % 5 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("_n")).alias("record_count"),
    )


def loose_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (event_id, raw JSON object text) whose key sets vary by row."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    fields = F.struct(
        F.col("event_type").alias("question"),
        F.when(eid % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.format_string("%.2f", F.col("value"))).alias("answer"),
        F.when(eid % 2 == 0, F.col("event_type")).alias("question_type"),
        F.when(eid % 3 == 0, F.lit("fever")).alias("symptoms"),
        F.when(eid % 5 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("timestamp"),
        F.when(eid % 4 == 1, F.col("user_id")).alias("user"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    # to_json drops null fields, which makes the key set vary per record.
    return e.select(eid.alias("id"), F.to_json(fields).alias("raw"))
