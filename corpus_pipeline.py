"""A corpus made ready for training, in five stages over the documents table.

Each stage takes the documents its predecessor kept, and returns a DataFrame
that is written as Parquet and read again.  All but the last return the
columns they were given, whatever else these hold.

Rows with a null doc_id stay in through the quality, line and decontamination
stages by the rules for any other row; in the near-duplicate stage one row of
each text stays.  Rows that repeat a doc_id and its text count once there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qamill.llm import decontaminate, line_dedup, near_dedup, pieces, quality
from qamill.llm.tables import passing, released, staged
from qamill.session import scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the risk-controlled rules keep.  The labelled holdout is what of the labels meets a document of this stage."""
    rows = docs.select(F.struct(*docs.columns).alias("whole"), "doc_id", "lang", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # Cutoffs need the counts of labelled documents alone: those are counted first, so that no text is written beside the rows.
    good = quality.labelled_good(labels)
    held = rows.drop("whole").where(passing(good, F.col("doc_id").cast("long")))
    counted = staged(spark, quality.measured(held).drop("text"), "counted")
    strata = docs.select("lang").distinct().count()
    chosen = quality.cutoffs(spark, counted, labels, "lang", strata=strata)
    # Behind a generator: the filter stays above it and does not repeat the counting.
    measured = quality.measured(rows).select("whole", "lang", F.explode(F.array("quality_counts")).alias("quality_counts"))
    return quality.judged(spark, measured, chosen, "lang").where("quality_kept").select("whole.*")


def line_set_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line matches; n_chars follows the text.
    A document all of whose lines are such copies goes, as nothing would be left of it."""
    out = line_dedup.deduplicated(spark, docs, drop_emptied=True)
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id."""
    known, unknown = docs.where("doc_id is not null"), docs.where("doc_id is null")
    verdict = staged(spark, near_dedup.near_duplicates(spark, known.select("doc_id", "text")), "verdict")
    gone = staged(spark, verdict.where("not kept").select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    repeated = not verdict.groupBy("doc_id").count().where("count > 1").isEmpty()
    released(spark, verdict)
    # Texts stay where they are: only rows that may go meet in the join.
    may = passing(gone, F.col("doc_id").cast("long"))
    some = known.where(may)
    out = known.where(~may).union(some.join(gone, some["doc_id"] == gone["gone_id"], "left_anti"))
    if repeated:
        out = out.dropDuplicates(["doc_id", "text"])
    return out if unknown.isEmpty() else out.union(unknown.dropDuplicates(["text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    key = F.xxhash64("doc_id", "text")  # rows of one key are the same document
    found = decontaminate.contamination(spark, docs.select(key.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = staged(spark, found.where("n_hit > 0").select(F.col("doc_id").alias("gone_key")).distinct(), "contaminated")
    return docs.join(gone, F.xxhash64(docs["doc_id"], docs["text"]) == gone["gone_key"], "left_anti")


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids, the number of these, and whether decoding gives the text back."""
    ids, decoded = _free(docs, "ids"), _free(docs, "decoded")
    both = pieces.decode(spark, pieces.encode(spark, docs, ids=ids), ids=ids, text=decoded)
    return both.withColumn(_free(both, "n_tokens"), F.coalesce(F.size(ids), F.lit(0)).cast("long")).withColumn(
        _free(both, "round_trip"), F.col("text").eqNullSafe(F.col(decoded))).drop(decoded)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_set_join),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("piece_encoding", piece_encoding),
]

#: Risk control, near duplicates and piece encoding are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
