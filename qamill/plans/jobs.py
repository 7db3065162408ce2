"""End-to-end jobs (X1-X6).  Paths are explicit arguments (S8); every job
reads and writes through Spark, so the same code runs on a laptop and on a
cluster with object-store URIs (K7: write straight to the target URI).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qamill.functions.text import prompt
from qamill.operators import clean as C
from qamill.operators import encode as E
from qamill.operators import order as O
from qamill.operators import profile as P
from qamill.operators import versions as V
from qamill.sources import fs, io

SPLIT_SCHEMA = T.StructType([T.StructField("id", T.LongType())] + list(io.QA_SCHEMA.fields) + [
    T.StructField("pos", T.LongType()), T.StructField("split_pos", T.LongType())])
# Reading the whole ``splits`` directory adds the partition column.
SPLITS_READ_SCHEMA = T.StructType(list(SPLIT_SCHEMA.fields) + [T.StructField("split", T.StringType())])


def split_schema(spark: SparkSession, out: str) -> T.StructType:
    """Schema of the splits under ``out``: the key's name and type are those of the raw table."""
    path = f"{out.rstrip('/')}/schema"
    if not fs.exists(spark, path):
        return SPLIT_SCHEMA
    return T.StructType.fromJson(json.loads(spark.read.text(path).first()["value"]))


def _read_part(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One split; an empty one has no folder."""
    if not fs.exists(spark, path):
        return spark.createDataFrame([], schema)
    return io.read_jsonl(spark, path, schema)


# --------------------------------------------------------------------- X1 --

@dataclass
class OfflineResult:
    initial_records: int
    final_records: int
    split_counts: dict[str, int]
    dropped: dict[str, int]


def offline_prepare(spark: SparkSession, raw: DataFrame, out: str, key: str = "id",
                    seed: int = O.DEFAULT_SEED, source: str = "raw-dataset",
                    num_batches: int = 3) -> OfflineResult:
    """Project -> profile -> clean -> allow-list -> seeded shuffle ->
    60/20/20 -> production batches -> JSONL splits, batches, metadata.

    Output under ``out``: ``splits/split=<name>/`` (K1),
    ``production/batch=<k>/`` (K2), ``metadata/`` (K3).

    ``key`` may be null or repeat: such rows are ordered by their content.
    """
    out = out.rstrip("/")
    raw = C.project(raw, (key,) + C.QA_COLUMNS)
    # One pass over the raw table gives both the quality profile (A1, A2) and
    # the per-bucket row counts the seeded rank needs (R1): rows that survive
    # cleaning are grouped by their rank bucket, the others under -1.  At most
    # 16**4 + 1 small rows, staged in the shared folder and read twice.
    keep = C.kept() & C.allowed()
    grp = F.when(keep, O.bucket_of(key, seed)).otherwise(F.lit(-1)).alias("_b")
    staged = f"{out}/_staging/bucket_profile"
    raw.groupBy(grp).agg(F.count(F.lit(1)).alias("_n"), *C.profile_columns()[1:]) \
        .write.mode("overwrite").parquet(staged)
    bp = spark.read.parquet(staged)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    prof = bp.agg(total("_n").alias("initial_records"), total(F.when(F.col("_b") >= 0, F.col("_n"))).alias("kept"),
                  *[total(k).alias(k) for k in (*P.DROP_KEYS, "rows_removed")]).first()
    counts = bp.where(F.col("_b") >= 0).select("_b", "_n")
    cleaned = raw.where(keep)                          # P2-P4
    sp = O.split_positional(cleaned, key, seed=seed, counts=counts, ties=C.QA_COLUMNS)   # R1, R2
    chosen = sp.select(key, *C.QA_COLUMNS, "pos", "split_pos", "split")
    io.write_jsonl(chosen, f"{out}/splits", partition_by=["split"])
    schema = T.StructType(chosen.schema.fields[:-1])
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(f"{out}/schema")
    # The sizes follow from the number of rows kept.
    final = int(prof["kept"])
    training, validation = int(final * O.OFFLINE_FRACTIONS["training"]), int(final * O.OFFLINE_FRACTIONS["validation"])
    m = final - training - validation
    # K2 reads the evaluation partition back (partition pruning) instead of
    # recomputing the shuffle.
    ev = _read_part(spark, f"{out}/splits/split=evaluation", schema)
    ev = ev.withColumn("batch", O.chunk_column(F.col("split_pos"), F.lit(m), num_batches))
    io.write_jsonl(ev, f"{out}/production", partition_by=["batch"])
    dropped = {k: int(prof[k]) for k in P.DROP_KEYS}
    meta_row = [(source, int(prof["initial_records"]), final,
                 (training, validation, m),
                 dropped, int(prof["rows_removed"]))]
    io.write_meta(spark.createDataFrame(meta_row, io.META_OFFLINE), f"{out}/metadata")
    fs.remove(spark, f"{out}/_staging")
    return OfflineResult(int(prof["initial_records"]), final,
                         {"training": training, "validation": validation, "testing": m}, dropped)


def read_split(spark: SparkSession, out: str, split: str) -> DataFrame:
    return _read_part(spark, f"{out.rstrip('/')}/splits/split={split}", split_schema(spark, out))


# ----------------------------------------------------------------- X3, X4 --

def feed(spark: SparkSession, train: DataFrame, val: DataFrame, out: str, key: str = "id",
         style: str = "instruct", max_len: int = E.MAX_LEN, max_vocab: int | None = E.MAX_VOCAB,
         batch_size: int = 8, epochs: int = 2, workers: int = 2, seed: int = O.DEFAULT_SEED,
         label_pad: int | None = None, extra: dict[str, object] | None = None, carry: tuple[str, ...] = ()) -> None:
    """Encode once, write samples sharded per worker, and batch plans per epoch.

    ``train``/``val`` need ``key``, ``question``, ``answer`` and ``split_pos``.
    Output: ``vocab/``, ``samples/split=/shard=/`` (Parquet), ``batches/``,
    ``unknown/`` (words and unknown words of each split).
    """
    out = out.rstrip("/")
    stage = f"{out}/_staging"
    lit_cols = [F.lit(v).alias(k) for k, v in (extra or {}).items()]
    both = (train.select(key, *carry, "split_pos", "question", "answer", F.lit("training").alias("split"))
            .unionByName(val.select(key, *carry, "split_pos", "question", "answer",
                                    F.lit("validation").alias("split"))))
    prompts = both.select(key, *carry, "split", "split_pos", prompt("question", "answer", style).alias("prompt"))
    # The JSON text is parsed once: prompts are staged as columns, which the word
    # counts, the encoder and (keys and places only) the batch plans read.
    prompts.write.mode("overwrite").parquet(f"{stage}/prompts")
    prompts = spark.read.parquet(f"{stage}/prompts")
    keys = prompts.select(key, "split", "split_pos")
    vocab = E.build_vocab(prompts.where(F.col("split") == "training"), "prompt", max_vocab,
                          staging=f"{stage}/vocab")
    vocab.write.mode("errorifexists").parquet(f"{out}/vocab")
    vocab = spark.read.parquet(f"{out}/vocab")
    # Words of each split, and how many the vocabulary lacks.
    unknown = [E.unknown_words(prompts.where(F.col("split") == x), vocab).withColumn("split", F.lit(x)) for x in ("training", "validation")]
    unknown[0].unionByName(unknown[1]).write.mode("errorifexists").parquet(f"{out}/unknown")
    enc = E.encode(prompts, vocab, key, "prompt", max_len, label_pad=label_pad,
                   carry=(*carry, "split", "split_pos"))
    samples = O.shard(enc, "split_pos", workers).select("*", *lit_cols)
    samples.write.mode("errorifexists").partitionBy("split", "shard").parquet(f"{out}/samples")
    parts = []
    tr_ids = keys.where(F.col("split") == "training").select(key)
    for e in range(epochs):
        parts.append(O.batches(tr_ids, key, batch_size, epoch=e, shuffle=True, seed=seed)
                     .withColumn("split", F.lit("training")))
    parts.append(O.batches(keys.where(F.col("split") == "validation").select(key, "split_pos"), key,
                           batch_size, shuffle=False, pos="split_pos")
                 .withColumn("split", F.lit("validation")))
    plan = parts[0]
    for p in parts[1:]:
        plan = plan.unionByName(p)
    plan.select("*", *lit_cols).write.mode("errorifexists").partitionBy("split", "epoch").parquet(
        f"{out}/batches")
    fs.remove(spark, stage)


def training_feed(spark: SparkSession, offline_out: str, out: str, **kw) -> None:
    """Offline splits -> instruction prompts -> encode -> shards, batches."""
    feed(spark, read_split(spark, offline_out, "training"), read_split(spark, offline_out, "validation"),
         out, style="instruct", **kw)


def retraining_feed(spark: SparkSession, base: str, out: str, **kw) -> int:
    """Latest version -> stored-order 80/20 (R4) -> short prompts ->
    encode -> shards, batches.  The version is carried in every row (V8).
    Returns the version used.
    """
    if fs.exists(spark, f"{base.rstrip('/')}/_manifest"):
        data, version = V.read_version(spark, base, "latest")
    else:                           # version_tracker.txt + v<N>/retraining_data.json
        data, version = V.read_tracked_version(spark, base)
    # Each record is named by its place in the drop files; the data's own id goes along.
    data = data.withColumn("record_id", F.concat_ws("|", "source_file", "source_line", "source_elem"))
    sp = O.split_positional(data, "record_id", fractions=O.RETRAIN_FRACTIONS, rest="validation",
                            order=["source_file", "source_line", "source_elem"])
    feed(spark, sp.where(F.col("split") == "training"), sp.where(F.col("split") == "validation"),
         out, key="record_id", carry=tuple(c for c in ("id",) if c in data.columns),
         style="short", extra={"version": version}, **kw)
    return version


# --------------------------------------------------------------------- X5 --

SPLITS = ("training", "validation", "evaluation")


def report(spark: SparkSession, offline_out: str, out: str, base: str | None = None,
           types: tuple[str, ...] = (), keyword: str = "", seed: int = O.DEFAULT_SEED,
           version: int | str = "latest") -> None:
    """The dashboard numbers as tables (Parquet) and CSV exports, for each split and for one version."""
    offline_out, out = offline_out.rstrip("/"), out.rstrip("/")
    meta = io.read_meta(spark, f"{offline_out}/metadata", io.META_OFFLINE)
    meta.select(F.explode("dropped").alias("type", "count")).write.parquet(f"{out}/dropped")       # A4
    meta.select("rows_removed").write.parquet(f"{out}/rows_removed")                                # D5
    schema = split_schema(spark, offline_out)
    key = schema.fields[0].name
    splits = io.read_jsonl(spark, f"{offline_out}/splits", T.StructType([*schema.fields, T.StructField("split", T.StringType())]))
    # One read of the JSON text: the columns every statistic needs are staged
    # as Parquet (no answer text), the CSV export reads the JSON once more.
    stage = f"{out}/_staging/splits"
    (P.with_word_count(splits).select(key, "split", "question_type", "question", "question_length")
     .write.mode("overwrite").parquet(stage))
    st = spark.read.parquet(stage)
    P.distribution(st, "question_type", by=["split"]).write.parquet(f"{out}/types")                # A5
    P.box_stats(st, "question_length", by=["split"]).write.parquet(f"{out}/length_box")            # A8
    P.histogram(st, "question_length", 30, by=["split"]).write.parquet(f"{out}/length_hist")       # A9
    P.explore_counts(st, types, keyword, by=["split"]).write.parquet(f"{out}/explore_counts")      # A12
    O.sample_by(P.explore(st, types, keyword), key, "split", SPLITS, 10, seed).write.parquet(f"{out}/explore_sample")  # R5
    filtered = P.explore(splits, types, keyword)                                                   # P6 P7
    io.write_csv(filtered.select(key, *C.QA_COLUMNS, "split"), f"{out}/explore_csv", partition_by=["split"])  # K6
    fs.remove(spark, f"{out}/_staging")
    if base:
        version_report(spark, base, f"{out}/version", types, keyword, seed, version)


def version_report(spark: SparkSession, base: str, out: str, types: tuple[str, ...] = (), keyword: str = "",
                   seed: int = O.DEFAULT_SEED, version: int | str = "latest") -> int | None:
    """History over versions, and of the chosen one: metadata, types, missing types, box, histogram,
    explorer counts, sample and CSV.  Reads this library's versions or the folders of another tool
    (``version_tracker.txt``, ``v<N>/``).  Returns the version, None if there is no data."""
    tracked = not fs.exists(spark, f"{base.rstrip('/')}/_manifest")
    man = V.metadata_documents(spark, base) if tracked else V.manifest(spark, base)
    P.history(man.select("version_tag", "record_count", "timestamp")).write.parquet(f"{out}/history")  # A11
    try:
        data, number = V.read_tracked_version(spark, base, version) if tracked else V.read_version(spark, base, version)
    except FileNotFoundError:
        return None
    chosen = man.where(F.col("version") == number)
    chosen.select("version_tag", "timestamp", "record_count", "archived_files").write.parquet(f"{out}/metadata")
    if tracked:
        chosen.select(F.explode("dropped").alias("type", "count")).write.parquet(f"{out}/dropped")
    data = data.withColumn("record_id", F.concat_ws("|", "source_file", "source_line", "source_elem"))
    counted = P.with_word_count(data)
    if "question_type" in data.columns:                                                             # P9
        P.distribution(data, "question_type").write.parquet(f"{out}/types")
        P.missing_values(data, "question_type").write.parquet(f"{out}/missing")                     # A10
    P.box_stats(counted, "question_length").write.parquet(f"{out}/length_box")
    P.histogram(counted, "question_length", 30).write.parquet(f"{out}/length_hist")
    P.explore_counts(data, types, keyword).write.parquet(f"{out}/explore_counts")
    found = P.explore(data, types, keyword)
    O.sample_n(found, "record_id", 10, seed).write.parquet(f"{out}/explore_sample")
    io.write_csv(found, f"{out}/explore_csv")
    return number
