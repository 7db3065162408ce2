"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
through the stand-ins, over whole tables and whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qamill.functions.text import prompt
from qamill.operators import clean as C
from qamill.operators import encode as E
from qamill.operators import order as O
from qamill.operators import profile as P
from qamill.plans import standins as S

# Parameters of the registered explorer query (P6, P7): a type selection and
# a regular-expression keyword.
EXPLORE_TYPES = ("Causes", "outlook", "Symptoms", "information")
EXPLORE_KEYWORD = "ti(on|er)"
SEED = 42
VOCAB_SIZE = 32_000
WHOLE_HEAD = 50
SEQ_LEN = E.MAX_LEN
BATCH_SIZE = 8
WORKERS = 2


def offline_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """qa_clean -> seeded shuffle -> 60/20/20 (R1, R2) with ``split_size``."""
    sp = O.split_positional(S.qa_clean(spark, sf_dir), "id", seed=SEED)
    n = F.col("n_total")
    n_train = F.floor(n.cast("double") * F.lit(0.6)).cast("bigint")
    n_val = F.floor(n.cast("double") * F.lit(0.2)).cast("bigint")
    size = (F.when(F.col("split") == "training", n_train)
            .when(F.col("split") == "validation", n_val)
            .otherwise(n - n_train - n_val))
    return sp.withColumn("split_size", size.cast("bigint"))


def q_quality_profile(spark, sf_dir):
    return C.quality_profile(S.qa_docs(spark, sf_dir))


def q_clean_allowlist(spark, sf_dir):
    return S.qa_clean(spark, sf_dir)


def q_split_60_20_20(spark, sf_dir):
    return offline_splits(spark, sf_dir).select("id", "pos", "split", "split_pos")


def q_split_counts(spark, sf_dir):
    """Split sizes from one count (A3): no ranking needed for the sizes."""
    n = S.qa_clean(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    t = F.floor(F.col("n").cast("double") * F.lit(0.6)).cast("bigint")
    v = F.floor(F.col("n").cast("double") * F.lit(0.2)).cast("bigint")
    return n.select(F.explode(F.array(
        F.struct(F.lit("training").alias("split"), t.alias("n")),
        F.struct(F.lit("validation").alias("split"), v.alias("n")),
        F.struct(F.lit("evaluation").alias("split"), (F.col("n") - t - v).alias("n")),
    )).alias("s")).select("s.split", "s.n")


def q_production_batches(spark, sf_dir):
    ev = offline_splits(spark, sf_dir).where(F.col("split") == "evaluation")
    return O.chunk(ev, "split_pos", "split_size", 3).select("id", "batch")


def q_split_80_20_ordered(spark, sf_dir):
    sp = O.split_positional(S.qa_pairs(spark, sf_dir), "id", fractions=O.RETRAIN_FRACTIONS,
                            rest="validation", order=["id"])
    return sp.select("id", "pos", "split")


def q_type_distribution(spark, sf_dir):
    return P.distribution(S.qa_clean(spark, sf_dir), "question_type")


def q_distinct_types(spark, sf_dir):
    return P.distinct_values(S.qa_docs(spark, sf_dir), "question_type", include_null=True)


def q_missing_types(spark, sf_dir):
    """Expected types absent from each production batch (A10 per batch)."""
    ev = offline_splits(spark, sf_dir).where(F.col("split") == "evaluation")
    pb = O.chunk(ev, "split_pos", "split_size", 3)
    return P.missing_values(pb, "question_type", by=["batch"])


def q_question_words(spark, sf_dir):
    return P.with_word_count(S.qa_clean(spark, sf_dir)).select("id", "question_length")


def _split_lengths(spark, sf_dir):
    sp = offline_splits(spark, sf_dir).select("id", "split", "question")
    return P.with_word_count(sp).select("split", "question_length")


def q_length_box(spark, sf_dir):
    return P.box_stats(_split_lengths(spark, sf_dir), "question_length", by=["split"])


def q_length_histogram(spark, sf_dir):
    return P.histogram(_split_lengths(spark, sf_dir), "question_length", 30, by=["split"])


def q_explore_filter(spark, sf_dir):
    return P.explore(S.qa_clean(spark, sf_dir), EXPLORE_TYPES, EXPLORE_KEYWORD).select(
        "id", "question_type", "question")


def q_explore_counts(spark, sf_dir):
    return P.explore_counts(S.qa_clean(spark, sf_dir), EXPLORE_TYPES, EXPLORE_KEYWORD)


def q_explore_sample(spark, sf_dir):
    f = P.explore(S.qa_clean(spark, sf_dir), EXPLORE_TYPES, EXPLORE_KEYWORD)
    return O.sample_n(f.select("id", "question_type", "question"), "id", 10, SEED)


def q_dropped_rows(spark, sf_dir):
    return P.dropped_rows(C.quality_profile(S.qa_docs(spark, sf_dir)))


def q_version_history(spark, sf_dir):
    return P.history(S.version_metadata(spark, sf_dir))


def q_latest_version(spark, sf_dir):
    """Rows of the newest version that has both metadata and data (V3, V4)."""
    meta = S.version_metadata(spark, sf_dir)
    data = S.version_rows(spark, sf_dir)
    have_data = data.select("version").distinct()
    latest = P.latest_version(meta.join(have_data, "version", "left_semi"))
    pick = latest.select(F.col("latest_version").alias("version"))
    return data.join(F.broadcast(pick), "version", "left_semi").select(
        "event_id", "version", "event_type", "value")


def q_schema_union(spark, sf_dir):
    from qamill.sources.records import union_records  # noqa: PLC0415
    recs = union_records(S.loose_records(spark, sf_dir), "raw", key="id")
    return C.clean(recs)


def _pairs_prompt(spark, sf_dir, style):
    return S.qa_pairs(spark, sf_dir).select("id", prompt("question", "answer", style).alias("prompt"))


def q_prompt_instruct(spark, sf_dir):
    return _pairs_prompt(spark, sf_dir, "instruct")


def q_prompt_short(spark, sf_dir):
    return _pairs_prompt(spark, sf_dir, "short")


def q_vocabulary(spark, sf_dir):
    return E.build_vocab(_pairs_prompt(spark, sf_dir, "short"), "prompt", VOCAB_SIZE)


def q_encode_fixed(spark, sf_dir):
    from qamill.session import scratch_dir  # noqa: PLC0415

    p = _pairs_prompt(spark, sf_dir, "short")
    vocab = E.build_vocab(p, "prompt", VOCAB_SIZE, staging=scratch_dir(spark, "vocab"))
    return E.encode(p, vocab, "id", "prompt", SEQ_LEN)


def q_vocabulary_whole(spark, sf_dir):
    return E.build_vocab(_pairs_prompt(spark, sf_dir, "short"), "prompt")


def q_encode_whole(spark, sf_dir):
    """The whole vocabulary, joined: a broadcast head of WHOLE_HEAD words and a shuffled tail."""
    from qamill.session import scratch_dir  # noqa: PLC0415

    p = _pairs_prompt(spark, sf_dir, "short")
    vocab = E.build_vocab(p, "prompt", staging=scratch_dir(spark, "vocab"))
    return E.encode(p, vocab, "id", "prompt", SEQ_LEN, method="join", broadcast_limit=0, head=WHOLE_HEAD)


def q_next_token_pairs(spark, sf_dir):
    return E.next_token_pairs(q_encode_fixed(spark, sf_dir)).select("id", "inputs", "targets")


def q_batches_epoch(spark, sf_dir):
    sp = offline_splits(spark, sf_dir)
    train = O.batches(sp.where(F.col("split") == "training").select("id"), "id",
                      BATCH_SIZE, epoch=0, shuffle=True, seed=SEED)
    val = O.batches(sp.where(F.col("split") == "validation").select("id", "split_pos"), "id",
                    BATCH_SIZE, epoch=0, shuffle=False, pos="split_pos")
    return (train.withColumn("split", F.lit("training"))
            .unionByName(val.withColumn("split", F.lit("validation"))))


def q_worker_shards(spark, sf_dir):
    return O.shard(offline_splits(spark, sf_dir), "split_pos", WORKERS).select("id", "split", "shard")


#: Whiskers of the price box, short enough for the data to have outliers.
PRICE_WHISKER = 0.25


def _price_box(spark, sf_dir, by):
    lines = S.table(spark, sf_dir, "lineitem")
    return lines, P.box_continuous(lines, "l_extendedprice", by, whisker=PRICE_WHISKER)


def q_price_box(spark, sf_dir):
    """A8 on a column with about as many values as rows, per group."""
    return _price_box(spark, sf_dir, ["l_returnflag"])[1]


def q_box_outliers(spark, sf_dir):
    """The points outside the fences, of a table without groups."""
    lines, box = _price_box(spark, sf_dir, [])
    return P.box_outliers(lines, "l_extendedprice", box).select("l_orderkey", "l_linenumber", "l_extendedprice")


def q_event_outliers(spark, sf_dir):
    events = S.table(spark, sf_dir, "events")
    box = P.box_continuous(events, "value", ["event_type"])
    return P.box_outliers(events, "value", box, ["event_type"]).select("event_id", "event_type", "value")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "quality_profile": q_quality_profile,
    "clean_allowlist": q_clean_allowlist,
    "split_60_20_20": q_split_60_20_20,
    "split_counts": q_split_counts,
    "production_batches": q_production_batches,
    "split_80_20_ordered": q_split_80_20_ordered,
    "type_distribution": q_type_distribution,
    "distinct_types": q_distinct_types,
    "missing_types": q_missing_types,
    "question_words": q_question_words,
    "length_box": q_length_box,
    "length_histogram": q_length_histogram,
    "explore_filter": q_explore_filter,
    "explore_counts": q_explore_counts,
    "explore_sample": q_explore_sample,
    "dropped_rows": q_dropped_rows,
    "version_history": q_version_history,
    "latest_version": q_latest_version,
    "schema_union": q_schema_union,
    "prompt_instruct": q_prompt_instruct,
    "prompt_short": q_prompt_short,
    "vocabulary": q_vocabulary,
    "encode_fixed": q_encode_fixed,
    "vocabulary_whole": q_vocabulary_whole,
    "encode_whole": q_encode_whole,
    "next_token_pairs": q_next_token_pairs,
    "batches_epoch": q_batches_epoch,
    "worker_shards": q_worker_shards,
    "price_box": q_price_box,
    "box_outliers": q_box_outliers,
    "event_outliers": q_event_outliers,
}
