"""Registered queries that write and read files: sources and sinks (S1-S3,
S5, K1-K3, K6), the offline job (X1), the drop-directory ingest as a stream
(ST1 with S4, S6, S7, V*, K4, K5, K8) and the scored replay (ST2, ST3).

Each call works in a fresh folder under the shared checkpoint folder and
returns what Spark reads back, so the oracle is the source table itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qamill.operators import clean as C
from qamill.operators import profile as P
from qamill.operators import samples
from qamill.operators import versions as V
from qamill.plans import catalog as Q
from qamill.plans import dropgen, jobs
from qamill.plans import oracle as O
from qamill.plans import standins as S
from qamill.session import scratch_dir
from qamill.sources import fs, io
from qamill.streaming.ingest import run_ingest_once
from qamill.streaming.replay import start_replay, word_count_score

DOC_SCHEMA = T.StructType([T.StructField("id", T.LongType())] + list(io.QA_SCHEMA.fields))

#: Shards of a small table.
ARROW_SHARDS = 4


def q_arrow_scan(spark, sf_dir):
    """Land qa_docs as Arrow stream shards, scan them back."""
    root = scratch_dir(spark, "arrow")
    docs = S.qa_docs(spark, sf_dir).select("id", *C.QA_COLUMNS)
    # As many shards as Spark reads the table in, at least ARROW_SHARDS: they grow in number, not in size.
    io.write_arrow(docs.repartition(max(ARROW_SHARDS, docs.rdd.getNumPartitions())), root, "train").collect()   # one small row per shard
    return io.read_arrow(spark, root, "train", schema=DOC_SCHEMA)


def q_csv_export(spark, sf_dir):
    """K6: explorer selection exported as CSV and read back."""
    root = scratch_dir(spark, "csv")
    f = P.explore(S.qa_clean(spark, sf_dir), Q.EXPLORE_TYPES, Q.EXPLORE_KEYWORD)
    f = f.select("id", "question_type", "question", "answer")
    io.write_csv(f, root)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("question_type", T.StringType()),
                           T.StructField("question", T.StringType()), T.StructField("answer", T.StringType())])
    return io.read_csv(spark, root, schema)


def _offline(spark, sf_dir) -> str:
    root = scratch_dir(spark, "offline")
    jobs.offline_prepare(spark, S.qa_docs(spark, sf_dir), root)
    return root


def q_jsonl_roundtrip(spark, sf_dir):
    """X1 with K1 + S3: splits written as JSON Lines, read back."""
    root = _offline(spark, sf_dir)
    sp = io.read_jsonl(spark, f"{root}/splits", jobs.SPLITS_READ_SCHEMA)
    return sp.select("id", *C.QA_COLUMNS, "pos", "split", "split_pos")


def q_production_files(spark, sf_dir):
    """X1 with K2: production batches written per batch, read back."""
    root = _offline(spark, sf_dir)
    schema = T.StructType(list(jobs.SPLIT_SCHEMA.fields) + [T.StructField("batch", T.IntegerType())])
    return io.read_jsonl(spark, f"{root}/production", schema).select("id", "batch")


def q_offline_metadata(spark, sf_dir):
    """X1 with K3 + S5: the run document, read back and flattened."""
    root = _offline(spark, sf_dir)
    m = io.read_meta(spark, f"{root}/metadata", io.META_OFFLINE)
    return m.select("source", "initial_records", "final_records",
                    F.col("split_counts.training").alias("training"),
                    F.col("split_counts.validation").alias("validation"),
                    F.col("split_counts.testing").alias("testing"),
                    *[F.col("dropped")[k].alias(k) for k in P.DROP_KEYS],
                    "rows_removed")


def _ingest(spark, sf_dir) -> str:
    """Two streaming runs over a growing drop directory: JSONL files and
    one-line arrays first (v1), pretty-printed arrays later (v2)."""
    root = scratch_dir(spark, "ingest")
    docs = S.qa_docs(spark, sf_dir)
    drop, base, arch, ck = f"{root}/drop", f"{root}/base", f"{root}/archive", f"{root}/_ckpt"
    dropgen.jsonl_files(spark, docs.where(F.col("id") % 4 < 2), f"{root}/tmp1", drop, "lines")
    dropgen.array_files(spark, docs.where(F.col("id") % 4 == 2), f"{root}/tmp2", drop, "array")
    run_ingest_once(spark, drop, base, arch, ck, quarantine_path=f"{root}/quarantine")
    dropgen.array_files(spark, docs.where(F.col("id") % 4 == 3), f"{root}/tmp3", drop, "pretty",
                        pretty=True)
    run_ingest_once(spark, drop, base, arch, ck, quarantine_path=f"{root}/quarantine")
    return root


def q_ingest_records(spark, sf_dir):
    root = _ingest(spark, sf_dir)
    return V.read_all(spark, f"{root}/base").select("id", *C.QA_COLUMNS, "version")


def q_ingest_versions(spark, sf_dir):
    root = _ingest(spark, sf_dir)
    return V.manifest(spark, f"{root}/base").select("version", "record_count")


def q_ingest_quarantine(spark, sf_dir):
    root = _ingest(spark, sf_dir)
    schema = T.StructType([T.StructField("reason", T.StringType()), T.StructField("raw", T.StringType())])
    return spark.read.schema(schema).json(f"{root}/quarantine").select("reason", "raw")


def q_replay_score(spark, sf_dir):
    """Production batches replayed as a stream, scored per record."""
    root = _offline(spark, sf_dir)
    schema = T.StructType(list(jobs.SPLIT_SCHEMA.fields) + [T.StructField("batch", T.IntegerType())])
    q = start_replay(spark, f"{root}/production", schema, word_count_score,
                     f"{root}/replay", f"{root}/_replay_ckpt", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(f"{root}/replay").select("pos", "status", "response", "error")


def _feed(spark, sf_dir) -> str:
    root = _offline(spark, sf_dir)
    jobs.training_feed(spark, root, f"{root}/feed", seed=Q.SEED, max_len=Q.SEQ_LEN,
                       max_vocab=Q.VOCAB_SIZE, batch_size=Q.BATCH_SIZE, workers=Q.WORKERS, epochs=2)
    return root


def q_training_samples(spark, sf_dir):
    """Offline splits -> instruction prompts -> vocabulary of the training
    split -> fixed-length arrays, sharded per worker (T1, T3, T6, T7)."""
    root = _feed(spark, sf_dir)
    return spark.read.parquet(f"{root}/feed/samples").select(
        "id", "split", "shard", "input_ids", "attention_mask", "labels")


def q_training_batches(spark, sf_dir):
    """Batch plan, training reshuffled per epoch, validation in order (T5)."""
    root = _feed(spark, sf_dir)
    return spark.read.parquet(f"{root}/feed/batches").select(
        "split", "epoch", "batch_id", "ids", "n_rows")


def q_retrain_samples(spark, sf_dir):
    """Latest ingested version -> stored-order 80/20 -> short prompts ->
    arrays; the version and the data's own id travel with every row (V3, R4,
    T2, T3, V8).  Version 2 has files of one id range each, named in order."""
    root = _ingest(spark, sf_dir)
    jobs.retraining_feed(spark, f"{root}/base", f"{root}/feed", seed=Q.SEED, max_len=Q.SEQ_LEN,
                         max_vocab=Q.VOCAB_SIZE, batch_size=Q.BATCH_SIZE, workers=Q.WORKERS)
    return spark.read.parquet(f"{root}/feed/samples").select(
        "id", "split", "shard", "version", "input_ids", "attention_mask", "labels")


def q_offline_string_key(spark, sf_dir):
    """X1 with a text key: the splits keep the key's name and type."""
    root = scratch_dir(spark, "offline")
    docs = S.qa_docs(spark, sf_dir).withColumn("key", F.concat(F.lit("doc-"), F.col("id").cast("string"))).drop("id")
    jobs.offline_prepare(spark, docs, root, key="key")
    parts = [jobs.read_split(spark, root, s).withColumn("split", F.lit(s)) for s in ("training", "validation", "evaluation")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("key", "question_type", "split").withColumn(
        "n", F.lit(1)).groupBy("key", "question_type").agg(F.sum("n").alias("n"))


def q_ingest_same_name(spark, sf_dir):
    """ST1, V1, K8: one file name dropped twice gives two versions, and both files stay in the archive."""
    root = scratch_dir(spark, "ingest")
    docs = S.qa_docs(spark, sf_dir)
    for part in (0, 1):
        dropgen.array_files(spark, docs.where(F.col("id") % 2 == part), f"{root}/tmp{part}", f"{root}/drop", "day", group_size=500)
        run_ingest_once(spark, f"{root}/drop", f"{root}/base", f"{root}/archive", f"{root}/_ckpt")
    return V.read_all(spark, f"{root}/base").select("id", "version")


def q_archive_listing(spark, sf_dir):
    """K7, K8: what the archive holds after two ingest runs, by version and kind of file."""
    root = _ingest(spark, sf_dir)
    name = F.element_at(F.split("path", "/"), -1)
    return fs.list_tree(spark, f"{root}/archive").select(
        F.regexp_extract("path", r"/(v[0-9]+)/[^/]*$", 1).alias("version_tag"), F.substring_index(name, "-", 1).alias("kind")).where(
        "kind <> 'lines'").groupBy("version_tag", "kind").agg(F.count(F.lit(1)).alias("files"))


def q_ingest_mixed_types(spark, sf_dir):
    """Questions that are text, numbers, blank, null or missing, in one version."""
    root = scratch_dir(spark, "ingest")
    q = F.expr("""case id % 5 when 0 then cast(id as string) when 1 then '""' when 2 then 'null'
                  when 3 then to_json(named_struct('q', concat('q', id))) else concat('"q', id, '"') end""")
    line = F.concat(F.lit('{"id":'), F.col("id"), F.lit(',"answer":"a","question":'), q, F.lit("}"))
    S.qa_docs(spark, sf_dir).select(line.alias("value")).write.text(f"{root}/tmp")
    dropgen._publish(spark, fs.list_files(spark, f"{root}/tmp", ".txt"), f"{root}/drop", "mixed")
    V.ingest_dir(spark, f"{root}/drop", f"{root}/base", f"{root}/archive")
    return V.read_all(spark, f"{root}/base").select("id", "question")


def q_report_splits(spark, sf_dir):
    """The explorer's "shown / total" of each split."""
    root = _offline(spark, sf_dir)
    jobs.report(spark, root, f"{root}/report", types=Q.EXPLORE_TYPES, keyword=Q.EXPLORE_KEYWORD)
    return spark.read.parquet(f"{root}/report/explore_counts").select("split", "shown", "total")


def q_report_version(spark, sf_dir):
    """Types of a chosen version that isn't the latest."""
    root = _ingest(spark, sf_dir)
    jobs.version_report(spark, f"{root}/base", f"{root}/report", version=1)
    return spark.read.parquet(f"{root}/report/types").select("question_type", "n")


#: Samples of one file in the lookup query.
LOOKUP_FILE = 256
#: Copies of each row, and ids of one file: the number of files grows with the table, not their size.
BIG_COPIES, BIG_IDS = 60, 1000


def _big_arrays(spark, sf_dir, copies: int) -> str:
    """JSON arrays on one line, one for each range of ids, ingested."""
    root = scratch_dir(spark, "ingest")
    docs = S.qa_docs(spark, sf_dir).select("id", F.lit("q").alias("question"), F.coalesce("answer", "question").alias("answer"))
    dropgen.one_line_arrays(spark, docs, F.floor(F.col("id") / BIG_IDS), ["id"], f"{root}/tmp", f"{root}/drop", "big", copies)
    V.ingest_dir(spark, f"{root}/drop", f"{root}/base", f"{root}/archive")
    return root


def q_ingest_big_array(spark, sf_dir):
    """JSON arrays on one line each, too large for a single parsed value (150 MB of one range of ids)."""
    root = _big_arrays(spark, sf_dir, BIG_COPIES)
    return V.read_all(spark, f"{root}/base").groupBy("copy").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("answer")).alias("chars"))


def q_ingest_array_places(spark, sf_dir):
    """The place of every record in arrays that several tasks cut (12 MB of one range of ids)."""
    root = _big_arrays(spark, sf_dir, 5)
    return V.read_all(spark, f"{root}/base").select("id", "copy", F.col("source_elem").cast("long").alias("source_elem"))


def q_ingest_odd_keys(spark, sf_dir):
    """Keys with an apostrophe, a colon, a comma, a back tick, a dot, and the empty key; nested and mixed values."""
    root = scratch_dir(spark, "ingest")
    odd = F.expr('''concat('"it\\\'s":', id, ',"c: d":', id / 4, ',"a,b":"x', id, '","`t`":', if(id % 2 = 0, 'true', 'null'),
                    ',"":"e', id, '","n.m":{"k":[', id, ']},"<o>":', if(id % 3 = 0, '"s"', '1'))''')
    line = F.concat(F.lit('{"question":"q","answer":"a","id":'), F.col("id"), F.when(F.col("id") % 5 > 0, F.concat(F.lit(","), odd)).otherwise(""), F.lit("}"))
    S.qa_docs(spark, sf_dir).select(line.alias("value")).write.text(f"{root}/tmp")
    dropgen._publish(spark, fs.list_files(spark, f"{root}/tmp", ".txt"), f"{root}/drop", "odd")
    V.ingest_dir(spark, f"{root}/drop", f"{root}/base", f"{root}/archive")
    keys = {"it's": "apostrophe", "c: d": "colon", "a,b": "comma", "``t``": "tick", "_": "empty", "n.m": "dot", "<o>": "mixed"}
    return V.read_all(spark, f"{root}/base").select("id", *[F.col(f"`{k}`").alias(a) for k, a in keys.items()])


def q_ingest_quarantine_elements(spark, sf_dir):
    """What is no object in an array goes to quarantine with its text, also what Spark's parser refuses."""
    root = scratch_dir(spark, "ingest")
    item = F.expr("""case id % 6 when 0 then 'NaN' when 1 then cast(id as string) when 2 then concat('"s', id, '"')
                     when 3 then concat('{"question":"q","answer":-Infinity,"id":', id, '}') else concat('{"question":"q","answer":"a","id":', id, '}') end""")
    docs = S.qa_docs(spark, sf_dir).select("id", item.alias("j")).groupBy(F.floor(F.col("id") / 500).alias("g")).agg(
        F.sort_array(F.collect_list(F.struct("id", "j"))).alias("items"))
    text = F.concat(F.lit("[\n"), F.array_join(F.transform("items", lambda x: x["j"]), ",\n"), F.lit("\n]"))
    docs.select("g", text.alias("value")).write.partitionBy("g").text(f"{root}/tmp")
    for g in fs.list_names(spark, f"{root}/tmp"):
        if g.startswith("g="):
            dropgen._publish(spark, fs.list_files(spark, f"{root}/tmp/{g}", ".txt"), f"{root}/drop", f"items-{g[2:]}")
    V.ingest_dir(spark, f"{root}/drop", f"{root}/base", f"{root}/archive", quarantine_path=f"{root}/quarantine")
    kept = V.read_all(spark, f"{root}/base").select(F.lit("kept").alias("reason"), F.col("id").cast("string").alias("raw"))
    return spark.read.schema("reason string, raw string").json(f"{root}/quarantine").select("reason", "raw").union(kept)


def q_ingest_widened(spark, sf_dir):
    """V3, V4: versions whose columns differ in type and number, read as one table."""
    root = scratch_dir(spark, "ingest")
    docs = S.qa_docs(spark, sf_dir)
    values = ("cast(id as string)", "cast(id + 0.5 as string)", "concat('\"t', id, '\"')")
    for k, value in enumerate(values):
        line = F.concat(F.lit('{"question":"q","answer":"a","id":'), F.col("id"), F.lit(',"x":'), F.expr(value), F.lit(f',"only{k}":true,"n":'),
                        F.expr("cast(id as string)" if k else "cast(id + 0.25 as string)"), F.lit("}"))
        docs.where(F.col("id") % 3 == k).select(line.alias("value")).write.text(f"{root}/tmp{k}")
        dropgen._publish(spark, fs.list_files(spark, f"{root}/tmp{k}", ".txt"), f"{root}/drop", f"part{k}")
        V.ingest_dir(spark, f"{root}/drop", f"{root}/base", f"{root}/archive")
    return V.read_all(spark, f"{root}/base").select("id", "x", "n", "only0", "only2", "version")


def q_offline_null_key(spark, sf_dir):
    """X1 with keys that are null or repeat: no row is lost, and their order follows their content."""
    root = scratch_dir(spark, "offline")
    key = F.expr("case id % 10 when 0 then null when 1 then 'twice' when 2 then '' else concat('doc-', id) end")
    docs = S.qa_docs(spark, sf_dir).select(key.alias("key"), *C.QA_COLUMNS)
    done = jobs.offline_prepare(spark, docs, root, key="key")
    assert done.final_records == sum(done.split_counts.values())
    parts = [jobs.read_split(spark, root, s).withColumn("split", F.lit(s)) for s in ("training", "validation", "evaluation")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("key", *C.QA_COLUMNS, "pos", "split", "split_pos")


def q_batches_permuted(spark, sf_dir):
    """T5: batches of two epochs; every row computes its own places from its position."""
    root = scratch_dir(spark, "epochs")
    train = Q.offline_splits(spark, sf_dir).where(F.col("split") == "training").select("id", "split_pos")
    train.write.parquet(root)
    keys = spark.read.parquet(root)
    return Q.O.batches_permuted(keys, "id", keys.count(), size=Q.BATCH_SIZE, epochs=(0, 1), seed=Q.SEED)


def q_sample_lookup(spark, sf_dir):
    """Samples written with their index, and looked up at a place for each row (places repeat, and one in 50 doesn't exist)."""
    root = _feed(spark, sf_dir)
    written = spark.read.parquet(f"{root}/feed/samples").select("id", "split", "split_pos", "input_ids", "attention_mask", "labels")
    samples.write(written, f"{root}/indexed", rows_per_file=LOOKUP_FILE)
    asked = written.select("split", "split_pos").withColumn("place", F.expr("if(split_pos % 50 = 7, -1 - split_pos, split_pos * 5 div 7)"))
    found = samples.lookup(spark, f"{root}/indexed", asked)
    return found.select("split", "split_pos", "place", "sample.id", "sample.input_ids")


def q_landed(spark, sf_dir):
    """A raw table of JSON Lines landed once as a snapshot in which every row has an id of its own."""
    root = scratch_dir(spark, "landed")
    io.write_jsonl(S.qa_docs(spark, sf_dir).select(*C.QA_COLUMNS), f"{root}/raw")
    out = io.land_raw(spark, f"{root}/raw", f"{root}/snapshot", fmt="json", schema=io.QA_SCHEMA)
    own = out.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return out.join(own, "id").select(*C.QA_COLUMNS, "n")


EXTRA_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "arrow_scan": q_arrow_scan,
    "csv_export": q_csv_export,
    "jsonl_roundtrip": q_jsonl_roundtrip,
    "production_files": q_production_files,
    "offline_metadata": q_offline_metadata,
    "ingest_records": q_ingest_records,
    "ingest_versions": q_ingest_versions,
    "ingest_quarantine": q_ingest_quarantine,
    "replay_score": q_replay_score,
    "training_samples": q_training_samples,
    "training_batches": q_training_batches,
    "retrain_samples": q_retrain_samples,
    "offline_string_key": q_offline_string_key,
    "ingest_same_name": q_ingest_same_name,
    "archive_listing": q_archive_listing,
    "ingest_mixed_types": q_ingest_mixed_types,
    "ingest_big_array": q_ingest_big_array,
    "ingest_array_places": q_ingest_array_places,
    "ingest_odd_keys": q_ingest_odd_keys,
    "ingest_quarantine_elements": q_ingest_quarantine_elements,
    "ingest_widened": q_ingest_widened,
    "offline_null_key": q_offline_null_key,
    "batches_permuted": q_batches_permuted,
    "sample_lookup": q_sample_lookup,
    "landed_raw": q_landed,
    "report_splits": q_report_splits,
    "report_version": q_report_version,
}


def extra_oracle_sql() -> dict[str, str]:
    docs = f"with {O.QA_DOCS}"
    valid = (f"question is not null and answer is not null and not {O.blank('question')} "
             f"and not {O.blank('answer')}")
    junk = "(id % 4 < 2 and id % 37 = 0)"
    types_in = O.TYPES_IN
    kw = O.KW
    return {
        "arrow_scan": f"{docs} select id, synonyms, question_type, question, question_focus, answer from qa_docs",
        "csv_export": f"""with {O.QA_DOCS}, {O.QA_CLEAN}
select id, question_type, question, answer from qa_clean
where question_type in ({types_in}) and regexp_matches(question, {kw})""",
        "jsonl_roundtrip": f"""with {O.QA_DOCS}, {O.QA_CLEAN}, {O.SPLITS}
select id, synonyms, question_type, question, question_focus, answer, pos, split, split_pos from splits""",
        "production_files": f"with {O.QA_DOCS}, {O.QA_CLEAN}, {O.SPLITS}, {O.PROD} select id, batch from prod",
        "offline_metadata": f"""with {O.QA_DOCS}, {O.QA_CLEAN}, {O.SPLITS}, {O.PROFILE},
c as (select cast(count_if(split = 'training') as bigint) as training,
             cast(count_if(split = 'validation') as bigint) as validation,
             cast(count_if(split = 'evaluation') as bigint) as testing,
             cast(count(*) as bigint) as final_records from splits)
select 'raw-dataset' as source, initial_records, final_records, training, validation, testing,
       missing_question, missing_answer, blank_question, blank_answer,
       cast(missing_question + missing_answer + blank_question + blank_answer as bigint) as total_dropped,
       rows_removed
from prof, c""",
        "ingest_records": f"""{docs}
select id, synonyms, question_type, question, question_focus, answer,
       cast(case when id % 4 = 3 then 2 else 1 end as integer) as version
from qa_docs where {valid} and not {junk}""",
        "ingest_versions": f"""{docs}
select cast(case when id % 4 = 3 then 2 else 1 end as integer) as version, cast(count(*) as bigint) as record_count
from qa_docs where {valid} and not {junk} group by 1""",
        "ingest_quarantine": f"""{docs}
select 'invalid_json' as reason, {O.lit(dropgen.JUNK_PREFIX)} || coalesce(question, '') as raw
from qa_docs where {junk}""",
        "training_samples": f"""with {O.QA_DOCS}, {O.QA_CLEAN}, {O.SPLITS},
p as (select id, split, split_pos, {O.PROMPT_INSTRUCT} as prompt from splits
      where split in ('training', 'validation')),
{O.vocab_sql("p", "split = 'training'")},
{O.encode_sql("p", ", split, split_pos")}
select id, split, cast(split_pos % {Q.WORKERS} as integer) as shard, input_ids, attention_mask, labels
from encoded""",
        "training_batches": f"""with {O.QA_DOCS}, {O.QA_CLEAN}, {O.SPLITS},
ep as (select unnest([0, 1]) as epoch),
tr as (select e.epoch, s.id,
              row_number() over (partition by e.epoch
                                 order by md5('{Q.SEED}|' || e.epoch || '|' || cast(s.id as varchar)), s.id) - 1
                as bpos
       from splits s, ep e where s.split = 'training'),
va as (select id, split_pos as bpos from splits where split = 'validation')
select 'training' as split, cast(epoch as integer) as epoch, cast(bpos // {Q.BATCH_SIZE} as bigint) as batch_id,
       list(id order by bpos) as ids, cast(count(*) as integer) as n_rows
from tr group by epoch, bpos // {Q.BATCH_SIZE}
union all
select 'validation', cast(0 as integer), cast(bpos // {Q.BATCH_SIZE} as bigint),
       list(id order by bpos), cast(count(*) as integer) from va group by bpos // {Q.BATCH_SIZE}""",
        "retrain_samples": f"""{docs},
st as (select id, question, answer, row_number() over (order by cast(id // 500 as varchar), id) - 1 as pos
       from qa_docs where {valid} and id % 4 = 3),
sz as (select cast(floor(count(*) * 0.8) as bigint) as n from st),
p as (select id, case when pos < n then 'training' else 'validation' end as split,
             case when pos < n then pos else pos - n end as split_pos, {O.PROMPT_SHORT} as prompt from st, sz),
{O.vocab_sql("p", "split = 'training'")},
{O.encode_sql("p", ", split, split_pos")}
select id, split, cast(split_pos % {Q.WORKERS} as integer) as shard, cast(2 as integer) as version,
       input_ids, attention_mask, labels from encoded""",
        "offline_string_key": f"""with {O.QA_DOCS}, {O.QA_CLEAN}
select 'doc-' || cast(id as varchar) as key, question_type, cast(1 as bigint) as n from qa_clean""",
        "ingest_same_name": f"""{docs}
select id, cast(id % 2 + 1 as integer) as version from qa_docs where {valid}""",
        "archive_listing": f"""{docs}
select case when id % 4 = 3 then 'v2' else 'v1' end as version_tag, case when id % 4 = 3 then 'pretty' else 'array' end as kind,
       count(distinct id // 500) as files from qa_docs where id % 4 >= 2 group by 1, 2""",
        "report_splits": f"""with {O.QA_DOCS}, {O.QA_CLEAN}, {O.SPLITS}
select split, count(*) filter (question_type in ({types_in}) and regexp_matches(question, {kw})) as shown, count(*) as total
from splits group by split""",
        "report_version": f"""{docs}
select question_type, count(*) as n from qa_docs where {valid} and not {junk} and id % 4 <> 3 group by 1""",
        "ingest_mixed_types": f"""{docs}
select id, case id % 5 when 0 then cast(id as varchar) when 3 then '{{"q":"q' || id || '"}}' else 'q' || id end as question
from qa_docs where id % 5 not in (1, 2)""",
        "ingest_big_array": f"""{docs},
a as (select coalesce(answer, question) as answer from qa_docs)
select cast(c as bigint) as copy, count(*) as n, cast(sum(length(answer)) as bigint) as chars
from a, (select unnest(range(1, {BIG_COPIES + 1})) as c)
where answer is not null and not {O.blank('answer')} group by c""",
        "ingest_array_places": f"""{docs},
a as (select id, coalesce(answer, question) as answer from qa_docs),
r as (select id, answer, cast(c as bigint) as copy, row_number() over (partition by id // {BIG_IDS} order by id, c) - 1 as source_elem
      from a, (select unnest(range(1, 6)) as c))
select id, copy, source_elem from r where answer is not null and not {O.blank('answer')}""",
        "ingest_odd_keys": f"""{docs}
select id, case when k then id end as apostrophe, case when k then id / 4 end as colon, case when k then 'x' || id end as comma,
       case when k and id % 2 = 0 then true end as tick, case when k then 'e' || id end as empty,
       case when k then '{{"k":[' || id || ']}}' end as dot, case when k then case when id % 3 = 0 then 's' else '1' end end as mixed
from (select id, id % 5 > 0 as k from qa_docs)""",
        "ingest_quarantine_elements": f"""{docs}
select case id % 6 when 0 then 'invalid_json' when 3 then 'invalid_json' when 1 then 'element_not_an_object'
            when 2 then 'element_not_an_object' else 'kept' end as reason,
       case id % 6 when 0 then 'NaN' when 2 then '"s' || id || '"' when 3 then '{{"question":"q","answer":-Infinity,"id":' || id || '}}'
            else cast(id as varchar) end as raw from qa_docs""",
        "ingest_widened": f"""{docs}
select id, case id % 3 when 0 then cast(id as varchar) when 1 then cast(id as varchar) || '.5' else 't' || id end as x,
       cast(id + case when id % 3 = 0 then 0.25 else 0 end as double) as n, case when id % 3 = 0 then true end as only0,
       case when id % 3 = 2 then true end as only2, cast(id % 3 + 1 as integer) as version from qa_docs""",
        "offline_null_key": f"""with {O.QA_DOCS}, {O.QA_CLEAN},
keyed as (select case id % 10 when 0 then null when 1 then 'twice' when 2 then '' else 'doc-' || id end as key,
                 synonyms, question_type, question, question_focus, answer from qa_clean),
r as (select *, row_number() over (order by md5('{Q.SEED}|' || coalesce(key, '')), key nulls first, synonyms nulls first,
             question_type nulls first, question nulls first, question_focus nulls first, answer nulls first) - 1 as pos,
             count(*) over () as n from keyed),
b as (select *, cast(floor(n * cast(0.6 as double)) as bigint) as nt, cast(floor(n * cast(0.2 as double)) as bigint) as nv from r)
select key, synonyms, question_type, question, question_focus, answer, pos,
       case when pos < nt then 'training' when pos < nt + nv then 'validation' else 'evaluation' end as split,
       case when pos < nt then pos when pos < nt + nv then pos - nt else pos - nt - nv end as split_pos from b""",
        "batches_permuted": O.permuted_sql(),
        "sample_lookup": f"""with {O.QA_DOCS}, {O.QA_CLEAN}, {O.SPLITS},
p as (select id, split, split_pos, {O.PROMPT_INSTRUCT} as prompt from splits
      where split in ('training', 'validation')),
{O.vocab_sql("p", "split = 'training'")},
{O.encode_sql("p", ", split, split_pos")}
select a.split, a.split_pos, a.split_pos * 5 // 7 as place, e.id, e.input_ids
from encoded a join encoded e on e.split = a.split and e.split_pos = a.split_pos * 5 // 7 where a.split_pos % 50 <> 7""",
        "landed_raw": f"{docs} select synonyms, question_type, question, question_focus, answer, cast(1 as bigint) as n from qa_docs",
        "replay_score": f"""with {O.QA_DOCS}, {O.QA_CLEAN}, {O.SPLITS}
select pos, 'ok' as status, cast(len({O.words('question')}) as varchar) as response,
       cast(null as varchar) as error
from splits where split = 'evaluation'""",
    }
