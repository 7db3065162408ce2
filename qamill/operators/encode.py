"""Vocabulary, fixed-length encoding, next-token pairs, encoder hook
(T3, T4, T7, U2).

The default encoder is a word vocabulary built by Spark: words are counted
with a partial aggregation, all of them or the ``max_vocab`` most frequent
(ties by word) become ids ``first_id..``; id 0 is unknown and id 1 is end-of-sequence, also
used as padding (T7).

Two execution paths give the same arrays:

* ``map`` (default when the vocabulary's measured size fits a broadcast):
  the vocabulary is broadcast once and every Arrow batch is encoded in
  ``mapInArrow``: no shuffle at all, one pass over the prompts.
* ``join`` (fallback for a vocabulary too big to broadcast): rows are dealt in
  blocks; each block's distinct words beyond the ``HEAD_WORDS`` most frequent
  ones are joined with the vocabulary, and each block is encoded as in ``map``
  with the head, which is broadcast, and its own words only.  Texts are shuffled
  once and words once per block; tokens are never shuffled.

A pretrained sub-word tokenizer can be plugged in through ``encode_with``:
it runs in ``mapInPandas`` over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qamill.functions.text import words
from qamill.operators.order import ordered_rank

UNK_ID = 0
EOS_ID = 1
FIRST_WORD_ID = 2
MAX_LEN = 512
MAX_VOCAB = None        # the whole vocabulary, unless a size is asked for
# Words sent to every task on the join path: the most frequent ones.
HEAD_WORDS = 20_000
# Rows of one block on the join path.
BLOCK_ROWS = 2048
# Rows that are encoded at once on the map path: the padded arrays and words of these are held, whatever a batch holds.
SLICE_ROWS = 512
# Characters of these rows, unless one row has more.
SLICE_BYTES = 1 << 20
# Broadcast the vocabulary only below this many bytes of words.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

ENCODED_SCHEMA = T.StructType([
    T.StructField("input_ids", T.ArrayType(T.IntegerType()), False),
    T.StructField("attention_mask", T.ArrayType(T.IntegerType()), False),
    T.StructField("labels", T.ArrayType(T.IntegerType()), False),
])


def word_counts(df: DataFrame, text: str = "prompt") -> DataFrame:
    """(word, n) over all rows; map-side combine keeps the shuffle small."""
    return (df.select(F.explode(words(text)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def build_vocab(df: DataFrame, text: str = "prompt", max_vocab: int | None = MAX_VOCAB,
                first_id: int = FIRST_WORD_ID, staging: str | None = None) -> DataFrame:
    """Top ``max_vocab`` words by count, ties by word: ``(word, n, token_id)``.

    ``max_vocab=None`` takes every word.  A cap is a feature (a vocabulary
    size); ``unknown_words`` counts what it leaves out.  Words below the k-th largest
    count can never enter, so a counts-of-counts histogram (one row per
    distinct count value) gives that threshold first and only words at or
    above it reach the top-k (``orderBy().limit()``: each partition keeps its
    best k, the final merge sees at most k per partition of a small set).
    """
    counts = word_counts(df, text)
    if staging:
        # The word counts feed two jobs (threshold, top-k): write them once.
        counts.write.mode("overwrite").parquet(f"{staging}/word_counts")
        counts = df.sparkSession.read.parquet(f"{staging}/word_counts")
    if max_vocab is None:
        # Exact ranks over range partitions: no single task orders the vocabulary.
        ranked = ordered_rank(counts.withColumn("_neg", -F.col("n")), ["_neg", "word"], out="_pos", total=None)
        return ranked.select("word", "n", (F.col("_pos") + first_id).cast("int").alias("token_id"))
    per_n = counts.groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    w = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = per_n.withColumn("cum", F.sum("c").over(w))
    row = reach.where(F.col("cum") >= max_vocab).agg(F.max("n").alias("t")).first()
    threshold = row["t"] if row is not None and row["t"] is not None else 0
    top = (counts.where(F.col("n") >= F.lit(threshold))
           .orderBy(F.desc("n"), F.asc("word")).limit(max_vocab))
    w = Window.orderBy(F.desc("n"), F.asc("word"))
    vocab = top.withColumn("token_id", (F.row_number().over(w) - 1 + first_id).cast("int"))
    if staging:
        # Size check, broadcast and lookups all read the same small table.
        vocab.write.mode("overwrite").parquet(f"{staging}/vocab")
        vocab = df.sparkSession.read.parquet(f"{staging}/vocab")
    return vocab


def unknown_words(df: DataFrame, vocab: DataFrame, text: str = "prompt") -> DataFrame:
    """One row: words of all texts, and how many of them the vocabulary lacks (id ``UNK_ID``)."""
    counts = word_counts(df, text).join(vocab.select("word", "token_id"), "word", "left")
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("words"),
                      F.coalesce(F.sum(F.when(F.col("token_id").isNull(), F.col("n"))), F.lit(0)).alias("unknown"))


def vocab_fits_broadcast(vocab: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Measure the vocabulary (one small aggregate) before broadcasting it."""
    row = vocab.agg(F.coalesce(F.sum(F.octet_length("word") + 16), F.lit(0)).alias("b")).first()
    return row["b"] <= limit


def encode(df: DataFrame, vocab: DataFrame, key: str = "id", text: str = "prompt",
           max_len: int = MAX_LEN, pad_id: int = EOS_ID, unk_id: int = UNK_ID,
           label_pad: int | None = None, method: str = "auto",
           carry: tuple[str, ...] = (), broadcast_limit: int = BROADCAST_LIMIT_BYTES,
           head: int = HEAD_WORDS) -> DataFrame:
    """Encode ``text`` to fixed-length ``input_ids``, ``attention_mask``, ``labels``.

    Truncate to ``max_len`` words, right-pad with ``pad_id``; mask is 1 for
    words and 0 for padding; labels copy the ids (pads included, as in the
    reference) unless ``label_pad`` is given (e.g. -100).  Returns ``key``,
    the ``carry`` columns and the three arrays.  ``method``: ``auto``,
    ``map`` or ``join`` (see the module docstring).
    """
    fits = vocab_fits_broadcast(vocab, broadcast_limit)
    if method == "auto":
        method = "map" if fits else "join"
    if method == "map":
        if not fits:
            raise ValueError("vocabulary too large to broadcast; use method='join'")
        return _encode_map(df, vocab, key, text, max_len, pad_id, unk_id, label_pad, carry)
    # Join path: a broadcast hash join only when the measured size allows it,
    # a shuffled join otherwise.
    return _encode_join(df, vocab, key, text, max_len, pad_id, unk_id, label_pad, fits, carry, head)


def encoded_arrays(texts, value_set, ids, max_len: int, pad_id: int, unk_id: int, label_pad: int | None) -> list:
    """input_ids, attention_mask and labels of an Arrow column of texts, with the words ``value_set`` and their ids.

    Arrow's ``utf8_trim_whitespace`` / ``utf8_split_whitespace`` use the
    same 29 whitespace code points as Python's ``str.split()`` (checked in
    the tests); ``index_in`` looks words up in a hash table of the
    vocabulary; a numpy scatter fills the padded matrix.
    """
    import numpy as np  # noqa: PLC0415
    import pyarrow as pa  # noqa: PLC0415
    import pyarrow.compute as pc  # noqa: PLC0415

    n = len(texts)
    id_table = np.asarray(ids, dtype=np.int32)
    texts = pc.utf8_trim_whitespace(texts.cast(pa.string()))
    toks = pc.list_slice(pc.utf8_split_whitespace(texts, max_splits=max_len), 0, max_len)
    lens = pc.list_value_length(toks).fill_null(0).to_numpy(zero_copy_only=False)
    lens = np.where(pc.fill_null(pc.equal(texts, ""), True).to_numpy(zero_copy_only=False), 0, lens)
    flat = pc.list_flatten(toks)
    offs = np.asarray(toks.offsets.to_numpy(zero_copy_only=False), dtype=np.int64)
    starts = offs[:-1] - offs[0]
    pos = pc.index_in(flat, value_set=value_set).to_numpy(zero_copy_only=False)
    found = ~np.isnan(pos.astype("float64"))
    flat_ids = np.full(len(pos), unk_id, dtype=np.int32)
    flat_ids[found] = id_table[pos[found].astype(np.int64)]
    rows = np.repeat(np.arange(n), lens)
    cols = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
    take = np.repeat(starts, lens) + cols
    mat = np.full((n, max_len), pad_id, dtype=np.int32)
    mask = np.zeros((n, max_len), dtype=np.int32)
    mat[rows, cols] = flat_ids[take]
    mask[rows, cols] = 1
    if label_pad is None:
        lab = mat
    else:
        lab = np.full((n, max_len), label_pad, dtype=np.int32)
        lab[rows, cols] = flat_ids[take]
    offsets = pa.array(np.arange(0, (n + 1) * max_len, max_len, dtype=np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(m.reshape(-1))) for m in (mat, mask, lab)]


def _slices(batch, column: str):
    """A batch in order, in parts of at most SLICE_ROWS rows and SLICE_BYTES of ``column``, one row at least."""
    import numpy as np  # noqa: PLC0415
    import pyarrow.compute as pc  # noqa: PLC0415

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        stop = int(np.searchsorted(sizes, before + SLICE_BYTES, side="right"))
        stop = min(max(stop, start + 1), start + SLICE_ROWS, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def _encode_map(df: DataFrame, vocab: DataFrame, key: str, text: str, max_len: int, pad_id: int,
                unk_id: int, label_pad: int | None, carry: tuple[str, ...]) -> DataFrame:
    """Broadcast path: vectorised per Arrow batch, no shuffle."""
    spark = df.sparkSession
    from qamill.session import ship_package  # noqa: PLC0415

    ship_package(spark)
    # Measured by the caller: safe to broadcast.
    rows = vocab.select("word", "token_id").collect()
    bc = spark.sparkContext.broadcast(([r["word"] for r in rows], [int(r["token_id"]) for r in rows]))
    keys = [key, *carry]
    src = df.select(*keys, F.col(text).alias("_text"))
    out_fields = [f for f in src.schema.fields if f.name != "_text"] + list(ENCODED_SCHEMA.fields)
    out_schema = T.StructType(out_fields)
    names = [f.name for f in out_fields]

    def run(batches):
        import pyarrow as pa  # noqa: PLC0415

        words, ids = bc.value
        value_set = pa.array(words, pa.string())
        for b in (part for batch in batches for part in _slices(batch, "_text")):
            arrays = encoded_arrays(b.column("_text"), value_set, ids, max_len, pad_id, unk_id, label_pad)
            yield pa.RecordBatch.from_arrays([b.column(nm) for nm in names[:len(keys)]] + arrays, names=names)

    return src.mapInArrow(run, out_schema)


def _encode_join(df: DataFrame, vocab: DataFrame, key: str, text: str, max_len: int, pad_id: int,
                 unk_id: int, label_pad: int | None, broadcast: bool,
                 carry: tuple[str, ...], head: int = HEAD_WORDS) -> DataFrame:
    """Join path of ``encode``: blocks of rows and the words of each block.

    A row's block follows from its key and text, so both branches agree on it;
    a block that repeated rows make large is cut in parts, each with the
    block's words.  Rows may share a key.
    """
    spark = df.sparkSession
    from qamill.session import ship_package  # noqa: PLC0415

    ship_package(spark)
    keys = [key, *carry]
    v = vocab.select("word", "token_id")
    n_blocks = max(1, -(-df.count() // BLOCK_ROWS))
    block = F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(n_blocks))
    # The most frequent words: at most ``head`` of them reach the driver and every task.
    top = v.orderBy("token_id").limit(0 if broadcast else head)
    rows = top.collect()
    bc = spark.sparkContext.broadcast(([r["word"] for r in rows], [int(r["token_id"]) for r in rows]))
    some = df.select(block.alias("_block"), F.explode(F.array_distinct(F.slice(words(text), 1, max_len))).alias("word"))
    if broadcast:
        found = some.distinct().join(F.broadcast(v), "word")
    else:
        found = some.join(F.broadcast(top.select("word")), "word", "left_anti").distinct().join(v, "word")
    # Blocks much larger than planned hold repeated rows.
    large = df.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 2 * BLOCK_ROWS).select(
        "_block", F.ceil(F.col("_n") / BLOCK_ROWS).cast("long").alias("_parts"))
    parts = F.coalesce(F.col("_parts"), F.lit(1).cast("long"))
    left = df.select(*keys, F.col(text).alias("_text"), block.alias("_block")).join(large, "_block", "left").withColumn(
        "_part", F.pmod(F.monotonically_increasing_id(), parts)).select(*keys, "_text", "_block", "_part")
    right = found.join(large, "_block", "left").select(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("_part"), "word", "token_id")
    out_fields = [f for f in left.schema.fields if f.name in keys] + list(ENCODED_SCHEMA.fields)
    names = [f.name for f in out_fields]

    def run(rows, known):
        import pyarrow as pa  # noqa: PLC0415

        rows, known = rows.combine_chunks(), known.combine_chunks()
        frequent, ids = bc.value
        value_set = pa.array([*frequent, *known.column("word").to_pylist()], pa.string())
        texts = rows.column("_text").combine_chunks() if rows.num_rows else pa.array([], pa.string())
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks)
        arrays = encoded_arrays(texts, value_set, [*ids, *known.column("token_id").to_pylist()], max_len, pad_id, unk_id, label_pad)
        return pa.Table.from_arrays([rows.column(n) for n in names[:len(keys)]] + arrays, names=names)

    on = ["_block", "_part"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(run, T.StructType(out_fields))


def next_token_pairs(df: DataFrame, ids: str = "input_ids", labels: str = "labels") -> DataFrame:
    """Model inputs and targets: ids without the last, labels without the first (T4)."""
    n = F.size(F.col(ids))
    return (df.withColumn("inputs", F.slice(F.col(ids), 1, n - 1))
              .withColumn("targets", F.slice(F.col(labels), 2, n - 1)))


def encode_with(df: DataFrame, encoder: Callable[[pd.Series], pd.DataFrame],
                text: str = "prompt") -> DataFrame:
    """Pluggable encoder (U2): ``encoder(texts) -> DataFrame(input_ids,
    attention_mask, labels)`` runs per Arrow batch in ``mapInPandas``.

    Use it for a sub-word tokenizer; the rest of the feed is unchanged.
    """
    from qamill.session import ship_package  # noqa: PLC0415

    ship_package(df.sparkSession)
    out_schema = T.StructType(list(df.schema.fields) + list(ENCODED_SCHEMA.fields))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            enc = encoder(pdf[text])
            yield pd.concat([pdf.reset_index(drop=True), enc.reset_index(drop=True)], axis=1)

    return df.mapInPandas(run, out_schema)
