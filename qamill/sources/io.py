"""Schemas, scans and sinks.

Readers always take a declared schema: no inference pass over the data and
no type drift between runs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QA_SCHEMA = T.StructType([
    T.StructField("synonyms", T.StringType()),
    T.StructField("question_type", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("question_focus", T.StringType()),
    T.StructField("answer", T.StringType()),
])

META_OFFLINE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("initial_records", T.LongType()),
    T.StructField("final_records", T.LongType()),
    T.StructField("split_counts", T.StructType([
        T.StructField("training", T.LongType()),
        T.StructField("validation", T.LongType()),
        T.StructField("testing", T.LongType()),
    ])),
    T.StructField("dropped", T.MapType(T.StringType(), T.LongType())),
    T.StructField("rows_removed", T.LongType()),
])

META_VERSION = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("archived_files", T.ArrayType(T.StringType())),
    T.StructField("dropped", T.MapType(T.StringType(), T.LongType())),
])


# ----------------------------------------------------------------- scans --

def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = QA_SCHEMA) -> DataFrame:
    """JSON Lines with a declared schema (S3).  Splittable: never ``multiLine``."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(paths)


def read_meta(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Small (possibly pretty-printed) JSON documents, one per file."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def land_raw(spark: SparkSession, src: str, dest: str, fmt: str = "parquet",
             options: dict[str, str] | None = None, schema: T.StructType | None = None,
             add_id: str | None = "id", split: str | None = "train") -> DataFrame:
    """Land the raw corpus once as a Parquet snapshot so later stages never
    touch the origin (S1).  ``fmt`` is any Spark source; ``arrow`` means a
    saved dataset of Arrow stream shards, split ``split`` (S2).

    ``add_id`` adds a unique row id when the source has none: assigned while
    landing, so it is fixed in the snapshot from then on (the seeded shuffle
    needs a unique key).
    """
    if fmt == "arrow":
        df = read_arrow(spark, src, split=split, schema=schema)
    else:
        r = spark.read.format(fmt).options(**(options or {}))
        if schema is not None:
            r = r.schema(schema)
        df = r.load(src)
    if add_id and add_id not in df.columns:
        df = df.withColumn(add_id, F.monotonically_increasing_id())
    df.write.mode("errorifexists").parquet(dest)
    return spark.read.parquet(dest)


def read_arrow(spark: SparkSession, path: str, split: str | None = "train",
               schema: T.StructType | None = None, glob: str = "*.arrow") -> DataFrame:
    """Arrow IPC *stream* shards of a saved dataset, split ``split``.

    The listing is a ``binaryFile`` scan of paths only; each shard is opened
    by the task that owns it and streamed batch by batch through
    ``mapInArrow`` (one shard = one task, never one whole file in a row).
    """
    from qamill.session import ship_package  # noqa: PLC0415

    ship_package(spark)
    root = path.rstrip("/") + (f"/{split}" if split else "")
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", "true").load(root).select("path"))
    if schema is None:
        schema = _arrow_schema(spark, listing)
    # One shard per partition, so each shard becomes its own task: the listing
    # (metadata only) is dealt round-robin from a single partition.
    n = max(1, listing.count())
    listing = listing.coalesce(1).repartition(n)
    names = schema.fieldNames()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs  # noqa: PLC0415
        import pyarrow.ipc as ipc  # noqa: PLC0415

        for b in batches:
            for p in b.column("path").to_pylist():
                fs, inner = _fs_for(p)
                with fs.open_input_stream(inner) as f:
                    reader = ipc.open_stream(f)
                    for rb in reader:
                        yield pa.RecordBatch.from_arrays(
                            [rb.column(rb.schema.get_field_index(c)) for c in names], names=names)

    return listing.mapInArrow(read, schema)


def _fs_for(path: str):
    """pyarrow file system + inner path for a Spark-listed path (a URI whose
    name may hold characters that need quoting, e.g. spaces)."""
    import urllib.parse  # noqa: PLC0415

    import pyarrow.fs as pafs  # noqa: PLC0415

    try:
        return pafs.FileSystem.from_uri(path)
    except (ValueError, OSError):
        fs, inner = pafs.FileSystem.from_uri(urllib.parse.quote(path, safe=":/"))
        return fs, urllib.parse.unquote(inner)


def _arrow_schema(spark: SparkSession, listing: DataFrame) -> T.StructType:
    """Schema of the first shard (reads only its stream header)."""
    import pyarrow.fs as pafs  # noqa: PLC0415
    import pyarrow.ipc as ipc  # noqa: PLC0415

    first = listing.orderBy("path").first()
    if first is None:
        raise FileNotFoundError("no arrow shards")
    fs, inner = _fs_for(first["path"])
    with fs.open_input_stream(inner) as f:
        arrow_schema = ipc.open_stream(f).schema
    from pyspark.sql.pandas.types import from_arrow_schema  # noqa: PLC0415

    return from_arrow_schema(arrow_schema)


def write_arrow(df: DataFrame, path: str, split: str = "train") -> DataFrame:
    """Write a DataFrame as Arrow stream shards, one per partition, under
    ``path/split`` (the layout S2 reads).  Lazy: returns ``(path, rows)`` per
    shard, and the files are written when that small frame is computed.
    """
    from qamill.session import ship_package  # noqa: PLC0415

    ship_package(df.sparkSession)
    root = path.rstrip("/") + f"/{split}"
    from pyspark.sql.pandas.types import to_arrow_schema  # noqa: PLC0415

    arrow_schema = to_arrow_schema(df.schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid  # noqa: PLC0415

        import pyarrow.fs as pafs  # noqa: PLC0415
        import pyarrow.ipc as ipc  # noqa: PLC0415
        from pyspark import TaskContext  # noqa: PLC0415

        ctx = TaskContext.get()
        # Deterministic name per partition; written under a temporary name and
        # moved into place, so a retried task replaces, never duplicates.
        final = f"{root}/data-{ctx.partitionId():05d}.arrow"
        tmp = f"{root}/_tmp/data-{ctx.partitionId():05d}-{ctx.attemptNumber()}-{uuid.uuid4().hex[:6]}.arrow"
        fs, inner_tmp = _fs_for(tmp)
        _, inner_final = _fs_for(final)
        fs.create_dir(inner_tmp.rsplit("/", 1)[0], recursive=True)
        rows = 0
        with fs.open_output_stream(inner_tmp) as out, ipc.new_stream(out, arrow_schema) as w:
            for b in batches:
                w.write_batch(b)
                rows += b.num_rows
        fs.move(inner_tmp, inner_final)
        yield pa.RecordBatch.from_pydict({"path": [final], "rows": [rows]})

    out_schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("rows", T.LongType())])
    return df.mapInArrow(write, out_schema)


# ----------------------------------------------------------------- sinks --

def write_jsonl(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """JSON Lines with nulls written as ``null`` (K1, K2, K4)."""
    w = df.write.mode(mode).option("ignoreNullFields", "false")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def write_meta(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A one-row metadata document (K3, K5).  One row, so one file."""
    df.coalesce(1).write.mode(mode).option("ignoreNullFields", "false").json(path)


CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "emptyValue": "", "nullValue": "",
               "quoteAll": "false", "escapeQuotes": "true", "lineSep": "\n"}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    """CSV with header and no index; quotes doubled; null and empty -> empty (K6)."""
    w = df.write.mode(mode).options(**CSV_OPTIONS)
    (w.partitionBy(*partition_by) if partition_by else w).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back what ``write_csv`` wrote (fields may span lines)."""
    return (spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", "true").csv(path))
