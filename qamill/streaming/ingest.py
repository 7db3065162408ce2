"""Incremental ingest of the drop directory as a stream (ST1).

The stream carries only the *file listing* (``binaryFile`` with ``path`` and
``length``; contents are never read by the stream).  Each micro-batch is one
version, written by the same batch function as ``ingest_dir``.  The
streaming checkpoint is the seen-set of files; the manifest stores the
micro-batch id so a replayed batch after a crash is not committed twice.

Spark's file stream knows files by path alone, so it never reports a name
that is used again.  Every batch therefore lists the directory and takes all
files that no version has (by path, length and time of change), and
``run_ingest_once`` looks once more after the stream has ended.

Run it with ``trigger(availableNow=True)``: each run takes every unseen file
at start as one batch (no ``maxFilesPerTrigger``: one run = one version).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from qamill.operators.versions import ingest_dir, ingest_paths
from qamill.sources import dropdir

# The fixed schema of the binaryFile source (streams must declare it).
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def start_ingest(spark: SparkSession, src: str, base: str, archive: str, checkpoint: str,
                 glob: str = "*.json", quarantine_path: str | None = None,
                 available_now: bool = True, interval: str = "1 minute",
                 single_object: str = "skip") -> StreamingQuery:
    listing = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
               .option("pathGlobFilter", glob)
               .load(src).select("path", "length"))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        now = dropdir.list_files(spark, src, glob)
        paths = [r["path"] for r in now.select("path").collect()]
        ingest_paths(spark, paths, base, archive, batch_id=batch_id, listing=now,
                     single_object=single_object, quarantine_path=quarantine_path,
                     others=dropdir.other_files(spark, src, glob) if quarantine_path else None)

    w = listing.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def run_ingest_once(spark: SparkSession, src: str, base: str, archive: str, checkpoint: str,
                    **kw) -> None:
    """One ``availableNow`` run, waited for."""
    q = start_ingest(spark, src, base, archive, checkpoint, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    # Names used again; single objects and unreadable files stay, and make no version.
    names = {k: v for k, v in kw.items() if k in ("glob", "quarantine_path", "single_object")}
    ingest_dir(spark, src, base, archive, **names)
