"""File-system actions on any Hadoop-FS URI (local, HDFS, object stores):
exists, make directories, move (K8), list (K7).  The driver only issues
metadata calls; no data passes through it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def head(spark: SparkSession, path: str, n: int) -> bytes:
    """The first n bytes of a file; none if it can't be read."""
    from py4j.protocol import Py4JJavaError  # noqa: PLC0415

    fs, p = _fs(spark, path)
    try:
        stream = fs.open(p)
        try:
            return bytes(stream.readNBytes(n))
        finally:
            stream.close()
    except Py4JJavaError:
        return b""


def move(spark: SparkSession, src: str, dst_dir: str) -> str:
    """Move ``src`` into ``dst_dir`` keeping its name; nothing happens if ``src`` is gone.

    Nothing is ever overwritten: if the name is taken, ``.1``, ``.2``, ... is
    put behind it.  Returns the destination path.
    """
    fs, sp = _fs(spark, src)
    dfs, dp = _fs(spark, dst_dir)
    dfs.mkdirs(dp)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target, k = path(dp, sp.getName()), 0
    if fs.exists(sp):
        while dfs.exists(target):
            k += 1
            target = path(dp, f"{sp.getName()}.{k}")
        if not fs.rename(sp, target):
            raise OSError(f"could not move {src} to {dst_dir}")
    return target.toString()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` (metadata only)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def list_tree(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Verification listing of a published tree: ``(path, length)`` of every
    file below ``path`` (K7).  ``binaryFile`` with only these columns never
    reads file contents.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(path)
            .select(F.col("path"), F.col("length")))


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Rename one file or directory (metadata only)."""
    fs, sp = _fs(spark, src)
    _, dp = _fs(spark, dst)
    fs.mkdirs(dp.getParent())
    if not fs.rename(sp, dp):
        raise OSError(f"could not rename {src} to {dst}")


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Paths of the data files directly under ``path`` (metadata only);
    names starting with ``_`` or ``.`` are skipped, as Spark does."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith(("_", ".")) and name.endswith(suffix):
            out.append(st.getPath().toString())
    return sorted(out)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this library created (e.g. a staging folder)."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)
