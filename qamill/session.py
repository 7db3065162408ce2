"""Session settings and the shared folder used to cut lineage.

On a cluster the session is owned by whoever submits the job; the library only
reads its settings.  ``local_session`` is for tests, the bench and small runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "qamill") -> SparkSession:
    """A local-mode session with the settings the operators rely on.

    * UTC session time zone (timestamps at rest are ISO text with ``Z``).
    * AQE on, so shuffle partitions are coalesced / skewed joins split at run time.
    * No web UI.
    * Duplicate JSON keys keep the last value, as Python's ``json`` does.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("QAMILL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from the running context or from ``spark.checkpoint.dir``.  Only a
    local-mode session without that setting gets a fresh folder of its own
    (tests); a cluster session without it is an error, because a
    machine-local folder is not visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        try:
            conf = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf = None
    if conf:
        sc.setCheckpointDir(conf)
    elif sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="qamill-ckpt-", dir="/tmp"))
    else:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``qamill`` importable on executors (like ``--py-files``), once per
    application.  Needed where Python runs in tasks (Arrow/pandas batches)
    and the task code refers to functions of this package.
    """
    import zipfile  # noqa: PLC0415

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    # Code, not data: the archive is built by the driver process, moved to
    # the shared folder and handed to every executor (as ``--py-files`` does).
    target = tempfile.mkdtemp(prefix="qamill-pyfiles-")
    zpath = os.path.join(target, "qamill.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    # Publish it in the shared folder and register it from there.
    shared = f"{scratch_dir(spark, 'pyfiles')}/qamill.zip"
    jvm = sc._jvm
    dst = jvm.org.apache.hadoop.fs.Path(shared)
    dst.getFileSystem(sc._jsc.hadoopConfiguration()).copyFromLocalFile(
        True, True, jvm.org.apache.hadoop.fs.Path(zpath), dst)
    sc.addPyFile(shared)
    _SHIPPED.add(app)
