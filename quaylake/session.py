"""Session construction and the shared scratch location.

The library never hard-codes cluster sizing. ``local_session`` is only for
tests, the benchmark and local runs; on a cluster the caller's session (and
its ``spark-defaults``) is used as is.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    master: str | None = None,
    app: str = "quaylake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session with AQE on and the UI off."""
    cpus = os.environ.get("QUAYLAKE_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("QUAYLAKE_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is the reliable, shared location; it is read from the
    session, and a cluster session without it is an error (a machine-local
    folder is not visible to the executors). Only a ``local`` master with the
    setting unset (tests, local runs) gets a private temporary folder,
    registered as the checkpoint directory.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the folder
        if not base:
            raise RuntimeError("spark.checkpoint.dir is not set on the remote session") from None
        return base.rstrip("/")
    if not base:
        current = sc.getCheckpointDir()
        if current:
            # setCheckpointDir appends a per-application folder; use its parent
            return current.rsplit("/", 1)[0]
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="quaylake-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


_SCRATCH: dict[str, str] = {}


def _scratch_root(spark: SparkSession) -> str:
    """The application's folder for written tables, deleted when it ends."""
    base = shared_dir(spark)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the folder
        return f"{base}/quaylake"
    key = f"{sc.applicationId} {base}"
    if key not in _SCRATCH:
        root = f"{base}/quaylake/{sc.applicationId}"
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _SCRATCH[key] = root
    return _SCRATCH[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for a written table, under the shared folder; it lives
    as long as the application, as frames that read it may."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
