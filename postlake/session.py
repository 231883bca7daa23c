"""Session defaults and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_fallback_dirs: dict[str, str] = {}


def build_session(app_name: str = "postlake", master: str | None = None, **conf) -> SparkSession:
    """Session with UTC timestamps and adaptive execution; extra settings use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, shuffled_bytes: int, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Set the shuffle partition count so that one holds about ``target_bytes`` of the largest shuffle.

    Adaptive execution joins partitions that turn out small but cannot add any, so the count must be
    right for the large case.
    """
    cores = spark.sparkContext.defaultParallelism
    n = max(cores, -(-shuffled_bytes // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", n)
    return n


def pin_utc(spark: SparkSession) -> SparkSession:
    """Stored times are UTC, so the session zone must be too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder all executors can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Only on one machine (a ``local[...]`` master, as in
    tests) does a local temporary folder take its place; elsewhere executors would not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _fallback_dirs:
            _fallback_dirs[app] = tempfile.mkdtemp(prefix="postlake-")
        base = _fallback_dirs[app]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def _folder(spark: SparkSession, path: str):
    """A path and its file system, whatever store it is in."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(conf)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, store = _folder(spark, path)
    return store.exists(folder)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files in a folder."""
    folder, store = _folder(spark, path)
    return store.getContentSummary(folder).getLength()


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of our own, as :func:`shared_dir` names them."""
    folder, store = _folder(spark, path)
    store.delete(folder, True)
