"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Adaptive execution coalesces small shuffle
# partitions, splits skewed join partitions and switches joins to broadcast at
# runtime once it has measured a side, so the plans below never hard-code a
# reducer count or an unchecked broadcast.
_SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Scratch folders made and not yet deleted, by application.
_OWNED: dict[str, set[str]] = {}


def build_session(master: str | None = None, app: str = "quarry",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_SQL_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """Driver and executors in one process (``local-cluster`` is a cluster)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def _configured(spark: SparkSession) -> str | None:
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return found or spark.conf.get("spark.checkpoint.dir", None)


def _plain(path: str) -> str:
    """A local path or file: URI as a plain path; other URIs as they are."""
    return os.path.normpath(path[5:]).replace("//", "/") if path.startswith("file:") else path.rstrip("/")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, registering it with the context.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is always
    preferred. Only a local-mode session without that setting (unit tests) gets
    a fresh private folder. On a cluster a missing setting is an error, and so
    is a local folder that was set earlier and does not lie in the named one: a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current, configured = sc.getCheckpointDir(), _configured(spark)
    if current:
        local = current.startswith(("/", "file:"))
        shared = configured and (_plain(current) + "/").startswith(_plain(configured) + "/")
        if local and not shared and not _is_local(spark):
            raise RuntimeError(f"the checkpoint folder {current} is local and not in spark.checkpoint.dir")
        return current
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the checkpoint folder (intermediate tables, stream state and outputs).

    The session owns the folder: ``release_scratch``, the end of a
    ``scratch_scope`` or the interpreter's exit deletes it.
    """
    path = os.path.join(checkpoint_dir(spark), f"quarry-{label}-{uuid.uuid4().hex}")
    app = spark.sparkContext.applicationId
    if app not in _OWNED:
        _OWNED[app] = set()
        atexit.register(_release_at_exit, spark, app)
    _OWNED[app].add(path)
    return path


def release_scratch(spark: SparkSession, paths: set[str] | None = None) -> int:
    """Delete the scratch folders of this session (or the given ones) once their results are no longer read.

    Returns how many there were. DataFrames that still read them fail afterwards.
    """
    owned = _OWNED.get(spark.sparkContext.applicationId, set())
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    gone = 0
    for path in sorted(owned if paths is None else paths & owned):
        at = jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(at.getFileSystem(conf).delete(at, True))
        owned.discard(path)
    return gone


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders made inside the ``with`` block at its end."""
    app = spark.sparkContext.applicationId
    before = set(_OWNED.get(app, ()))
    try:
        yield
    finally:
        release_scratch(spark, _OWNED.get(app, set()) - before)


def _release_at_exit(spark: SparkSession, app: str) -> None:
    try:
        if spark.sparkContext._jsc is not None and spark.sparkContext.applicationId == app:
            release_scratch(spark)
    except Exception:  # noqa: BLE001 - the session ended first; nothing can be deleted through it
        _OWNED.pop(app, None)


def write_scratch(df: DataFrame, label: str) -> DataFrame:
    """Run ``df`` once into a scratch table and read that: an action, named as such by its callers."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
