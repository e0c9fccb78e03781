"""Session helpers: building a session, the shared folder, partition counts."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "clickspark",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build one with sane analytics defaults.

    On a cluster the session normally exists already (spark-submit) and is
    returned untouched.  Locally we enable AQE and switch the UI off.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
        return active
    builder = (SparkSession.builder.appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    getter = getattr(sc, "getCheckpointDir", None)
    current = getter() if getter else None
    if current:
        return current
    return spark.conf.get("spark.checkpoint.dir", None) or None


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is read from the session.
    Only a local master (tests), whose executors are this process, gets a
    temporary folder when it is unset; on a cluster that would scatter the
    files over machines, so it is refused.
    """
    ensure_checkpoint_dir(spark)
    base = _checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), *parts, uuid.uuid4().hex])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``clickspark`` importable on every Python worker, like
    ``--py-files``: zip the package into the shared folder once per
    application and ``addPyFile`` it (executors fetch it at task start)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    target = shared_dir(spark, "clickspark-pyfiles") + "/clickspark.zip"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def drop_stage_tables(spark: SparkSession) -> None:
    """Delete this application's intermediate tables (``clickspark/`` under
    the checkpoint folder).  Call at the end of a job, once no DataFrame
    built by the library is used any more."""
    base = _checkpoint_dir(spark)
    if not base:
        return
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base.rstrip("/") + "/clickspark")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable.  Sets a folder only if none is
    set and the master is local; raises on a cluster without one."""
    sc = spark.sparkContext
    if not _checkpoint_dir(spark):
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="clickspark-ckpt-"))
    elif not (getattr(sc, "getCheckpointDir", lambda: None)()):
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))


def is_local(master: str) -> bool:
    """Whether the executors run in the driver's process."""
    return master == "local" or master.startswith("local[")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


__all__ = ["get_spark", "shared_dir", "ship_package", "drop_stage_tables", "ensure_checkpoint_dir",
           "is_local", "shuffle_partitions"]
