"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults applied only when this call creates the session; an existing
# session (a cluster's, a notebook's) is used as it is.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app_name: str = "ledgerline", master: str | None = None,
                conf: dict[str, str] | None = None, packages: list[str] | None = None) -> SparkSession:
    """S1. Returns the active session untouched if there is one; otherwise
    creates one with the defaults above, ``conf`` on top, and ``packages``
    (Maven coordinates, e.g. a JDBC driver for the JDBC sink) on the classpath.
    Like any ``getOrCreate``, packages only take effect on the call that
    starts the JVM."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_DEFAULTS, **(conf or {})}
    if packages:
        settings["spark.jars.packages"] = ",".join(packages)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, from ``spark.checkpoint.dir``.

    A temporary folder is set (on the session's context, the one thing this library
    changes there) only for a ``local[...]`` session that has none (tests); on a cluster a node-local folder would be invisible to the other
    executors, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d is None:
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if conf:
            sc.setCheckpointDir(conf)
        elif sc.master.startswith("local"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
        else:
            raise RuntimeError("spark.checkpoint.dir is not set: give the session a folder "
                               "that every executor can reach (e.g. on the cluster file system)")
        d = sc.getCheckpointDir()
    return d


def scratch_root(spark: SparkSession) -> str:
    """This application's folder under the shared checkpoint folder; the file system
    client removes it when the driver's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/ledgerline/{spark.sparkContext.applicationId}"
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        fs.mkdirs(jpath)
        fs.deleteOnExit(jpath)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under ``scratch_root``."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def make_folder(spark: SparkSession, path: str) -> str:
    """Create a folder, if it isn't there, on the file system of its URI."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jpath)
    return path


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the Hadoop file system of its URI (any scheme the
    cluster is configured for). Used only for scratch output this library
    created itself."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(jpath, True))
