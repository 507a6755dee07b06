"""Session construction and the shared scratch folder.

Everything the library writes outside a warehouse (landing fixtures, staged merge
buckets, stream checkpoints) goes below the cluster's shared checkpoint folder,
``spark.checkpoint.dir``.  The setting is read from the running session; a private
folder is created only when it is unset *and* Spark runs in local mode (tests).
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tidepool",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    Falls back to a fresh local folder only for local-mode sessions, and registers it
    as the checkpoint directory so ``DataFrame.checkpoint()`` uses it too.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    existing = sc.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(
            "spark.checkpoint.dir must name a folder shared by all executors"
        )
    root = tempfile.mkdtemp(prefix="tidepool-")
    sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder below the shared checkpoint root (never reused)."""
    return f"{checkpoint_root(spark)}/tidepool/{purpose}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


@contextlib.contextmanager
def session_conf(spark: SparkSession, **settings: str):
    """Set SQL settings for the jobs started inside the block, then restore them.

    Keys use ``__`` for dots (``spark__sql__x`` -> ``spark.sql.x``).
    """
    previous = {}
    for key, value in settings.items():
        name = key.replace("__", ".")
        previous[name] = spark.conf.get(name, None)
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in previous.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
