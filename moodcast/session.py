"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


# Settings for a large cluster (about 100 TB of input, ~1000 executors).
# The library never sets these on a session it is given; they are what a
# user would pass to spark-submit.  Many initial shuffle partitions let
# adaptive execution coalesce towards the advisory size instead of
# spilling, and split skewed partitions of joins and rebalanced writes.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.checkpoint.dir": "<shared folder, e.g. an object-store or HDFS path>",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "moodcast", extra: dict | None = None) -> SparkSession:
    """A session for tests and local runs.  On a cluster use your own
    session; the library only reads settings from it."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only a local-mode session without the setting
    gets its own folder (tests, the bench); a cluster session must name a
    shared folder, since a machine-local one is invisible to executors.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
        root = tempfile.mkdtemp(prefix="moodcast-ckpt-", dir="/tmp")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


#: Scratch tables of this process, until ``clear_scratch``.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for a written table."""
    root = checkpoint_root(spark).rstrip("/")
    _SCRATCH.append(f"{root}/tables/{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def clear_scratch(spark: SparkSession) -> None:
    """Delete the written scratch tables.  Frames that read them must not
    be used afterwards."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(conf).delete(path, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for tests that look at files directly."""
    return path[len("file:"):] if path.startswith("file:") else path


def exists_local(path: str) -> bool:
    return os.path.exists(local_path(path))


_SHIPPED: set[int] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``moodcast`` importable by the Python workers of this session.

    The pandas UDFs refer to functions of this package, so the executors'
    Python workers must be able to import it.  The package is zipped once
    per SparkContext and added with ``addPyFile``, which Spark sends to
    every executor (a package installed on the executors works as well).
    """
    sc = spark.sparkContext
    key = id(sc._jsc) if getattr(sc, "_jsc", None) is not None else id(sc)
    with _SHIP_LOCK:
        if key in _SHIPPED:
            return
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg_dir)
        out = os.path.join(tempfile.mkdtemp(prefix="moodcast-pkg-"), "moodcast.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(pkg_dir):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(out)
        _SHIPPED.add(key)
