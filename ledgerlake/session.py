"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_local_roots: dict[str, str] = {}
_work_folders: set[str] = set()


def local_session(name: str, cpus: int | str = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.files.minPartitionNum", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]):
    """Session settings for the plans made inside, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the session names.

    Only a single-machine session without the setting gets a temporary folder;
    on a cluster a missing setting is an error, never a machine-local path.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="ledgerlake-")
        spark.sparkContext.setCheckpointDir(_local_roots[app])
    return _local_roots[app]


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder for tables one run writes and reads back.

    All paths of an application lie in one folder, which is removed when it ends: until
    then a result may still read them.
    """
    root, app = shared_root(spark), spark.sparkContext.applicationId
    folder = f"{root}/work-{app}"
    if folder not in _work_folders:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _work_folders.add(folder)
    return f"{folder}/{purpose}-{uuid.uuid4().hex}"
