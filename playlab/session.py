"""Session helpers.

A cluster hands us a session; we only fill in settings that are unset.
``shared_dir`` returns a folder every executor can reach (the one named by
``spark.checkpoint.dir``); only a local session without that setting gets a
fresh folder under the system temp directory.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, Observation, SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.driver.host": "127.0.0.1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "playlab",
                  extra_conf: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**_LOCAL_DEFAULTS, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only where none is configured.

    ``spark.checkpoint.dir`` (a core setting, read at start-up) is the shared
    folder on a cluster.  Only a local session without it gets a fresh folder
    under the system temp directory, set on the context (the setting itself
    cannot change at run time).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="playlab-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint location; it goes when the application ends."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") and not base.startswith("file://") else base
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def stable_dir(spark: SparkSession, name: str, *key: str) -> str:
    """A folder below the shared checkpoint location that every application with the same key finds again."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") and not base.startswith("file://") else base
    return os.path.join(base, f"{name}-{hashlib.sha256(repr(key).encode()).hexdigest()[:16]}")


def materialize(df, observe: dict | None = None):
    """Write ``df`` once to the shared checkpoint folder, as Parquet, and read it back.

    Used where several jobs reuse one intermediate frame (statistics, then
    the rows): later jobs start from the written files instead of
    recomputing the lineage, and a lost executor costs a re-read, not a
    recomputation.  Never a machine-local copy.
    """
    return write_stage(df, "stage", observe)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    The zip goes through ``addPyFile`` (the driver serves it, as with
    ``--py-files``), so functions that run on executors can import the package
    although it is not installed there.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="playlab-zip-"), "playlab-package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("playlab", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_stage(df: DataFrame, name: str, observe: dict | None = None):
    """Write ``df`` as Parquet into the shared folder and read it back.

    ``observe`` maps names to aggregate columns over the written rows; the same job then
    yields them, and the result is (frame, values).  They are gathered in the write's own
    tasks, whose metrics count once each, also where a task is run again.

    Cuts the lineage like a checkpoint, but the files are columnar, compressed
    and have statistics, so later readers prune columns and Spark knows their
    size.  The shuffle files of the query that made them are freed when it
    ends, and the folder goes when the application ends.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    schema, watch = df.schema, Observation() if observe else None
    if observe:
        df = df.observe(watch, *[c.alias(k) for k, c in observe.items()])
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)
    written = spark.read.schema(schema).parquet(path)
    return (written, watch.get) if observe else written
