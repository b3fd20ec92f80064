"""Session construction and shared-storage helpers.

Library functions never change session settings; only ``build_session``
(used by tests and the bench) and ``shared_dir`` (which fills in a
checkpoint folder when none is configured) touch configuration.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans shuffles at runtime, splits
# skewed join partitions and coalesces small ones; the UI stays off.
SCALE_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(
    master: str = "local[8]",
    app: str = "wayfare",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session for tests and benchmarks (clusters bring their own)."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(SCALE_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only in local mode, where driver and executors are one process, a fresh
    local folder is registered when none is set; on a cluster that is an
    error, as executors would write to disks of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wayfare-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint root for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    path = "/".join([root, "wayfare", *parts])
    if unique:
        path = f"{path}-{uuid.uuid4().hex[:12]}"
    return path


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system) of a path string."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_token(spark: SparkSession, paths: list[str], salt: str = "") -> str:
    """A short fingerprint of input files (name, size, modification time),
    so a table derived from them can be reused while they are unchanged."""
    import hashlib

    entries = []
    for path in paths:
        p, fs = file_system(spark, path)
        files = fs.listFiles(p, True)  # with those of nested folders
        while files.hasNext():
            st = files.next()
            entries.append((str(st.getPath()), st.getLen(), st.getModificationTime()))
    digest = hashlib.sha1(repr((salt, sorted(entries))).encode()).hexdigest()
    return digest[:16]


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = file_system(spark, path)
    return bool(fs.exists(p))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder of the shared checkpoint folder and
    read back: computed once, and safe when an executor is lost."""
    spark = df.sparkSession
    path = shared_dir(spark, "written", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
