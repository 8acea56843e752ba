"""Session helpers: a local test session and the shared work folder.

Intermediate tables (landed files, versioned silver snapshots, stream
checkpoints) go under the folder the cluster names in ``spark.checkpoint.dir``.
Only a local session without that setting gets a private folder, as in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and the bench: UTC, AQE on, no UI."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ingestkit")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, taken from ``spark.checkpoint.dir``."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no SparkContext
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="ingestkit-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the work root for one run of one operator."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its own file system (the default one without a scheme, as Spark
    resolves it). Only "not found" is False; any other failure is raised, so a table that cannot be
    looked up is never taken as empty."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def small_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, sorted; none where there is no folder."""
    fs, p = _file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_small(spark: SparkSession, path: str) -> str:
    """A small text file on any file system Spark reads, without a job."""
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small text file under a hidden name and renames it, so it is seen whole or not at all."""
    fs, p = _file_system(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}")
    stream = fs.create(hidden, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    if not fs.rename(hidden, p):
        raise OSError(f"could not write {path}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none where there is no such folder."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)
