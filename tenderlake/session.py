"""Session settings, shared scratch tables and the small Hadoop file helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs rely on, the UTC time zone among them; they stay set in this
    session. Cluster sizing stays with the cluster."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tenderlake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tenderlake-")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a temporary folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_scratch()


_job_folders: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    """The name of a fresh folder for intermediate tables, inside that of the running job if there is one."""
    return f"{_job_folders[-1] if _job_folders else scratch_root(spark) + '/tenderlake'}/{uuid.uuid4().hex}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[str]:
    """All intermediate tables of a job in one folder, which goes when the job ends, however it ends."""
    folder = scratch_folder(spark)
    _job_folders.append(folder)
    try:
        yield folder
    finally:
        _job_folders.remove(folder)
        fs, path = hadoop_path(spark, folder)
        fs.delete(path, True)


def materialize(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to a fresh shared table and read it back.

    Cuts the lineage on storage that outlives executors, computes a reused intermediate once,
    and gives the optimizer its real size, so small tables broadcast and large ones do not.
    """
    spark = df.sparkSession
    path = scratch_folder(spark)
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of ``path`` through Hadoop, so any cluster storage works."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)
