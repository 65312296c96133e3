"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(name: str = "clearbook", cpus: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a single local process may fall back to a temporary folder: on a cluster that
    would put a table where the other machines cannot see it.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="clearbook-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_OWNED: set[tuple[str, str]] = set()


def file_system(spark: SparkSession, path: str) -> tuple:
    """The path and the file system it lies in."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def application_folder(spark: SparkSession) -> str:
    """This application's folder under the shared folder; it is removed when the driver's JVM ends."""
    app = spark.sparkContext.applicationId
    folder = f"{shared_folder(spark)}/clearbook/{app}"
    if (app, folder) not in _OWNED:
        target, fs = file_system(spark, folder)
        fs.mkdirs(target)
        fs.deleteOnExit(target)
        _OWNED.add((app, folder))
    return folder


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one job's output, under the application's folder."""
    return f"{application_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
