"""Where reports go, and intermediate tables with an owner."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from clearbook.session import file_system, run_folder

# Staged folders of each application with a weak reference to the file index that every plan over them holds.
_WATCHED: dict[str, list[tuple[str, JavaObject]]] = {}


def write_csv(report: DataFrame, path: str) -> None:
    """A report as CSV files with a header, written in parallel."""
    report.write.mode("errorifexists").option("header", True).csv(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    For an intermediate result that several joins use: it is computed once, its
    real size is known to the plans that follow, and a lost executor costs no
    more than the tasks that read it. The table is removed once no DataFrame that
    reads it is left (``sweep``), and with the application.
    """
    spark = df.sparkSession
    sweep(spark)
    folder = run_folder(spark, "staged")
    path = f"{folder}/{name}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    index = table._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
    watch = spark.sparkContext._jvm.java.lang.ref.WeakReference(index)
    _WATCHED.setdefault(spark.sparkContext.applicationId, []).append((folder, watch))
    return table


def sweep(spark: SparkSession, collect: bool = False) -> int:
    """Remove staged tables that nothing reads any more; how many are left.

    Every DataFrame over a staged table, however derived, holds its file index, so
    that the index is gone only after the last of them. The JVM finds that out when
    it collects garbage, which ``collect`` asks it to do now; what the query run
    last has read may stay until another one has run.
    """
    if collect:
        spark.sparkContext._jvm.System.gc()
    watched = _WATCHED.get(spark.sparkContext.applicationId, [])
    left = []
    for folder, watch in watched:
        if watch.get() is None:
            target, fs = file_system(spark, folder)
            fs.delete(target, True)
        else:
            left.append((folder, watch))
    watched[:] = left
    return len(left)
