"""Running a stream to the end of its input and reading what it wrote.

Results go to files in the shared folder, never through the driver's memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.session import run_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def stream_settings(spark: SparkSession, count_state: bool = True) -> Iterator[None]:
    """State in RocksDB, outside the heap.

    A stateful query keeps the number of state partitions it starts with, which is
    the session's number of shuffle partitions. Counting the rows of the state, which only the
    stream's progress reports show, costs a look-up for each row written.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": str(count_state).lower(),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_appending(stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream over all available input and read its output."""
    spark = stream.sparkSession
    folder = run_folder(spark, f"stream-{name}")
    with stream_settings(spark, count_state=False):
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{folder}/output")
        )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/output")


def run_updating(stream: DataFrame, name: str, key: str, newest_by: str | None = None) -> DataFrame:
    """Run an update-mode stream and read the last version of each key: that of the last batch,
    or that with the highest ``newest_by``, which is then left out of the result.

    Every batch overwrites its own folder, so a repeated batch changes nothing.
    """
    spark = stream.sparkSession
    folder = run_folder(spark, f"stream-{name}")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/output/batch={number}")

    with stream_settings(spark, count_state=False):
        query = (
            stream.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    versions = spark.read.option("basePath", f"{folder}/output").parquet(f"{folder}/output")
    values = [c for c in stream.columns if c not in (key, newest_by)]
    newest = F.max_by(F.struct(*values), newest_by or "batch").alias("newest")
    return versions.groupBy(key).agg(newest).select(key, "newest.*")
