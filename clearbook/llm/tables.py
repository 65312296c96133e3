"""What the operators share: reading a table, its id and text columns, and a table kept for reuse."""

from __future__ import annotations

import tempfile
import zipfile
from collections import OrderedDict
from collections.abc import Callable, Hashable
from pathlib import Path
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Made = TypeVar("Made")

DOC_ID = "_doc_id"
TEXT = "_text"

_shipped: dict[str, tempfile.TemporaryDirectory] = {}
_per_worker: OrderedDict[Hashable, object] = OrderedDict()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, for their Python workers to import.

    Spark serves the archive from the driver; it goes with the application.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory(prefix="package-")
    package = Path(__file__).resolve().parents[1]
    archive = Path(folder.name) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator needs, under names that no column of the input clashes with."""
    ship_package(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias(DOC_ID), F.col(text_col).cast("string").alias(TEXT))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that no column of ``df`` has."""
    taken, found = {name.lower() for name in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def _keys(id_col: str, text_col: str) -> list[Column]:
    text = F.col(text_col).cast("string")
    return [F.col(id_col).cast("long"), F.coalesce(F.xxhash64(text), F.lit(0)), F.coalesce(F.xxhash64(F.lit(7), text), F.lit(0))]


def with_row_keys(df: DataFrame, id_col: str, text_col: str, names: list[str]) -> DataFrame:
    """Id and text, and what tells a row apart as three columns: its id and two hashes of its text.

    Rows that share all three are one for whoever decides by the text.
    """
    ship_package(df.sparkSession)
    keys = [key.alias(name) for key, name in zip(_keys(id_col, text_col), names, strict=True)]
    return df.select(F.col(id_col).cast("long").alias(DOC_ID), F.col(text_col).cast("string").alias(TEXT), *keys)


def without_rows(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, names: list[str]) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose keys are not among ``names`` of ``gone``."""
    same = F.lit(True)
    for key, name in zip(_keys(id_col, text_col), names, strict=True):
        same &= key.eqNullSafe(F.col(name))
    return docs.join(gone.select(*names).distinct(), same, "left_anti")


def once_per_worker(key: Hashable, make: Callable[[], Made], keep: int = 1) -> Made:
    """A costly object (a vocabulary, an automaton) made once in a Python worker and reused by its tasks.

    The one that the worker made before goes, so that memory doesn't add up over stages.
    """
    if key in _per_worker:
        _per_worker.move_to_end(key)
    else:
        while len(_per_worker) >= keep:
            _per_worker.popitem(last=False)
        _per_worker[key] = make()
    return _per_worker[key]  # type: ignore[return-value]
