"""Where the ledger tables come from: Parquet, a catalog, or a live database."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from clearbook.sources.schemas import LEDGER_COLUMNS, ledger_schema


class LedgerTables(Mapping[str, DataFrame]):
    """Ledger tables by name, each loaded on first use."""

    def __init__(self, load: Callable[[str], DataFrame], names: list[str] | None = None):
        self._load = load
        self._names = list(names or LEDGER_COLUMNS)
        self._loaded: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._loaded:
            self._loaded[name] = self._load(name)
        return self._loaded[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def from_frames(frames: Mapping[str, DataFrame]) -> LedgerTables:
    return LedgerTables(frames.__getitem__, list(frames))


def from_parquet(spark: SparkSession, root: str) -> LedgerTables:
    """One Parquet folder per table under ``root``."""
    return LedgerTables(lambda t: spark.read.schema(ledger_schema(t)).parquet(f"{root}/{t}"))


def from_catalog(
    spark: SparkSession, namespace: str, other_namespaces: Mapping[str, str] | None = None
) -> LedgerTables:
    """Catalog tables; ``other_namespaces`` names the tables kept in another schema.

    ``from_catalog(spark, "ledger", {"fxTransaction": "fx_adapter"})`` reads
    ``ledger.transfer`` and ``fx_adapter.fxTransaction``.
    """
    others = dict(other_namespaces or {})
    return LedgerTables(lambda t: spark.table(f"{others.get(t, namespace)}.{t}"))


def hash_predicates(column: str, parts: int) -> list[str]:
    """Conditions that cut a table with a text key into ``parts`` pieces by the key's checksum.

    Each row meets exactly one; a row without the key meets the first.
    """
    checksum = f"MOD(CRC32({column}), {parts})"
    return [f"{checksum} = {k}" + (f" OR {column} IS NULL" if k == 0 else "") for k in range(parts)]


def time_predicates(column: str, cuts: Sequence[datetime]) -> list[str]:
    """Conditions that cut a table at some moments; each row meets exactly one.

    A row at a cut belongs to what follows it, a row without a time to the first piece.
    """
    moments = [f"'{cut:%Y-%m-%d %H:%M:%S.%f}'" for cut in sorted(set(cuts))]
    if not moments:
        return ["1 = 1"]
    first = f"{column} < {moments[0]} OR {column} IS NULL"
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(moments, moments[1:])]
    return [first, *between, f"{column} >= {moments[-1]}"]


def both_predicates(one: list[str], other: list[str]) -> list[str]:
    """Every piece of one cut again by the other."""
    return [f"({a}) AND ({b})" for a in one for b in other]


def from_jdbc(
    spark: SparkSession,
    url: str,
    options: Mapping[str, str] | None = None,
    schemas: Mapping[str, str] | None = None,
    split_on: Mapping[str, tuple[str, int, int, int] | list[str]] | None = None,
) -> LedgerTables:
    """Tables of a live database.

    ``split_on`` gives, for a large table, the numeric column to split the read
    on, its lower and upper bound, and the number of parallel reads; or, for a
    table with a text key, conditions of which each row meets exactly one
    (``hash_predicates``, ``time_predicates``), each read by a task. A table
    without an entry is read by one task, which suits the lookup tables only.
    """

    def load(table: str) -> DataFrame:
        prefix = (schemas or {}).get(table)
        name, settings = f"{prefix}.{table}" if prefix else table, dict(options or {})
        split = (split_on or {}).get(table)
        if isinstance(split, list):
            return spark.read.jdbc(url, name, predicates=split, properties=settings)
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**settings)
        if split is not None:
            column, low, high, parts = split
            reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
        return reader.load()

    return LedgerTables(load)
