"""Vector code compression: each vector as one code per part, with integer codebooks.

Everything is whole numbers: components are floored to integers, distances come
from products of limbs that doubles hold exactly, and sums are integers, so that
codes and codebooks are the same however Spark deals the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm import exact
from clearbook.llm.tables import ship_package
from clearbook.sources.sinks import staged

LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry]`` are the integer components of an entry."""

    entries: np.ndarray
    scale: int

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    @property
    def width(self) -> int:
        return self.parts * self.entries.shape[2]

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row and part the first nearest entry and its squared distance."""
        cut = rows.reshape(len(rows), self.parts, -1)
        codes = np.zeros((len(rows), self.parts), dtype=np.int64)
        errors = np.zeros((len(rows), self.parts), dtype=np.int64)
        for part in range(self.parts):
            mine, book = cut[:, part], self.entries[part]
            far = (book * book).sum(axis=1)[None, :] - 2 * exact.products(mine, book)
            codes[:, part] = far.argmin(axis=1)
            errors[:, part] = far[np.arange(len(rows)), codes[:, part]] + (mine * mine).sum(axis=1)
        return codes, errors


def integer_vectors(vectors: DataFrame, vector_col: str, scale: int, parts: int, others: list[str]) -> tuple[DataFrame, int]:
    """``others`` and ``ints`` of each vector that takes part, and the common width."""
    table = exact.without_gaps(vectors.select(*others, F.col(vector_col).alias("_vector")), "_vector")
    width = -(-exact.longest(table, "_vector") // parts) * parts
    # A distance is at most four times a sum of products.
    most = exact.saturation(width, spare_bits=4)
    return table.select(*others, exact.floored(F.col("_vector"), scale, most).cast("array<int>").alias("ints")), width


def _chunks(batches: Iterable[pa.RecordBatch], width: int, rows: int = 4096) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            part = batch.slice(low, rows)
            yield part, exact.rows_of(part["ints"], width)


def _moved(table: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the floored mean of its parts; an unused one stays.

    Each task adds up its own rows first. What comes to the driver is the sums
    of the codebooks, one number for each component and one count for each entry.
    """
    parts, entries, size = books.entries.shape

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, size + 1), dtype=np.int64)
        for _, rows in _chunks(batches, books.width):
            codes, _ = books.nearest(rows)
            cut = rows.reshape(len(rows), parts, size)
            for part in range(parts):
                np.add.at(sums[part], codes[:, part], np.concatenate([cut[:, part], np.ones((len(rows), 1), dtype=np.int64)], axis=1))
        used = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(sums.ravel()[used], pa.int64())], ["slot", "total"])

    totals = table.mapInArrow(add_up, "slot long, total long").groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)")))
    sums = np.zeros(parts * entries * (size + 1), dtype=object)
    for slot, total in totals.collect():
        sums[slot] = int(total)
    sums = sums.reshape(parts, entries, size + 1)
    moved = books.entries.copy()
    for part in range(parts):
        for entry in range(entries):
            if sums[part, entry, size]:
                moved[part, entry] = [int(x) // sums[part, entry, size] for x in sums[part, entry, :size]]
    return Codebooks(moved, books.scale)


def learn(table: DataFrame, width: int, scale: int, id_col: str, parts: int = 4, entries: int = 256, rounds: int = 4) -> Codebooks:
    """Codebooks of the integer vectors ``ints``, learned from all rows.

    They start as the parts of the rows with the smallest ids (null ids last,
    equal ids by vector); with fewer rows than ``entries`` there are as many
    entries as rows. ``entries * width`` numbers pass through the driver.
    """
    ship_package(table.sparkSession)
    first = table.orderBy(F.asc_nulls_last(id_col), "ints").limit(entries).select("ints").collect()
    start = np.zeros((len(first), width), dtype=np.int64)
    for k, (ints,) in enumerate(first):
        start[k, : len(ints)] = ints
    books = Codebooks(start.reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy(), scale)
    for _ in range(rounds if first else 0):
        books = _moved(table, books)
    return books


def encode(table: DataFrame, books: Codebooks, others: list[str]) -> DataFrame:
    """``others``, ``code`` (two hex digits for each part) and ``error`` (squared distance to the coded vector)."""
    ship_package(table.sparkSession)
    schema = exact.extended(table.select(*others).schema, "code string, error long")

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in _chunks(batches, books.width):
            codes, errors = books.nearest(rows)
            text = pa.array([bytes(x).hex() for x in codes.astype(np.uint8)], pa.string())
            columns = [*(batch[name] for name in others), text, pa.array(errors.sum(axis=1), pa.int64())]
            yield pa.record_batch(columns, [*others, "code", "error"])

    return table.select(*others, "ints").mapInArrow(code, schema)


def decode(codes: DataFrame, books: Codebooks, code_col: str = "code") -> DataFrame:
    """Add ``decoded``: the vector, in the original scale, that a code stands for."""
    numbers = F.transform(F.array(*[F.lit(2 * k + 1) for k in range(books.parts)]), lambda at: F.conv(F.substring(code_col, at, F.lit(2)), 16, 10).cast("int"))
    flat = [[[x / books.scale for x in entry] for entry in part] for part in books.entries.tolist()]
    pieces = [F.get(F.lit(part) if part else F.array(F.array().cast("array<double>")), numbers[k]) for k, part in enumerate(flat)]
    return codes.withColumn("decoded", F.flatten(F.array(*pieces)))


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 1024,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
) -> tuple[DataFrame, Codebooks]:
    """``vec_id``, ``label``, ``code``, ``error`` and ``label_error`` of every vector, and the codebooks.

    Vectors that are null or hold null or non-finite components have no row. Of
    different lengths, the shorter ones count as filled up with zeros, as do all to
    a multiple of ``parts``. Components beyond ``2 ** 26`` after scaling (64
    components; less for more) stay there, so that no distance leaves 64 bits.
    Repeated rows and ids are rows of their own; null ids come last. An empty table
    gives none. ``label_error`` is the error summed over equal labels, nulls
    together, and ends at the largest long.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits: 256 entries at most")
    named = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    table, width = integer_vectors(named, "vector", scale, parts, ["vec_id", "label"])
    table = staged(table, "integers")
    books = learn(table, width, scale, "vec_id", parts, entries, rounds)
    coded = staged(encode(table, books, ["vec_id", "label"]), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    sums = coded.groupBy(F.col("label").alias("_of_label")).agg(total.alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_of_label"))).drop("_of_label"), books
