"""Near copies by SimHash, found by multi-index hashing.

Fingerprints that differ in few bits agree, up to even fewer, in one of their
segments. So each fingerprint's segment, and those one bit away from it, are
looked up in a table of segments, and what is met there is compared in full.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.llm.components import connected
from clearbook.llm.tables import DOC_ID, TEXT, free_names, id_and_text
from clearbook.sources.sinks import staged

SEED = 42
FINGERPRINT_BITS = 64


def fingerprint(text: bytes, shingle_words: int) -> int:
    """Bitwise majority of the hashes of all shingles, as a signed number; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined, ends = b" ".join(words), [end - 1 for end in accumulate(len(word) + 1 for word in words)]
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_intdigest
    ends = ends[shingle_words - 1 :] or ends[-1:]
    ones, at = np.zeros(FINGERPRINT_BITS, dtype=np.int64), 0
    while at < len(ends):
        some = ends[at : at + 100_000]
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + len(some)], some, strict=True)]
        bits = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        at += len(some)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view("<i8")[0])


def _prints(docs: DataFrame, shingle_words: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``same`` (a hash of the text) and ``fingerprint`` of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((x.as_py() or "").encode("utf-8"), shingle_words) for x in batch[TEXT]]
            yield pa.record_batch([batch[DOC_ID], batch["same"], pa.array(found, pa.int64())], ["doc_id", "same", "fingerprint"])

    table = id_and_text(docs, id_col, text_col).withColumn("same", _same(TEXT))
    return table.mapInArrow(run, "doc_id long, same long, fingerprint long")


def _same(text_col: str) -> Column:
    return F.coalesce(F.xxhash64(F.col(text_col).cast("string")), F.lit(0))


def fingerprints(docs: DataFrame, shingle_words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` (a long) of every row, from its whole text; null counts as empty. No shuffle."""
    return _prints(docs, shingle_words, id_col, text_col).select("doc_id", "fingerprint")


def _segments(most_bits: int) -> list[tuple[int, int]]:
    """Start and width of the fewest segments of which one differs in at most one bit."""
    count = most_bits // 2 + 1
    bounds = [FINGERPRINT_BITS * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def close_pairs(values: DataFrame, most_bits: int = 4) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct ``fingerprint`` values that differ in at most ``most_bits`` bits.

    Of two values whose segments differ in one bit, the one without the bit
    looks up the other. A segment of 21 bits has two million entries, so an entry
    holds a few unrelated values up to some tens of millions of fingerprints.
    """
    parts = _segments(most_bits)

    def segment(start: int, width: int) -> Column:
        return F.shiftrightunsigned("fingerprint", start).bitwiseAND(F.lit((1 << width) - 1))

    table = values.select("fingerprint", F.posexplode(F.array(*(segment(*part) for part in parts))).alias("part", "entry"))

    def ball(number: int, start: int, width: int) -> Column:
        key = segment(start, width)
        own = F.array(F.struct(F.lit(number).alias("part"), key.alias("entry"), F.lit(False).alias("moved")))
        bits = F.filter(F.array(*(F.lit(1 << k) for k in range(width))), lambda bit: key.bitwiseAND(bit) == 0)
        near = F.transform(
            bits, lambda bit: F.struct(F.lit(number).alias("part"), key.bitwiseOR(bit).alias("entry"), F.lit(True).alias("moved"))
        )
        return F.concat(own, near)

    balls = F.concat(*(ball(number, *part) for number, part in enumerate(parts)))
    probes = values.select(F.col("fingerprint").alias("a"), F.explode(balls).alias("probe")).select("a", "probe.*")
    met = probes.join(table.withColumnRenamed("fingerprint", "b"), ["part", "entry"])
    close = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits) & (F.col("moved") | (F.col("a") < F.col("b")))
    return met.where(close).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _components(prints: DataFrame, most_bits: int) -> DataFrame:
    """``fingerprint``, ``root`` (one for each component) and ``component_id`` of the distinct fingerprints."""
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    links = close_pairs(nodes.select("fingerprint"), most_bits)
    roots = connected(links).withColumnRenamed("node", "fingerprint")
    placed = nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    firsts = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return placed.select("fingerprint", "root").join(firsts, "root").select("fingerprint", "root", "component_id")


def near_copies(
    docs: DataFrame, shingle_words: int = 4, most_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    A component is all that is reachable over links; its id is its smallest
    ``doc_id``. Equal fingerprints are one node, so a group of copies costs one
    row. Texts without words have fingerprint zero and are linked like others. A row
    in, a row out; a component whose ids are all null has a null id.
    """
    prints = staged(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    named = _components(prints, most_bits).select("fingerprint", "component_id")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return prints.join(named, "fingerprint").select("doc_id", digits, "component_id")


def one_of_each(
    docs: DataFrame, shingle_words: int = 4, most_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component: that of the smallest id (null after all others), then of the smallest text hash.

    Rows that share an id are told apart by their texts; of rows that share both, one stays.
    """
    prints = staged(_prints(docs, shingle_words, id_col, text_col), "fingerprints")
    named = _components(prints, most_bits).select("fingerprint", "root")
    rows = prints.groupBy("doc_id", "same", "fingerprint").agg(F.count("*").alias("_n")).join(named, "fingerprint")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), F.col("doc_id").alias("_first"), F.col("same").alias("_first_same")))
    firsts = rows.groupBy("root").agg(first.alias("_f")).select("root", "_f._first", "_f._first_same")
    is_first = F.col("doc_id").eqNullSafe(F.col("_first")) & (F.col("same") == F.col("_first_same"))
    named_id, named_hash, key_id, key_same = free_names(docs, "_id", "_text_hash", "_key_id", "_key_same")
    told = rows.join(firsts, "root").select(F.col("doc_id").alias(named_id), F.col("same").alias(named_hash), is_first.alias("_is_first"), "_n")
    # Few rows are of a kind to be dropped or thinned out, so these are what is looked up.
    told = staged(told.where(~F.col("_is_first") | (F.col("_n") > 1)), "later")
    here = F.col(id_col).cast("long").eqNullSafe(F.col(named_id)) & (_same(text_col) == F.col(named_hash))
    alone = docs.join(told.select(named_id, named_hash), here, "left_anti")
    repeated = docs.join(told.where("_is_first").select(named_id, named_hash), here, "left_semi")
    one = repeated.withColumns({key_id: F.col(id_col).cast("long"), key_same: _same(text_col)}).dropDuplicates([key_id, key_same])
    return alone.unionByName(one.drop(key_id, key_same))
