"""From raw documents to token ids: five stages, each one an operator of ``clearbook.llm``.

Every stage gets what the one before kept, written as Parquet and read again.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.llm import byte_bpe, decontaminate, language_id, line_dedup, simhash
from clearbook.llm.queries import BYTE_RANKS, PIECES
from clearbook.llm.tables import read_table
from clearbook.sources.sinks import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the others go."""
    model = language_id.train(docs.where(~language_id.held_out("doc_id")), PIECES)
    return language_id.without_rejected(docs, model).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of runs of lines. A document of which nothing is left goes."""
    cleaned = line_dedup.without_repeated_runs(docs, keep=("lang", "source"))
    left = cleaned.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return simhash.one_of_each(docs, shingle_words=4, most_bits=4).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_items(docs, read_table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of each document that is left, and of what they decode to."""
    return byte_bpe.round_trip_digests(docs, BYTE_RANKS, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language),
    ("line dedup", lines),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark),
    ("byte-level BPE", tokens),
]

# Language identification, SimHash and edit distances can't be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
