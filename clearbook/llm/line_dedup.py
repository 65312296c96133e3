"""Repeated runs of lines, by a suffix array over line ids.

A document is a sequence of line ids; a suffix starts at each line. Prefix
doubling ranks the suffixes by their first line, then their first two, four and
so on: the order by 2h lines is the order by the ranks for h lines at the start
and h lines on. Suffixes of equal rank share h lines, so the groups of a rank are
the intervals of the suffix array whose common prefix has h lines or more.
Suffixes alone in their rank leave at once, so later rounds hold repeated lines
only. Written with DataFrame functions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.llm.tables import DOC_ID, TEXT
from clearbook.sources.sinks import staged

PLACE = ["_doc", "_same", "_at"]


def _ranked(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """Suffixes that share their keys with another, with the keys' place in sorted order as their new ``_rank``.

    The keys are counted before they are shuffled, sorted by ranges and numbered
    in that order; the written table keeps the numbers the same when read again.
    """
    repeated = suffixes.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    ordered = repeated.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranks = staged(ordered.withColumn("_place", F.monotonically_increasing_id()), "line-ranks")
    return suffixes.join(ranks, keys).select(*PLACE, F.col("_place").alias("_rank"))


def _pairs(ranked: DataFrame, step: int) -> DataFrame:
    """Each suffix with its rank and the rank ``step`` lines on; without one there it is alone."""
    on = ranked.select("_doc", "_same", (F.col("_at") - step).alias("_at"), F.col("_rank").alias("_next"))
    return ranked.join(on, PLACE)


def repeated_starts(lines: DataFrame, min_lines: int) -> DataFrame:
    """Places of the lines from which ``min_lines`` lines also start earlier."""
    ranked, length = staged(_ranked(lines, ["_line", "_line2"]), "line-suffixes"), 1
    while length < min_lines:
        step = min(length, min_lines - length)
        ranked, length = staged(_ranked(_pairs(ranked, step), ["_rank", "_next"]), "line-suffixes"), length + step
    first = ranked.groupBy("_rank").agg(F.min(F.struct("_doc", "_at")).alias("_first"))
    return ranked.join(first, "_rank").where(F.col("_first") < F.struct("_doc", "_at")).select(*PLACE)


def without_repeated_runs(
    docs: DataFrame,
    min_lines: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    lone_words: int | None = None,
) -> DataFrame:
    """``doc_id``, ``text`` without later copies of line runs, ``n_lines``, ``n_removed`` and ``n_runs`` of every row.

    A line goes if it lies in a run of ``min_lines`` lines or more that also
    starts earlier: in a document of smaller id, or before in its own. With ``lone_words`` a
    repeated run of fewer lines counts too if one of its lines has that many words. Runs are
    judged on the input, not on what is left, and don't cross documents. Lines end
    with a line feed. A null text stays null and has no lines; an empty one is one
    empty line. Null ids come before all others; rows that share id and text
    are treated alike; of rows that share the id alone, as if they were one document, that is
    earlier which stands at a smaller line. Columns named in ``keep`` are passed on.
    """
    rest = F.struct(F.lit(0).alias("_none"), *(F.col(name) for name in keep)).alias("_rest")
    table = docs.select(F.col(id_col).cast("long").alias(DOC_ID), F.col(text_col).cast("string").alias(TEXT), rest).select(
        F.col(DOC_ID).alias("_id"),
        F.coalesce(DOC_ID, F.lit(-(1 << 63))).alias("_doc"),
        F.coalesce(F.xxhash64(TEXT), F.lit(0)).alias("_same"),
        TEXT,
        "_rest",
    )
    split = F.split(TEXT, "\n")
    lines = table.where(F.col(TEXT).isNotNull()).select("_doc", "_same", F.posexplode(split).alias("_at", "_text"))
    # Two independent hashes of a line are its id. A repeated row adds nothing.
    ids = [F.xxhash64("_text").alias("_line"), F.xxhash64(F.lit(1), "_text").alias("_line2")]
    if lone_words is not None:
        ids.append((F.regexp_count("_text", F.lit("\\S+")) >= lone_words).alias("_long"))
    lines = staged(lines.select(*PLACE, *ids).dropDuplicates(PLACE), "lines")
    starts = repeated_starts(lines, min_lines).select(
        "_doc", "_same", F.explode(F.sequence("_at", F.col("_at") + (min_lines - 1))).alias("_gone")
    )
    if lone_words is not None:
        long = repeated_starts(lines.where("_long"), 1).select("_doc", "_same", F.col("_at").alias("_gone"))
        starts = starts.unionByName(long)
    gone = starts.groupBy("_doc", "_same").agg(F.collect_set("_gone").alias("_gone"))
    joined = table.join(gone, ["_doc", "_same"], "left")
    removed = F.coalesce("_gone", F.array().cast("array<int>"))
    places = F.sequence(F.lit(0), F.size(split) - 1)

    def line(at: Column) -> Column:
        return F.get(F.col("_lines"), at)

    return (
        joined.withColumn("_lines", split)
        .withColumn("_kept", F.array_except(places, removed))
        .select(
            F.col("_id").alias("doc_id"),
            F.when(F.col("_gone").isNull(), F.col(TEXT)).otherwise(F.array_join(F.transform("_kept", line), "\n")).alias("text"),
            F.when(F.col(TEXT).isNull(), 0).otherwise(F.size("_lines")).alias("n_lines"),
            F.size(removed).alias("n_removed"),
            F.size(F.array_except(removed, F.transform(removed, lambda at: at + 1))).alias("n_runs"),
            *(F.col(f"_rest.{name}") for name in keep),
        )
    )
