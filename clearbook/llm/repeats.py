"""Where a window of fixed length occurs again, over a whole corpus: candidates and their grouping.

Each window of ``length`` units (bytes, words) belongs to its anchor: the start in it of
the run of ``anchor`` units with the smallest hash, the leftmost of equals. That
depends on the window's content alone, so equal windows have equal anchors at the
same offset, and consecutive windows mostly share one. The windows of one anchor
are a block; a document is cut into blocks by its content.

Blocks are dealt by the hash of their anchor. Equal blocks (128 bits) stand behind
their first, whose windows they all repeat. What is left to tell is which windows
repeat between different blocks of one anchor; those go, with their text, to an
exact matcher. Anchors with very many different blocks (what stands around a
passage that a large share of all documents holds) are dealt by window instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm.tables import DOC_ID, TEXT, ship_package
from clearbook.sources.sinks import staged

U8 = np.uint64
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
INVERSES = tuple(pow(base, -1, 1 << 64) for base in BASES)
FLUSH = 100_000
KEY = ["_doc", "_same"]
OUT = "_kind int, _doc long, _same long, _start int, _stop int, _shard long"
MARK, BLOCK = 0, 1


@dataclass(frozen=True)
class Windows:
    """What repeats: windows of ``length`` units, anchored by runs of ``anchor`` units.

    ``units`` gives 64-bit values of a text's units. With ``within`` an earlier
    place in the same document counts as earlier, else only a smaller id does.
    """

    length: int
    anchor: int
    units: Callable[[str], np.ndarray]
    within: bool


class _Powers:
    """Powers of both bases and of their inverses, as long as the longest text so far."""

    def __init__(self) -> None:
        self.tables = [np.ones(1, dtype=U8)] * 4

    def get(self, size: int) -> list[np.ndarray]:
        if len(self.tables[0]) < size:
            size = max(size, 2 * len(self.tables[0]), 1 << 16)
            for k, factor in enumerate((*BASES, *INVERSES)):
                table = np.full(size, factor, dtype=U8)
                table[0] = 1
                self.tables[k] = np.multiply.accumulate(table)
        return self.tables


_POWERS = _Powers()


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> U8(33))) * U8(0xFF51AFD7ED558CCD)
    value = (value ^ (value >> U8(33))) * U8(0xC4CEB9FE1A85EC53)
    return value ^ (value >> U8(33))


class _Prints:
    """Hashes of any stretch of a sequence, by differences of running sums."""

    def __init__(self, units: np.ndarray) -> None:
        self._powers = _POWERS.get(len(units) + 1)
        self._sums = []
        for k, values in enumerate((units, _mixed(units + U8(1)))):
            sums = np.zeros(len(units) + 1, dtype=U8)
            np.cumsum(values * self._powers[k][: len(units)], out=sums[1:])
            self._sums.append(sums)

    def of(self, which: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        sums = self._sums[which]
        return _mixed((sums[stops] - sums[starts]) * self._powers[2 + which][starts] + (stops - starts).astype(U8))

    def runs(self, size: int) -> np.ndarray:
        sums = self._sums[0]
        return _mixed((sums[size:] - sums[:-size]) * self._powers[2][: len(sums) - size])


def blocks(units: np.ndarray, windows: Windows) -> tuple[np.ndarray, ...]:
    """Anchor hash, block hash, first and last window start of every block, and the means to hash more."""
    prints = _Prints(units)
    least, place = prints.runs(windows.anchor), None
    place = np.arange(len(least), dtype=np.int32)
    width, span = windows.length - windows.anchor + 1, 1
    while span < width:
        step = min(span, width - span)
        right = least[step:] < least[: len(least) - step]
        least = np.where(right, least[step:], least[: len(least) - step])
        place = np.where(right, place[step:], place[: len(place) - step])
        span += step
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.append(first[1:], len(place)) - 1
    return least[first], prints.of(1, first, last + windows.length), first, last, prints


class _Buffer:
    """Blocks of many documents, to be dealt by anchor."""

    def __init__(self, windows: Windows, buckets: int, hot: np.ndarray) -> None:
        self._windows, self._buckets, self._hot = windows, buckets, hot
        self._columns: list[list[np.ndarray]] = [[] for _ in range(6)]
        self.size = 0

    def add(self, doc: int, same: int, text: str) -> None:
        units = self._windows.units(text)
        if len(units) < self._windows.length:
            return
        anchor, block, first, last, prints = blocks(units, self._windows)
        if len(self._hot):
            near = np.minimum(np.searchsorted(self._hot, anchor), len(self._hot) - 1)
            hot = self._hot[near] == anchor
            if hot.any():
                sizes = (last - first + 1)[hot]
                single = np.repeat(first[hot] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                stop = single + self._windows.length
                anchor = np.concatenate([anchor[~hot], prints.of(0, single, stop)])
                block = np.concatenate([block[~hot], prints.of(1, single, stop)])
                first, last = np.concatenate([first[~hot], single]), np.concatenate([last[~hot], single])
        for column, values in zip(
            self._columns,
            (anchor, block, np.full(len(first), doc), np.full(len(first), same), first, last - first),
            strict=True,
        ):
            column.append(values)
        self.size += len(first)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        columns = [np.concatenate(column) for column in self._columns]
        self.size, self._columns = 0, [[] for _ in range(6)]
        columns, marks = _behind_first(columns, self._windows.within)
        bucket = (columns[0] % U8(self._buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        columns, bucket = [column[order] for column in columns], bucket[order]
        numbers, starts = np.unique(bucket, return_index=True)
        rows = [(int(b), BLOCK, _packed([c[x:y] for c in columns])) for b, x, y in zip(numbers, starts, np.append(starts[1:], len(bucket)), strict=True)]
        # Marks need no further work: any bucket will do, so they are spread by a hash of their document.
        for low in range(0, len(marks[0]), MARKS_TOGETHER):
            part = [column[low : low + MARKS_TOGETHER] for column in marks]
            place = _mixed(part[2][:1].astype(np.int64).view(U8) + U8(low))[0] % U8(self._buckets)
            rows.append((int(place), MARK, _packed(part)))
        yield pa.record_batch(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
            ["_bucket", "_kind", "_packed"],
        )


# Marks that go to one bucket together.
MARKS_TOGETHER = 1 << 12
KINDS = ("<u8", "<u8", "<i8", "<i8", "<i4", "<i4")


def _packed(columns: list[np.ndarray]) -> bytes:
    return b"".join(column.astype(kind).tobytes() for column, kind in zip(columns, KINDS, strict=True))


def _unpacked(payload: bytes) -> list[np.ndarray]:
    count, at, columns = len(payload) // 40, 0, []
    for kind in KINDS:
        columns.append(np.frombuffer(payload, kind, count, at))
        at += columns[-1].nbytes
    return columns


def _grouped(columns: list[np.ndarray], within: bool) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Columns in order of anchor, block and place; which rows begin a block; which stand at its first place."""
    anchor, block, doc, _, first, _ = columns
    order = np.lexsort((first, doc, block, anchor))
    columns = [column[order] for column in columns]
    anchor, block, doc, _, first, _ = columns
    begins = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])))
    at = np.flatnonzero(begins)[np.cumsum(begins) - 1]
    is_first = doc == doc[at]
    if within:
        is_first &= first == first[at]
    return columns, begins, is_first


def _behind_first(columns: list[np.ndarray], within: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The rows at the first place of their block, and the others, whose windows all start earlier."""
    columns, _, is_first = _grouped(columns, within)
    return [c[is_first] for c in columns], [c[~is_first] for c in columns]


def _settled(parts: Iterable[tuple[int, bytes]], windows: Windows) -> pa.RecordBatch:
    """Marks and the blocks that an exact matcher must look at, of one bucket."""
    found = {MARK: [], BLOCK: []}
    for kind, payload in parts:
        found[kind].append(_unpacked(payload))
    marks = [[np.concatenate(c) for c in zip(*found[MARK], strict=True)]] if found[MARK] else []
    left = None
    if found[BLOCK]:
        columns, begins, is_first = _grouped([np.concatenate(c) for c in zip(*found[BLOCK], strict=True)], windows.within)
        anchor = columns[0]
        begins_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        group = np.cumsum(begins_anchor) - 1
        several = np.add.reduceat(begins.astype(np.int64), np.flatnonzero(begins_anchor))[group] > 1
        marks.append([c[~is_first] for c in columns])
        left = [c[is_first & several] for c in columns]
    rows = [(MARK, m) for m in marks] + ([(BLOCK, left)] if left is not None else [])
    out = [[], [], [], [], [], []]
    for kind, (anchor, _, doc, same, first, more) in rows:
        for column, values in zip(out, (np.full(len(doc), kind, np.int32), doc, same, first, first + more, anchor.view(np.int64)), strict=True):
            column.append(values)
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
    return pa.record_batch([pa.array(np.concatenate(c) if c else [], k) for c, k in zip(out, kinds, strict=True)], ["_kind", "_doc", "_same", "_start", "_stop", "_shard"])


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, order key (null ids first) and text, with a hash to tell apart rows that share an id; null text is empty."""
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc = F.col(id_col).cast("long")
    return docs.select(doc.alias(DOC_ID), F.coalesce(doc, F.lit(-(1 << 63))).alias("_doc"), F.xxhash64(text).alias("_same"), text.alias(TEXT))


def _hot_anchors(table: DataFrame, windows: Windows, one_in: int, share: int, least: int) -> np.ndarray:
    """Anchors with so many different blocks in a sample of texts that one task should not get them all.

    They decide how rows are dealt, not what comes out. At most ``share`` times the
    anchors of an average text can be over the threshold, so the list is bounded.
    """
    sample = table.where(F.pmod("_same", F.lit(one_in)) == 0).select("_same", TEXT)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch[TEXT]:
                units = windows.units(text.as_py())
                if len(units) >= windows.length:
                    anchor, block, *_ = blocks(units, windows)
                    yield pa.record_batch([pa.array(anchor.view(np.int64)), pa.array(block.view(np.int64))], ["a", "b"])

    counts = sample.mapInArrow(run, "a long, b long").distinct().groupBy("a").count()
    threshold = max(least, sample.count() // share)
    found = [row["a"] for row in counts.where(F.col("count") >= threshold).select("a").toLocalIterator()]
    return np.sort(np.array(found, dtype=np.int64).view(U8))


Match = Callable[[np.ndarray, np.ndarray, list[bytes]], tuple[np.ndarray, np.ndarray]]
Cut = Callable[[str, list[int], list[int]], list[bytes]]


def earlier_windows(docs: DataFrame, windows: Windows, cut: Cut, match: Match) -> DataFrame:
    """``_doc``, ``_same`` and ``_gone``: the window starts that also start earlier, each stretch as first << 32 | last.

    ``docs`` comes from ``keyed``. ``cut`` gives the content of blocks of a text by
    first and last window start. ``match`` gets the blocks of some anchors in order
    of place (documents, first window starts, contents) and tells the number of a
    block and the window start for each window that also starts in an earlier one.
    Rows that share id and text count as one document.
    """
    spark = docs.sparkSession
    buckets = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = spark.sparkContext.broadcast(_hot_anchors(docs, windows, one_in=50, share=2000, least=100))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer = _Buffer(windows, buckets, hot.value)
        for batch in batches:
            for doc, same, text in zip(batch["_doc"].to_pylist(), batch["_same"].to_pylist(), batch[TEXT], strict=True):
                buffer.add(doc, same, text.as_py())
                if buffer.size >= FLUSH:
                    yield from buffer.flush()
        yield from buffer.flush()

    def settle(table: pa.Table) -> pa.Table:
        parts = zip(table["_kind"].to_pylist(), table["_packed"].to_pylist(), strict=True)
        return pa.Table.from_batches([_settled(parts, windows)])

    def content(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            rows = zip(batch["_doc"].to_pylist(), batch["_same"].to_pylist(), batch["_blocks"].to_pylist(), batch[TEXT], strict=True)
            for doc, same, found, text in rows:
                # Rows that share id and text ask for the same blocks; one copy of each is enough.
                found = sorted({(x["_start"], x["_stop"], x["_shard"]) for x in found})
                columns[0] += [x[2] for x in found]
                columns[1] += [doc] * len(found)
                columns[2] += [same] * len(found)
                columns[3] += [x[0] for x in found]
                columns[4] += cut(text.as_py(), [x[0] for x in found], [x[1] for x in found])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["_shard", "_doc", "_same", "_start", "_content"])

    def matched(table: pa.Table) -> pa.Table:
        doc, same, start = (table[c].to_numpy() for c in ("_doc", "_same", "_start"))
        order = np.lexsort((same, start, doc))
        contents = table["_content"].to_pylist()
        number, at = match(doc[order], start[order], [contents[k] for k in order])
        # Neighbouring windows of a document are one stretch.
        by_place = np.lexsort((at, number))
        number, at = number[by_place], at[by_place].astype(np.int64)
        begins = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1] + 1) | (number[1:] != number[:-1]))) if len(at) else [])
        ends = np.append(begins[1:], len(at)) - 1 if len(begins) else begins
        row = order[number[begins]] if len(begins) else np.zeros(0, dtype=np.int64)
        columns = [doc[row], same[row], at[begins] << 32 | at[ends] if len(begins) else np.zeros(0, dtype=np.int64)]
        return pa.table(columns, names=[*KEY, "_gone"])

    dealt = docs.select(*KEY, TEXT).mapInArrow(deal, "_bucket int, _kind int, _packed binary")
    settled = staged(dealt.groupBy("_bucket").applyInArrow(settle, OUT), "blocks")
    marks = settled.where(F.col("_kind") == MARK)
    marks = marks.select(*KEY, F.shiftleft(F.col("_start").cast("long"), 32).bitwiseOR(F.col("_stop")).alias("_gone"))
    asked = settled.where(F.col("_kind") == BLOCK).groupBy(*KEY).agg(F.collect_list(F.struct("_start", "_stop", "_shard")).alias("_blocks"))
    with_text = asked.join(docs.select(*KEY, TEXT).dropDuplicates(KEY), KEY)
    cut_out = with_text.mapInArrow(content, "_shard long, _doc long, _same long, _start int, _content binary")
    shard = F.pmod("_shard", F.lit(buckets)).alias("_bucket")
    found = cut_out.groupBy(shard).applyInArrow(matched, "_doc long, _same long, _gone long")
    return marks.unionByName(found)


def with_stretches(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``keyed`` with ``_gone``, the list of all their stretches (null where there are none)."""
    listed = gone.groupBy(*KEY).agg(F.collect_list("_gone").alias("_gone"))
    return docs.join(listed, KEY, "left").select(DOC_ID, TEXT, "_gone")


def covered(stretches: np.ndarray | list[int] | None, units: int, length: int) -> np.ndarray:
    """Which units lie in a window that starts in one of the stretches."""
    change = np.zeros(units + 1, dtype=np.int64)
    if stretches is not None and len(stretches):
        packed = np.array(stretches, dtype=np.int64)
        np.add.at(change, packed >> 32, 1)
        np.add.at(change, (packed & 0xFFFFFFFF) + length, -1)
    return np.cumsum(change)[:units] > 0
