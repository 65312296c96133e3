"""Documents that hold a benchmark item, within an edit budget.

An item of n characters may differ by up to e edits. Cut into e + 1 pieces, one
piece at least must occur unchanged (pigeonhole). An automaton over the pieces
of a block of items finds all of them in one pass over a document; around each,
the item's distance is computed with bit vectors (Myers), one step per character.
Case and the amount of white space don't count.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from uuid import uuid4

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearbook.llm.tables import DOC_ID, TEXT, free_names, id_and_text, once_per_worker, with_row_keys, without_rows
from clearbook.sources.sinks import staged

Item = tuple[int | None, str]
FOUND = "doc_id long, item_id long, distance int, start long, stop long"


def plain(text: str) -> str:
    """Lower case, with white space as single spaces."""
    return " ".join(text.lower().split())


def cut(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of nearly equal length and where each starts."""
    bounds = [len(item) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def nearest_substring(item: str, text: str, most: int) -> tuple[int, int] | None:
    """Smallest edit distance of ``item`` to a substring of ``text``, and where that ends; none beyond ``most``.

    Columns of differences as bit vectors of any length; the first row is zero, so
    a match may start anywhere.
    """
    places: dict[str, int] = {}
    for i, letter in enumerate(item):
        places[letter] = places.get(letter, 0) | 1 << i
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, score, best = full, 0, len(item), None
    for end, letter in enumerate(text, 1):
        same = places.get(letter, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right_up = down | ~(diagonal | up) & full
        right_down = up & diagonal
        score += bool(right_up & top) - bool(right_down & top)
        right_up = right_up << 1 & full
        right_down = right_down << 1 & full
        up = right_down | ~((diagonal | down) | right_up) & full
        down = right_up & (diagonal | down)
        if score <= most and (best is None or score < best[0]):
            best = (score, end)
    return best


def within_word(text: str, at: int) -> bool:
    """Whether a word goes on over a place; scripts from U+2E80 on are written without spaces."""
    return 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum() and max(text[at - 1 : at + 1]) < "\u2e80"


class ItemIndex:
    """The pieces of a block of items in one automaton; an item of fewer than ``least_chars`` is one piece."""

    def __init__(self, items: list[Item], rate: float, least_chars: int) -> None:
        self._least = least_chars
        self._items = [(item_id, item, int(len(item) * rate) if len(item) >= least_chars else 0) for item_id, item in items]
        owners: dict[str, list[tuple[int, int]]] = {}
        for k, (_, item, edits) in enumerate(self._items):
            for at, piece in cut(item, edits):
                owners.setdefault(piece, []).append((k, at))
        self._automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self._automaton.add_word(piece, (len(piece), where))
        self._automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int | None, int, int, int]]:
        """Item, distance, start and end (in plain text) of the best place of each item in the text."""
        windows: dict[int, set[int]] = {}
        for end, (length, owners) in self._automaton.iter(text):
            for k, at in owners:
                start = end + 1 - length - at
                if len(self._items[k][1]) >= self._least:
                    windows.setdefault(k, set()).add(start)
                elif k not in windows and not within_word(text, start) and not within_word(text, end + 1):
                    windows[k] = {start}
        for k, starts in windows.items():
            item_id, item, edits = self._items[k]
            best, reach = None, -1
            for start in sorted(starts):
                # Places within the budget of each other lie in one window.
                low, high = max(0, start - edits, reach), start + len(item) + edits
                low = max(0, start - edits) if low <= start + edits else low
                found = nearest_substring(item, text[low:high], edits)
                if found and (best is None or found[0] < best[0]):
                    best = (found[0], max(0, low + found[1] - len(item)), low + found[1])
                    if not found[0]:
                        break
            if best:
                yield item_id, *best


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[Item]]:
    """The items in blocks of bounded size, read one after the other."""
    block, size = [], 0
    for row in id_and_text(items, id_col, text_col).distinct().toLocalIterator():
        item = plain(row[TEXT] or "")
        if not item:
            continue
        block.append((row[DOC_ID], item))
        size += len(item)
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_items(
    docs: DataFrame,
    items: DataFrame,
    rate: float = 0.05,
    least_chars: int = 40,
    block_chars: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Document, item, distance and place of every item that a document holds.

    An item may differ by ``rate`` times its characters, rounded down. Items of
    fewer than ``least_chars`` plain characters count only where they stand unchanged
    and as whole words; null and blank ones take no part. Whole documents are searched; null and empty
    ones hold nothing. For each document and item the place with the smallest
    distance (the first of these) is returned. Repeated documents are found
    each, repeated items once for each id. The benchmark is sent in blocks of
    ``block_chars``, each with one pass over the documents; there is no shuffle.
    """
    texts = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col(DOC_ID))
    return _found(texts, ["doc_id"], items, rate, least_chars, block_chars, item_id_col, item_text_col)


def _found(
    texts: DataFrame,
    carried: list[str],
    items: DataFrame,
    rate: float = 0.05,
    least_chars: int = 40,
    block_chars: int = 1 << 20,
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The columns ``carried`` of each text and what it holds of the items."""
    spark, found = texts.sparkSession, []
    schema = StructType([*texts.select(*carried).schema.fields, *StructType.fromDDL(FOUND).fields[1:]])
    for block in item_blocks(items, item_id_col, item_text_col, block_chars):
        sent = spark.sparkContext.broadcast((block, rate, least_chars))

        def search(batches: Iterable[pa.RecordBatch], sent=sent, key=uuid4().hex) -> Iterator[pa.RecordBatch]:
            index = once_per_worker(("items", key), lambda: ItemIndex(*sent.value))
            for batch in batches:
                rows = [
                    (k, *hit)
                    for k, text in enumerate(batch[TEXT])
                    if text.is_valid
                    for hit in index.find(plain(text.as_py()))
                ]
                at = pa.array([row[0] for row in rows], pa.int64())
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds, 1)]
                names = [*carried, "item_id", "distance", "start", "stop"]
                yield pa.record_batch([*(batch[name].take(at) for name in carried), *columns], names)

        found.append(texts.mapInArrow(search, schema))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def without_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The documents that hold no item, with all their columns. Each row is judged by its own text, whatever its id."""
    names = free_names(docs, "_hit_id", "_hit_hash", "_hit_hash2")
    rows = with_row_keys(docs, id_col, text_col, names)
    hit = staged(_found(rows, names, items, **options).select(*names), "hits")
    return without_rows(docs, hit, id_col, text_col, names)
