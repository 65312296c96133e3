"""Repeated stretches of bytes, by induced suffix sorting.

Blocks that may share a window meet in a shard (see ``repeats``). A shard's suffixes
are sorted by induction: first the suffixes at the local minima (the S* suffixes),
then, from these, the others in two sweeps over the first letter, one upward and one
downward. Queues, one for each letter, carry the suffixes from the place where they
are induced to where their letter's turn comes; what doesn't fit in memory of a
queue waits in a file. As only common prefixes of a window's length count, S*
suffixes are compared up to that length and neighbours' common prefixes as well.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clearbook.llm.repeats import Windows, _mixed, covered, earlier_windows, keyed, with_stretches
from clearbook.llm.tables import DOC_ID, TEXT

LETTERS = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
END = 0  # stands after each block; letters are bytes plus one
STRIPPED = 256  # documents handed back together


class LetterQueues:
    """A queue of suffixes for each letter. Beyond ``in_memory`` suffixes the longest queues' parts go to a file."""

    def __init__(self, letters: int, in_memory: int = 1 << 24) -> None:
        self._parts: list[list] = [[] for _ in range(letters)]
        self._held, self._most, self._file = 0, in_memory, None

    def put(self, letters: np.ndarray, suffixes: np.ndarray) -> None:
        order = np.argsort(letters, kind="stable")
        letters, suffixes = letters[order], suffixes[order]
        starts = np.flatnonzero(np.concatenate(([True], letters[1:] != letters[:-1]))) if len(letters) else []
        for letter, part in zip(letters[starts], np.split(suffixes, starts[1:]), strict=True) if len(letters) else ():
            self._parts[letter].append(part)
            self._held += len(part)
        if self._held > self._most:
            self._spill()

    def _spill(self) -> None:
        self._file = self._file or tempfile.TemporaryFile()  # noqa: SIM115  closed with the queues
        for parts in self._parts:
            for k, part in enumerate(parts):
                if isinstance(part, np.ndarray):
                    at = self._file.seek(0, 2)
                    self._file.write(part.tobytes())
                    parts[k] = (at, part.dtype, len(part))
        self._held = 0

    def take(self, letter: int) -> np.ndarray:
        parts, found = self._parts[letter], []
        self._parts[letter] = []
        for part in parts:
            if isinstance(part, np.ndarray):
                self._held -= len(part)
                found.append(part)
            else:
                at, kind, size = part
                self._file.seek(at)
                found.append(np.frombuffer(self._file.read(size * kind.itemsize), kind))
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def packed_words(letters: np.ndarray, depth: int) -> np.ndarray:
    """At each place the next seven letters as one number that sorts like them, zeros after the end."""
    padded = np.concatenate([letters, np.zeros(depth + 8, dtype=letters.dtype)]).astype(np.uint16)
    words = np.zeros(len(letters) + depth + 1, dtype=np.uint64)
    for k in range(7):
        words <<= np.uint64(9)
        words |= padded[k : k + len(words)]
    return words


def _sorted_to_depth(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of their next ``depth`` letters; equal ones in order of place."""
    places = places[np.argsort(words[places], kind="stable")]
    value = words[places]
    group = np.cumsum(np.concatenate(([0], value[1:] != value[:-1])))
    for at in range(7, depth, 7):
        tied = np.zeros(len(places), dtype=bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        open_ = np.flatnonzero(tied)
        if not len(open_):
            break
        value = words[places[open_] + at]
        order = np.lexsort((value, group[open_]))
        places[open_], value = places[open_][order], value[order]
        breaks = np.zeros(len(places), dtype=np.int64)
        own = group[open_]
        breaks[open_[1:]] = (own[1:] != own[:-1]) | (value[1:] != value[:-1])
        breaks[1:] |= ~same
        group = np.cumsum(breaks)
    return places


def induced_order(letters: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in order of their next ``depth`` letters at least. The last letter must be ``END``."""
    size, most = len(letters), int(letters.max()) + 1
    step = (letters[1:] > letters[:-1]).astype(np.int8) - (letters[1:] < letters[:-1])
    changes = np.arange(size - 1, dtype=np.int32 if size < 1 << 31 else np.int64)
    changes[step == 0] = size - 1
    following = np.minimum.accumulate(changes[::-1])[::-1]
    rises = np.append(np.append(step, np.int8(1))[following] > 0, True)  # S suffixes; the others are L
    del step, changes, following
    minima = np.flatnonzero(rises[1:] & ~rises[:-1]) + 1
    minima = _sorted_to_depth(minima, words, depth)
    first = np.searchsorted(letters[minima], np.arange(most + 1))

    falling: list[np.ndarray] = []
    queues = LetterQueues(most)

    def induce(suffixes: np.ndarray, falls: bool) -> tuple[np.ndarray, np.ndarray]:
        before = suffixes - 1
        before = before[before >= 0]
        before = before[~rises[before]] if falls else before[rises[before]]
        return letters[before], before

    for letter in range(most):
        turn, done = queues.take(letter), []
        while len(turn):
            done.append(turn)
            at, before = induce(turn, True)
            turn = before[at == letter]
            queues.put(at[at != letter], before[at != letter])
        falling.append(np.concatenate(done) if done else np.zeros(0, dtype=np.int64))
        queues.put(*induce(minima[first[letter] : first[letter + 1]], True))

    queues, order = LetterQueues(most), []
    queues.put(letters[-1:], np.array([size - 1]))
    for letter in range(most - 1, -1, -1):
        turn, done = queues.take(letter), []
        while len(turn):
            done.append(turn)
            at, before = induce(turn, False)
            turn = before[at == letter]
            queues.put(at[at != letter], before[at != letter])
        queues.put(*induce(falling[letter][::-1], False))
        order.append(np.concatenate([falling[letter], *(part[::-1] for part in done[::-1])]))
    return np.concatenate(order[::-1])


def share_prefix(left: np.ndarray, right: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Whether the common prefix of two suffixes reaches ``depth``."""
    equal = np.ones(len(left), dtype=bool)
    for at in [*range(0, depth - 6, 7), max(0, depth - 7)]:
        open_ = np.flatnonzero(equal)
        equal[open_] = words[left[open_] + at] == words[right[open_] + at]
    return equal


def matcher(length: int):
    """For blocks in order of place: the windows that also start in an earlier block, by block and start."""

    def match(docs: np.ndarray, starts: np.ndarray, contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(content) for content in contents])
        letters = np.frombuffer(b"".join(content + b"\0" for content in contents), dtype=np.uint8).astype(np.int16) + np.int16(1)
        ends = np.cumsum(sizes + 1) - 1
        letters[ends] = END
        words = packed_words(letters, length)
        order = induced_order(letters, words, length)
        block = np.repeat(np.arange(len(contents)), sizes + 1)
        is_window = np.arange(len(letters)) + length <= ends[block]
        order = order[is_window[order]]
        alike = share_prefix(order[:-1], order[1:], words, length)
        begins = np.flatnonzero(np.concatenate(([True], ~alike)))
        first = np.repeat(np.minimum.reduceat(order, begins), np.diff(np.append(begins, len(order))))
        moved = starts - (ends - sizes)
        later = docs[block[order]] > docs[block[first]]
        later |= order + moved[block[order]] > first + moved[block[first]]
        found = order[(order != first) & later]
        return block[found], found + moved[block[found]]

    return match


def byte_units(text: str) -> np.ndarray:
    return LETTERS[np.frombuffer(text.encode("utf-8"), dtype=np.uint8)]


def without_repeated_bytes(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``kept`` (the remaining bytes), ``n_bytes``, ``n_removed`` and ``n_spans`` of every row.

    A byte goes if it is covered by ``length`` bytes that also start earlier: in a
    document of smaller id, or before in the same. Stretches are judged on the
    input; they overlap and don't cross documents. Texts are UTF-8, null counts as
    empty, texts shorter than ``length`` stay. Null ids come before all others;
    rows that share id and text are treated alike.
    """

    def cut(text: str, starts: list[int], stops: list[int]) -> list[bytes]:
        content = text.encode("utf-8")
        return [content[a : b + length] for a, b in zip(starts, stops, strict=True)]

    def strip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (batch.slice(low, STRIPPED) for batch in batches for low in range(0, batch.num_rows, STRIPPED))
        for batch in pieces:
            kept, totals, spans = [], [], []
            for text, gone in zip(batch[TEXT], batch["_gone"], strict=True):
                content = np.frombuffer(text.as_py().encode("utf-8"), dtype=np.uint8)
                hidden = covered(gone.values.to_numpy() if gone.is_valid else None, len(content), length)
                kept.append(content[~hidden].tobytes())
                totals.append(len(content))
                spans.append(int(hidden[:1].sum() + (hidden[1:] & ~hidden[:-1]).sum()))
            removed = [total - len(rest) for total, rest in zip(totals, kept, strict=True)]
            columns = [batch[DOC_ID], pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (totals, removed, spans))]
            yield pa.record_batch(columns, ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    table = keyed(docs, id_col, text_col)
    gone = earlier_windows(table, Windows(length, 32 if length >= 64 else max(1, length // 3), byte_units, True), cut, matcher(length))
    return with_stretches(table, gone).mapInArrow(strip, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
