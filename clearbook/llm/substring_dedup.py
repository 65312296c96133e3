"""Repeated runs of words, by suffix automata of reference shards.

The corpus is its own reference. Blocks of words that may share a window meet in a
shard of bounded content (see ``repeats``): each different block of an anchor once, at
its first document. A shard's automaton grows with the documents in ascending
order: a document is streamed through the automaton of those before it, which
gives at each word the longest run that occurs there (its matching statistics),
and is then added. Runs over the threshold go.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from clearbook.llm.repeats import Windows, covered, earlier_windows, keyed, with_stretches
from clearbook.llm.tables import DOC_ID, TEXT


class SuffixAutomaton:
    """Recognises every run of words of the sequences added."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, following: dict[bytes, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, word: bytes, to: int) -> int:
        """A state for the runs of ``to`` no longer than ``state`` and ``word``."""
        short = self._state(self.length[state] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = short
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = short
            state = self.link[state]
        return short

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            to = self.next[last].get(word)
            if to is not None:
                last = to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
                continue
            new, state = self._state(self.length[last] + 1, 0, {}), last
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = new
                state = self.link[state]
            if state >= 0:
                to = self.next[state][word]
                self.link[new] = to if self.length[to] == self.length[state] + 1 else self._split(state, word, to)
            last = new

    def matching_statistics(self, words: list[bytes]) -> Iterator[int]:
        """At each word the length of the longest run ending there that occurs in what was added."""
        state = size = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            to = self.next[state].get(word)
            if to is not None:
                state, size = to, size + 1
            yield size


def matcher(length: int):
    """For blocks in order of place: the windows that also start in a document before, by block and start."""

    def match(docs: np.ndarray, starts: np.ndarray, contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        automaton, number, at = SuffixAutomaton(), [], []
        cut = [content.split() for content in contents]
        bounds = [*np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1]))).tolist(), len(docs)]
        for low, high in zip(bounds, bounds[1:], strict=False):
            for k in range(low, high):
                for end, size in enumerate(automaton.matching_statistics(cut[k]), 1):
                    if size >= length:
                        number.append(k)
                        at.append(int(starts[k]) + end - length)
            for k in range(low, high):
                automaton.add(cut[k])
        return np.array(number, dtype=np.int64), np.array(at, dtype=np.int64)

    return match


def word_units(text: str) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(word) for word in text.encode("utf-8").split()], dtype=np.uint64)


def without_repeated_words(docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``kept`` (remaining words joined by spaces), ``n_words`` and ``n_removed`` of every row.

    Words are what stands between ASCII white space, unchanged. A word goes if it
    is covered by ``length`` words in a row that also start in a document of smaller
    id; runs are judged on the input. Null texts have no words, texts of fewer than
    ``length`` words stay. Null ids come before all others; rows that share an id
    don't count as before each other.
    """

    def cut(text: str, starts: list[int], stops: list[int]) -> list[bytes]:
        words = text.encode("utf-8").split()
        return [b" ".join(words[a : b + length]) for a, b in zip(starts, stops, strict=True)]

    def strip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, totals, removed = [], [], []
            for text, gone in zip(batch[TEXT], batch["_gone"], strict=True):
                words = text.as_py().encode("utf-8").split()
                hidden = covered(gone.values.to_numpy() if gone.is_valid else None, len(words), length)
                rest = [word for word, out in zip(words, hidden.tolist(), strict=True) if not out] if gone.is_valid else words
                kept.append(b" ".join(rest).decode("utf-8"))
                totals.append(len(words))
                removed.append(len(words) - len(rest))
            columns = [batch[DOC_ID], pa.array(kept, pa.string()), pa.array(totals, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.record_batch(columns, ["doc_id", "kept", "n_words", "n_removed"])

    table = keyed(docs, id_col, text_col)
    gone = earlier_windows(table, Windows(length, max(1, (length + 2) // 3), word_units, False), cut, matcher(length))
    return with_stretches(table, gone).mapInArrow(strip, "doc_id long, kept string, n_words long, n_removed long")
