"""Byte-level BPE as a finite-state transducer, and the streaming way back to text.

The merges are compiled into a transducer that reads one byte at a time. Its
states are the ways in which the bytes read so far can still go on: for each
start of a token that may not have ended yet, the place in the token trie and
the tokens before it that are not certain yet. Tokens that all ways share are
emitted; so a token leaves after at most as many bytes as the longest token has.
States and transitions are made when they are first needed and then looked up.

That one way per position is enough rests on a property of merges whose ranks
grow with each merge: the encoding of a prefix ends in the one token that is
compatible with the last token of the encoding before it, where two tokens are
compatible if no merge crosses their boundary while both are being formed.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from clearbook.llm.tables import DOC_ID, TEXT, id_and_text, once_per_worker

LONG_TEXT = 1 << 20
# Fixed value: the splitting pattern published with the vocabulary of 50,257 ids.
SPACE_LED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEVER = 1 << 62
LATIN_END = "\u0250"  # below it what is a letter is the same in every version of Unicode
# Signs that SPACE_LED takes together behind a word: all ASCII ones but the apostrophe.
SIGNS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of base64 text and number per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class MergeTransducer:
    """Encodes one piece of text (a match of the splitting pattern) as little-endian ids of four bytes.

    ``most_steps`` bounds the memory of the lazily made transitions; a piece that
    needs one beyond it goes on through the same ways by the trie's suffix links,
    of which there is one for each node.
    """

    def __init__(self, ranks: dict[bytes, int], most_steps: int = 100_000) -> None:
        self.ranks = ranks
        self.most_steps = most_steps
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._sizes = {rank: len(token) for token, rank in ranks.items()}
        self._ids = {rank: rank.to_bytes(4, "little") for rank in ranks.values()}
        self._next: dict[int, int] = {}  # trie: node << 8 | byte -> node
        self._token = [-1]
        self._leaf = [True]
        self._depth = [0]
        for token, rank in ranks.items():
            node = 0
            for depth, byte in enumerate(token, 1):
                key = node << 8 | byte
                child = self._next.get(key)
                if child is None:
                    child = self._next[key] = len(self._token)
                    self._token.append(-1)
                    self._leaf.append(True)
                    self._depth.append(depth)
                    self._leaf[node] = False
                node = child
            self._token[node] = rank
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._spines: tuple[dict[int, list[tuple[int, int]]], ...] = ({}, {})
        self._pairs: dict[int, bool] = {}
        self._token = [rank if rank >= 0 and self._reachable(rank) else -1 for rank in self._token]
        self._link_suffixes()
        self._threads = [((0, (-1,)),)]
        self._state_of = {self._threads[0]: 0}
        self._last = [b""]
        self._step: dict[int, tuple[int, bytes]] = {}
        self._opened: dict[int, tuple[int, list[int]]] = {}

    def _link_suffixes(self) -> None:
        """For each node that of its longest proper suffix, and the longest token that ends there."""
        size = len(self._token)
        self._fallback = [0] * size
        self._ending = [(-1, 0)] * size  # token and its number of bytes
        self._shorter: dict[int, tuple[int, int]] = {}  # the next token that ends where this one does
        for key, child in sorted(self._next.items(), key=lambda edge: self._depth[edge[1]]):
            node, byte = key >> 8, key & 255
            if node:
                node = self._fallback[node]
                while node and node << 8 | byte not in self._next:
                    node = self._fallback[node]
                self._fallback[child] = self._next.get(node << 8 | byte, 0)
            token, shorter = self._token[child], self._ending[self._fallback[child]]
            if token >= 0:
                self._shorter[token] = shorter
            self._ending[child] = shorter if token < 0 else (token, self._depth[child])

    def _last_merge(self, rank: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of a token joins; none for a byte or a token that merges never reach."""
        if rank not in self._parts:
            parts = [self._bytes[rank][i : i + 1] for i in range(len(self._bytes[rank]))]
            while len(parts) > 2:
                joined = [self.ranks.get(parts[i] + parts[i + 1], NEVER) for i in range(len(parts) - 1)]
                first = min(joined)
                if first == NEVER:
                    break
                i = joined.index(first)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self._parts[rank] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._parts[rank]

    def _reachable(self, rank: int) -> bool:
        return len(self._bytes[rank]) == 1 or self._last_merge(rank) is not None

    def _spine(self, rank: int, side: int) -> list[tuple[int, int]]:
        """What stands at one edge of a token while it is formed, and the rank of the merge that ends it."""
        if rank not in self._spines[side]:
            found, ended, token = [], NEVER, rank
            while True:
                found.append((token, ended))
                parts = self._last_merge(token) if len(self._bytes[token]) > 1 else None
                if parts is None:
                    break
                ended, token = token, parts[side]
            self._spines[side][rank] = found[::-1]
        return self._spines[side][rank]

    def _compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= 250_000:
                self._pairs.clear()
            known = self._pairs[key] = left < 0 or self._boundary_stays(left, right)
        return known

    def _boundary_stays(self, left: int, right: int) -> bool:
        # Of merges of equal rank the leftmost goes first: before the boundary one on
        # the left wins, after it one on the right does not.
        lefts, rights, i, j = self._spine(left, 1), self._spine(right, 0), 0, 0
        while True:
            (a, a_ends), (b, b_ends) = lefts[i], rights[j]
            crossing = self.ranks.get(self._bytes[a] + self._bytes[b], NEVER)
            if crossing < a_ends and crossing <= b_ends and crossing != NEVER:
                return False
            if a_ends == NEVER and b_ends == NEVER:
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def _make_step(self, state: int, byte: int) -> tuple[int, bytes]:
        ways, ended = [], None
        for node, path in self._threads[state]:
            child = self._next.get(node << 8 | byte)
            if child is None:
                continue
            if not self._leaf[child]:
                ways.append((child, path))
            token = self._token[child]
            if ended is None and token >= 0 and self._compatible(path[-1], token):
                ended = (*path, token)
        if ended is None:
            raise ValueError(f"byte {byte} is no token of the vocabulary")
        sure = len(ended)
        for _, path in ways:
            sure = min(sure, len(path))
            while path[:sure] != ended[:sure]:
                sure -= 1
        ways.append((0, ended))
        threads = tuple((node, path[sure - 1 :]) for node, path in ways)
        to = self._state_of.get(threads)
        if to is None:
            to = self._state_of[threads] = len(self._threads)
            self._threads.append(threads)
            self._last.append(_packed(threads[-1][1][1:]))
        known = self._step[state << 8 | byte] = (to, _packed(ended[1:sure]))
        return known

    def _open(self, state: int) -> tuple[int, list[int]]:
        """The node of the longest open start of a state, and by position the last token up to it, from the last one emitted on.

        Positions that no way passes are never looked up.
        """
        known = self._opened.get(state)
        if known is None:
            ends: dict[int, int] = {}
            for _, path in self._threads[state]:
                ends[0], at = path[0], 0
                for token in path[1:]:
                    at += self._sizes[token]
                    ends[at] = token
            known = self._threads[state][0][0], [ends.get(at, -1) for at in range(max(ends) + 1)]
            self._opened[state] = known
        return known

    def _follow(self, state: int, rest: bytes) -> bytes:
        """The tokens of the rest of a piece, without further states: one walk over the nodes of the trie.

        The starts that are open after some bytes are the suffixes of them that lie in the trie. So the
        node of the longest, with the links to shorter ones, stands for all of them. The last token up to
        a position is looked for only where a token that may follow it asks for it.
        """
        following, fallback, ending, shorter = self._next.get, self._fallback, self._ending, self._shorter
        node, known = self._open(state)
        ends: list[int | None] = [*known, *[None] * len(rest)]
        asked: list[tuple[int, int]] = [(-1, 0)] * len(known)  # by position: the longest token left that may end there
        for byte in rest:
            child = following(node << 8 | byte)
            while child is None and node:
                node = fallback[node]
                child = following(node << 8 | byte)
            node = child or 0
            asked.append(ending[node])
        open_, pairs = [len(ends) - 1], self._pairs.get
        while open_:
            at = open_[-1]
            token, length = asked[at]
            if token < 0:
                raise ValueError(f"byte {rest[at - len(ends)]} is no token of the vocabulary")
            before = ends[at - length]
            if before is None:
                open_.append(at - length)
                continue
            fits = pairs(before << 32 | token)
            if self._compatible(before, token) if fits is None else fits:
                ends[at] = token
                open_.pop()
            else:
                asked[at] = shorter[token]
        found, at, ids, sizes = [], len(ends) - 1, self._ids, self._sizes
        while at:
            token = ends[at]
            found.append(ids[token])
            at -= sizes[token]
        found.reverse()
        return b"".join(found)

    def encode(self, piece: bytes) -> bytes:
        whole = self.ranks.get(piece)
        if whole is not None:
            return whole.to_bytes(4, "little")
        state, out, step = 0, [], self._step.get
        for i, byte in enumerate(piece):
            known = step(state << 8 | byte)
            if known is None:
                if len(self._step) >= self.most_steps:
                    out.append(self._follow(state, piece[i:]))
                    return b"".join(out)
                known = self._make_step(state, byte)
            state, ids = known
            if ids:
                out.append(ids)
        out.append(self._last[state])
        return b"".join(out)


def _packed(ids: Iterable[int]) -> bytes:
    return b"".join([x.to_bytes(4, "little") for x in ids])


class Recent(dict):
    """What was encoded of late: the running and, when that is full, the last generation.

    So memory stays bounded and frequent keys stay known.
    """

    def __init__(self, encode: Callable[[str | bytes], bytes], most: int) -> None:
        self.encode, self.most, self.last = encode, most, {}

    def __missing__(self, key: str | bytes) -> bytes:
        ids = self.last.get(key)
        if ids is None:
            ids = self.encode(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.last = dict(self)
                self.clear()
            self[key] = ids
        return ids


class TextEncoder:
    """Splits a text by the pattern and encodes each match.

    The pattern in common use, ``SPACE_LED``, never has a match that goes on over
    a space followed by something else than white space. There texts are first
    cut before such spaces, and the cuts that were met of late looked up.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, most_kept: int = 150_000) -> None:
        self.transducer = MergeTransducer(ranks)
        self._cut = pattern == SPACE_LED
        self._split = regex.compile(pattern)
        self._space = re.compile(r" (?=\s|\Z)")
        self._pieces = Recent(lambda piece: self.transducer.encode(piece.encode("utf-8")), most_kept)
        self._cuts = Recent(self._cut_ids, 2 * most_kept)

    def _cut_ids(self, cut: str) -> bytes:
        # What the pattern does to a space and letters (one match), signs behind them (another), and a line's end between words.
        if cut.isalpha() and max(cut) < LATIN_END:
            return self.transducer.encode(f" {cut}".encode())
        word = cut.rstrip(SIGNS)
        if len(word) < len(cut) and word.isalpha() and max(word) < LATIN_END:
            return self._cuts[word] + self._pieces[cut[len(word) :]]
        head, _, tail = cut.partition("\n")
        if head and tail and not head[-1].isspace() and not tail[0].isspace():
            return self._cuts[head] + self._pieces["\n"] + self._line_ids(tail)
        return self._matches(f" {cut}")

    def _line_ids(self, cut: str) -> bytes:
        if cut.isalpha() and max(cut) < LATIN_END:
            return self._pieces[cut]
        return self._matches(cut)

    def _matches(self, text: str) -> bytes:
        if len(text) > LONG_TEXT:
            return b"".join(self._pieces[found.group()] for found in self._split.finditer(text))
        return b"".join(map(self._pieces.__getitem__, self._split.findall(text)))

    def encode(self, text: str) -> bytes:
        if not self._cut or self._space.search(text):
            return self._matches(text)
        first, *cuts = text.split(" ")
        return self._matches(first) + b"".join(map(self._cuts.__getitem__, cuts))


class Utf8Stream:
    """Turns chunks of bytes into text; a character cut by the end of a chunk waits for the next.

    Bytes that are no UTF-8 become U+FFFD.
    """

    def __init__(self) -> None:
        self._machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, chunk: bytes) -> str:
        return self._machine.decode(chunk)

    def finish(self) -> str:
        return self._machine.decode(b"", final=True)


def decode_ids(ids: bytes, tokens: np.ndarray, chunk_ids: int = 1 << 16) -> Iterator[str]:
    """The text of little-endian ids, chunk by chunk; ``tokens`` holds the bytes of each id."""
    stream, numbers = Utf8Stream(), np.frombuffer(ids, dtype="<u4")
    for start in range(0, len(numbers), chunk_ids):
        yield stream.feed(b"".join(tokens[numbers[start : start + chunk_ids]].tolist()))
    yield stream.finish()


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned 32-bit integers) and ``n_tokens`` of every row.

    A row in, a row out: repeated rows and null ids stay. A null text counts as
    empty and has no ids. Texts are taken whole, however long; other columns are
    not read. The file of ranks must be readable on every executor. No shuffle.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_per_worker(("bpe", ranks_path, pattern), lambda: TextEncoder(read_ranks(ranks_path), pattern))
        for batch in batches:
            ids = [encoder.encode(text.as_py() or "") for text in batch[TEXT]]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.record_batch([batch[DOC_ID], pa.array(ids, pa.binary()), counts], ["doc_id", "ids", "n_tokens"])

    return id_and_text(docs, id_col, text_col).mapInArrow(encode, "doc_id long, ids binary, n_tokens long")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The rows of ``encode_documents`` with ``text``, decoded from ``ids``. No shuffle."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = once_per_worker(("bpe tokens", ranks_path), lambda: _by_rank(read_ranks(ranks_path)))
        for batch in batches:
            texts = ["".join(decode_ids(ids.as_py() or b"", tokens)) for ids in batch["ids"]]
            columns = [batch["doc_id"], batch["ids"], batch["n_tokens"], pa.array(texts, pa.string())]
            yield pa.record_batch(columns, ["doc_id", "ids", "n_tokens", "text"])

    wanted = encoded.select("doc_id", "ids", "n_tokens")
    return wanted.mapInArrow(decode, "doc_id long, ids binary, n_tokens long, text string")


def _by_rank(ranks: dict[bytes, int]) -> np.ndarray:
    tokens = np.full(max(ranks.values(), default=-1) + 1, b"", dtype=object)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """What ``decode_documents`` gives for ``encode_documents``, in one Python step: half the workers, half the transfers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make() -> tuple[TextEncoder, np.ndarray]:
            ranks = read_ranks(ranks_path)
            return TextEncoder(ranks, pattern), _by_rank(ranks)

        encoder, tokens = once_per_worker(("bpe round trip", ranks_path, pattern), make)
        for batch in batches:
            ids = [encoder.encode(text.as_py() or "") for text in batch[TEXT]]
            texts = pa.array(["".join(decode_ids(x, tokens)) for x in ids], pa.string())
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            columns = [batch[DOC_ID], pa.array(ids, pa.binary()), counts, texts]
            yield pa.record_batch(columns, ["doc_id", "ids", "n_tokens", "text"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary, n_tokens long, text string")


def round_trip_digests(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the bytes decoded from them.

    As ``round_trip``, but the ids and texts stay in the task, one document at a time.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make() -> tuple[TextEncoder, np.ndarray]:
            ranks = read_ranks(ranks_path)
            return TextEncoder(ranks, pattern), _by_rank(ranks)

        encoder, tokens = once_per_worker(("bpe round trip", ranks_path, pattern), make)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch[TEXT]:
                ids = encoder.encode(text.as_py() or "")
                decoded = hashlib.sha256()
                for part in decode_ids(ids, tokens):
                    decoded.update(part.encode("utf-8"))
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(decoded.hexdigest())
            columns = [batch[DOC_ID], pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            yield pa.record_batch(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
