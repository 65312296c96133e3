"""Token ids of a corpus in files: grammar-compressed blocks with random access.

A block holds the ids of consecutive documents (ascending id). Re-Pair shortens
them: the most frequent pairs of neighbouring symbols are replaced by new symbols,
again and again, until no pair is frequent. The block keeps the rules, how many
ids each rule stands for, and the shortened sequence. Prefix sums over those
lengths find any range of ids without expanding the rest. No rule reaches over
the end of a document.

Layout of a block, little-endian: magic, then counts (first rule symbol, rules,
symbols, documents, symbol width in bytes), rule pairs, rule lengths, symbols,
and per document the id, whether it is null, and its number of ids. Blocks are
rows of Parquet files, so that Spark commits them and any store can hold them.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clearbook.llm.byte_bpe import Recent
from clearbook.llm.tables import DOC_ID, TEXT, id_and_text, once_per_worker

MAGIC = b"IDRP"
HEADER = struct.Struct("<4sIIIII")
PACKERS = [struct.Struct(f"<{n}I").pack for n in range(64)]  # by number of ids
END_ID = 1
END = END_ID.to_bytes(4, "little")
# Signs that a tokenizer with WORD_PIECES takes together behind a word: all ASCII ones but the apostrophe.
SIGNS = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
# How the published tokenizer of words changes and cuts a text.
WORD_STEPS = [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
LATIN_END = "\u0250"  # below it letters are one character each, in composed form
WORD_PIECES = [
    ("Split", {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, True, None),
    ("ByteLevel", None, None, False),
]
BLOCK_SCHEMA = "part int, block long, part_start long, n_docs long, n_ids long, payload binary"


def _shown_bytes() -> str:
    """The published way to write bytes as characters: those with a sign of their own as it, the others from U+0100 on."""
    signs = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in signs]
    shown = {byte: chr(256 + k) for k, byte in enumerate(others)}
    return "".join(shown.get(byte) or chr(byte) for byte in range(256))


SHOWN = _shown_bytes()


def _takes_words_alone(spec: dict) -> bool:
    """Whether a tokenizer changes case alone in Latin words and sees them and the signs after them as two pieces."""
    normalizer, splitter = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = [(x["type"], x.get("pattern"), x.get("content")) for x in normalizer.get("normalizers", [])]
    pieces = [(x["type"], x.get("pattern"), x.get("invert"), x.get("add_prefix_space")) for x in splitter.get("pretokenizers", [])]
    return steps == WORD_STEPS and pieces == WORD_PIECES and spec["model"]["type"] == "BPE" and not spec["model"]["dropout"]


class ChunkEncoder:
    """Ids of texts by a tokenizer that drops white space, so that what stands between is encoded alone.

    Chunks met of late are looked up in two generations of bounded size. Where the tokenizer's
    file allows it, words of Latin letters go straight to its model, and what is known of a word is used for
    the same word in (ASCII) capitals or before signs; all other chunks go through the whole tokenizer.
    """

    def __init__(self, path: str, most_kept: int = 400_000) -> None:
        self._tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self._tokenizer.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as file:
            self._model = self._tokenizer.model if _takes_words_alone(json.load(file)) else None
        self._chunks = Recent(self._learn, most_kept)

    def _learn(self, chunk: bytes) -> bytes:
        if self._model is not None:
            if chunk.isalpha() and chunk.islower():  # ASCII letters alone, which are shown as they are
                return self._word(chunk.decode("ascii"))
            word = chunk.rstrip(SIGNS)
            if word.isalpha():
                return self._chunks[word] + self._chunks[chunk[len(word) :]] if len(word) < len(chunk) else self._chunks[word.lower()]
            name = word.decode("utf-8", "replace")
            if name.isalpha() and max(name) < LATIN_END and name == name.lower():
                if len(word) < len(chunk):
                    return self._chunks[word] + self._chunks[chunk[len(word) :]]
                return self._word(word.decode("latin-1").translate(SHOWN))
        return _packed(self._tokenizer.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def _word(self, shown: str) -> bytes:
        return _packed([token.id for token in self._model.tokenize(shown)])

    def encode(self, text: bytes) -> np.ndarray:
        """The ids of a text, without special tokens and with the end id."""
        return np.frombuffer(b"".join(map(self._chunks.__getitem__, text.split())) + END, dtype="<u4")


def _packed(ids: list[int]) -> bytes:
    return PACKERS[len(ids)](*ids) if len(ids) < len(PACKERS) else struct.pack(f"<{len(ids)}I", *ids)


def repair(ids: np.ndarray, base: int, least: int, per_round: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """The rules (left and right symbol) and the shortened sequence.

    Each round replaces, from left to right, the most frequent pairs that occur
    ``least`` times or more, ``per_round`` at most; rounds go on until there is none.
    Symbols stay below 65,536 where the vocabulary allows it, which ends the rules.
    """
    narrow = base < 60_000
    most = (1 << 16) - base if narrow else 1 << 20
    kind, shift = (np.uint32, 16) if narrow else (np.uint64, 32)
    sequence, rules = ids.astype(kind), []
    made = 0
    while len(sequence) > 1 and made < most:
        pairs = (sequence[:-1] << kind(shift)) | sequence[1:]
        open_ = (sequence[:-1] != END_ID) & (sequence[1:] != END_ID)
        in_order = np.sort(pairs[open_])
        if not len(in_order):
            break
        starts = np.flatnonzero(np.concatenate(([True], in_order[1:] != in_order[:-1])))
        counts = np.diff(np.append(starts, len(in_order)))
        often = np.flatnonzero(counts >= least)
        take = min(per_round, most - made)
        if len(often) > take:
            often = often[np.argpartition(-counts[often], take - 1)[:take]]
        if not len(often):
            break
        chosen = np.sort(in_order[starts[often]])
        is_left = np.zeros(base + most, dtype=bool)
        is_left[chosen >> kind(shift)] = True
        maybe = np.flatnonzero(open_ & is_left[sequence[:-1]])
        rule = np.minimum(np.searchsorted(chosen, pairs[maybe]), len(chosen) - 1)
        hit = chosen[rule] == pairs[maybe]
        at, rule = maybe[hit], rule[hit]
        # Of hits that overlap in a row, every other one from the left is replaced.
        first = np.concatenate(([True], at[1:] != at[:-1] + 1))
        run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        keep = (np.arange(len(at)) - run) % 2 == 0
        at, rule = at[keep], rule[keep]
        sequence[at] = base + made + rule
        stays = np.ones(len(sequence), dtype=bool)
        stays[at + 1] = False
        sequence = sequence[stays]
        rules.append(np.stack([chosen >> kind(shift), chosen & kind((1 << shift) - 1)], axis=1))
        made += len(chosen)
    return np.concatenate(rules) if rules else np.zeros((0, 2), dtype=kind), sequence


def pack_block(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int], base: int, least: int) -> bytes:
    rules, sequence = repair(ids, base, least)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    symbol = f"<u{width}"
    sizes = [1] * base
    for left, right in rules.tolist():
        sizes.append(sizes[left] + sizes[right])
    head = HEADER.pack(MAGIC, base, len(rules), len(sequence), len(doc_ids), width)
    numbers = np.array([x or 0 for x in doc_ids], dtype="<i8")
    nulls = np.array([x is None for x in doc_ids], dtype="u1")
    parts = (rules.astype(symbol), np.array(sizes[base:], dtype="<u4"), sequence.astype(symbol), numbers, nulls)
    return b"".join([head, *(x.tobytes() for x in parts), np.array(lengths, dtype="<u4").tobytes()])


@lru_cache(maxsize=1)
def _single_ids(base: int) -> list[bytes]:
    ids = np.arange(base, dtype="<u4").tobytes()
    return [ids[at : at + 4] for at in range(0, len(ids), 4)]


class Block:
    """A packed block, read."""

    def __init__(self, payload: bytes) -> None:
        magic, self.base, n_rules, n_symbols, n_docs, width = HEADER.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        at = HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(payload, dtype=kind, count=count, offset=at)
            at += found.nbytes
            return found

        self.rules = take(f"<u{width}", 2 * n_rules).reshape(-1, 2).astype(np.int64)
        self.rule_sizes = take("<u4", n_rules)
        self.sequence = take(f"<u{width}", n_symbols)
        numbers, nulls = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if null else number for number, null in zip(numbers.tolist(), nulls.tolist(), strict=True)]
        self.lengths = take("<u4", n_docs).astype(np.int64)
        self.sizes = np.concatenate([np.ones(self.base, dtype=np.int64), self.rule_sizes.astype(np.int64)])
        self.ends = np.cumsum(self.sizes[self.sequence])
        rule_starts = np.concatenate([[0], np.cumsum(self.rule_sizes)]).astype(np.int64)
        spelled = list(_single_ids(self.base))
        for left, right in self.rules.tolist():
            spelled.append(spelled[left] + spelled[right])
        flat = np.frombuffer(b"".join(spelled[self.base :]), dtype="<u4")
        self._table = np.concatenate([np.arange(self.base, dtype="<u4"), flat])
        self._table_starts = np.concatenate([np.arange(self.base), self.base + rule_starts[:-1]])

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.sizes[symbols]
        begins = np.repeat(self._table_starts[symbols] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        return self._table[begins + np.arange(int(sizes.sum()))]

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the block; only the symbols over that range are expanded."""
        if stop <= start:
            return np.zeros(0, dtype="<u4")
        first, last = np.searchsorted(self.ends, [start, stop - 1], "right")
        skipped = int(self.ends[first - 1]) if first else 0
        return self._expand(self.sequence[first : last + 1].astype(np.int64))[start - skipped : stop - skipped]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        ids = self._expand(self.sequence.astype(np.int64))
        stops = np.cumsum(self.lengths)
        for doc_id, length, stop in zip(self.doc_ids, self.lengths.tolist(), stops.tolist(), strict=True):
            yield doc_id, ids[stop - length : stop]


def write_store(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = 1 << 20,
    least: int = 256,
) -> None:
    """Write the ids of every text, each document followed by id 1, in ascending id order.

    Rows are dealt by ranges of the id (one shuffle) and sorted; null ids come
    first, equal ids by text. A null or empty text has the end id alone. A block
    closes with the document that fills it to ``block_ids``; a longer document is
    a block of its own. ``least`` is how often a pair must occur in a block to be
    replaced. The tokenizer's file must be readable on every executor.
    """

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_per_worker(("tokenizer", tokenizer_path), lambda: ChunkEncoder(tokenizer_path))
        part, state = TaskContext.get().partitionId(), {"block": 0, "start": 0}
        names: list[int | None] = []
        ids: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            joined = np.concatenate(ids)
            payload = pack_block(joined, names, [len(x) for x in ids], encoder.vocabulary, least)
            row = [part, state["block"], state["start"], len(names), len(joined), payload]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            state["block"] += 1
            state["start"] += len(joined)
            names.clear()
            ids.clear()
            columns = [pa.array([x], k) for x, k in zip(row, kinds, strict=True)]
            return pa.record_batch(columns, ["part", "block", "part_start", "n_docs", "n_ids", "payload"])

        filled = 0
        for batch in batches:
            for doc_id, text in zip(batch[DOC_ID].to_pylist(), batch[TEXT].cast(pa.binary()), strict=True):
                found = encoder.encode(text.as_py() or b"")
                names.append(doc_id)
                ids.append(found)
                filled += len(found)
                if filled >= block_ids:
                    filled = 0
                    yield close()
        if names:
            yield close()

    ordered = id_and_text(docs, id_col, text_col).repartitionByRange(DOC_ID).sortWithinPartitions(DOC_ID, TEXT)
    ordered.mapInArrow(pack, BLOCK_SCHEMA).write.parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` of every document in the files.

    Only the number of ids per written partition is summed over the whole table,
    one row for each partition; that table is what is broadcast.
    """
    blocks = spark.read.parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n_part_ids"))
    before = F.sum("n_part_ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = parts.select("part", F.coalesce(before, F.lit(0)).alias("ids_before"))

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch["start"].to_pylist(), batch["payload"], strict=True):
                block = Block(payload.as_py())
                ends = start + np.cumsum(block.lengths)
                columns = [
                    pa.array(block.doc_ids, pa.int64()),
                    pa.array(ends - block.lengths, pa.int64()),
                    pa.array(block.lengths, pa.int64()),
                    pa.array([ids.tobytes() for _, ids in block.documents()], pa.binary()),
                ]
                yield pa.record_batch(columns, ["doc_id", "start", "n_tokens", "ids"])

    placed = blocks.join(F.broadcast(starts), "part")
    wanted = placed.select((F.col("ids_before") + F.col("part_start")).alias("start"), "payload")
    return wanted.mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids binary")


def checksum(ids: bytes) -> int:
    return zlib.crc32(ids)
