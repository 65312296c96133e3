"""Language identification by unigram pieces, with all segmentations of a word summed.

Every language has probabilities for the pieces of one fixed public vocabulary.
A word's probability is the sum, over all ways to cut it into pieces, of the
product of their probabilities (forward algorithm). The probabilities are
learned by expectation maximisation: the expected number of times a piece is used,
over all segmentations (forward and backward), from one round to the next.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearbook.llm.tables import DOC_ID, TEXT, free_names, id_and_text, once_per_worker, ship_package, with_row_keys, without_rows
from clearbook.sources.sinks import staged

UNDETERMINED = "und"
WORD_START = "▁"
LETTERS = regex.compile(r"\p{L}+")
LONGEST = 200  # letters in a row beyond this are scored as several words
# A factor per character keeps sums over words of LONGEST letters within the range of doubles.
LIFT = 2.5
MIX, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1  # of the hash by which pieces are found
Edges = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class Pieces:
    """The public vocabulary as a look-up of lower-case pieces; the last number stands for an unknown letter."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = (
            model.id_to_piece(i)
            for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        )
        kept = sorted({piece.lower() for piece in plain if LETTERS.search(piece) or piece == WORD_START})
        self.number = {piece: i for i, piece in enumerate(kept)}
        self.names = kept
        self.longest = max(map(len, kept), default=1)
        self.unknown = len(kept)
        # Every beginning of a piece by a hash of its letters, with the piece that it is, if any.
        known: dict[int, int] = {}
        for piece in kept:
            value = 0
            for k, letter in enumerate(piece, 1):
                value = (value * MIX + ord(letter) + 1) & MASK
                known.setdefault(value, -1)
                if k == len(piece):
                    known[value] = self.number[piece]
        self._hashes = np.array(sorted(known), dtype=np.uint64)
        self._pieces = np.array([known[x] for x in sorted(known)], dtype=np.int64)

    def edges(self, words: list[str]) -> Edges:
        """Word, start, end and piece of every piece in every word, with an edge for each unknown letter."""
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        lengths = np.array([len(word) for word in words], dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left = lengths[owner] - place
        at, value = np.arange(len(letters)), np.zeros(len(letters), dtype=np.uint64)
        found = []
        for size in range(1, self.longest + 1):
            value = value * np.uint64(MIX) + letters[at + size - 1]
            near = np.minimum(np.searchsorted(self._hashes, value), len(self._hashes) - 1)
            begins = self._hashes[near] == value
            piece = np.where(begins, self._pieces[near], -1)
            if size == 1:
                piece[piece < 0] = self.unknown
            is_piece = piece >= 0
            found.append((owner[at[is_piece]], place[at[is_piece]], place[at[is_piece]] + size, piece[is_piece]))
            goes_on = begins & (left[at] > size)
            at, value = at[goes_on], value[goes_on]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))  # type: ignore[return-value]


def _forward(edges: Edges, lengths: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each word, position and language the summed weight of all ways to get there."""
    owner, begin, end, piece = edges
    ways = np.zeros((len(lengths), int(lengths.max(initial=0)) + 1, weights.shape[1]))
    ways[:, 0] = 1.0
    order = np.argsort(end, kind="stable")
    bounds = np.searchsorted(end[order], np.arange(1, ways.shape[1] + 1))
    for at in range(1, ways.shape[1]):
        chosen = order[bounds[at - 1] : bounds[at]]
        if len(chosen):
            chosen = chosen[np.argsort(owner[chosen], kind="stable")]
            w = owner[chosen]
            first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
            ways[w[first], at] = np.add.reduceat(ways[w, begin[chosen]] * weights[chosen], first, axis=0)
    return ways


def _lifted(edges: Edges, logs: np.ndarray) -> np.ndarray:
    return np.exp(logs[edges[3]] + LIFT * (edges[2] - edges[1])[:, None])


def word_scores(words: list[str], pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """Log probability of each word (with its start mark) in each language."""
    if not words:
        return np.zeros((0, logs.shape[1]))
    lengths = np.array([len(word) for word in words])
    edges = pieces.edges(words)
    ways = _forward(edges, lengths, _lifted(edges, logs))
    return np.log(ways[np.arange(len(words)), lengths] + 1e-300) - LIFT * lengths[:, None]


def expected_counts(words: list[str], times: np.ndarray, pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """How often each piece is used in all segmentations of the words; ``logs`` has one column."""
    lengths = np.array([len(word) for word in words])
    edges = pieces.edges(words)
    weights = _lifted(edges, logs)
    ahead = _forward(edges, lengths, weights)
    owner, begin, end, piece = edges
    turned = (owner, lengths[owner] - end, lengths[owner] - begin, piece)
    behind = _forward(turned, lengths, weights)
    total = ahead[np.arange(len(words)), lengths, 0]
    used = ahead[owner, begin, 0] * weights[:, 0] * behind[owner, lengths[owner] - end, 0]
    return np.bincount(piece, used / total[owner] * times[owner], minlength=pieces.unknown + 1)


def words_of(chunk: str) -> list[str]:
    runs = (run.lower() for run in LETTERS.findall(chunk))
    return [WORD_START + run[at : at + LONGEST] for run in runs for at in range(0, len(run), LONGEST)]


def held_out(id_col: str) -> Column:
    """Whether a document is left out of training: a quarter, by a hash of its id."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


class LanguageModel:
    """Learned languages and, for each, the log probability of each piece."""

    def __init__(self, vocabulary_path: str, languages: list[str], logs: np.ndarray) -> None:
        self.vocabulary_path, self.languages, self.logs = vocabulary_path, languages, logs


def train(
    docs: DataFrame,
    vocabulary_path: str,
    lang_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    per_language: int = 1000,
    rounds: int = 2,
) -> LanguageModel:
    """Learn from texts whose language is known.

    The sample is bounded: for each language the ``per_language`` documents with
    the smallest hash of their id, and whole texts of these. Rows without text or
    language take no part. To the driver come at most as many numbers as the
    vocabulary has pieces, for each language.
    """
    spark = docs.sparkSession
    ship_package(spark)
    labelled = docs.select(
        F.col(id_col).cast("long").alias(DOC_ID), F.col(text_col).alias(TEXT), F.col(lang_col).alias("_lang")
    ).where(F.col("_lang").isNotNull() & F.col(TEXT).isNotNull())
    place = F.row_number().over(W.partitionBy("_lang").orderBy(F.xxhash64(DOC_ID), DOC_ID))
    # At most per_language rows for each language: bounded, so it can be sent to all executors.
    chosen = labelled.select(DOC_ID, "_lang").withColumn("_place", place).where(F.col("_place") <= per_language)
    chosen = F.broadcast(chosen.select(DOC_ID, "_lang").distinct())
    sample = labelled.join(chosen, [DOC_ID, "_lang"]).select("_lang", TEXT)

    pieces = Pieces(vocabulary_path)
    start = np.full((pieces.unknown + 1, 1), -np.log(len(pieces.names) + 1.0))
    model: dict[str, np.ndarray] = {}
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((start, dict(model)))

        def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, logs = sent.value
            own = once_per_worker(("pieces", vocabulary_path), lambda: Pieces(vocabulary_path))
            seen: dict[str, Counter] = {}
            sums: dict[str, np.ndarray] = {}

            def add(language: str) -> None:
                times = Counter()
                for chunk, n in seen.pop(language).items():
                    for word in words_of(chunk):
                        times[word] += n
                known = logs.get(language, start)
                items = list(times.items())
                for at in range(0, len(items), 4000):
                    some = items[at : at + 4000]
                    n_times = np.array([n for _, n in some], dtype=float)
                    got = expected_counts([word for word, _ in some], n_times, own, known)
                    sums[language] = sums.get(language, 0) + got

            for batch in batches:
                for language, text in zip(batch["_lang"].to_pylist(), batch[TEXT], strict=True):
                    counter = seen.setdefault(language, Counter())
                    counter.update(text.as_py().split())
                    if len(counter) > 200_000:
                        add(language)
            for language in list(seen):
                add(language)
            for language, found in sums.items():
                used = np.flatnonzero(found > 0)
                columns = [pa.array([language] * len(used)), pa.array(used, pa.int64()), pa.array(found[used])]
                yield pa.record_batch(columns, ["lang", "piece", "n"])

        counts = sample.mapInArrow(count, "lang string, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        found = counts.toPandas()
        table = {lang: np.zeros(pieces.unknown + 1) for lang in sorted(found["lang"].unique())}
        for lang, rows in found.groupby("lang"):
            table[lang][rows["piece"].to_numpy()] = rows["n"].to_numpy()
        # Pieces a language lacks get a share of what all languages use, and a little for all.
        pooled = sum(table.values()) if table else np.ones(pieces.unknown + 1)
        back = 0.5 * pooled / max(pooled.sum(), 1.0) + 0.5 / len(pooled)
        model = {lang: np.log((n + 100.0 * back) / (n.sum() + 100.0))[:, None] for lang, n in table.items()}
    languages = sorted(model)
    logs = np.concatenate([model[x] for x in languages], axis=1) if languages else np.zeros((pieces.unknown + 1, 0))
    logs[pieces.unknown] = logs[pieces.unknown].min() if languages else 0.0
    return LanguageModel(vocabulary_path, languages, logs)


class _Scorer:
    """Scores texts; chunks between white space that were met of late are looked up."""

    def __init__(self, pieces: Pieces, logs: np.ndarray, most_kept: int = 400_000) -> None:
        self._pieces, self._logs, self._most = pieces, logs, most_kept
        self._clear()

    def _clear(self) -> None:
        self._row: dict[str, int] = {}
        self._table = np.zeros((1024, self._logs.shape[1] + 1))

    def _learn(self, chunks: list[str]) -> None:
        for at in range(0, len(chunks), 4000):
            some = chunks[at : at + 4000]
            cut = [words_of(chunk) for chunk in some]
            scores = word_scores([word for words in cut for word in words], self._pieces, self._logs)
            owner = np.repeat(np.arange(len(some)), [len(words) for words in cut])
            size = len(self._row)
            while len(self._table) < size + len(some):
                self._table = np.concatenate([self._table, np.zeros_like(self._table)])
            rows = self._table[size : size + len(some)]
            rows[:] = 0.0
            np.add.at(rows[:, :-1], owner, scores)
            np.add.at(rows[:, -1], owner, 1.0)
            for k, chunk in enumerate(some):
                self._row[chunk] = size + k

    def score(self, texts: list[str], group: int = 128) -> Iterator[np.ndarray]:
        """Log probability in each language, and the number of words, of each text."""
        for at in range(0, len(texts), group):
            cut = [text.split() for text in texts[at : at + group]]
            if len(self._row) > self._most:
                self._clear()
            self._learn(list({chunk for chunks in cut for chunk in chunks if chunk not in self._row}))
            for chunks in cut:
                rows = np.fromiter(map(self._row.__getitem__, chunks), dtype=np.int64, count=len(chunks))
                yield self._table[rows].sum(axis=0)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row, from its text alone.

    The score is the probability of the language given the whole text, all
    languages being equally likely before. A null text, one without letters, and
    any text if no language was learned, is ``und`` with score 0; ties go to the
    first language in alphabetical order. A row in, a row out; no shuffle.
    """
    texts = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col(DOC_ID))
    return _told(texts, ["doc_id"], model)


def _told(texts: DataFrame, carried: list[str], model: LanguageModel) -> DataFrame:
    """The columns ``carried`` of each text, its language and the score."""
    sent = texts.sparkSession.sparkContext.broadcast(model.logs)
    schema = StructType([*texts.select(*carried).schema.fields, *StructType.fromDDL("lang_pred string, score double").fields])
    languages, path, key = model.languages, model.vocabulary_path, uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = once_per_worker(("scorer", key), lambda: _Scorer(Pieces(path), sent.value))
        for batch in batches:
            texts = [text.as_py() or "" for text in batch[TEXT]]
            names, scores = [], []
            for found in scorer.score(texts):
                if not languages or found[-1] == 0:
                    names.append(UNDETERMINED), scores.append(0.0)
                    continue
                logs = found[:-1]
                best = int(logs.argmax())
                names.append(languages[best]), scores.append(float(1.0 / np.exp(logs - logs[best]).sum()))
            told = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch([*(batch[name] for name in carried), *told], [*carried, "lang_pred", "score"])

    return texts.mapInArrow(run, schema)


def without_rejected(
    docs: DataFrame, model: LanguageModel, least_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows, with all columns, of a language told with at least ``least_score``.

    Null and empty texts, and those without letters, go. Each row is judged by its own text, whatever its id.
    """
    names = free_names(docs, "_bad_id", "_bad_hash", "_bad_hash2")
    told = _told(with_row_keys(docs, id_col, text_col, names), names, model)
    bad = told.where((F.col("lang_pred") == UNDETERMINED) | (F.col("score") < least_score))
    return without_rows(docs, staged(bad.select(*names), "rejected"), id_col, text_col, names)
