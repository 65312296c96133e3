"""The operators against plain versions, on small tables with nulls, empty texts, ties and repeated rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clearbook.llm import (
    byte_bpe,
    decontaminate,
    language_id,
    line_dedup,
    nn_descent,
    repeats,
    secrets,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_store,
)
from clearbook.llm.components import connected
from clearbook.llm.queries import BYTE_RANKS, PIECES, QUERIES, WORD_TOKENIZER
from clearbook.session import run_folder
from tests.llm import brute

SCHEMA = "doc_id long, text string"
# Columns that clash with names used inside and in the results.
CLASHING = {"ids": 1, "fingerprint": "x", "_text": "y", "_doc": 2, "lines": 0}


def clashing():
    return {name: F.lit(value) for name, value in CLASHING.items()}


def passages(seed, documents=150):
    """Documents made of shared, cut and edited passages, with a passage that a third of them hold."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(50)]
    shared = [[rng.choice(words) for _ in range(rng.randint(5, 90))] for _ in range(25)]
    hot = [rng.choice(words) for _ in range(40)]
    rows = []
    for k in range(documents):
        text = []
        for _ in range(rng.randint(0, 4)):
            part = list(rng.choice(shared))
            low = rng.randint(0, len(part))
            part = part[low : rng.randint(low, len(part))] if rng.random() < 0.6 else part
            if part and rng.random() < 0.3:
                part[rng.randrange(len(part))] = f"edit{k}"
            text += part
        if k % 3 == 0:
            text = [rng.choice(words) for _ in range(20)] + hot + text
        rows.append((k * 7 % documents, " ".join(text)))
    return rows + [(1000, None), (1001, ""), (1002, "word"), (1003, rows[5][1]), (1004, "é" * 400)] + [(2000 + k, "z" * 9 * k) for k in range(25)]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(passages(1), SCHEMA).withColumns(clashing())


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("hot", [False, True])
def test_repeated_bytes(spark, texts, hot, monkeypatch):
    if hot:
        found = repeats._hot_anchors
        monkeypatch.setattr(repeats, "_hot_anchors", lambda table, windows, **_: found(table, windows, one_in=1, share=10**9, least=3))
    expected = {}
    for doc_id, (content, hidden) in brute.repeated_stretches(passages(1), 100, str.encode, True).items():
        rest = bytes(x for k, x in enumerate(content) if k not in hidden)
        expected[doc_id] = (rest, len(content), len(hidden), brute.spans(hidden))
    rows = suffix_dedup.without_repeated_bytes(texts).collect()
    assert {r.doc_id: (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in rows} == expected
    assert suffix_dedup.without_repeated_bytes(empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_repeated_words(spark, texts, hot, monkeypatch):
    if hot:
        found = repeats._hot_anchors
        monkeypatch.setattr(repeats, "_hot_anchors", lambda table, windows, **_: found(table, windows, one_in=1, share=10**9, least=3))
    expected = {}
    for doc_id, (words, hidden) in brute.repeated_stretches(passages(1), 13, lambda t: tuple(t.encode().split()), False).items():
        rest = b" ".join(x for k, x in enumerate(words) if k not in hidden).decode()
        expected[doc_id] = (rest, len(words), len(hidden))
    rows = substring_dedup.without_repeated_words(texts).collect()
    assert {r.doc_id: (r.kept, r.n_words, r.n_removed) for r in rows} == expected
    assert substring_dedup.without_repeated_words(empty(spark)).count() == 0


def test_rows_that_share_an_id(spark):
    text = " ".join(f"v{k}" for k in range(60))
    rows = [(1, text), (1, text), (1, "x " + text), (None, text + " tail"), (None, None)]
    found = substring_dedup.without_repeated_words(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in found) == [(0, 0, 0), (0, 61, 0), (1, 60, 60), (1, 60, 60), (1, 61, 60)]
    assert suffix_dedup.without_repeated_bytes(spark.createDataFrame(rows, SCHEMA)).count() == 5


def test_induced_order():
    rng = random.Random(3)
    for _ in range(150):
        text = bytes(rng.choice(b"aab") for _ in range(rng.randint(0, 50)))
        letters = np.append(np.frombuffer(text, np.uint8).astype(np.int64) + 1, 0)
        order = suffix_dedup.induced_order(letters, suffix_dedup.packed_words(letters, 200), 200)
        plain = bytes(letters.astype(np.uint8))
        assert order.tolist() == sorted(range(len(letters)), key=lambda k: plain[k:])


def test_queues_in_a_file():
    queues, small = suffix_dedup.LetterQueues(5, in_memory=3), suffix_dedup.LetterQueues(5)
    rng = np.random.default_rng(1)
    for _ in range(20):
        letters, values = rng.integers(0, 5, 7), rng.integers(0, 1000, 7)
        queues.put(letters, values)
        small.put(letters, values)
    for letter in range(5):
        assert queues.take(letter).tolist() == small.take(letter).tolist()


def test_automaton_statistics():
    rng = random.Random(4)
    automaton, seen = substring_dedup.SuffixAutomaton(), []
    for _ in range(30):
        words = [bytes([rng.choice(b"abc")]) for _ in range(rng.randint(0, 12))]
        for end, size in enumerate(automaton.matching_statistics(words), 1):
            runs = {tuple(s[a:b]) for s in seen for a in range(len(s)) for b in range(a, len(s) + 1)} | {()}
            assert size == max(k for k in range(end + 1) if tuple(words[end - k : end]) in runs)
        automaton.add(words)
        seen.append(words)


def test_simhash(spark):
    rng = random.Random(5)
    words = [f"t{k}" for k in range(400)]
    base = [[rng.choice(words) for _ in range(120)] for _ in range(12)]
    rows = [(0, None), (1, ""), (2, "One"), (3, "one"), (4, " \t\n"), (5, "É a b")]
    for k in range(10, 120):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((k, " ".join(text)))
    prints = [(doc_id, brute.fingerprint(text or "", 4)) for doc_id, text in rows]
    found = simhash.near_copies(spark.createDataFrame(rows, SCHEMA).withColumns(clashing())).collect()
    assert {r.doc_id: r.fingerprint for r in found} == {doc_id: f"{value:016x}" for doc_id, value in prints}
    expected = brute.components(prints, 4)
    assert {r.doc_id: r.component_id for r in found} == expected
    kept = simhash.one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))
    assert simhash.near_copies(empty(spark)).count() == 0


def test_one_row_of_each_component(spark):
    rng = random.Random(15)
    a, b, c, d = (" ".join(rng.choice([f"t{k}" for k in range(400)]) for _ in range(120)) for _ in range(4))
    # Id 5 stands for a copy of 1 and a clean text; 1 is repeated; of copies with null ids one or none stays.
    rows = [(1, a), (1, a), (5, a), (5, b), (None, a), (None, c), (None, c), (7, d), (8, d), (None, d)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, a), (5, b), (0, c), (7, d)])


def test_close_pairs_are_complete(spark):
    rng = random.Random(6)
    values = {0, (1 << 64) - 1}
    for _ in range(60):
        value = rng.getrandbits(64)
        values |= {value} | {value ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(3)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    pairs = simhash.close_pairs(spark.createDataFrame(signed, "fingerprint long")).collect()
    expected = {tuple(sorted((a, b))) for (a,) in signed for (b,) in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    assert sorted((r.a, r.b) for r in pairs) == sorted(expected)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    roots = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == {k: 100 for k in range(100, 161)} | {k: 500 for k in range(500, 560)}


def test_line_runs(spark):
    rows = [(1, "a\nb\nc"), (2, "a\nb\nd"), (3, "x\nb\nc"), (4, "a\nb\nc"), (5, "a"), (6, ""), (7, None), (8, "q\nq\nq\nq"), (4, "a\nb\nc"), (None, "n\nm")]
    found = line_dedup.without_repeated_runs(spark.createDataFrame(rows, SCHEMA).withColumns(clashing()), keep=("ids",)).collect()
    assert sorted((r.doc_id or 0, r.text, r.n_lines, r.n_removed, r.n_runs) for r in found if r.text is not None) == [
        (0, "n\nm", 2, 0, 0), (1, "a\nb\nc", 3, 0, 0), (2, "d", 3, 2, 1), (3, "x", 3, 2, 1), (4, "", 3, 3, 1), (4, "", 3, 3, 1),
        (5, "a", 1, 0, 0), (6, "", 1, 0, 0), (8, "q", 4, 3, 1),
    ]
    assert {r.ids for r in found} == {1}
    assert line_dedup.without_repeated_runs(empty(spark)).count() == 0


def test_long_lone_lines(spark):
    long, short = " ".join(f"w{k}" for k in range(60)), " ".join(f"w{k}" for k in range(49))
    rows = [(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd"), (3, long), (4, f"{short}\ne"), (5, f"{short}\nf"), (6, f"a\n{long}\nz"), (7, f"x\n{long}\n{long}")]
    found = line_dedup.without_repeated_runs(spark.createDataFrame(rows, SCHEMA), lone_words=50).collect()
    assert sorted((r.doc_id, r.text, r.n_removed, r.n_runs) for r in found) == [
        (1, rows[0][1], 0, 0), (2, "c\nd", 1, 1), (3, "", 1, 1), (4, rows[3][1], 0, 0), (5, rows[4][1], 0, 0), (6, "z", 2, 1), (7, "x", 2, 1),
    ]


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_line_runs_of_other_lengths(spark, least):
    rng = random.Random(least)
    rows = [(k, "\n".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))) for k in range(40)]
    expected = {
        doc_id: len(hidden) for doc_id, (_, hidden) in brute.repeated_stretches(rows, least, lambda t: tuple(t.split("\n")), True).items()
    }
    found = line_dedup.without_repeated_runs(spark.createDataFrame(rows, SCHEMA), min_lines=least).collect()
    assert {r.doc_id: r.n_removed for r in found} == expected


def test_byte_bpe_equals_the_library(spark):
    ranks = byte_bpe.read_ranks(BYTE_RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(7)
    letters = "aaabbthe hello 123 ÉñÖ日本語\n\t!!??    x'll\U0001f600"
    rows = [(k, "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))) for k in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "ab" * 30_000), (1003, "<|endoftext|>"), (1003, "<|endoftext|>"), (None, "  x ")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(clashing())
    encoded = byte_bpe.encode_documents(docs, BYTE_RANKS, public_tokenizers.PATTERN)
    found = {(r.doc_id, r.text): np.frombuffer(r.ids, "<u4").tolist() for r in byte_bpe.decode_documents(encoded, BYTE_RANKS).collect()}
    assert found == {(doc_id, text or ""): library.encode_ordinary(text or "") for doc_id, text in rows}
    assert byte_bpe.encode_documents(empty(spark), BYTE_RANKS, public_tokenizers.PATTERN).count() == 0


def test_transducer_without_stored_steps():
    ranks = byte_bpe.read_ranks(BYTE_RANKS)
    stored, free = byte_bpe.MergeTransducer(ranks), byte_bpe.MergeTransducer(ranks, most_steps=0)
    for word in ("antidisestablishmentarianism", "thththereing", "ññandú", "zzzzzzzzzz"):
        assert stored.encode(word.encode()) == free.encode(word.encode())


@pytest.mark.parametrize("most_steps", [0, 3, 40, 400])
def test_transducer_goes_on_after_any_step(most_steps):
    ranks = byte_bpe.read_ranks(BYTE_RANKS)
    library = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    transducer, rng = byte_bpe.MergeTransducer(ranks, most_steps=most_steps), random.Random(3)
    parts = [" the", "ing", "er", "tion", "aaaa", "zq", "ó", "ß", "日本", "xx", "th"]
    for _ in range(400):
        word = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        assert np.frombuffer(transducer.encode(word.encode()), "<u4").tolist() == library.encode_ordinary(word), word


def test_words_before_signs_and_lines_need_no_pattern(monkeypatch):
    ranks = byte_bpe.read_ranks(BYTE_RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, rng = byte_bpe.TextEncoder(ranks, public_tokenizers.PATTERN, most_kept=40), random.Random(11)
    letters = "aabéÉßñİı'.,!#_-1²日\u0301\u00a0\t\n\n \u2028ªǅ"
    odd = ["a.\nb", "a\n\nb", "a \nb", "a\n b", "a.\n", "x 's\nt", "it's\n'll", "a.'s\n.b", "x a\u00a0\nb", "\nA b\n", "dʰ. ʰ\nʰ", "a b\r\nc"]
    for text in odd + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text), text
    plain = [" Wörter.", " Wörter,###", " noch.\nEiner", " ñandúes"]
    expected = [library.encode_ordinary(text) for text in plain]
    encoder = byte_bpe.TextEncoder(ranks, public_tokenizers.PATTERN)
    monkeypatch.setattr(encoder, "_matches", lambda text: b"" if not text else pytest.fail(f"{text!r} went through the pattern"))
    assert [np.frombuffer(encoder.encode(text), "<u4").tolist() for text in plain] == expected


def test_last_tokens_are_looked_for_where_asked(monkeypatch):
    ranks = byte_bpe.read_ranks(BYTE_RANKS)
    transducer, asked = byte_bpe.MergeTransducer(ranks, most_steps=0), []
    monkeypatch.setattr(transducer, "_boundary_stays", lambda left, right: not asked.append((left, right)))
    word = "internationalization"
    transducer.encode(f" {word}".encode())
    assert len(asked) < len(word) // 2


def test_utf8_stream_cut_anywhere():
    data = "aé日😀".encode() + b"\xff\xe6"
    for cut in range(len(data)):
        stream = byte_bpe.Utf8Stream()
        assert stream.feed(data[:cut]) + stream.feed(data[cut:]) + stream.finish() == data.decode("utf-8", "replace")


def test_token_store(spark):
    library = Tokenizer.from_file(WORD_TOKENIZER)
    rng = random.Random(8)
    words = ["Hello,", "world's", "É́a", "日本", "don't", "x y", "42", "Σίσυφος", "thth" * 20]
    rows = [(k * 5 % 301, " ".join(rng.choice(words) for _ in range(rng.randint(0, 300)))) for k in range(301)] + [(400, None), (401, "")]
    path = run_folder(spark, "test-store")
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(clashing()).repartition(5)
    token_store.write_store(docs, path, WORD_TOKENIZER, block_ids=5000, least=4)
    found = {r.doc_id: (r.start, r.n_tokens, bytes(r.ids)) for r in token_store.read_store(spark, path).collect()}
    start, expected = 0, {}
    for doc_id, text in sorted(rows):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        expected[doc_id] = (start, len(ids), ids.tobytes())
        start += len(ids)
    assert found == expected
    token_store.write_store(empty(spark), path + "-none", WORD_TOKENIZER)
    assert token_store.read_store(spark, path + "-none").count() == 0


@pytest.mark.parametrize("most_kept", [2, 400_000])
def test_chunks_equal_the_library(most_kept):
    library, rng = Tokenizer.from_file(WORD_TOKENIZER), random.Random(5)
    encoder = token_store.ChunkEncoder(WORD_TOKENIZER, most_kept)
    odd = ["DOGS', x", "a's b'S cat'd. '", "ABC<|endoftext|> <|endoftext|>!!", "endoftext|> x--y--", "ﬁ İI ıi Ǆ ǅ ǆ ŉ ª º ĸ", "\x00a a\x1fb"]
    odd += ["e\u0301a éa, éa\u0301 É", "a\u00a0b \u2028 c\u00ad", "¼a a² ½", "über### ÜBER### straße% ẞ", "", "  ", "a" * 3000 + "!"]
    letters = "aAbéÉßñİı'.,!#-1²日\u0301 \n"
    for text in odd + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2000)]:
        ids = [*library.encode(text, add_special_tokens=False).ids, token_store.END_ID]
        assert encoder.encode(text.encode()).tolist() == ids, text


def test_plain_words_go_to_the_model_as_they_are(monkeypatch):
    library, encoder = Tokenizer.from_file(WORD_TOKENIZER), token_store.ChunkEncoder(WORD_TOKENIZER)
    text = "unthinkably plain, Words"
    expected = [*library.encode(text, add_special_tokens=False).ids, token_store.END_ID]
    monkeypatch.setattr(token_store, "SHOWN", None)
    assert encoder.encode(text.encode()).tolist() == expected


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(2)
    ids = rng.choice([5, 6, 7, 300, token_store.END_ID], 6000, p=[0.4, 0.3, 0.1, 0.1, 0.1]).astype("<u4")
    for base in (500, 70_000):
        payload = token_store.pack_block(ids, [None, 9], [2500, 3500], base, 4)
        block = token_store.Block(payload)
        assert len(block.rules) and len(payload) < ids.nbytes
        assert [(d, x.tolist()) for d, x in block.documents()] == [(None, ids[:2500].tolist()), (9, ids[2500:].tolist())]
        for low, high in ((0, 1), (17, 18), (1234, 4321), (5999, 6000), (3, 3)):
            assert block.read(low, high).tolist() == ids[low:high].tolist()


def test_language_scores_sum_over_all_segmentations():
    pieces = language_id.Pieces(PIECES)
    rng = np.random.default_rng(3)
    chances = rng.random((pieces.unknown + 1, 2)) / 100
    words = [language_id.WORD_START + w for w in ("the", "schöne", "日本", "a", "internationalisation")]
    scores = language_id.word_scores(words, pieces, np.log(chances))
    for k, word in enumerate(words):
        for lang in range(2):
            table = {piece: chances[number, lang] for piece, number in pieces.number.items()}
            assert math.isclose(scores[k, lang], math.log(brute.segmentations(word, table, chances[pieces.unknown, lang])), rel_tol=1e-9)


def test_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.train(docs.where(~language_id.held_out("doc_id")), PIECES, per_language=50)
    told = language_id.predict(docs, model).join(docs, "doc_id").where(language_id.held_out("doc_id"))
    right, total = told.where("lang = lang_pred").count(), told.count()
    assert total > 20 and right >= 0.95 * total
    assert told.where("score < 0 or score > 1").count() == 0
    odd = [(1, None), (2, ""), (3, "12 -- !"), (4, "a" * 100_000), (None, docs.first().text), (1, None)]
    table = spark.createDataFrame(odd, SCHEMA).withColumns(clashing())
    found = language_id.predict(table, model).collect()
    assert sorted((r.doc_id or 0, r.lang_pred == "und") for r in found) == [(0, False), (1, True), (1, True), (2, True), (3, True), (4, False)]
    assert sorted((r.doc_id or 0) for r in language_id.without_rejected(table, model).collect()) in ([0, 4], [0])
    nothing = language_id.train(docs.limit(0), PIECES)
    assert [(r.lang_pred, r.score) for r in language_id.predict(docs.limit(1), nothing).collect()] == [("und", 0.0)]


def test_distance_by_bit_vectors():
    rng = random.Random(9)
    for _ in range(400):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
        most, least = rng.randint(0, 12), brute.nearest_distance(item, text)
        found = decontaminate.nearest_substring(item, text, most)
        assert (found[0] if found else None) == (least if least <= most else None)


def test_benchmark_items(spark):
    rng = random.Random(10)
    letters = "abcdefgh "
    items = [(k, "".join(rng.choice(letters) for _ in range(rng.randint(60, 200)))) for k in range(12)] + [(50, None), (51, "short"), (None, "q" * 60)]
    docs = []
    for k in range(80):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 300)))
        if k % 2:
            item = list(rng.choice(items[:12])[1].upper())
            for _ in range(rng.randint(0, len(item) // 10)):
                item[rng.randrange(len(item))] = rng.choice(letters)
            text += " " + "".join(item).replace(" ", " \n ") + " " + text
        docs.append((k, text))
    docs += [(100, None), (101, ""), (102, "x " + "q" * 60), (102, "x " + "q" * 60)]
    expected = []
    for doc_id, text in docs:
        for item_id, item in items:
            item = decontaminate.plain(item or "")
            if len(item) >= 40 and text:
                least = brute.nearest_distance(item, decontaminate.plain(text))
                if least <= int(len(item) * 0.05):
                    expected.append((doc_id, item_id if item_id is not None else -1, least))
    table = spark.createDataFrame(docs, SCHEMA).withColumns(clashing())
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_items(table, benchmark, block_chars=500).collect()
    assert sorted((r.doc_id, r.item_id if r.item_id is not None else -1, r.distance) for r in found) == sorted(expected)
    kept = decontaminate.without_items(table, benchmark).collect()
    assert {r.doc_id for r in kept} == {d for d, _ in docs} - {d for d, *_ in expected}
    assert decontaminate.find_items(table, benchmark.limit(0)).count() == 0


def test_short_benchmark_items(spark):
    items = [(1, "What is a quine?"), (2, "art"), (3, "东京在哪里"), (4, " "), (5, None), (6, "thirty characters of plain text")]
    docs = [(1, "Q: what  is a\nQUINE? A"), (2, "a party"), (3, "the art."), (4, "我问东京在哪里吗"), (5, "what is a quin?"), (6, "thirty characters of plain texts"), (7, "partart art")]
    found = decontaminate.find_items(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 0, 3, 19), (3, 2, 0, 4, 7), (4, 3, 0, 2, 7), (7, 2, 0, 8, 11)]


def test_secret_candidates_and_forest(spark):
    rng = random.Random(11)
    rows = []
    for k in range(200):
        hexes = hashlib.sha1(str(k).encode()).hexdigest()
        number = "".join(rng.choice("0123456789") for _ in range(16))
        rows.append((k, f"some text here token = \"{hexes}\" and then {number} more words, src/tests/data", "src/app.py" if k % 2 else None))
    rows += [(300, None, "a"), (301, "", "a"), (302, "nothing long here 12", "a"), (0, rows[0][1], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(clashing())
    found = secrets.candidates(docs)
    assert found.count() == 402
    words = secrets.dictionary(spark, WORD_TOKENIZER)
    labelled = secrets.labelled_by_rule(found)
    model = secrets.train(labelled.where(F.col("doc_id") % 4 != 2), words)
    scanned = secrets.scan(found, words, model).collect()
    held = [r for r in scanned if r.doc_id % 4 == 2]
    assert len(held) == 100 and all(r.is_secret == (len(r.candidate) == 40) for r in held)
    assert secrets.scan(found, words, None).where("is_secret").count() == 402
    assert secrets.train(labelled.limit(0), words) is None
    assert secrets.candidates(docs.limit(0)).count() == 0


def test_numbers_alone_are_no_secrets(spark, tmp_path):
    rows = [(1, "order 1234567890123456 was sent", "a"), (2, "commit 2234567890123456", "a"), (3, "token abcd1234abcd1234abcd", "a")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op2_secret_scan"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.probability, r.is_secret) for r in found) == [(1, None, False), (2, None, False), (3, None, True)]


def test_neighbours(spark):
    rng = np.random.default_rng(12)
    vectors = {k: rng.normal(size=8).tolist() for k in range(700)}
    for k in range(100, 160):
        vectors[k] = vectors[100]
    odd = [(1000, None), (1100, [0.0] * 8), (1200, [None] + [1.0] * 7), (1300, [float("nan")] + [1.0] * 7), (1400, [float("inf")] * 8)]
    table = spark.createDataFrame([*vectors.items(), *odd, (None, [1.0] * 8)], "vec_id long, embedding array<double>").withColumn("node", F.lit(1))
    found = {}
    for r in nn_descent.nearest_neighbours(table, block=128, cell_bits=2).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(found) == [0, 100, 200, 300, 400, 500, 600]
    hits = 0
    for query, rows in found.items():
        expected = brute.nearest(vectors, query, 10)
        assert [r[0] for r in sorted(rows)] == list(range(1, 11))
        assert all(abs(score - dict((i, s) for s, i in brute.nearest(vectors, query, 700))[vec]) < 1e-12 for _, vec, score in rows)
        hits += len({i for _, i in expected} & {r[1] for r in rows})
    assert hits >= 63
    assert [r[1] for r in sorted(found[100])] == list(range(101, 111))
    few = nn_descent.nearest_neighbours(spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0]), (2, [3.0, 1.0])], "vec_id long, embedding array<double>"))
    assert [(r["rank"], r.vec_id) for r in few.orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert nn_descent.nearest_neighbours(table.limit(0)).count() == 0


def test_descent_goes_on_to_convergence(spark):
    """From two orders in small blocks a single round leaves most neighbours unfound."""
    rng = np.random.default_rng(13)
    rows = rng.normal(size=(3000, 16))
    table = spark.createDataFrame(list(enumerate(rows.tolist())), "vec_id long, embedding array<double>")
    found = nn_descent.nearest_neighbours(table, one_in=30, orders=2, block=16, cell_bits=1, neighbours=12, beam=16).collect()
    hits = 0
    for query in range(0, 3000, 30):
        far = ((rows - rows[query]) ** 2).sum(axis=1)
        far[query] = np.inf
        hits += len(set(np.argsort(far)[:10].tolist()) & {r.vec_id for r in found if r.query_id == query})
    assert len(found) == 1000 and hits >= 970


def test_blocks_are_the_same_for_any_partitions(spark):
    rows = np.random.default_rng(14).normal(size=(1000, 6)).round(1)
    table = spark.createDataFrame(list(enumerate(rows.tolist())), "node long, vector array<double>").selectExpr("node", "cast(vector as array<float>) vector")
    planes = np.random.default_rng(1).normal(size=(3, 6, 3))
    dealt = []
    for parts in (1, 13):
        blocks = nn_descent._blocks(table.repartition(parts), planes, 128).collect()
        dealt.append({(r.order, r.block, r.node) for r in blocks})
        sizes = Counter((r.order, r.block) for r in blocks)
        assert len(blocks) == 3000 and len(sizes) == 24 and set(sizes.values()) == {125}
    assert dealt[0] == dealt[1]


def test_components_beyond_single_precision(spark):
    rng = np.random.default_rng(15)
    vectors = {k: (rng.normal(size=6) * 1e60).tolist() for k in range(400)}
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    found = nn_descent.nearest_neighbours(table, block=64, cell_bits=2).collect()
    hits = sum(r.vec_id in {i for _, i in brute.nearest(vectors, r.query_id, 10)} for r in found)
    assert len(found) == 40 and hits >= 36


def test_query_digests(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    library = Tokenizer.from_file(WORD_TOKENIZER)
    for r in QUERIES["op6_token_ids"](spark, sf_dir).orderBy("doc_id").limit(20).collect():
        ids = np.array([*library.encode(docs[r.doc_id], add_special_tokens=False).ids, 1], dtype="<u4")
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
    for r in QUERIES["op9_byte_bpe"](spark, sf_dir).collect():
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
