"""Stages that leave rows out judge each row by itself: null and shared ids, clashing columns, empty tables."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clearbook.llm import byte_bpe, decontaminate, language_id, repeats, simhash
from clearbook.llm.queries import BYTE_RANKS, PIECES
from clearbook.llm.tables import free_names

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["_hit", "_hit_id", "_hit_hash", "_bad", "_bad_id", "_id", "_text_hash", "_key_id", "_key_same", "_doc_id", "_text", "doc_id_", "_n", "fingerprint"]
ITEM = "the quick brown fox jumps over the lazy dog while twelve wizards watch from the hill"


def table(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    return docs.withColumns({name: F.lit(k) for k, name in enumerate(CLASHING)})


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_rows_without_items(spark):
    hit, clean = f"some words {ITEM} more words", "nothing of that kind stands in this text at all"
    rows = [(None, hit), (None, clean), (7, hit), (7, clean), (7, clean), (8, None), (9, ""), (1, clean)]
    items = spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string")
    left = decontaminate.without_items(table(spark, rows), items)
    assert left.columns[-len(CLASHING) :] == CLASHING
    assert kept(left) == sorted(((i, t) for i, t in rows if t != hit), key=str)
    assert decontaminate.without_items(table(spark, rows).where("doc_id > 99"), items).count() == 0
    assert decontaminate.without_items(table(spark, rows), items.where("item_id > 99")).count() == len(rows)


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return language_id.train(docs.where(~language_id.held_out("doc_id")), PIECES)


def test_rows_of_a_language(spark, sf_dir, model):
    good = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang = 'en' AND n_chars > 500").limit(3).collect()]
    rows = [(None, "12 34"), (None, good[0]), (5, None), (5, good[1]), (5, ""), (5, good[1]), (6, good[2])]
    left = language_id.without_rejected(table(spark, rows), model)
    assert kept(left) == sorted(((i, t) for i, t in rows if t in good), key=str)
    assert language_id.without_rejected(table(spark, rows).where("doc_id > 99"), model).count() == 0


def test_one_row_of_each_component(spark):
    text, other = " ".join(f"w{k}" for k in range(300)), " ".join(f"v{k}" for k in range(300))
    rows = [(None, text), (None, text), (4, text), (4, text), (4, other), (3, other), (9, None)]
    single = simhash.one_of_each(table(spark, rows))
    assert kept(single) == sorted([(4, text), (3, other), (9, None)], key=str)


def test_all_stages_with_gaps(spark, sf_dir):
    """Null and shared ids, null and empty texts, further columns: rows go for their text alone, and nothing crashes."""
    some = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect()]
    rows = [*some, *some[:5], (None, some[6][1]), (None, None), (some[7][0], some[8][1]), (some[7][0], None), (1 << 40, "")]
    for docs in (table(spark, rows), table(spark, rows).where("doc_id IS NULL AND doc_id IS NOT NULL")):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, sf_dir)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert result.columns == corpus_pipeline.COLUMNS
                texts = {t for _, t in rows}
                assert name == "line dedup" or {r["text"] for r in result.collect()} <= texts
            else:
                assert result.count() == docs.count()


def test_digests_against_the_round_trip(spark, sf_dir):
    """The query's digests are those of the ids and texts that the operator gives."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    docs = docs.unionByName(docs.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string")}))
    rows = byte_bpe.round_trip(docs, BYTE_RANKS, public_tokenizers.PATTERN).collect()
    expected = {(r["doc_id"], r["n_tokens"], hashlib.sha256(r["ids"]).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows}
    assert {tuple(r) for r in byte_bpe.round_trip_digests(docs, BYTE_RANKS, public_tokenizers.PATTERN).collect()} == expected


def test_marks_are_spread():
    """Marks of copies go to many buckets, not to the first of a flush."""
    windows = repeats.Windows(13, 5, lambda text: np.array([hash(w) & 0xFFFF for w in text.split()], dtype=np.uint64), within=False)
    buffer = repeats._Buffer(windows, 128, np.zeros(0, dtype=np.uint64))
    text = " ".join(f"w{k}" for k in range(200))
    for doc in range(2000):
        buffer.add(doc, 0, text)
    places = [b for batch in buffer.flush() for b, kind in zip(batch["_bucket"].to_pylist(), batch["_kind"].to_pylist(), strict=True) if kind == repeats.MARK]
    assert len(places) > 5 and max(places.count(b) for b in places) <= len(places) // 2


def test_names_that_are_free(spark):
    df = spark.createDataFrame([(1, 2)], "_A int, _a_ int")
    assert free_names(df, "_a", "b") == ["_a__", "b"]
