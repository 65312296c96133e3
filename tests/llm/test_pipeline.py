"""Each stage of the pipeline against a plain version of what it should keep."""

import hashlib

import corpus_pipeline
from clearbook.llm import language_id
from clearbook.llm.decontaminate import plain
from clearbook.llm.queries import BYTE_RANKS, PIECES
from tests.llm import brute


def rows(df):
    return sorted(tuple(r[c] for c in corpus_pipeline.COLUMNS) for r in df.collect())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    start = rows(docs)
    stages = dict(corpus_pipeline.STAGES)

    told = stages["language ID"](spark, docs, sf_dir)
    assert told.columns == corpus_pipeline.COLUMNS
    model = language_id.train(docs.where(~language_id.held_out("doc_id")), PIECES)
    good = {r.doc_id for r in language_id.predict(docs, model).collect() if r.lang_pred != "und" and r.score >= 0.5}
    assert rows(told) == [r for r in start if r[0] in good] and len(good) > 0.99 * len(start)

    cleaned = stages["line dedup"](spark, docs, sf_dir)
    gone = brute.repeated_stretches([r[:2] for r in start], 2, lambda t: tuple(t.split("\n")), True)
    expected = []
    for doc_id, _, lang, source, _ in start:
        lines, hidden = gone[doc_id]
        text = "\n".join(line for k, line in enumerate(lines) if k not in hidden)
        if len(hidden) < len(lines):
            expected.append((doc_id, text, lang, source, len(text)))
    assert rows(cleaned) == expected

    single = stages["SimHash near-dedup"](spark, docs, sf_dir)
    roots = brute.components([(r[0], brute.fingerprint(r[1], 4)) for r in start], 4)
    assert rows(single) == [r for r in start if roots[r[0]] == r[0]]

    clean = stages["benchmark decontamination"](spark, docs, sf_dir)
    items = [plain(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {r[0] for r in rows(clean)}
    assert all(not any(item in plain(text) for item in items) for doc_id, text, *_ in start if doc_id in kept)
    assert 0.9 * len(start) < len(kept) < len(start)


def test_run(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in found} <= set(texts) and len(found) > 0.5 * len(texts)
    whole = sum(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in found)
    assert whole > 0.7 * len(found)  # the others lost repeated lines
    assert BYTE_RANKS
