"""The registered queries of this subpackage, with production parameters, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.llm import (
    byte_bpe,
    decontaminate,
    hard_negatives,
    language_id,
    line_dedup,
    nn_descent,
    secrets,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_store,
    vector_codes,
    warc,
)
from clearbook.llm.tables import read_table
from clearbook.session import run_folder
from clearbook.sources.sinks import staged

Query = Callable[[SparkSession, str], DataFrame]

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(read_table(spark, sf_dir, "documents"), shingle_words=4, most_bits=4)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = staged(secrets.candidates(read_table(spark, sf_dir, "documents")), "candidates")
    words = secrets.dictionary(spark, WORD_TOKENIZER)
    model = secrets.train(secrets.labelled_by_rule(found), words)
    scanned = secrets.scan_by_rule(found) if model is None else secrets.scan(found, words, model)
    digest = F.sha2(F.col("candidate").cast("binary"), 256).alias("candidate_sha256")
    return scanned.select("doc_id", "word_at", "match_at", F.length("candidate").alias("length"), digest, "probability", "is_secret")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.without_repeated_runs(read_table(spark, sf_dir, "documents"), min_lines=2)
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return cleaned.select("doc_id", "n_lines", "n_removed", "n_runs", digest)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.without_repeated_bytes(read_table(spark, sf_dir, "documents"), length=100)
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~language_id.held_out("doc_id")), PIECES)
    told = language_id.predict(docs, model)
    return told.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "token-ids")
    token_store.write_store(read_table(spark, sf_dir, "documents"), path, WORD_TOKENIZER)
    return token_store.read_store(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), wanted=10, one_in=100)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.without_repeated_words(read_table(spark, sf_dir, "documents"), length=13)
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return cleaned.select("doc_id", "n_words", "n_removed", digest)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(read_table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.find_items(docs, items).select("doc_id", "item_id", "distance", "start", "stop")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    digest = F.lit(books.sha256()).alias("codebooks_sha256")
    return coded.select("vec_id", "code", "error", "label_error", digest)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "archives")
    warc.write_archives(read_table(spark, sf_dir, "pages"), path, least_bytes=0)
    records = staged(warc.read_archives(spark, path, payloads=False), "records")
    return warc.outermost(records).select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_secret_scan,
        op3_line_dedup,
        op4_suffix_dedup,
        op5_language_id,
        op6_token_ids,
        op7_nearest_neighbours,
        op8_substring_dedup,
        op9_byte_bpe,
        op10_decontaminate,
        op11_hard_negatives,
        op12_vector_codes,
        op13_warc,
    )
}

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _negatives_sql() -> str:
    return f"""
        WITH kept AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_FINITE}
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
                CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
            FROM kept a JOIN kept b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ),
        ranked AS (
            SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
                row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
            FROM positives JOIN scored USING (anchor_id)
            WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        )
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM ranked WHERE rank <= 10
    """


def _codes_sql() -> str:
    """Every round of the codebooks as three steps: entries, nearest entry of each part, floored means."""

    def nearest(k: int) -> str:
        return f"""
            SELECT vec_id, label, part, v, min(d) AS d, arg_min(entry, (d, entry)) AS entry FROM (
                SELECT p.*, b.entry, CAST(list_inner_product(list_transform(list_zip(p.v, b.v), lambda z: z[1] - z[2]),
                    list_transform(list_zip(p.v, b.v), lambda z: z[1] - z[2])) AS BIGINT) AS d
                FROM cut p JOIN book{k} b ON p.part = b.part
            ) GROUP BY vec_id, label, part, v
        """

    def moved(k: int) -> str:
        return f"""
            SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN (
                SELECT part, entry, list(floor(total / n) ORDER BY place) AS v FROM (
                    SELECT part, entry, place, sum(x) AS total, count(*) AS n FROM (
                        SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS place FROM near{k}
                    ) GROUP BY part, entry, place
                ) GROUP BY part, entry
            ) m ON m.part = b.part AND m.entry = b.entry
        """

    steps = []
    for k in range(4):
        steps += [f"near{k} AS MATERIALIZED ({nearest(k)})", f"book{k + 1} AS MATERIALIZED ({moved(k)})"]
    return f"""
        WITH kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
            FROM embeddings WHERE {_FINITE}
        ),
        cut AS MATERIALIZED (
            SELECT vec_id, label, part, list_slice(v, part * len(v) // 4 + 1, (part + 1) * len(v) // 4) AS v
            FROM kept, (SELECT unnest(range(4)) AS part)
        ),
        book0 AS MATERIALIZED (
            SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v FROM cut
            QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= 256
        ),
        {", ".join(steps)},
        last AS ({nearest(4)}),
        coded AS (
            SELECT vec_id, label, string_agg(lower(printf('%02X', CAST(entry AS INTEGER))), '' ORDER BY part) AS code,
                CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY vec_id, label
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY part, entry))
             FROM book4) AS codebooks_sha256
        FROM coded
    """


def _warc_sql() -> str:
    group = "CAST(('0x' || substr(hexed, 1 + 5 * k, 5)) AS BIGINT)"
    letters = " || ".join(f"substr('{warc.BASE32}', CAST(({group} >> {bits}) & 31 AS INTEGER) + 1, 1)" for bits in (15, 10, 5, 0))
    return f"""
        WITH page AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hexed FROM pages),
        digest AS (
            SELECT hexed, string_agg({letters}, '' ORDER BY k) AS payload_digest
            FROM (SELECT DISTINCT hexed FROM page), (SELECT unnest(range(8)) AS k) GROUP BY hexed
        ),
        placed AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM page JOIN digest USING (hexed))
        SELECT page_id, strlen(payload) AS payload_bytes, payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to
        FROM placed
    """


ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": """
        WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
        line AS (
            SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM cut
        ),
        pair AS (
            SELECT doc_id, place, line, lead(line) OVER (PARTITION BY doc_id ORDER BY place) AS following FROM line
        ),
        later AS (
            SELECT doc_id, place, row_number() OVER (PARTITION BY line, following ORDER BY doc_id, place) AS copy
            FROM pair WHERE following IS NOT NULL
        ),
        gone AS (
            SELECT DISTINCT doc_id, place + step AS place FROM later, (SELECT unnest([0, 1]) AS step) AS s WHERE copy > 1
        ),
        marked AS (
            SELECT line.doc_id, line.place, line.line, gone.place IS NOT NULL AS out FROM line
            LEFT JOIN gone ON gone.doc_id = line.doc_id AND gone.place = line.place
        ),
        runs AS (
            SELECT *, out AND NOT coalesce(lag(out) OVER (PARTITION BY doc_id ORDER BY place), false) AS begins FROM marked
        )
        SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines,
            CAST(count(*) FILTER (WHERE out) AS INTEGER) AS n_removed,
            CAST(count(*) FILTER (WHERE begins) AS INTEGER) AS n_runs,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT out), '')) AS kept_sha256
        FROM runs GROUP BY doc_id
    """,
    "op11_hard_negatives": _negatives_sql(),
    "op12_vector_codes": _codes_sql(),
    "op13_warc": _warc_sql(),
}
