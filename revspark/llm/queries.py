"""Registered queries of the operators: each applies one operator, with production parameters, to
its whole table. ``ORACLE`` holds the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revspark.llm.alignment import aligned
from revspark.llm.block_naming import exact_duplicates
from revspark.llm.common import small_batches
from revspark.llm.conversations import conversation_audits, damaged
from revspark.llm.decontaminate import contamination
from revspark.llm.ngram_join import near_duplicates
from revspark.llm.packing import pack
from revspark.llm.quality import quality
from revspark.llm.repair import read_blocks, write_blocks
from revspark.llm.substring_dedup import substring_dedup
from revspark.llm.token_counts import token_counts
from revspark.llm.toxicity import toxicity
from revspark.llm.vector_search import top_k
from revspark.llm.warc import archived_pages
from revspark.session import sf_table

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
WORD_BPE_IDS = 49_408


def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(sf_table(spark, sf, "documents"))


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity(sf_table(spark, sf, "documents"), sf_table(spark, sf, "labels"))


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(sf_table(spark, sf, "documents"), BYTE_BPE)


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality(sf_table(spark, sf, "documents"), sf_table(spark, sf, "labels"))


def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(sf_table(spark, sf, "documents"), BYTE_BPE, end_id=0)


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    hits = contamination(sf_table(spark, sf, "documents"), sf_table(spark, sf, "benchmark"))
    return hits.drop("text_key")


def op7_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup(sf_table(spark, sf, "documents")).drop("text_key")


def op8_top_k_search(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(sf_table(spark, sf, "embeddings"), k=10, query_every=100)


def op9_token_blocks(spark: SparkSession, sf: str) -> DataFrame:
    documents = sf_table(spark, sf, "documents")
    return read_blocks(write_blocks(documents, WORD_BPE, end_id=1, terminals=WORD_BPE_IDS))


def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    return archived_pages(sf_table(spark, sf, "pages")).drop("target_uri")


def op11_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_duplicates(sf_table(spark, sf, "documents"))


def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_audits(damaged(sf_table(spark, sf, "conversations")))


def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return aligned(sf_table(spark, sf, "documents"), BYTE_BPE, PIECE_BPE)


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf)

    return run


QUERIES: dict[str, Query] = {name: _prepared(query) for name, query in {
    "op1_ngram_join": op1_ngram_join,
    "op2_toxicity": op2_toxicity,
    "op3_token_counts": op3_token_counts,
    "op4_quality": op4_quality,
    "op5_packing": op5_packing,
    "op6_decontamination": op6_decontamination,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_top_k_search": op8_top_k_search,
    "op9_token_blocks": op9_token_blocks,
    "op10_warc": op10_warc,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_alignment": op13_token_alignment,
}.items()}

ORACLE: dict[str, str] = {
    "op1_ngram_join": r"""
        WITH RECURSIVE doc_words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3),
                                                  lambda i: array_to_string(w[i:i + 4], ' ')))
                END AS s
            FROM doc_words
        ), shingles AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
        ), reach AS (
            SELECT a, b FROM links
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        )
        SELECT doc_id, len(s)::BIGINT AS n_shingles,
               least(doc_id, coalesce(min(b), doc_id)) AS component_id
        FROM sets LEFT JOIN reach ON a = doc_id GROUP BY doc_id, len(s)
    """,
    "op6_decontamination": r"""
        WITH doc_words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), item_words AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), item_starts AS (
            SELECT item_id, w, least(10, len(w)) AS size,
                   unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s
            FROM item_words WHERE len(w) > 0
        ), windows AS (
            SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS key
            FROM item_starts
        ), doc_starts AS (
            SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
            FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
        ), hits AS (
            SELECT doc_id, item_id, s, size FROM (
                SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS key
                FROM doc_starts) JOIN windows USING (size, key)
        ), places AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + size)) AS place FROM hits) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
            FROM hits GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc_words LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op7_substring_dedup": """
        WITH docs AS (
            SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h
            FROM documents
        ), strings AS (
            SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS string
            FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS s FROM docs WHERE n >= 50)
        ), least_ids AS (
            SELECT string, min(doc_id) AS least_id FROM strings GROUP BY string
        ), found AS (
            SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before
            FROM strings JOIN least_ids USING (string) WHERE least_id < doc_id
        ), islands AS (
            SELECT doc_id, s, sum(CASE WHEN s <= before + 50 THEN 0 ELSE 1 END)
                       OVER (PARTITION BY doc_id ORDER BY s) AS island
            FROM found
        ), spans AS (
            SELECT doc_id, min(s) AS a, max(s) + 50 AS b FROM islands GROUP BY doc_id, island
        ), gaps AS (
            SELECT doc_id, a, b,
                   coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from
            FROM spans
        ), cut AS (
            SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
                   string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a)
                       AS kept
            FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
               coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1)))
                   AS kept_sha256
        FROM docs LEFT JOIN cut USING (doc_id)
    """,
    "op8_top_k_search": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   list_inner_product(q.v, c.v)::BIGINT AS score
            FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
                   AS "rank"
            FROM scored
        )
        SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 10
    """,
    "op10_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
            FROM pages
        ), digests AS (
            SELECT page_id, first, strlen(payload) AS n, sha1(payload) AS hex FROM payloads
        )
        SELECT page_id, n::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
                       ((('0x' || substr(hex, 1 + (5 * i // 8) * 2, 2))::INTEGER * 256
                         + ('0x' || coalesce(nullif(substr(hex, 3 + (5 * i // 8) * 2, 2), ''), '00'))
                           ::INTEGER)
                        >> (11 - 5 * i % 8)::INTEGER) & 31)::INTEGER, 1)), '') AS payload_digest,
               CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response'
                    ELSE 'revisit' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM digests
    """,
    "op11_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal
            FROM documents
        ), ordered AS (
            SELECT doc_id, normal, count(*) OVER (PARTITION BY normal) AS group_size,
                   row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id
            FROM texts
            WINDOW w AS (PARTITION BY normal ORDER BY length(text) DESC, doc_id NULLS LAST)
        )
        SELECT doc_id, keep_id, group_size::BIGINT AS group_size, place = 1 AS kept,
               sha256(normal) AS text_sha256
        FROM ordered
    """,
}
