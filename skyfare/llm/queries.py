"""The registered queries of this folder, each over its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skyfare.llm.common import documents
from skyfare.llm.exact_dedup import exact_duplicates
from skyfare.llm.fingerprints import document_fingerprints
from skyfare.llm.html_text import extract_text
from skyfare.llm.licenses import scan_licenses
from skyfare.llm.line_dedup import line_report
from skyfare.llm.merkle import verified_documents
from skyfare.llm.packing import packed_documents
from skyfare.llm.pieces import encode_documents
from skyfare.llm.quality import quality_scores
from skyfare.llm.sharding import shard_rows
from skyfare.llm.simhash import simhash_components
from skyfare.llm.vector_codes import vector_codes
from skyfare.llm.warc import archived_pages


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(documents(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(documents(spark, sf_dir))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(documents(spark, sf_dir), labels)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_documents(documents(spark, sf_dir))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_pieces": op2_pieces,
    "op3_fingerprints": op3_fingerprints,
    "op4_line_dedup": op4_line_dedup,
    "op5_sharding": op5_sharding,
    "op6_licenses": op6_licenses,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_simhash": op8_simhash,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_vector_codes": op11_vector_codes,
    "op12_merkle": op12_merkle,
    "op13_warc": op13_warc,
}


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, width: int = 8) -> str:
    """Every round as a step of its own; vectors have parts * width components."""
    places = range(1, width + 1)
    apart = " + ".join(f"(v.q[{i}] - b.q[{i}]) * (v.q[{i}] - b.q[{i}])" for i in places)
    floor = lambda s: f"({s} - (({s} % count(*)) + count(*)) % count(*)) // count(*)"
    mean = ", ".join(f"CAST({floor(f'CAST(sum(v.q[{i}]) AS HUGEINT)')} AS BIGINT)" for i in places)
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        near{r} AS MATERIALIZED (
            SELECT v.rid, v.p, min(({apart}) * {entries} + b.e) AS best FROM v JOIN book{r} b ON v.p = b.p GROUP BY v.rid, v.p
        )""")
        if r < rounds:
            steps.append(f"""
        mean{r} AS (
            SELECT v.p, n.best % {entries} AS e, [{mean}] AS q FROM v JOIN near{r} n ON v.rid = n.rid AND v.p = n.p GROUP BY ALL
        ),
        book{r + 1} AS MATERIALIZED (
            SELECT b.p, b.e, coalesce(m.q, b.q) AS q FROM book{r} b LEFT JOIN mean{r} m ON b.p = m.p AND b.e = m.e
        )""")
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
                   list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        v AS MATERIALIZED (
            SELECT rid, p, q[p * {width} + 1 : (p + 1) * {width}] AS q FROM kept, range({parts}) AS t(p)
        ),
        book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, q FROM v WHERE rid <= {entries}),
        {",".join(steps)},
        digest AS (
            SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY p, e)) AS h FROM book{rounds}
        ),
        coded AS (
            SELECT rid, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code,
                   CAST(sum(best // {entries}) AS BIGINT) AS error
            FROM near{rounds} GROUP BY rid
        )
        SELECT k.vec_id, c.code, c.error,
               CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
               (SELECT h FROM digest) AS codebooks_sha256
        FROM kept k JOIN coded c USING (rid)
    """

ORACLE_SQL: dict[str, str] = {
    "op7_exact_dedup": """
        WITH d AS (
            SELECT doc_id,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(norm) AS text_sha256
        FROM d
        WINDOW same AS (PARTITION BY norm)
    """,
    "op11_vector_codes": _codes_sql(),
    "op12_merkle": """
        WITH RECURSIVE fields AS (
            SELECT row_number() OVER () AS rid, doc_id, lang, n_chars,
                   [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS own,
                   [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars + 1 AS VARCHAR), text] AS other,
                   -- CRC-32, bit by bit
                   list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
                       lambda c, b: list_reduce(
                           [xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                           lambda y, z: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END) + z
                       )
                   ) AS crc
            FROM documents
        ),
        leaf AS (
            SELECT rid, doc_id, lang,
                   sha256(list_aggregate(list_transform(own, lambda x: coalesce(strlen(x) || ':' || x, '-')), 'string_agg', '')) AS leaf,
                   sha256(list_aggregate(list_transform(other, lambda x: coalesce(strlen(x) || ':' || x, '-')), 'string_agg', '')) AS forged,
                   xor(crc, 4294967295) % 7 = 0 AS tampered
            FROM fields
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
            FROM leaf
        ),
        tree AS (
            SELECT lang, 0 AS lvl, pos, n, leaf AS node FROM placed
            UNION ALL
            SELECT lang, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
            FROM tree WHERE n > 1 GROUP BY lang, lvl, pos // 2, n
        ),
        top AS (
            SELECT 0 AS lvl, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, node FROM tree WHERE n = 1
            UNION ALL
            SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
            FROM top WHERE n > 1 GROUP BY lvl, pos // 2, n
        ),
        langs AS (SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM tree WHERE n = 1),
        lang_steps AS (
            SELECT a.lang, a.lvl, a.pos, a.pos % 2 = 1 AS at_right, b.node AS sib
            FROM tree a LEFT JOIN tree b ON a.lang IS NOT DISTINCT FROM b.lang AND a.lvl = b.lvl AND b.pos = xor(a.pos, 1)
            WHERE a.n > 1
        ),
        top_steps AS (
            SELECT a.lvl, a.pos, a.pos % 2 = 1 AS at_right, b.node AS sib
            FROM top a LEFT JOIN top b ON a.lvl = b.lvl AND b.pos = xor(a.pos, 1)
            WHERE a.n > 1
        ),
        steps AS MATERIALIZED (
            SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY part, lvl) AS k, at_right, sib
            FROM (
                SELECT p.rid, 0 AS part, s.lvl, s.at_right, s.sib
                FROM placed p JOIN lang_steps s ON p.lang IS NOT DISTINCT FROM s.lang AND s.pos = p.pos >> s.lvl
                UNION ALL
                SELECT p.rid, 1, s.lvl, s.at_right, s.sib
                FROM placed p JOIN langs l ON p.lang IS NOT DISTINCT FROM l.lang JOIN top_steps s ON s.pos = l.pos >> s.lvl
            )
        ),
        folded AS (
            SELECT rid, 1 AS k, CASE WHEN tampered THEN forged ELSE leaf END AS value FROM placed
            UNION ALL
            SELECT f.rid, f.k + 1, sha256(CASE WHEN s.sib IS NULL THEN f.value WHEN s.at_right THEN s.sib || f.value ELSE f.value || s.sib END)
            FROM folded f JOIN steps s ON f.rid = s.rid AND f.k = s.k
        ),
        proof AS (SELECT rid, coalesce(string_agg(sib, '' ORDER BY k), '') AS siblings FROM steps GROUP BY rid),
        reached AS (SELECT rid, arg_max(value, k) AS value FROM folded GROUP BY rid)
        SELECT p.doc_id, p.leaf, l.subroot, t.node AS root, sha256(coalesce(r.siblings, '')) AS proof_sha256,
               f.value AS folded_root, f.value = t.node AS verified
        FROM placed p
        JOIN langs l ON p.lang IS NOT DISTINCT FROM l.lang
        JOIN top t ON t.n = 1
        JOIN reached f ON f.rid = p.rid
        LEFT JOIN proof r ON r.rid = p.rid
    """,
    "op13_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
        ),
        d AS (
            SELECT page_id, payload,
                   list_aggregate(
                       list_transform(range(32), lambda i: substr(
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                           CAST((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1, 1)),
                       'string_agg', '') AS payload_digest
            FROM p
        )
        SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
        FROM d
        WINDOW same AS (PARTITION BY payload)
    """,
}
