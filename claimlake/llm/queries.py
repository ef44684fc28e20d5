"""The registered queries of the text operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import attribution, decontamination, divergence, extraction, line_dedup, packing, personal_data, quality, secret_scan, similarity, toxicity, url_filter, whitening
from claimlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
# The pre-tokenization of the byte-level vocabulary.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The rules of the contract.
URL_RULES = {
    "org/": url_filter.ALLOW,
    "example.org/es/": url_filter.BLOCK,
    "example.org/en/1": url_filter.BLOCK,
    "com/fr/": url_filter.ALLOW,
    "com/de/": url_filter.BLOCK,
}
# Host labels that put a host on the list.
LISTED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def packing_params(cached_bytes: int = 192 << 20) -> packing.PackingParams:
    return packing.PackingParams(public_tokenizers.path("word_bpe_49k.json"), cached_bytes=cached_bytes)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document per line, as ``line:tokens`` pairs in page order."""
    params = attribution.AttributionParams(public_tokenizers.path("byte_bpe_50k.tiktoken"), BYTE_PATTERN)
    counted = attribution.attribute(table(spark, sf_dir, "documents"), params)
    pairs = F.transform("sections", lambda s: F.concat_ws(":", s["line"], s["n_tokens"]))
    return counted.select(
        "doc_id",
        "n_tokens",
        F.size("sections").cast("bigint").alias("n_sections"),
        "n_crossing",
        "n_unallocated",
        F.array_join(pairs, ",").alias("section_tokens"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_boilerplate(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing_params())


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(url_filter.url_host(F.col("url")).alias("key"))
    listed = hosts.where(F.arrays_overlap(F.split("key", r"\."), F.array(*map(F.lit, LISTED_LABELS))))
    judged = url_filter.judge_urls(pages, URL_RULES, listed)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, sf_dir, "documents"))
    counts = [personal_data.n_of_kind(F.col("base"), kind).alias(f"n_{kind}") for kind in personal_data.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(personal_data.spans_text(F.col("base")), 256).alias("base_sha256"),
        personal_data.spans_text(F.col("spans")).alias("spans"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).drop("clean_text")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontamination.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_checked"
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.links_per_document(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_line_dedup,
        op3_packing,
        op4_url_filter,
        op5_personal_data,
        op6_quality_rules,
        op7_decontamination,
        op8_secret_scan,
        op9_jaccard_join,
        op10_html_extraction,
        op11_toxicity,
        op12_embedding_whitening,
        op13_source_divergence,
    )
}

ORACLE_SQL = {
    "op2_line_dedup": r"""
WITH lines AS (
    SELECT source, doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), sizes AS (
    SELECT source, count(*) AS n_pages FROM documents GROUP BY source
), counts AS (
    SELECT source, line, count(*) AS n
    FROM (
        SELECT source, unnest(list_distinct(list_filter(
            list_transform(lines, lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> ''))) AS line
        FROM lines
    )
    GROUP BY source, line
), dropped AS (
    SELECT c.source, list(c.line) AS gone
    FROM counts c JOIN sizes s ON c.source IS NOT DISTINCT FROM s.source
    WHERE c.n >= 3 AND c.n > 0.1::DOUBLE * s.n_pages
    GROUP BY c.source
), kept AS (
    SELECT l.*, list_filter(lines, lambda x:
        NOT list_contains(coalesce(gone, []::VARCHAR[]), trim(x, ' ' || chr(9) || chr(13)))) AS left_lines
    FROM lines l LEFT JOIN dropped d ON l.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, source, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(left_lines, chr(10)) END AS text,
    coalesce(len(list_filter(lines, lambda x: trim(x, ' ' || chr(9) || chr(13)) <> '')), 0) AS n_lines,
    coalesce(len(lines) - len(left_lines), 0) AS n_dropped
FROM kept
""",
    "op4_url_filter": r"""
WITH parsed AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), rules(rule, host, start, verdict) AS (
    VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
        ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
        ('com/de/', 'com', '/de/', 'block')
), fits AS (
    SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM (
        SELECT p.page_id, r.rule, r.verdict
        FROM parsed p JOIN rules r
            ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.start)
    )
    GROUP BY page_id
)
SELECT p.page_id, p.host, p.path, f.rule,
    coalesce(f.verdict, CASE WHEN list_has_any(string_split(p.host, '.'),
        ['adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])
        THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed p LEFT JOIN fits f ON p.page_id = f.page_id
""",
    "op13_source_divergence": r"""
WITH read AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), kept AS (
    SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM read)
    GROUP BY lang, term HAVING count(*) >= 10
), counts AS (
    SELECT lang, source, term, count(*) AS n
    FROM (SELECT lang, source, unnest(terms) AS term FROM read) JOIN kept USING (lang, term)
    GROUP BY lang, source, term
), sizes AS (
    SELECT lang, count(*) AS v FROM kept GROUP BY lang
), totals AS (
    SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source
), groups AS (
    SELECT DISTINCT lang, source FROM read
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * s.v) AS p
    FROM groups g JOIN sizes s ON g.lang = s.lang JOIN kept k ON g.lang = k.lang
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
), summed AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), languages AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (w + 2)) // (sum(w) OVER (PARTITION BY lang) + 2 * v) AS q
    FROM (SELECT lang, term, sum(n) AS w FROM counts GROUP BY lang, term) JOIN sizes USING (lang)
), terms AS (
    SELECT s.lang, s.source, 'term' AS part, s.term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
    FROM shares s JOIN languages l ON s.lang = l.lang AND s.term = l.term
    WHERE s.n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
""",
}
