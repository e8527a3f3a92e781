"""One registered query per operator, over its whole table, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from varve.llm import (
    content_sort,
    gear_chunks,
    part_enum,
    pii_trees,
    positional_index,
    ring,
    suffix_pieces,
    tag_paths,
    token_groups,
    token_transducer,
    toxicity,
    url_rules,
    whitening,
)
from varve.llm.common import table

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def query(oracle: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[run.__name__] = run
        if oracle:
            ORACLES[run.__name__] = oracle
        return run

    return register


@query(r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + 9], ' ') AS gram
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item_words WHERE len(w) > 0)
), grams AS (
    SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS gram
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
          FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (SELECT doc_id, s, n, item_id FROM grams JOIN windows USING (n, gram)),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
    FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
""")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return positional_index.contamination(docs, items).drop("n_near")


@query()
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract_main_text(table(spark, sf_dir, "pages"))


@query()
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_transducer.count_tokens(table(spark, sf_dir, "documents"), path)


@query()
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gear_chunks.repeated_spans(table(spark, sf_dir, "documents"))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query()
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_enum.jaccard_components(table(spark, sf_dir, "documents"))


@query()
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return url_rules.judge_urls(pages, labels, URL_RULES)


@query()
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return suffix_pieces.round_trip(table(spark, sf_dir, "documents"), path)


@query(r"""
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size,
    row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM (
    SELECT doc_id, length(coalesce(text, '')) AS n,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
    FROM documents
)
WINDOW best AS (PARTITION BY norm ORDER BY n DESC, doc_id)
""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.content_sort(table(spark, sf_dir, "documents"))


@query()
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.shard_rows(table(spark, sf_dir, "documents"), shards=8)


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(table(spark, sf_dir, "embeddings"), most=16))


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return token_groups.align_tokens(table(spark, sf_dir, "documents"), *paths, digest=True)


@query()
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_trees.span_digests(pii_trees.find_pii(table(spark, sf_dir, "documents")))
