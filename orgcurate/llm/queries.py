"""The queries of this subpackage, by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, concurrency, decontaminate, exact_dedup, filter_audit, html, license, near_dedup, quality, suffix_dedup, tokenstore, toxicity, urls
from ._spark import table


def word_bpe() -> str:
    """Path of the public word-level BPE vocabulary."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))



def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op4_tokenstore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.stored(table(spark, sf_dir, "documents"), word_bpe())


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), word_bpe())


def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.licenses(table(spark, sf_dir, "documents"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op11_concurrency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concurrency.peaks(*(table(spark, sf_dir, name) for name in ("sales", "sale_lines", "clients")))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_near_dedup": op2_near_dedup,
    "op3_html": op3_html,
    "op4_tokenstore": op4_tokenstore,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_quality": op6_quality,
    "op7_decontaminate": op7_decontaminate,
    "op8_bpe": op8_bpe,
    "op9_license": op9_license,
    "op10_urls": op10_urls,
    "op11_concurrency": op11_concurrency,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_filter_audit": op13_filter_audit,
}

SQL: dict[str, str] = {
    "op7_decontaminate": r"""
        WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS a FROM documents),
        i AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS a FROM benchmark),
        p AS (SELECT DISTINCT item, least(10, len(a)) AS k, array_to_string(a[s : s + least(10, len(a)) - 1], ' ') AS g FROM i, unnest(generate_series(1, greatest(1, len(a) - 9))) t(s) WHERE len(a) > 0),
        d AS (SELECT doc_id, k, s, array_to_string(a[s : s + k - 1], ' ') AS g FROM w, (SELECT DISTINCT k FROM p) n, unnest(generate_series(1, CAST(len(a) - k + 1 AS BIGINT))) t(s) WHERE len(a) >= k),
        h AS (SELECT doc_id, d.k, s, item FROM d JOIN p ON d.k = p.k AND d.g = p.g),
        x AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + k - 1)) AS pos FROM h) GROUP BY doc_id),
        y AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
        SELECT w.doc_id, CAST(coalesce(len(a), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN x USING (doc_id) LEFT JOIN y USING (doc_id)
    """,
    "op11_concurrency": r"""
        WITH e AS (SELECT sale_id, epoch(date_trunc('minute', max(shipped_at)))::BIGINT + 604800 AS end_s FROM sale_lines GROUP BY sale_id),
        c AS (SELECT client_id, min(nation_id) AS nation_id FROM clients GROUP BY client_id),
        s AS (SELECT coalesce(nation_id, -1) AS nation_id, epoch(date_trunc('minute', sold_at))::BIGINT AS start_s, end_s, coalesce(floor(100 * total + 0.5), 0)::BIGINT AS cents
            FROM sales LEFT JOIN e USING (sale_id) LEFT JOIN c USING (client_id) WHERE sold_at IS NOT NULL),
        b AS (SELECT nation_id, start_s, end_s, cents FROM s WHERE end_s IS NULL OR end_s > start_s UNION ALL SELECT -2, start_s, end_s, cents FROM s WHERE end_s IS NULL OR end_s > start_s),
        d AS (SELECT nation_id, t, sum(n) AS n, sum(v) AS v FROM (SELECT nation_id, start_s AS t, 1 AS n, cents AS v FROM b UNION ALL SELECT nation_id, end_s, -1, -cents FROM b WHERE end_s IS NOT NULL) GROUP BY ALL HAVING sum(n) <> 0 OR sum(v) <> 0),
        o AS (SELECT nation_id, t, sum(n) OVER w AS n_open, sum(v) OVER w AS open_cents, lead(t) OVER w AS to_s FROM d WINDOW w AS (PARTITION BY nation_id ORDER BY t))
        SELECT nation_id, t AS from_s, to_s, n_open::BIGINT AS n_open, open_cents::BIGINT AS open_cents, max(n_open) OVER (PARTITION BY nation_id ORDER BY t)::BIGINT AS high_open, n_open = max(n_open) OVER (PARTITION BY nation_id) AS is_peak FROM o
    """,
    "op12_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, doc_id = first_value(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)
    """,
    "op13_filter_audit": r"""
        WITH RECURSIVE w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a FROM documents),
        l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, map {'A': len(a) < 100, 'B': 100 * len(list_distinct(a)) < 80 * len(a), 'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t), 'D': regexp_matches(t, '[#$%&*|]'), 'E': doc_id > min(doc_id) OVER (PARTITION BY t)} AS m
            FROM w LEFT JOIN l USING (doc_id)),
        p AS (SELECT '' AS o UNION ALL SELECT o || x FROM p, unnest(['A', 'B', 'C', 'D', 'E']) t(x) WHERE NOT contains(o, x)),
        g AS (SELECT part, good, toxic, m, list_sum(list_transform(map_values(m), lambda v: v::INT)) AS n_fails, count(*) AS n FROM f GROUP BY ALL),
        s AS (SELECT g.*, o, k, m[o[k]] AS fails, coalesce(list_min(list_filter([1, 2, 3, 4, 5], lambda j: m[o[j]])), 6) AS first FROM g, (SELECT o FROM p WHERE length(o) = 5), unnest([1, 2, 3, 4, 5]) u(k)),
        c AS (SELECT part, o AS filter_order, k AS step, sum(n * (first > k)::INT) AS kept, sum(n * (first = k)::INT) AS removed, sum(n * (fails AND first < k)::INT) AS redundant, sum(n * (fails AND n_fails = 1)::INT) AS unique_fails,
            sum(n * (first = k AND good)::INT) AS good_lost, sum(n * (first = k AND toxic)::INT) AS toxic_lost FROM s GROUP BY ALL)
        SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, sum(removed) OVER (PARTITION BY part, filter_order[step])::BIGINT AS shapley FROM c
    """,
}
