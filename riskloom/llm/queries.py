"""The registered queries of this subpackage and their SQL counterparts, where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import bpe_matrix, chat_events, content_sort, host_rules, html_crf, impact_search, jaccard_join, mixing, phrase_automata, pseudonyms, secret_battery, simhash_grid, token_store
from riskloom.llm.common import table
from riskloom.session import materialize, shared_dir

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def llm_query(name: str, sql: str | None = None):
    def register(fn):
        LLM_QUERIES[name] = fn
        if sql:
            LLM_ORACLES[name] = sql
        return fn

    return register


@llm_query(
    "op1_content_sort_dedup",
    """
    WITH t AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
    ), g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size, sha256(norm) AS text_sha256 FROM t GROUP BY norm)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (norm)
    """,
)
def op1(spark: SparkSession, directory: str) -> DataFrame:
    """Exact copies of whole texts (A-Z lower-cased); the largest doc_id stays."""
    return content_sort.content_groups(table(spark, directory, "documents"), keep="largest").withColumnRenamed("id", "doc_id")


@llm_query(
    "op5_host_quality_rules",
    r"""
    WITH t AS (
        SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
    ), w AS (
        SELECT *, list_filter(string_split_regex(text, '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '') AS words,
               list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\x0c\r]')) AS lines
        FROM t
    ), windows AS (
        SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
        FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
    ), repeated AS (
        SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM windows) WHERE n >= 2
    ), covered AS (
        SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + k AS at FROM repeated, (VALUES (0), (1), (2)) AS v(k)) GROUP BY rid
    ), counts AS (
        SELECT w.rid, doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
               CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
        FROM w LEFT JOIN covered USING (rid)
    ), ruled AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               100 * n_symbols > 10 * word_chars OR n_dup_lines > 5 AS soft_failed,
               [n_words < 50, 100 * n_repeat_words > 50 * n_words, 100 * n_symbols > 10 * word_chars, n_dup_lines > 5] AS rules
        FROM counts
    ), hosts AS (
        SELECT source, rule, count(*) AS n, count(*) FILTER (rules[rule]) AS f FROM ruled, range(1, 5) AS r(rule) GROUP BY source, rule
    ), sums AS (
        SELECT rule, count(*) AS k, sum(n) AS n, sum(f) AS f, var_pop(f / n) AS v, avg(1 / n) AS inv,
               least(greatest(sum(f) / sum(n), 1e-6), 1 - 1e-6) AS m
        FROM hosts GROUP BY rule
    ), prior AS (
        SELECT rule, m, f / n AS common, least(greatest(CASE WHEN v - m * (1 - m) * inv > 1e-12 THEN m * (1 - m) / (v - m * (1 - m) * inv) - 1 ELSE n / k END, 1.0), n / k) AS s FROM sums
    ), posterior AS (
        SELECT source, (f + m * s) / (n + s) AS mean, n + s + 1 AS weight, common FROM hosts JOIN prior USING (rule)
    ), verdicts AS (
        SELECT source, bool_or(round((mean - 1.25 * common) / sqrt(mean * (1 - mean) / weight), 6) >= 1.645) AS bad FROM posterior GROUP BY source
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT (bad AND soft_failed) AS kept
    FROM ruled JOIN verdicts ON ruled.source IS NOT DISTINCT FROM verdicts.source
    """,
)
def op5(spark: SparkSession, directory: str) -> DataFrame:
    """Counts, base rules and host verdict of every document."""
    out = host_rules.judged(table(spark, directory, "documents"))
    return out.select(F.col("id").alias("doc_id"), *host_rules.COUNTS, "base_failed", "kept")


@llm_query(
    "op6_source_mix",
    r"""
    WITH t AS (
        SELECT doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '')) AS BIGINT) AS size,
               md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS mix_key
        FROM documents
    ), s AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM t GROUP BY source
    ), w AS (
        SELECT source, source_size, n, CASE n % 3 WHEN 1 THEN 3.0 WHEN 2 THEN 1.0 ELSE 2.0 END AS weight, 2.0 * source_size AS most,
               (SELECT sum(source_size) FROM s) * 1.5 AS budget
        FROM s
    ), ratio AS (
        SELECT *, most / weight AS r, sum(most) OVER (ORDER BY most / weight, n) AS given, sum(weight) OVER () - sum(weight) OVER (ORDER BY most / weight, n) AS open FROM w
    ), levels AS (
        -- the level after capping the first k sources by ratio; the right k is the first whose next ratio is above it
        SELECT 0 AS k, budget / sum(weight) AS level, min(r) AS next FROM ratio GROUP BY budget
        UNION ALL
        SELECT row_number() OVER (ORDER BY r, n), (budget - given) / nullif(open, 0), lead(r) OVER (ORDER BY r, n) FROM ratio
    ), level AS (SELECT coalesce((SELECT level FROM levels WHERE next > level ORDER BY k LIMIT 1), 1e300) AS level),
    goals AS (
        SELECT source, source_size, least(most, level * weight) AS target FROM w, level
    ), e AS (
        SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(round(target) / source_size) ELSE 0 END AS BIGINT) AS epochs FROM goals
    ), o AS (
        SELECT doc_id, t.source, size, source_size, target, epochs, CAST(round(target) AS BIGINT) - epochs * source_size AS rest,
               CAST(sum(size) OVER (PARTITION BY t.source ORDER BY mix_key, doc_id) AS BIGINT) - size AS before
        FROM t JOIN e ON t.source IS NOT DISTINCT FROM e.source
    )
    SELECT doc_id, size, source_size, round(CAST(target AS DOUBLE), 6) AS target, CAST(epochs * size + least(greatest(rest - before, 0), size) AS BIGINT) AS taken FROM o
    """,
)
def op6(spark: SparkSession, directory: str) -> DataFrame:
    """Words that a mix of all sources takes from every document."""
    out = mixing.mixed(table(spark, directory, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"), "taken")


@llm_query("op4_simhash_grid")
def op4(spark: SparkSession, directory: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    out = simhash_grid.near_duplicates(table(spark, directory, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@llm_query("op7_bpe_matrix")
def op7(spark: SparkSession, directory: str) -> DataFrame:
    """Byte-level BPE ids of every document, and the bytes they decode to, as digests."""
    docs = table(spark, directory, "documents")
    out = bpe_matrix.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.withColumnRenamed("id", "doc_id")


@llm_query("op8_token_store")
def op8(spark: SparkSession, directory: str) -> DataFrame:
    """Token-id files of every document, written and read back."""
    path = f"{shared_dir(spark)}/riskloom/token-store-{uuid.uuid4().hex}"
    token_store.write_store(table(spark, directory, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    out = token_store.read_store(spark, path)
    return out.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@llm_query("op9_secret_battery")
def op9(spark: SparkSession, directory: str) -> DataFrame:
    """Secrets of every document: base patterns and randomness tests."""
    return secret_battery.secrets(table(spark, directory, "documents")).withColumnRenamed("id", "doc_id")


# Pseudonyms are only as private as the key: callers of the operator pass their own.
PSEUDONYM_KEY = b"key of the registered query"


@llm_query("op2_feistel_pseudonyms")
def op2(spark: SparkSession, directory: str) -> DataFrame:
    """Documents with their personal data replaced by format-preserving pseudonyms."""
    return pseudonyms.pseudonyms(table(spark, directory, "documents"), PSEUDONYM_KEY).withColumnRenamed("id", "doc_id")


@llm_query("op3_chat_events")
def op3(spark: SparkSession, directory: str) -> DataFrame:
    """Every conversation rebuilt from its events, rendered, written, and read back as digests."""
    own = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    log = chat_events.log_of_turns(table(spark, directory, "conversations").select("conv_id", "turn", "role", "text").unionByName(more))
    return chat_events.digests(materialize(chat_events.rendered_turns(log), "chat-turns"))


@llm_query("op10_html_crf")
def op10(spark: SparkSession, directory: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, directory, "pages")
    return html_crf.main_texts(pages, html_crf.fit(pages)).withColumnRenamed("id", "page_id")


@llm_query(
    "op11_nra_search",
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS row, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), q AS (
        SELECT item, item_id, unnest(list_distinct(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
        FROM (SELECT row_number() OVER () AS item, * FROM benchmark)
    ), c AS (
        SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM d WHERE len(terms) > 0
    ), p AS (
        SELECT row, term, CAST(count(*) AS BIGINT) AS tf
        FROM (SELECT row, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY row, term
    ), w AS (
        SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, c GROUP BY term, n
    ), m AS (
        SELECT row, doc_id, 10 + (90 * CAST(len(terms) AS BIGINT) * n) // l AS m FROM d, c WHERE len(terms) > 0
    ), s AS (
        SELECT item, item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM p JOIN m USING (row) JOIN w USING (term) JOIN q USING (term) GROUP BY item, item_id, row, doc_id
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= 10
    """,
)
def op11(spark: SparkSession, directory: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return impact_search.search_documents(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


@llm_query("op12_jaccard_join")
def op12(spark: SparkSession, directory: str) -> DataFrame:
    """Set size and near-duplicate component of every document."""
    out = jaccard_join.near_classes(table(spark, directory, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@llm_query(
    "op13_phrase_automata",
    r"""
    WITH t AS (
        SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ), p AS (
        SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w
        FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM t)
    ), spans AS (
        SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS len FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p)
    ), g AS (
        SELECT lang, array_to_string(w[i:i + len - 1], ' ') AS phrase, len, CAST(count(*) AS BIGINT) AS f FROM spans GROUP BY ALL HAVING count(*) >= 100
    ), n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang
    ), cand AS (
        SELECT * FROM g c WHERE len > 1 AND NOT EXISTS (
            SELECT 1 FROM g b WHERE b.lang = c.lang AND b.len > c.len AND 100 * b.f >= 100 * c.f AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))
    ), cut AS (
        SELECT *, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
        FROM (SELECT *, unnest(range(1, len)) AS k FROM cand)
    ), s AS (
        SELECT cut.lang, cut.phrase, cut.f AS a, k, h.f AS l, t.f AS r, n, (1000::HUGEINT * cut.f * n) // (h.f::HUGEINT * t.f) AS score
        FROM cut JOIN g h ON h.lang = cut.lang AND h.phrase = head JOIN g t ON t.lang = cut.lang AND t.phrase = tail JOIN n ON n.lang = cut.lang
    ), low AS (
        SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    )
    SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low) WHERE rank <= 2000
    """,
)
def op13(spark: SparkSession, directory: str) -> DataFrame:
    """The best phrases of every language."""
    return phrase_automata.collocations(table(spark, directory, "documents"))
