"""The operators of this folder bound to the test tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorastat.llm import attribution, chat, decontamination, licenses, log_bilinear, negatives, packing, pii, prefix_trie, quality, secrets, simhash, substrings
from agorastat.llm.common import read, ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def shipped(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return function(spark, folder)

        QUERIES[name] = shipped
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op6_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.token_pieces(read(spark, folder, "documents")))


_RULES_SQL = quality.RULES
_RATES_SQL = ",\n".join(
    f"""CASE WHEN sum(f{i} * f{i} * 1.0 / n) OVER () / sum(n) OVER () - (sum(f{i}) OVER () / sum(n) OVER ()) ** 2 > 1e-12
        THEN (f{i} + greatest(1.0, (sum(f{i}) OVER () / sum(n) OVER ()) * (1 - sum(f{i}) OVER () / sum(n) OVER ())
                / (sum(f{i} * f{i} * 1.0 / n) OVER () / sum(n) OVER () - (sum(f{i}) OVER () / sum(n) OVER ()) ** 2) - 1)
                * (sum(f{i}) OVER () / sum(n) OVER ()))
             / (n + greatest(1.0, (sum(f{i}) OVER () / sum(n) OVER ()) * (1 - sum(f{i}) OVER () / sum(n) OVER ())
                / (sum(f{i} * f{i} * 1.0 / n) OVER () / sum(n) OVER () - (sum(f{i}) OVER () / sum(n) OVER ()) ** 2) - 1))
        ELSE sum(f{i}) OVER () / sum(n) OVER () END AS r{i}"""
    for i in range(len(_RULES_SQL))
)


@query(
    "op4_host_quality_rules",
    f"""
    WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
    words AS (SELECT doc_id, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM texts),
    grams AS (
        SELECT doc_id, i, list_slice(w, i, i + 4) AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)
    ),
    twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams),
    repeats AS (
        SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
        FROM twice, (SELECT unnest(range(0, 5)) AS k) WHERE c > 1 GROUP BY doc_id
    ),
    lines AS (
        SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM texts)
        WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
    ),
    metrics AS (
        SELECT t.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
               CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
               CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM texts t JOIN words USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
    ),
    hosts AS (
        SELECT source AS host, count(*) AS n,
               {", ".join(f"count(*) FILTER (WHERE {rule}) AS f{i}" for i, rule in enumerate(_RULES_SQL.values()))}
        FROM metrics GROUP BY source
    ),
    rates AS (SELECT host, {_RATES_SQL} FROM hosts),
    rejected AS (
        SELECT host FROM rates
        WHERE greatest({", ".join(f"r{i}" for i in range(len(_RULES_SQL)))}) > {quality.HostPolicy().reject_above}
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           ({quality.BASE_FAILED}) AS base_failed,
           NOT ({quality.BASE_FAILED}) AND NOT EXISTS (
               SELECT 1 FROM rejected WHERE rejected.host IS NOT DISTINCT FROM metrics.source) AS kept
    FROM metrics
    """,
)
def host_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_verdicts(read(spark, folder, "documents"))


@query(
    "op9_prefix_filtered_decontamination",
    r"""
    WITH docs AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    ),
    items AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
    ),
    windows AS (
        SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 9), ' ') AS g, least(len(w), 10) AS n
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
    ),
    sizes AS (SELECT DISTINCT n FROM windows),
    grams AS (
        SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
        FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes)
    ),
    found AS (SELECT doc_id, i, grams.n, item_id FROM grams JOIN windows ON grams.g = windows.g AND grams.n = windows.n),
    hit AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
    ),
    listed AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
)
def prefix_filtered_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination_report(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query("op10_gray_order_simhash")
def gray_order_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


@query("op3_skip_chain_pii")
def skip_chain_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(read(spark, folder, "documents"))


@query("op2_offset_mapped_token_counts")
def offset_mapped_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.token_counts(read(spark, folder, "documents"))


@query("op1_blob_ledger_secrets")
def blob_ledger_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(read(spark, folder, "documents"))


_CONTROL_SQL = "|".join(
    "".join("\\" + c if c in "[]|" else c for c in s[0]) + r"\\*" + "".join("\\" + c if c in "[]|" else c for c in s[1:])
    for s in chat.CONTROL
)


@query(
    "op8_grammar_round_trip_chat",
    f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    )
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(role) + length(text) + len(regexp_extract_all(text, '{_CONTROL_SQL}'))
                    + {len(chat.OPEN) + len(chat.CLOSE) + 2}) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id
    """,
)
def grammar_round_trip_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.report(read(spark, folder, "conversations"))


@query("op7_two_stage_suffix_dedup")
def two_stage_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, folder, "documents"))


_NOTICES_SQL = ", ".join(
    f"({n}, '{name}', '{b}', {len(bigrams)})"
    for n, (name, text) in enumerate(licenses.NOTICES)
    for bigrams in [licenses.template_bigrams(text)]
    for b in sorted(bigrams)
)


@query(
    "op5_bigram_dice_licenses",
    rf"""
    WITH templates(template, license, bigram, size) AS (VALUES {_NOTICES_SQL}),
    paragraphs AS (
        SELECT doc_id, regexp_split_to_array(text, '\n(?:[\x20\x09\x0B-\x0D]*\n)+') AS p FROM documents
    ),
    passages AS (
        SELECT doc_id, 'line' AS part, unnest(range(0, len(l))) AS number, unnest(l) AS t
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
        UNION ALL
        SELECT * FROM (SELECT doc_id, 'paragraph', unnest(range(0, len(p))), unnest(p) AS t FROM paragraphs) WHERE contains(t, chr(10))
    ),
    words AS (
        SELECT doc_id, part, number, list_filter(string_split(regexp_replace(
            translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), ' '),
            lambda x: x <> '') AS w FROM passages
    ),
    bigrams AS (
        SELECT doc_id, part, number, unnest(list_distinct(
            CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS bigram
        FROM words
    ),
    sized AS (SELECT doc_id, part, number, bigram, count(*) OVER (PARTITION BY doc_id, part, number) AS n FROM bigrams),
    scored AS (
        SELECT doc_id, part, number, template, license, 2 * count(*) / (n + size) AS similarity
        FROM sized JOIN templates USING (bigram) GROUP BY doc_id, part, number, n, template, license, size
    )
    SELECT doc_id, part, number, arg_min(license, (-similarity, template)) AS license, max(similarity) AS similarity
    FROM scored WHERE similarity >= {licenses.AT_LEAST} GROUP BY doc_id, part, number
    """,
)
def bigram_dice_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_findings(read(spark, folder, "documents"))


@query("op5_license_windows")
def license_windows(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_windows(read(spark, folder, "documents"))


#: CRC-32 of a text of ASCII characters, bit by bit.
_CRC_SQL = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda r, c: list_reduce([xor(r, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


@query(
    "op12_euler_tour_prefix_trie",
    f"""
    WITH turns AS (
        SELECT CAST(conv_id AS BIGINT) AS conv_id, length(t) AS chars, turn, sha256(CAST(length(r) AS VARCHAR) || ':' || r || t) AS digest
        FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)
    ),
    convs AS (
        SELECT conv_id, list(digest || '/' || chars ORDER BY turn NULLS FIRST, digest) AS own, ({_CRC_SQL}) % 6 AS h FROM turns GROUP BY conv_id
    ),
    rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(list_slice(b.own, 1, c.h), []), list_slice(c.own, c.h + 1, len(c.own))) AS w
        FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 100
    ),
    paths AS (
        SELECT conv_id, d, len(w) = d AS last, array_to_string(list_slice(w, 1, d), ' ') AS node,
               CASE WHEN d > 0 THEN array_to_string(list_slice(w, 1, d - 1), ' ') END AS parent,
               CASE WHEN d > 0 THEN CAST(split_part(w[d], '/', 2) AS BIGINT) ELSE 0 END AS chars
        FROM (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d FROM rebuilt)
    ),
    nodes AS (
        SELECT node, d, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saved,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
        FROM paths GROUP BY node, d
    ),
    children AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
    counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children ON children.parent = nodes.node),
    above AS (
        SELECT array_to_string(list_slice(w, 1, k), ' ') AS up, saved, n_children
        FROM (SELECT saved, n_children, w, unnest(range(0, len(w) + 1)) AS k
              FROM (SELECT saved, n_children, CASE WHEN node = '' THEN [] ELSE string_split(node, ' ') END AS w FROM counted))
    ),
    sums AS (SELECT up, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY up)
    SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
    FROM counted c JOIN sums ON sums.up = c.node LEFT JOIN counted p ON p.node = c.parent
    """,
)
def euler_tour_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.report(read(spark, folder, "conversations"))


@query(
    "op13_str_rtree_hard_negatives",
    """
    WITH usable AS (
        SELECT DISTINCT CAST(vec_id AS BIGINT) AS id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.id AS anchor_id, a.label AS anchor_label, b.id, b.label,
               CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
        FROM usable a JOIN usable b ON a.id % 100 = 0 AND a.id <> b.id
    ),
    positives AS (
        SELECT anchor_id, id, score FROM scored WHERE label = anchor_label
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
           n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND n.label <> n.anchor_label
     AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 5
    """,
)
def str_rtree_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.report(read(spark, folder, "embeddings"))


@query("op11_log_bilinear_scores")
def log_bilinear_scores(spark: SparkSession, folder: str) -> DataFrame:
    return log_bilinear.report(read(spark, folder, "documents"))
