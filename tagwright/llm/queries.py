"""The numbered queries over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagwright.llm import audit, exact, merkle, mixing, packing, phrases, pii, quality, sharding, simhash, suffix, tokens, toxicity
from tagwright.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_simhash_near_dedup(spark, folder):
    return simhash.near_groups(table(spark, folder, "documents"))


@query
def op2_mixing(spark, folder):
    return mixing.mix(table(spark, folder, "documents"))


@query
def op3_exact_dedup(spark, folder):
    return exact.exact_groups(table(spark, folder, "documents"))


SQL["op3_exact_dedup"] = """
    WITH d AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY t)
"""


@query
def op4_suffix_dedup(spark, folder):
    return suffix.remove_repeats(table(spark, folder, "documents"))


@query
def op5_token_counts(spark, folder):
    return tokens.count_tokens(
        table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


@query
def op6_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_quality(spark, folder):
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_fingerprints(spark, folder):
    return merkle.fingerprint_edits(table(spark, folder, "documents"))


@query
def op9_sharding(spark, folder):
    return sharding.shard(table(spark, folder, "documents"))


@query
def op10_personal_data(spark, folder):
    return pii.find(table(spark, folder, "documents"))


@query
def op12_filter_audit(spark, folder):
    return audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


SQL["op12_filter_audit"] = r"""
    WITH d AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ),
    l AS (
        SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
               max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
        FROM labels GROUP BY doc_id
    ),
    fails AS (
        SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
               [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
                100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
                regexp_matches(t, '[#$%&*|]'),
                coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS f
        FROM d LEFT JOIN l ON d.doc_id = l.doc_id
    ),
    kinds AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, f),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE length(regexp_replace(a.x || b.x || c.x || d.x || e.x, '[^A]', '', 'g')) = 1
          AND length(regexp_replace(a.x || b.x || c.x || d.x || e.x, '[^B]', '', 'g')) = 1
          AND length(regexp_replace(a.x || b.x || c.x || d.x || e.x, '[^C]', '', 'g')) = 1
          AND length(regexp_replace(a.x || b.x || c.x || d.x || e.x, '[^D]', '', 'g')) = 1
    ),
    places AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
    judged AS (
        SELECT part, filter_order, step, n, good, toxic, substr(filter_order, step, 1) AS x,
               f[instr('ABCDE', substr(filter_order, step, 1))] AS hit,
               coalesce(list_bool_or([f[instr('ABCDE', c)] FOR c IN string_split(filter_order[1:step - 1], '') IF c <> '']), false) AS gone,
               len([1 FOR y IN f IF y]) AS failed
        FROM kinds, places
    ),
    steps AS (
        SELECT part, filter_order, step, x,
               sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN hit AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
               sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
        FROM judged GROUP BY ALL
    )
    SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
           unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
           (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
    FROM steps
"""


@query
def op13_phrases(spark, folder):
    return phrases.collocations(table(spark, folder, "documents"))


SQL["op13_phrases"] = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    grams AS (
        SELECT lang, k, unnest([list_aggregate(w[i:i + k - 1], 'string_agg', ' ') FOR i IN range(1, len(w) - k + 2)]) AS g
        FROM w, (SELECT unnest([1, 2, 3]) AS k)
    ),
    f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g),
    total AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
    candidate AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS s FROM f WHERE k > 1 AND f >= 10),
    cut AS (
        SELECT lang, k, g, a, c, list_aggregate(s[1:c], 'string_agg', ' ') AS x, list_aggregate(s[c + 1:k], 'string_agg', ' ') AS y
        FROM candidate, (SELECT unnest([1, 2]) AS c) WHERE c < k
    ),
    scored AS (
        SELECT cut.lang, cut.k, cut.g, a, c, p.f AS l, q.f AS r,
               (1000000::HUGEINT * a * a) // (p.f::HUGEINT * q.f) AS score
        FROM cut JOIN f p ON p.lang = cut.lang AND p.g = x JOIN f q ON q.lang = cut.lang AND q.g = y
    ),
    best AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1
    ),
    held AS (
        SELECT DISTINCT i.lang, i.g FROM candidate i JOIN candidate o
        ON o.lang = i.lang AND i.k = 2 AND o.k = 3
           AND (o.s[1] = i.s[1] AND o.s[2] = i.s[2] OR o.s[2] = i.s[1] AND o.s[3] = i.s[2]) AND 100 * o.a >= 50 * i.a
    ),
    ranked AS (
        SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank
        FROM best ANTI JOIN held USING (lang, g)
    )
    SELECT lang, rank, g AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query
def op11_toxicity(spark, folder):
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
