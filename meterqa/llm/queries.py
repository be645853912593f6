"""The registered queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterqa.llm import (
    chat,
    decontaminate,
    exact_dedup,
    language_id,
    mixing,
    near_dedup,
    phrases,
    pieces,
    quality,
    secrets,
    sharding,
    substrings,
    whitening,
)
from meterqa.llm.base import table


def op1_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(table(spark, sf_dir, "conversations"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_order(table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), 85)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), [1.0] * 16)


def op7_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predicted(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_piece_dropout,
        op2_exact_dedup,
        op3_chat_format,
        op4_source_mix,
        op5_near_dedup,
        op6_sharding,
        op7_repeated_substrings,
        op8_quality_rules,
        op9_language_id,
        op10_secret_scan,
        op11_phrase_mining,
        op12_embedding_whitening,
        op13_decontamination,
    )
}

ORACLES = {
    "op5_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id,
                   list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ),
        s AS (
            SELECT doc_id, list_distinct(CASE
                       WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                       WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
            FROM w
        ),
        sets AS (SELECT s, len(s) AS n, min(doc_id) AS id FROM (SELECT doc_id, list_sort(s) AS s FROM s) WHERE len(s) > 0 GROUP BY s),
        e AS (SELECT id, n, unnest(s) AS x FROM sets),
        l AS (
            SELECT a.id AS a, b.id AS b FROM e a JOIN e b ON a.x = b.x AND a.id <> b.id
                AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
            GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ),
        r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT sets.s, least(id, coalesce(min(r.b), id)) AS c FROM sets LEFT JOIN r ON r.a = sets.id GROUP BY sets.s, id)
        SELECT doc_id, len(s.s) AS n_shingles, coalesce(c, doc_id) AS component_id, doc_id = coalesce(c, doc_id) AS kept
        FROM s LEFT JOIN c ON list_sort(s.s) = c.s
    """,
    "op2_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)
    """,
    "op3_chat_format": r"""
        WITH t AS (
            SELECT conv_id, row_number() OVER w AS n,
                   '<|' || coalesce(role, 'unknown') || e'|>\n' || replace(coalesce(text, ''), '<|', '<\|')
                       || e'\n<|end|>\n' AS line
            FROM conversations
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ),
        p AS (
            SELECT conv_id, n, string_agg(line, '') OVER (PARTITION BY conv_id ORDER BY n) AS chat,
                   count(*) OVER (PARTITION BY conv_id) AS total
            FROM t
        ),
        whole AS (
            SELECT min(conv_id) AS conv_id, n AS n_turns, count(*) AS n_copies, chat FROM p WHERE n = total GROUP BY n, chat
        )
        SELECT conv_id, n_turns, n_copies, chat FROM whole
        WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.n < p.total AND p.n = whole.n_turns AND p.chat = whole.chat)
    """,
    "op11_phrase_mining": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS p
            FROM documents
        ),
        w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
        u AS (SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM w) GROUP BY lang, x),
        n AS (SELECT lang, sum(f) AS n FROM u GROUP BY lang),
        b AS (
            SELECT lang, x, y, count(*) AS f FROM (SELECT lang, unnest(w[:-2]) AS x, unnest(w[2:]) AS y FROM w WHERE len(w) > 1)
            GROUP BY lang, x, y HAVING count(*) >= 10
        ),
        t AS (
            SELECT lang, x, y, z, count(*) AS f
            FROM (SELECT lang, unnest(w[:-3]) AS x, unnest(w[2:-2]) AS y, unnest(w[3:]) AS z FROM w WHERE len(w) > 2)
            GROUP BY lang, x, y, z HAVING count(*) >= 10
        ),
        longer AS (
            SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM t UNION ALL SELECT lang, y, z, f FROM t) GROUP BY lang, x, y
        ),
        cuts AS (
            SELECT b.lang, b.x || ' ' || b.y AS phrase, b.f AS a, 1 AS k, l.f AS l, r.f AS r
            FROM b JOIN u l ON l.lang = b.lang AND l.x = b.x JOIN u r ON r.lang = b.lang AND r.x = b.y
            LEFT JOIN longer ON longer.lang = b.lang AND longer.x = b.x AND longer.y = b.y
            WHERE 100 * coalesce(longer.f, 0) < 50 * b.f
            UNION ALL
            SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 1, l.f, r.f
            FROM t JOIN u l ON l.lang = t.lang AND l.x = t.x JOIN b r ON r.lang = t.lang AND r.x = t.y AND r.y = t.z
            UNION ALL
            SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, l.f, r.f
            FROM t JOIN b l ON l.lang = t.lang AND l.x = t.x AND l.y = t.y JOIN u r ON r.lang = t.lang AND r.x = t.z
        ),
        scored AS (
            SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
        ),
        worst AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst
        )
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
    """,
    "op13_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ),
        i AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ),
        windows AS (
            SELECT DISTINCT item, least(10, len(w)) AS size, unnest(list_transform(
                range(1, len(w) - least(10, len(w)) + 2), lambda k: array_to_string(w[k:k + least(10, len(w)) - 1], ' '))) AS phrase
            FROM i WHERE len(w) > 0
        ),
        places AS (
            SELECT row, size, unnest(range(1, len(w) - size + 2)) AS place, w FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
        ),
        found AS (
            SELECT row, item, place, p.size FROM places p JOIN windows s
            ON s.size = p.size AND s.phrase = array_to_string(p.w[place:place + p.size - 1], ' ')
        ),
        hit AS (SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(place, place + size)) AS k FROM found) GROUP BY row),
        items AS (
            SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT row, item FROM found) GROUP BY row
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN hit USING (row) LEFT JOIN items USING (row)
    """,
}
