"""The queries again as SQL, where SQL can express them."""

from __future__ import annotations

from daymill.llm.shared import LOWER, UPPER

WORD = r"[^\x20\x09-\x0D]+"

OP3 = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
    SELECT r, doc_id, text, regexp_extract_all(text, '{WORD}') AS words,
           [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '{WORD}')] AS lines
    FROM texts
), windows AS (
    SELECT r, i, hash(array_to_string(words[i:i+7], ' ')) AS h
    FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM parts WHERE len(words) >= 8)
), repeated AS (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, h) > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n FROM repeated, range(8) AS steps(k) GROUP BY r
), measures AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
           len([i FOR i IN range(2, len(words) + 1) IF words[i] = words[i - 1]]) AS n_echo_words,
           length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper
    FROM parts LEFT JOIN covered USING (r)
), ledger AS (
    SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
        + 4 * (n_symbols > 20 AND 100 * n_symbols > 15 * n_words)::BIGINT
        + 8 * (n_dup_lines > 3 AND 100 * n_dup_lines > 50 * n_lines)::BIGINT
        + 16 * (word_chars > 15 * n_words)::BIGINT + 32 * (word_chars < 2 * n_words)::BIGINT
        + 64 * (100 * n_upper > 40 * word_chars)::BIGINT
        + 128 * (n_echo_words > 5 AND 100 * n_echo_words > 20 * n_words)::BIGINT AS failed
    FROM measures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed
FROM ledger
"""

OP5 = rf"""
WITH parts AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                     '{UPPER}', '{LOWER}') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), ruled AS (
    SELECT *, CASE
        WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/'
    END AS rule
    FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

OP7 = rf"""
WITH sized AS (
    SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
           coalesce('a' || source, 'b') AS skey
    FROM documents
), keyed AS (
    SELECT *, bin(size) AS digits,
           md5('23:' || coalesce(doc_id::VARCHAR, 'null') || ':' || size || ':' || skey) AS key
    FROM sized
), ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY skey
        ORDER BY lpad(length(digits)::VARCHAR, 2, '0') || rpad(left(digits, 4), 4, '0'), key
    ) AS rank
    FROM keyed
), sources AS (
    SELECT skey, sum(size)::BIGINT AS source_size FROM sized GROUP BY skey
), weighed AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY skey) - 1) % 3 + 1)::INT] AS w FROM sources
), filled AS (
    SELECT *, row_number() OVER filling AS place,
           ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
            - 2 * coalesce(sum(source_size) OVER before, 0)::DOUBLE)
           / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
    FROM weighed
    WINDOW filling AS (ORDER BY source_size::DOUBLE / w, skey),
           before AS (filling ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), opened AS (
    SELECT arg_min(level, place) AS level FROM filled WHERE NOT w * level >= 2 * source_size
), targets AS (
    SELECT skey, source_size,
           least(2 * source_size::DOUBLE, coalesce(w * opened.level, 2 * source_size::DOUBLE)) AS target
    FROM filled LEFT JOIN opened ON true
), rates AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS rate,
           ('0x' || left(md5('23:' || skey), 8))::UBIGINT::DOUBLE / 4294967296::DOUBLE AS turn
    FROM targets
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rank::DOUBLE * rate + turn) - floor((rank - 1)::DOUBLE * rate + turn)))::BIGINT AS taken
FROM ranked JOIN rates USING (skey)
"""

ROUNDS_13 = 6


def _nearest(books: str) -> str:
    """Each part with its nearest entry and the squared distance to it."""
    return f"""
    SELECT r, p, v, (least_of % 16)::INT AS e, least_of // 16 AS d FROM (
        SELECT r, p, any_value(v) AS v,
               min(list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::HUGEINT * 16 + e) AS least_of
        FROM parts JOIN {books} USING (p) GROUP BY r, p
    )
    """


def _means(assigned: str, books: str) -> str:
    """Entries after a round: sums divided and rounded down; unused entries stay."""
    return f"""
    SELECT p, e, coalesce(m.c, b.c) AS c FROM {books} b LEFT JOIN (
        SELECT p, e, list((total - ((total % n) + n) % n) // n ORDER BY j) AS c FROM (
            SELECT p, e, j, sum(x)::HUGEINT AS total, count(*)::HUGEINT AS n FROM (
                SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS j FROM {assigned}
            ) GROUP BY p, e, j
        ) GROUP BY p, e
    ) m USING (p, e)
    """


_CHAIN = ", ".join(
    f"a{k} AS MATERIALIZED ({_nearest(f'b{k}')}), b{k + 1} AS MATERIALIZED ({_means(f'a{k}', f'b{k}')})"
    for k in range(ROUNDS_13)
)

OP13 = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, label,
           list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS whole
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT r, vec_id, p, whole[p * len(whole) // 8 + 1 : (p + 1) * len(whole) // 8] AS v
    FROM kept, (SELECT unnest(range(8))::INT AS p)
), b0 AS MATERIALIZED (
    SELECT p, (dense_rank() OVER (ORDER BY vec_id) - 1)::INT AS e, v AS c
    FROM parts WHERE r IN (SELECT r FROM kept ORDER BY vec_id LIMIT 16)
), {_CHAIN}, last AS MATERIALIZED ({_nearest(f'b{ROUNDS_13}')}), coded AS (
    SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM last GROUP BY r
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{ROUNDS_13}) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""

ORACLES = {
    "op3_quality_rules": OP3, "op5_url_filter": OP5, "op7_mixing": OP7, "op13_vector_codes": OP13,
}
