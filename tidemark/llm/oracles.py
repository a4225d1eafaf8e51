"""DuckDB statements for the corpus queries that SQL can express."""

from __future__ import annotations

#: Fixed value: a word.
WORD = r"[^\x20\x09-\x0D]+"

LINE_DEDUP = rf"""
WITH lines AS (
    SELECT doc_id, coalesce(text, '') AS text,
        CASE WHEN text <> '' THEN string_split(text, chr(10)) ELSE [] END AS l
    FROM documents
), windows AS (
    SELECT doc_id, i, l[i:i + 2] AS held
    FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM lines)
    WHERE regexp_matches(array_to_string(l[i:i + 2], ' '), '{WORD}')
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY held ORDER BY doc_id, i) AS n FROM windows
), gone AS (
    SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS line FROM ranked WHERE n > 1
), lost AS (
    SELECT doc_id, list(line) AS lost FROM gone GROUP BY doc_id
)
SELECT doc_id, len(l) AS n_lines, coalesce(len(lost), 0) AS n_removed,
    sha256(array_to_string(
        list_filter(l, lambda x, j: lost IS NULL OR NOT list_contains(lost, j)), chr(10)
    )) AS kept_sha256
FROM lines LEFT JOIN lost USING (doc_id)
"""

SUBSTRING_DEDUP = rf"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), windows AS (
    SELECT doc_id, i,
        md5(array_to_string(w[i:i + 34], ' ')) AS m
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words)
), repeats AS (
    SELECT doc_id, i FROM windows
    WHERE m IN (SELECT m FROM windows GROUP BY m HAVING count(*) > 1)
), lost AS (
    SELECT doc_id, list(DISTINCT p) AS lost
    FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM repeats) GROUP BY doc_id
), flagged AS (
    SELECT doc_id, w, coalesce(lost, []) AS lost FROM words LEFT JOIN lost USING (doc_id)
), each AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM flagged
), gone AS (
    SELECT doc_id, unnest(lost) AS p FROM flagged
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
    FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(lost) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM flagged LEFT JOIN kept USING (doc_id)
"""

SUFFIX_DEDUP = """
WITH bytes AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), places AS (
    SELECT doc_id, h, unnest(range(1, strlen(h) // 2 + 1)) AS i FROM bytes
), held AS (
    SELECT doc_id, i, substr(h, 2 * i - 1, 2) AS byte,
        CASE WHEN 2 * i + 98 <= strlen(h) THEN substr(h, 2 * i - 1, 100) END AS s
    FROM places
), firsts AS (
    SELECT s, min(doc_id) AS first FROM held WHERE s IS NOT NULL GROUP BY s
), flagged AS (
    SELECT doc_id, i, byte, coalesce(first < doc_id, FALSE) AS flag
    FROM held LEFT JOIN firsts USING (s)
), marked AS (
    SELECT doc_id, i, byte, bool_or(flag) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
    FROM flagged
), edges AS (
    SELECT *, gone AND NOT coalesce(
        lag(gone) OVER (PARTITION BY doc_id ORDER BY i), FALSE) AS opens
    FROM marked
), counted AS (
    SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
        count(*) FILTER (WHERE opens) AS n_spans,
        string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept
    FROM edges GROUP BY doc_id
)
SELECT doc_id, strlen(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
    coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM bytes LEFT JOIN counted USING (doc_id)
"""

#: N-gram lengths and the percent of characters they may repeat.
NGRAMS = {5: 20, 6: 19, 8: 18, 10: 16}


def _quality_rules() -> str:
    grams = ",\n".join(
        f"""grams{n} AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS nth,
        count(*) OVER (PARTITION BY doc_id, g) AS times
    FROM (SELECT doc_id, i, list_slice(w, i, i + {n - 1}) AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM words))
), dup{n} AS (
    SELECT doc_id, sum(length(word)) AS dup{n} FROM each JOIN (
        SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS p FROM grams{n} WHERE nth > 1
    ) USING (doc_id, p) GROUP BY doc_id
)"""
        for n in NGRAMS
    )
    joins = " ".join(f"LEFT JOIN dup{n} USING (doc_id)" for n in NGRAMS)
    over = " OR ".join(
        f"100 * coalesce(dup{n}, 0) > {percent} * word_chars" for n, percent in NGRAMS.items()
    )
    return rf"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), each AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words
), lines AS (
    SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS nth
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
    WHERE regexp_matches(line, '{WORD}')
), dup_lines AS (
    SELECT doc_id, count(*) AS n_dup_lines,
        sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS line_chars
    FROM lines WHERE nth > 1 GROUP BY doc_id
), {grams}, repeats AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM grams5 WHERE times > 1)
    GROUP BY doc_id
), measured AS (
    SELECT doc_id, len(w) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        100 * coalesce(line_chars, 0) > 30 * word_chars OR {over} AS over
    FROM words LEFT JOIN dup_lines USING (doc_id) LEFT JOIN repeats USING (doc_id) {joins}
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR over OR 100 * n_symbols > 10 * n_words) AS kept
FROM judged
"""


DECONTAMINATION = r"""
WITH plain AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), asked AS (
    SELECT DISTINCT item_id, size, list_slice(w, i, i + size - 1) AS g FROM (
        SELECT item_id, w, least(13, len(w)) AS size,
            unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0)
), windows AS (
    SELECT doc_id, i, size, list_slice(w, i, i + size - 1) AS g FROM (
        SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM plain, (SELECT DISTINCT size FROM asked))
), hits AS (
    SELECT doc_id, i, size, item_id FROM windows JOIN asked USING (size, g)
), words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS all_items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(all_items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM plain LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def _clustering(rounds: int = 3) -> str:
    distance = "list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = ""
    for n in range(rounds + 1):
        steps += f""", a{n} AS (
    SELECT r, vec_id, k.v, c.c, CAST({distance} AS BIGINT) AS d FROM kept k, c{n} c
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c.c) = 1
)"""
        if n < rounds:
            steps += f""", m{n} AS (
    SELECT c, list(CAST(floor_mean AS BIGINT) ORDER BY i) AS v FROM (
        SELECT c, i, (s - ((s % n + n) % n)) // n AS floor_mean FROM (
            SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
            FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n})
            GROUP BY c, i))
    GROUP BY c
), c{n + 1} AS (
    SELECT c, coalesce(m.v, o.v) AS v FROM c{n} o LEFT JOIN m{n} m USING (c)
)"""
    return f"""
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
), c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept
    QUALIFY c < 16
){steps}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance,
    CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (c)
"""


FILTER_AUDIT = rf"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
        min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
    FROM documents
), failed AS (
    SELECT part,
        [len(w) < 100,
         100 * len(list_distinct(w)) < 80 * len(w),
         100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text),
         regexp_matches(text, '[#$%&*|]'),
         coalesce(doc_id > first, FALSE)] AS f,
        coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic
    FROM words LEFT JOIN (
        SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
        FROM labels GROUP BY doc_id) USING (doc_id)
), letters AS (
    SELECT unnest([1, 2, 3, 4, 5]) AS n
), orders AS (
    SELECT [a.n, b.n, c.n, d.n, e.n] AS o
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.n, b.n, c.n, d.n, e.n])) = 5
), steps AS (
    SELECT o, step, o[step] AS own, o[1:step - 1] AS before
    FROM orders, (SELECT n AS step FROM letters)
), patterns AS (
    SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good,
        count(*) FILTER (WHERE toxic) AS toxic
    FROM failed GROUP BY part, f
), judged AS (
    SELECT part, o, step, own, n, good, toxic, f[own] AS fails,
        len(list_filter(before, lambda x: f[x])) > 0 AS gone,
        len(list_filter(f, lambda x: x)) = 1 AS single
    FROM patterns, steps
), counted AS (
    SELECT part, o, step, own,
        coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS kept,
        coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS removed,
        coalesce(sum(n) FILTER (WHERE gone AND fails), 0) AS redundant,
        coalesce(sum(n) FILTER (WHERE fails AND single), 0) AS unique_fails,
        coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0) AS toxic_lost
    FROM judged GROUP BY part, o, step, own
)
SELECT part, array_to_string(list_transform(o, lambda x: 'ABCDE'[x]), '') AS filter_order,
    step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""


MINHASH_DEDUP = rf"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
    FROM documents
), sets AS (
    SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3),
            lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM words
), shingles AS (
    SELECT r, unnest(s) AS g FROM sets
), sizes AS (
    SELECT r, len(s) AS n FROM sets
), shared AS (
    SELECT x.r AS a, y.r AS b, count(*) AS mutual
    FROM shingles x JOIN shingles y ON x.g = y.g AND x.r <> y.r GROUP BY x.r, y.r
), links AS (
    SELECT a, b FROM shared JOIN sizes m ON m.r = a JOIN sizes n ON n.r = b
    WHERE 100 * mutual >= 85 * (m.n + n.n - mutual)
), reached AS (
    SELECT r AS a, r AS b FROM sets
    UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), least AS (
    SELECT a, min(doc_id) AS component_id FROM reached JOIN sets ON sets.r = b GROUP BY a
)
SELECT doc_id, len(s) AS n_shingles, component_id,
    doc_id IS NOT DISTINCT FROM component_id AS kept
FROM sets JOIN least ON a = r
"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op6_suffix_dedup": SUFFIX_DEDUP,
    "op9_quality_rules": _quality_rules(),
    "op10_decontamination": DECONTAMINATION,
    "op11_centroid_clustering": _clustering(),
    "op12_filter_audit": FILTER_AUDIT,
    "op13_minhash_dedup": MINHASH_DEDUP,
}
