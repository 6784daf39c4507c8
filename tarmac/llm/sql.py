"""SQL for the queries whose results SQL can express."""

from __future__ import annotations

# Phrases of two and three words by language, as counted word by word.
COLLOCATIONS = r"""
WITH docs AS (
    SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents WHERE text IS NOT NULL
),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
numbered AS (SELECT lang, row_number() OVER () AS id, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
spread AS (SELECT lang, id, unnest(words) AS a, generate_subscripts(words, 1) AS place FROM numbered),
runs AS (
    SELECT lang, a, lead(a, 1) OVER (PARTITION BY id ORDER BY place) AS b, lead(a, 2) OVER (PARTITION BY id ORDER BY place) AS c FROM spread
),
f1 AS (SELECT lang, a, count(*) AS f FROM runs GROUP BY ALL),
f2 AS (SELECT lang, a, b, count(*) AS f FROM runs WHERE b IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, a, b, c, count(*) AS f FROM runs WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang),
longer AS (
    SELECT lang, a, b, max(f) AS f FROM (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3) GROUP BY lang, a, b
),
pairs AS (
    SELECT p.lang, p.a || ' ' || p.b AS phrase, p.f AS a, x.f AS l, y.f AS r, 1000000::HUGEINT * p.f * p.f // (x.f::HUGEINT * y.f) AS score
    FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.a = p.a JOIN f1 y ON y.lang = p.lang AND y.a = p.b
    LEFT JOIN longer g ON g.lang = p.lang AND g.a = p.a AND g.b = p.b
    WHERE p.f >= 10 AND (g.f IS NULL OR 100 * g.f < 50 * p.f)
),
cuts AS (
    SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c AS phrase, t.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2,
        1000000::HUGEINT * t.f * t.f // (x.f::HUGEINT * yz.f) AS s1, 1000000::HUGEINT * t.f * t.f // (xy.f::HUGEINT * z.f) AS s2
    FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.a = t.a JOIN f1 z ON z.lang = t.lang AND z.a = t.c
    JOIN f2 xy ON xy.lang = t.lang AND xy.a = t.a AND xy.b = t.b JOIN f2 yz ON yz.lang = t.lang AND yz.a = t.b AND yz.b = t.c
),
scored AS (
    SELECT lang, phrase, a, l, r, score FROM pairs
    UNION ALL
    SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cuts
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
