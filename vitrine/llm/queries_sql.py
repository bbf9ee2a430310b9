"""DuckDB SQL of the corpus operators that SQL can express, over whole tables."""

from __future__ import annotations

DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
tok AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs FROM tok GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS total FROM c GROUP BY ALL HAVING sum(docs) >= 30),
v AS (SELECT lang, count(*) AS v, sum(total) AS lang_total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
cell AS (SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n FROM g JOIN kept k USING (lang)
         LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sized AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS group_total FROM cell),
shares AS (SELECT s.lang, s.source, s.term, s.n,
                  1 + (1000000000 * (s.n + 5)::HUGEINT) // (s.group_total + 5 * v.v)::HUGEINT AS p,
                  1 + (1000000000 * (s.total + 5)::HUGEINT) // (v.lang_total + 5 * v.v)::HUGEINT AS q FROM sized s JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
          UNION ALL
          SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= 50
"""


def assigned(name: str, book: str) -> str:
    """Each part beside the nearest entry of its codebook, the lower index of equals."""
    return f"""{name} AS (SELECT vec_id, part, entry, distance FROM (
    SELECT x.vec_id, x.part, b.entry, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x.v, b.v)]) AS distance
    FROM parts x JOIN {book} b USING (part)) QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY distance, entry) = 1)"""


def moved(name: str, book: str, found: str) -> str:
    """Each used entry at the floor of the mean of its parts; the others stay."""
    return f"""{name}_sum AS (SELECT a.part, a.entry, t.i, CAST(sum(x.v[t.i]) AS HUGEINT) AS s, count(*) AS n
    FROM {found} a JOIN parts x USING (vec_id, part), (SELECT unnest(range(1, (SELECT any_value(len(v)) + 1 FROM parts))) AS i) t
    GROUP BY ALL),
{name}_used AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM {name}_sum GROUP BY ALL),
{name} AS (SELECT b.part, b.entry, coalesce(u.v, b.v) AS v FROM {book} b LEFT JOIN {name}_used u USING (part, entry))"""


CODES = f"""
WITH kept AS (SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
parts AS (SELECT vec_id, p AS part, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS v
    FROM kept, (SELECT unnest(range(16)) AS p) t),
ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 64),
book0 AS (SELECT part, entry, v FROM ids JOIN parts USING (vec_id)),
{assigned("near0", "book0")},
{moved("book1", "book0", "near0")},
{assigned("near1", "book1")},
{moved("book2", "book1", "near1")},
{assigned("near2", "book2")},
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2),
coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(distance) AS BIGINT) AS error
    FROM near2 GROUP BY vec_id)
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, d.codebooks_sha256
FROM coded c JOIN kept k USING (vec_id), digest d
"""
