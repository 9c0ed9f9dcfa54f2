"""DuckDB SQL for the queries that SQL can express."""

from terrace.llm import quality_rules as R

_W = r"\x20\x09-\x0D"


def _count(chars: str) -> str:
    return f"CAST(length(t) - length(regexp_replace(t, '{chars}', '', 'g')) AS BIGINT)"


def op9() -> str:
    bits = " + ".join(f"CASE WHEN {cond} THEN {1 << k} ELSE 0 END" for k, (_, cond) in enumerate(R.RULES))
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
words AS (SELECT rid, regexp_extract_all(t, '[^{_W}]+') AS w FROM texts),
windows AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
again AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM again CROSS JOIN (VALUES (0), (1), (2)) x(k) GROUP BY rid),
lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
          FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM texts)
          WHERE regexp_matches(line, '[^{_W}]') GROUP BY rid),
measured AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, {_count(f'[^{_W}]')} AS word_chars,
  {_count('[#*$%&|<>]')} AS n_symbols, coalesce(n_lines, 0) AS n_lines,
  CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
  {_count(chr(92) + 'p{Lu}')} AS n_upper, {_count(chr(92) + 'p{L}')} AS n_letters, {_count('!')} AS n_marks
  FROM texts JOIN words USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN lines USING (rid)),
judged AS (SELECT *, CAST({bits} AS BIGINT) AS failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failed & {R.mask_of(R.BASE)}) != 0 AS base_failed, (failed & {R.mask_of(R.POLICIES['v2'])}) = 0 AS kept, failed
FROM judged"""


def op11() -> str:
    fails = " ".join(f"WHEN contains(failed, filter_order[{k}]) THEN {k}" for k in range(1, 6))
    return f"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
words AS (SELECT *, regexp_extract_all(t, '[^{_W}]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM texts),
judged AS (SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad, concat(
    CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
    CASE WHEN 100 * {_count('[A-Z]')} > 2 * length(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > first_id THEN 'E' END) AS failed FROM words LEFT JOIN marks USING (doc_id)),
sets AS (SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE bad) AS n_bad
         FROM judged GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
           FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
gone AS (SELECT part, filter_order, failed, n, n_good, n_bad, CASE {fails} ELSE 6 END AS fell FROM sets, orders),
cells AS (SELECT part, filter_order, step, filter_order[step] AS f,
    coalesce(sum(n) FILTER (WHERE fell > step), 0) AS kept, coalesce(sum(n) FILTER (WHERE fell = step), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE fell < step AND contains(failed, filter_order[step])), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE failed = filter_order[step]), 0) AS unique_fails,
    coalesce(sum(n_good) FILTER (WHERE fell = step), 0) AS good_lost, coalesce(sum(n_bad) FILTER (WHERE fell = step), 0) AS toxic_lost
    FROM gone, (SELECT unnest(range(1, 6)) AS step) GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM cells"""


def op12() -> str:
    window = " || ' ' || ".join(f"w[i + {k}]" if k else "w[i]" for k in range(13))
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^{_W}]+') AS w FROM documents),
windows AS (SELECT rid, doc_id, i, {window} AS g
            FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM texts WHERE len(w) >= 13)),
late AS (SELECT rid, i FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY g)),
cut AS (SELECT DISTINCT rid, i + k AS i FROM late CROSS JOIN (SELECT unnest(range(0, 13)) AS k)),
places AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM texts),
kept AS (SELECT rid, string_agg(w[i], ' ' ORDER BY i) AS t, count(*) AS n FROM places ANTI JOIN cut USING (rid, i) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256 FROM texts LEFT JOIN kept USING (rid)"""


def op13() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    runs = " UNION ALL ".join(f"SELECT lang, array_slice(w, i, i + {m - 1}) AS p FROM (SELECT lang, w, "
                              f"unnest(range(1, len(w) - {m - 2})) AS i FROM pieces WHERE len(w) >= {m})" for m in (1, 2, 3, 4))
    cuts = " UNION ALL ".join(f"SELECT lang, p, a, {k} AS k, array_slice(p, 1, {k}) AS head, array_slice(p, {k + 1}, len(p)) AS tail "
                              f"FROM cands WHERE len(p) > {k}" for k in (1, 2, 3))
    inner = " UNION ALL ".join(f"SELECT lang, array_slice(p, {s}, {s + m - 1}) AS p, a AS longer FROM cands WHERE len(p) >= {max(s + m - 1, m + 1)}"
                               for m in (2, 3) for s in range(1, 6 - m))
    return f"""
WITH pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (SELECT coalesce(lang, 'und') AS lang,
  unnest(string_split_regex({lower}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
counts AS (SELECT lang, p, count(*) AS a FROM ({runs}) GROUP BY lang, p),
cands AS (SELECT * FROM counts WHERE len(p) > 1 AND a >= 30),
cuts AS ({cuts}),
scored AS (SELECT c.lang, c.p, c.a, c.k, x.a AS l, y.a AS r, (2000000 * CAST(c.a AS HUGEINT)) // (x.a + y.a) AS score FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.p = c.head JOIN counts y ON y.lang = c.lang AND y.p = c.tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (SELECT lang, p, max(longer) AS longer FROM ({inner}) GROUP BY lang, p),
ranked AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM best JOIN totals USING (lang)
  LEFT JOIN inside USING (lang, p) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked
QUALIFY rank <= 2000"""
