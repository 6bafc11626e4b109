"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from . import quality, secrets
from .quality import COMMON_WORDS, MARKS, MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE, MIN_CHARS, MIN_COMMON

GAP = r"[\x20\x09-\x0D]+"
SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WORDS = f"""words AS (SELECT doc_id, lang, coalesce(text, '') AS t,
  list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}'), lambda x: x <> '') AS ws FROM documents)"""


def _secrets() -> str:
    """Positions are running sums of the gaps between matches and the matches."""
    found = []
    for rank, r in enumerate(secrets.RULES):
        p = _quoted(r.pattern)
        found.append(f"""SELECT doc_id, {rank} AS r, '{r.kind}' AS k, ms,
          regexp_split_to_array(t, {p}) AS gaps,
          unnest(list_filter(range(1, len(ms) + 1), lambda i: length(chk[i]) >= {r.least})) AS i
          FROM (SELECT doc_id, t, regexp_extract_all(t, {p}, 0) AS ms, regexp_extract_all(t, {p}, {r.checked}) AS chk
                FROM docs WHERE regexp_matches(t, {p}))""")
    kinds = [r.kind for r in secrets.BASE_RULES]
    counts = ", ".join(f"count(*) FILTER (k = '{k}') AS n_{k}" for k in kinds)
    base = ", ".join(f"'{k}'" for k in kinds)
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(found)}),
placed AS (SELECT doc_id, r, k, len(ms[i]) AS n,
  list_sum(list_transform(gaps[1:i], lambda x: length(x)))
  + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s
  FROM found),
spans AS (SELECT doc_id, {counts},
  coalesce(string_agg(k || ':' || s || ':' || (s + n), ',' ORDER BY s, r) FILTER (k IN ({base})), '') AS base,
  string_agg(k || ':' || s || ':' || (s + n), ',' ORDER BY s, r) AS spans
  FROM (SELECT doc_id, r, k, s::BIGINT AS s, n::BIGINT AS n FROM placed) GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in kinds)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN spans USING (doc_id)"""


RELATIVE_LZ = f"""
WITH {WORDS},
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM words),
later AS (SELECT doc_id, i FROM (
  SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(ws[i:i + 19], ' ') ORDER BY doc_id, i) AS n
  FROM starts) WHERE n > 1),
covered AS (SELECT doc_id, list(DISTINCT i + k) AS gone FROM later, range(0, 20) AS r(k) GROUP BY doc_id),
kept AS (SELECT doc_id, ws, coalesce(gone, []) AS gone,
  list_filter(ws, lambda x, j: NOT list_contains(coalesce(gone, []), j)) AS left_ FROM words LEFT JOIN covered USING (doc_id))
SELECT doc_id, len(ws)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(left_, ' '), '')) AS kept_sha256
FROM kept"""


def _distance(a: str, b: str) -> str:
    terms = (f"list_transform(list_zip({a}, {b}), lambda z: {{'x': z[1] / list_sum({a}), 'y': z[2] / list_sum({b})}})")
    half = "(CASE WHEN z.{0} > 0 THEN z.{0} * log2(z.{0} / ((z.x + z.y) / 2)) ELSE 0.0 END) / 2"
    return (f"round(sqrt(greatest(list_sum(list_transform({terms}, "
            f"lambda z: {half.format('x')} + {half.format('y')})), 0.0)), 6)")


def _quality() -> str:
    without = lambda c: f"length(regexp_replace(ink, '[{c}]+', '', 'g'))"
    words = ", ".join(f"list_count(list_filter(hits, lambda h: h = {_quoted(w)}))::DOUBLE" for w in COMMON_WORDS)
    bins = ", ".join(_quoted(w) for w in COMMON_WORDS)
    known = ", ".join(_quoted(k) for k in quality.CLASSES_PER_THOUSAND)
    common = lambda k: [quality.COMMON_PER_THOUSAND.get(k, {}).get(w, 0) for w in COMMON_WORDS]
    refs = ", ".join(f"('{k}', {c}::DOUBLE[], {common(k)}::DOUBLE[])" for k, c in
                     [*quality.CLASSES_PER_THOUSAND.items(), (quality.OTHER, quality.OTHER_CLASSES)])
    shares = lambda c, n, least: "[" + ", ".join(
        f"sum({quality.SHARE} * {c}[{i}]::BIGINT // greatest(list_sum({c}), {least})::BIGINT)" for i in range(1, n + 1)) + "]::DOUBLE[]"
    far = lambda a, b, least: f"CASE WHEN list_sum({a}) >= {least} AND list_sum({b}) > 0 THEN {_distance(a, b)} ELSE 0.0 END"
    return f"""
WITH {WORDS},
windows AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM words),
repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i,
  count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 4], ' ')) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(0, 5) AS r(k) GROUP BY doc_id),
inked AS (SELECT doc_id, CASE WHEN l IN ({known}) THEN l ELSE '{quality.OTHER}' END AS lang,
  l AS tag, t, ws, translate(t, {SPACE}, '') AS ink,
  list_filter(list_transform(list_filter(regexp_split_to_array(lower(t), '{GAP}'), lambda x: x <> ''),
    lambda x: rtrim(x, '{MARKS}')), lambda x: x IN ({bins})) AS hits,
  list_filter(string_split(t, chr(10)), lambda x: translate(x, {SPACE}, '') <> '') AS lines
  FROM (SELECT *, lower(split_part(replace(coalesce(lang, ''), '_', '-'), '-', 1)) AS l FROM words)),
parts AS (SELECT *, length(ink) AS n, length(ink) - {without('a-z')} AS lo, length(ink) - {without('A-Z')} AS up,
  length(ink) - {without('0-9')} AS dg, {without(chr(92) + 'x00-' + chr(92) + 'x7F')} AS wide,
  length(ink) - length(translate(ink, '{quality.SYMBOLS}', '')) AS sy FROM inked),
hist AS (SELECT doc_id, lang, tag, len(ws)::BIGINT AS n_words, n::BIGINT AS word_chars,
  (length(t) - length(translate(t, '{quality.SYMBOLS}', '')))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  [lo + CASE WHEN lang = '' THEN wide ELSE 0 END, up, dg, CASE WHEN lang = '' THEN 0 ELSE wide END, sy,
   n - lo - up - dg - wide - sy]::DOUBLE[] AS cls, [{words}] AS com FROM parts),
refs(lang, rcls, rcom) AS (VALUES {refs}),
based AS (SELECT h.*, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
  n_words < 10 OR 100 * coalesce(c.n, 0) > 20 * n_words AS base_failed FROM hist h LEFT JOIN covered c ON c.doc_id = h.doc_id),
judged AS (SELECT b.*, {far('cls', 'rcls', MIN_CHARS)} AS fixed_class, {far('com', 'rcom', MIN_COMMON)} AS fixed_word
  FROM based b JOIN refs USING (lang)),
own AS (SELECT tag, {shares('cls', len(quality.OTHER_CLASSES), MIN_CHARS)} AS ocls, {shares('com', len(COMMON_WORDS), MIN_COMMON)} AS ocom
  FROM judged WHERE NOT base_failed AND fixed_class <= {MAX_CLASS_DISTANCE} AND fixed_word <= {MAX_WORD_DISTANCE} GROUP BY tag),
ruled AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  greatest(fixed_class, {far('cls', 'ocls', MIN_CHARS)}) AS class_distance,
  greatest(fixed_word, {far('com', 'ocom', MIN_COMMON)}) AS word_distance, base_failed
  FROM judged LEFT JOIN own USING (tag))
SELECT *, NOT base_failed AND class_distance <= {MAX_CLASS_DISTANCE} AND word_distance <= {MAX_WORD_DISTANCE} AS kept
FROM ruled"""


LOWER = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"

JACCARD_JOIN = f"""
WITH RECURSIVE docs AS (SELECT doc_id,
  list_filter(regexp_split_to_array({LOWER}, '{GAP}'), lambda x: x <> '') AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(
  CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
       WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM docs)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_ FROM shingles x JOIN shingles y USING (s)
    WHERE x.doc_id <> y.doc_id GROUP BY ALL) AS p
  JOIN sizes u ON u.doc_id = p.a JOIN sizes v ON v.doc_id = p.b
  WHERE 100 * p.both_ >= 80 * (u.n + v.n - p.both_)),
reached AS (SELECT doc_id, doc_id AS r FROM docs UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.r = links.a)
SELECT doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(r) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

FILL_MIDDLE = """
WITH cut AS (SELECT doc_id, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a,
  ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b, ('0x' || h[17:24])::BIGINT % 100 AS c,
  ('0x' || h[25:32])::BIGINT % 100 AS d FROM cut),
parts AS (SELECT doc_id, t, n,
  coalesce(array_to_string(u[1:least(a, b)], ''), '') AS p,
  coalesce(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS m,
  coalesce(array_to_string(u[greatest(a, b) + 1:], ''), '') AS s,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
       WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""


ORACLE_SQL = {
    "op3_secret_scan": _secrets(),
    "op4_relative_lz": RELATIVE_LZ,
    "op7_quality_rules": _quality(),
    "op11_partenum_join": JACCARD_JOIN,
    "op13_fill_middle": FILL_MIDDLE,
}
