"""SQL of the queries on drifting schemas for a second engine: plain joins over all pairs, no blocking."""

from __future__ import annotations


def _label(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[\\s\\x{{85}}\\x{{a0}}]+', ' ', 'g'))"


def _canonical(c: str) -> str:
    s = f"lower(trim({c}, ' \t\r\n'))"
    bare = f"replace(replace({s}, '$', ''), ',', '')"
    number = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({bare}, '^\\+?(-?)0*(\\d)', '\\1\\2'), '(\\.\\d*?)0+$', '\\1'), '\\.$', ''), '^-0$', '0')"
    return f"""CASE WHEN {s} IN ('', '*', '-', '.', 'n/a', 'na', '<10', '< 10', 'none', 'null') THEN NULL WHEN {s} IN ('true', 'yes', 'y') THEN '1' WHEN {s} IN ('false', 'no', 'n') THEN '0'
 WHEN regexp_full_match({bare}, '[+-]?\\d+(\\.\\d*)?') THEN {number} ELSE {s} END"""


def _words(c: str) -> str:
    return f"array_to_string(list_sort(string_split(trim(regexp_replace(regexp_replace({c}, '^[a-z]+(_[a-z]+)?__', ''), '[^a-z0-9]+', ' ', 'g')), ' ')), '')"


_ID = "regexp_full_match(v, '\\s*0{0,2}[1-9]\\d{5,7}(\\.0*)?\\s*') AND TRY_CAST(trim(v) AS DOUBLE) < 100000000 AND TRY_CAST(trim(v) AS DOUBLE) % 100 <= 20"

CELLS = f"""raw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY report_row_id ORDER BY loaded_at DESC) AS rn FROM raw_reports) WHERE rn = 1),
 cell AS (SELECT r.report_row_id AS id, r.series_id AS s, TRY_CAST(substr(trim(r.award_year), 1, 4) AS INTEGER) AS y, {_label('e.key')} AS h, e.value ->> '$' AS v,
 CASE WHEN e.type IN ('UBIGINT', 'BIGINT', 'HUGEINT') THEN 'integer' WHEN e.type = 'DOUBLE' THEN 'decimal' WHEN e.type = 'BOOLEAN' THEN 'boolean' WHEN e.type <> 'NULL' THEN 'string' END AS t FROM raw r, json_each(r.payload) e)"""

_FIELDS = f"""{CELLS}, facts AS (SELECT s, y, h, t, COUNT(t) AS n, COUNT(*) FILTER ({_ID}) AS ids FROM cell GROUP BY s, y, h, t),
 top AS (SELECT s, y, h, arg_max(t, (n, t)) FILTER (n > 0) AS tag, SUM(ids) AS ids FROM facts GROUP BY s, y, h),
 listed AS (SELECT series_id AS s, TRY_CAST(substr(trim(award_year), 1, 4) AS INTEGER) AS y, {_label('source_column')} AS h, {_label('sheet')} AS sheet FROM schema_availability UNION ALL SELECT s, y, h, NULL FROM top),
 col0 AS (SELECT s, y, h, list(DISTINCT sheet ORDER BY sheet) FILTER (sheet IS NOT NULL) AS sheets FROM listed WHERE s IS NOT NULL AND y IS NOT NULL AND h <> '' GROUP BY s, y, h),
 file AS (SELECT s, y, lag(y) OVER w AS py, lead(y) OVER w AS ny FROM (SELECT DISTINCT s, y FROM col0) WINDOW w AS (PARTITION BY s ORDER BY y)),
 col AS (SELECT c.*, f.py, f.ny, t.tag, coalesce(t.ids, 0) AS ids FROM col0 c JOIN file f USING (s, y) LEFT JOIN top t USING (s, y, h)),
 came AS (SELECT a.s, a.y, a.py, a.h FROM col a WHERE a.py IS NOT NULL AND NOT EXISTS (SELECT 1 FROM col b WHERE b.s = a.s AND b.y = a.py AND b.h = a.h)),
 went AS (SELECT a.s, a.ny AS y, a.y AS py, a.h FROM col a WHERE a.ny IS NOT NULL AND NOT EXISTS (SELECT 1 FROM col b WHERE b.s = a.s AND b.y = a.ny AND b.h = a.h)),
 canon AS (SELECT c.*, {_canonical('v')} AS k FROM cell c WHERE t IS NOT NULL),
 idc AS (SELECT c.s, c.y, c.h, COUNT(k) AS n, COUNT(k) FILTER ({_ID}) AS i, COUNT(DISTINCT k) AS d FROM canon c JOIN col USING (s, y, h) WHERE col.ids > 0 GROUP BY c.s, c.y, c.h),
 idh AS (SELECT s, y, CASE WHEN COUNT(*) = 1 THEN MAX(h) ELSE arg_max(h, ((i / n) * d / n, -length(h), h)) END AS h FROM idc GROUP BY s, y),
 unit AS (SELECT c.id, c.s, c.y, MIN(k) AS u FROM canon c JOIN idh USING (s, y, h) GROUP BY c.id, c.s, c.y),
 val AS (SELECT c.s, c.y, c.h, u.u, MAX(c.k) AS k FROM canon c JOIN unit u ON u.id = c.id AND u.s = c.s AND u.y = c.y WHERE c.k IS NOT NULL AND u.u IS NOT NULL GROUP BY c.s, c.y, c.h, u.u),
 both_ AS (SELECT a.s, a.y, a.py, o.h AS old, a.h AS new, COUNT(w.u) AS n, AVG(CASE WHEN TRY_CAST(v.k AS DOUBLE) > 0 AND TRY_CAST(w.k AS DOUBLE) > 0 THEN (abs(ln(TRY_CAST(v.k AS DOUBLE) / TRY_CAST(w.k AS DOUBLE))) < 0.35)::INT WHEN w.k IS NOT NULL THEN (v.k = w.k)::INT END) AS share
 FROM came a JOIN went o ON o.s = a.s AND o.y = a.y LEFT JOIN val v ON v.s = a.s AND v.y = a.y AND v.h = a.h LEFT JOIN val w ON w.s = a.s AND w.y = a.py AND w.h = o.h AND w.u = v.u GROUP BY a.s, a.y, a.py, o.h, a.h),
 judged AS (SELECT *, 1 - levenshtein({_words('old')}, {_words('new')}) / greatest(length({_words('old')}), length({_words('new')}), 1) AS likeness FROM both_),
 ok AS (SELECT *, row_number() OVER (PARTITION BY s, y, old ORDER BY coalesce(share, 0) DESC, likeness DESC, old, new) AS r1, row_number() OVER (PARTITION BY s, y, new ORDER BY coalesce(share, 0) DESC, likeness DESC, old, new) AS r2 FROM judged WHERE CASE WHEN n >= 3 THEN share >= 0.6 ELSE likeness >= 0.75 END),
 ren AS (SELECT s, y, old, new FROM ok WHERE r1 = 1 AND r2 = 1),
 lnk AS (SELECT c.*, coalesce(r.old, p.h) AS ph FROM col c LEFT JOIN ren r ON r.s = c.s AND r.y = c.y AND r.new = c.h LEFT JOIN col p ON p.s = c.s AND p.y = c.py AND p.h = c.h)"""

_FOUND = f"""WITH {_FIELDS}, met AS (SELECT c.s, c.y, c.h, c.py, c.ph, c.tag, c.sheets, p.tag AS tag0, p.sheets AS sheets0 FROM lnk c LEFT JOIN col p ON p.s = c.s AND p.y = c.py AND p.h = c.ph)
 SELECT s AS series_id, y AS award_year_start, 'added' AS change_kind, h AS source_column, '' AS previous_column FROM met WHERE py IS NOT NULL AND ph IS NULL
 UNION ALL SELECT s, y, 'renamed', h, ph FROM met WHERE ph <> h UNION ALL SELECT s, y, 'retyped', h, ph FROM met WHERE ph IS NOT NULL AND tag <> tag0
 UNION ALL SELECT s, y, 'moved', h, ph FROM met WHERE ph IS NOT NULL AND len(sheets) > 0 AND len(sheets0) > 0 AND sheets <> sheets0
 UNION ALL SELECT a.s, a.ny, 'removed', '', a.h FROM col a LEFT JOIN lnk n ON n.s = a.s AND n.y = a.ny AND n.ph = a.h WHERE a.ny IS NOT NULL AND n.h IS NULL"""

_ALTERNATIVES = f"""WITH RECURSIVE {_FIELDS}, fld AS (SELECT s, y, h, ny, h AS field, y AS since FROM lnk WHERE ph IS NULL UNION ALL SELECT l.s, l.y, l.h, l.ny, f.field, f.since FROM fld f JOIN lnk l ON l.s = f.s AND l.y = f.ny AND l.ph = f.h),
 alt AS (SELECT f.s, f.field, f.since, x.t AS tag, SUM(x.n) AS n, MIN(f.y) AS a, MAX(f.y) AS b, COUNT(DISTINCT f.h) AS hs FROM fld f JOIN facts x ON x.s = f.s AND x.y = f.y AND x.h = f.h WHERE x.n > 0 GROUP BY f.s, f.field, f.since, x.t)
 SELECT s AS series_id, field, CAST(since AS INTEGER) AS since, tag, CAST(n AS BIGINT) AS n_cells, CAST(a AS INTEGER) AS first_year, CAST(b AS INTEGER) AS last_year, hs AS n_headers, a > MIN(a) OVER (PARTITION BY s, field, since) AS appeared FROM alt"""

SQL = {
    "p1_found": _FOUND,
    "p1_alternatives": _ALTERNATIVES,
    "p1_cells_kept": f"WITH {CELLS} SELECT t AS tag, COUNT(*) AS n_read, COUNT(*) AS n_found FROM cell WHERE t IS NOT NULL GROUP BY t",
}
