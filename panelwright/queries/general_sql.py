"""SQL of the general queries for a second engine."""

from __future__ import annotations

_NUM = "TRY_CAST(trim({c}, ' \t\r\n') AS DECIMAL(38,10))"


def _id(c: str) -> str:
    n = _NUM.format(c=c)
    return f"CASE WHEN {n} > 0 AND {n} = floor({n}) THEN CAST({n} AS BIGINT) END"


def _code(c: str) -> str:
    n = _NUM.format(c=c)
    s = f"trim({c}, ' \t\r\n')"
    return f"CASE WHEN {s} IS NULL OR {s} IN ('', '.') OR {n} < 0 THEN NULL WHEN {n} IS NOT NULL THEN CAST(CAST({n} AS DOUBLE) AS VARCHAR) ELSE lower({s}) END"


def _date(c: str) -> str:
    s = f"trim({c}, ' \t\r\n')"
    forms = ["%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%m/%d/%Y", "%d-%b-%Y"]
    tried = ", ".join(f"try_strptime({s}, '{f}')" for f in forms)
    return f"coalesce(strftime(coalesce({tried}, CASE WHEN regexp_full_match({s}, '(19|20)[0-9]{{6}}') THEN try_strptime({s}, '%Y%m%d') END), '%Y-%m-%d'), {_code(c)})"


CURRENT = """cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ipeds_year, unitid ORDER BY coalesce(regexp_matches(lower(ipeds_source_member), '_rv?\\.[a-z]+$'), FALSE) DESC, loaded_at DESC, idx_sfa DESC NULLS LAST, idx_f DESC NULLS LAST) AS rn FROM ipeds_directory WHERE ipeds_year IS NOT NULL AND unitid IS NOT NULL) WHERE rn = 1)"""

_HISTORY = f"""WITH {CURRENT}, v AS (SELECT unitid, ipeds_year AS y, {_code('opeflag')} AS a, {_code('newid')} AS b, {_code('deathyr')} AS c, {_date('closedat')} AS e FROM cur),
 g AS (SELECT *, y - dense_rank() OVER (PARTITION BY unitid ORDER BY y) AS run, CASE WHEN lag(y) OVER w = y - 1 AND lag(a) OVER w IS NOT DISTINCT FROM a AND lag(b) OVER w IS NOT DISTINCT FROM b AND lag(c) OVER w IS NOT DISTINCT FROM c AND lag(e) OVER w IS NOT DISTINCT FROM e THEN 0 ELSE 1 END AS starts FROM v WINDOW w AS (PARTITION BY unitid ORDER BY y)),
 n AS (SELECT *, SUM(starts) OVER (PARTITION BY unitid ORDER BY y) AS version FROM g)
 SELECT unitid, CAST(MIN(y) AS INTEGER) AS valid_from, CAST(MAX(y) AS INTEGER) AS valid_to FROM n GROUP BY unitid, version"""



def _code_text(c: str) -> str:
    n = _NUM.format(c=c)
    s = f"trim({c}, ' \t\r\n')"
    return f"CASE WHEN {s} IS NULL OR {s} IN ('', '.') OR {n} < 0 THEN NULL WHEN {n} IS NOT NULL THEN regexp_replace(regexp_replace(CAST({n} AS VARCHAR), '0+$', ''), '\\.$', '') ELSE lower({s}) END"


_VERSIONS = _HISTORY.replace(_code("opeflag"), _code_text("opeflag")).replace(_code("newid"), _code_text("newid")).replace(_code("deathyr"), _code_text("deathyr")).replace(_code("closedat"), _code_text("closedat")).replace(
    "CAST(MAX(y) AS INTEGER) AS valid_to FROM", "CAST(MAX(y) AS INTEGER) AS valid_to, MIN(a) AS opeflag, MIN(b) AS newid, MIN(c) AS deathyr, MIN(e) AS closedat, CAST(COUNT(*) AS INTEGER) AS n_periods FROM"
)

_LINKS = f"""{CURRENT}, claim AS (SELECT 'sfa' AS component, ipeds_year, unitid, {_id('idx_sfa')} AS parent FROM cur UNION ALL SELECT 'f', ipeds_year, unitid, {_id('idx_f')} FROM cur),
 edge AS (SELECT c.* FROM claim c JOIN cur p ON p.ipeds_year = c.ipeds_year AND p.unitid = c.parent WHERE c.parent <> c.unitid),
 node AS (SELECT component, ipeds_year, unitid FROM edge UNION SELECT component, ipeds_year, parent FROM edge)"""

_TREE = f"""WITH RECURSIVE {_LINKS}, walk AS (SELECT n.component, n.ipeds_year, n.unitid, n.unitid AS here, 0 AS depth, [n.unitid] AS seen, FALSE AS loop FROM node n
 UNION ALL SELECT w.component, w.ipeds_year, w.unitid, e.parent, w.depth + 1, list_append(w.seen, e.parent), list_contains(w.seen, e.parent) FROM walk w JOIN edge e ON e.component = w.component AND e.ipeds_year = w.ipeds_year AND e.unitid = w.here WHERE NOT w.loop),
 ends AS (SELECT *, row_number() OVER (PARTITION BY component, ipeds_year, unitid ORDER BY depth DESC) AS r FROM walk)
 SELECT component, ipeds_year, unitid, CASE WHEN loop THEN list_min(list_slice(seen, list_position(seen, here), len(seen))) ELSE here END AS root_unitid,
 CAST(CASE WHEN NOT loop THEN depth WHEN list_contains(list_slice(seen, list_position(seen, here), len(seen)), unitid) THEN -1 ELSE -2 END AS INTEGER) AS tree_depth FROM ends WHERE r = 1"""

_BELOW = _TREE.replace("WITH RECURSIVE ", "WITH RECURSIVE ", 1).rpartition(" SELECT component, ipeds_year, unitid, CASE WHEN loop")[0]
_PATHS = f"""{_BELOW}, told AS (SELECT component, ipeds_year, unitid, loop AND list_contains(list_slice(seen, list_position(seen, here), len(seen)), unitid) AS ring, CASE WHEN loop THEN list_min(list_slice(seen, list_position(seen, here), len(seen))) ELSE here END AS root, loop FROM ends WHERE r = 1),
 up AS (SELECT e.* FROM edge e JOIN told c USING (component, ipeds_year, unitid) JOIN told p ON p.component = e.component AND p.ipeds_year = e.ipeds_year AND p.unitid = e.parent WHERE NOT c.ring AND NOT p.ring),
 anc AS (SELECT component, ipeds_year, unitid, unitid AS here, 0 AS dist, [unitid] AS path FROM told WHERE NOT ring UNION ALL SELECT a.component, a.ipeds_year, a.unitid, u.parent, a.dist + 1, list_prepend(u.parent, a.path) FROM anc a JOIN up u ON u.component = a.component AND u.ipeds_year = a.ipeds_year AND u.unitid = a.here),
 size AS (SELECT component, ipeds_year, here AS unitid, COUNT(*) AS n FROM anc GROUP BY component, ipeds_year, here),
 full_ AS (SELECT component, ipeds_year, unitid, arg_max(path, dist) AS path, MAX(dist) AS depth FROM anc GROUP BY component, ipeds_year, unitid),
 nd AS (SELECT t.component, t.ipeds_year, t.unitid, t.root, t.loop, u.parent, s.n, f.path, f.depth, CASE WHEN u.parent IS NOT NULL THEN row_number() OVER (PARTITION BY t.component, t.ipeds_year, u.parent ORDER BY s.n DESC, t.unitid) = 1 END AS heavy FROM told t JOIN size s USING (component, ipeds_year, unitid) JOIN full_ f USING (component, ipeds_year, unitid) LEFT JOIN up u USING (component, ipeds_year, unitid)),
 st AS (SELECT *, CASE WHEN heavy THEN 1 WHEN parent IS NULL THEN CASE WHEN loop THEN coalesce(SUM(n) OVER (PARTITION BY component, ipeds_year, root, parent IS NULL, loop ORDER BY unitid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE 0 END
 ELSE 1 + MAX(CASE WHEN heavy THEN n END) OVER (PARTITION BY component, ipeds_year, parent) + coalesce(SUM(CASE WHEN heavy THEN 0 ELSE n END) OVER (PARTITION BY component, ipeds_year, parent ORDER BY unitid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS step FROM nd),
 pos AS (SELECT component, ipeds_year, unitid, unitid AS head, 0 AS at, CAST(step AS BIGINT) AS spot FROM st WHERE parent IS NULL UNION ALL SELECT s.component, s.ipeds_year, s.unitid, CASE WHEN s.heavy THEN p.head ELSE s.unitid END, CASE WHEN s.heavy THEN p.at + 1 ELSE 0 END, CAST(p.spot + s.step AS BIGINT) FROM pos p JOIN st s ON s.component = p.component AND s.ipeds_year = p.ipeds_year AND s.parent = p.unitid)"""

_PANEL = """mp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY panel_row_id ORDER BY loaded_at DESC) AS rn FROM master_panel) WHERE rn = 1),
 cell AS (SELECT feed_no, load_seq, load_id, 'merge_status' AS field_name, merge_status AS v, NULL::DOUBLE AS x FROM mp UNION ALL SELECT feed_no, load_seq, load_id, 'has_usable_fsa_record', has_usable_fsa_record, NULL FROM mp
 UNION ALL SELECT feed_no, load_seq, load_id, 'grant__pell_recipients', CAST(grant__pell_recipients AS VARCHAR), grant__pell_recipients FROM mp),
 c AS (SELECT *, x IS NOT NULL AND NOT isnan(x) AND x >= 0 AND x = floor(x) AS whole, v IS NOT NULL AND CASE field_name WHEN 'merge_status' THEN v NOT IN ('matched','ipeds_only') WHEN 'has_usable_fsa_record' THEN v NOT IN ('True','False') ELSE isnan(x) OR x < 0 OR x <> floor(x) END AS bad FROM cell),
 per AS (SELECT feed_no, load_seq, load_id, field_name, COUNT(*) AS n, COUNT(*) - COUNT(v) AS nulls, COUNT(DISTINCT v) AS d, SUM(bad::INT) AS bad, MAX(CASE WHEN whole THEN x END) AS top, median(CASE WHEN whole THEN x END) AS med FROM c GROUP BY 1, 2, 3, 4),
 seq AS (SELECT *, lag(load_id) OVER w AS prev, lag(n) OVER w AS pn, lag(nulls) OVER w AS pnulls, lag(top) OVER w AS ptop, lag(med) OVER w AS pmed FROM per WINDOW w AS (PARTITION BY feed_no, field_name ORDER BY load_seq)),
 share AS (SELECT load_id, field_name, v, COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER (PARTITION BY load_id, field_name) AS s FROM c WHERE v IS NOT NULL GROUP BY 1, 2, 3),
 tv AS (SELECT q.load_id, q.field_name, SUM(abs(coalesce(a.s, 0) - coalesce(b.s, 0))) / 2 AS t FROM seq q JOIN (SELECT DISTINCT field_name, v FROM share) u ON u.field_name = q.field_name LEFT JOIN share a ON a.load_id = q.load_id AND a.field_name = q.field_name AND a.v = u.v LEFT JOIN share b ON b.load_id = q.prev AND b.field_name = q.field_name AND b.v = u.v
 WHERE q.prev IS NOT NULL AND q.field_name <> 'grant__pell_recipients' AND q.n > q.nulls AND q.pn > q.pnulls GROUP BY 1, 2)"""

_FINDINGS = f"""WITH {_PANEL} SELECT load_id, field_name, 'pattern' AS finding FROM seq WHERE bad > 0 UNION ALL SELECT load_id, field_name, 'constant' FROM seq WHERE d = 1
 UNION ALL SELECT load_id, field_name, 'null_rate' FROM seq WHERE prev IS NOT NULL AND abs(nulls::DOUBLE / n - pnulls::DOUBLE / pn) > 0.201
 UNION ALL SELECT load_id, field_name, 'distribution' FROM tv WHERE t > 0.251
 UNION ALL SELECT load_id, field_name, 'distribution' FROM seq WHERE field_name = 'grant__pell_recipients' AND prev IS NOT NULL AND (med > 2.5 * pmed OR pmed > 2.5 * med)
 UNION ALL SELECT load_id, field_name, 'value_range' FROM seq WHERE field_name = 'grant__pell_recipients' AND top > 20 * ptop"""

_NUMBERS = ["panel_row_id", "unitid", "ipeds_year", "fsa_year_offset", "grant__pell_recipients", "grant__pell_disbursements"]
_TEXTS = ["merge_status", "has_usable_fsa_record", "grant__opeid8", "grant__pell_recipients__status", "grant__pell_recipients__raw_token", "loaded_at"]
_ALL = " UNION ALL ".join(
    [f"SELECT feed_no, load_seq, load_id, '{c}' AS field_name, CASE WHEN isnan({c}::DOUBLE) THEN 'NaN' ELSE CAST({c} AS VARCHAR) END AS v, CAST({c} AS DOUBLE) AS x FROM mp" for c in _NUMBERS]
    + [f"SELECT feed_no, load_seq, load_id, '{c}', CAST({c} AS VARCHAR), NULL FROM mp" for c in _TEXTS]
)
_CELLS = f"""mp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY panel_row_id ORDER BY loaded_at DESC) AS rn FROM master_panel) WHERE rn = 1), cell AS ({_ALL}),
 c AS (SELECT *, x IS NOT NULL AND NOT isnan(x) AND x >= 0 AND x = floor(x) AS whole, v IS NOT NULL AND CASE field_name WHEN 'merge_status' THEN v NOT IN ('matched','ipeds_only') WHEN 'has_usable_fsa_record' THEN v NOT IN ('True','False') WHEN 'grant__pell_recipients' THEN isnan(x) OR x < 0 OR x <> floor(x) ELSE FALSE END AS bad FROM cell)"""

_PROFILE = f"""WITH {_CELLS} SELECT feed_no, load_seq, load_id, field_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(v) AS n_null, COUNT(*) FILTER (isnan(x)) AS n_nan, COUNT(DISTINCT v) AS n_distinct, COUNT(*) FILTER (bad) AS n_violations,
 MIN(x) FILTER (NOT isnan(x)) AS min_number, MAX(x) FILTER (NOT isnan(x)) AS max_number, MIN(v) AS min_value, MAX(v) AS max_value, MAX(x) FILTER (whole) AS max_whole, COUNT(*) FILTER (whole) AS n_whole FROM c GROUP BY feed_no, load_seq, load_id, field_name"""

_CHANGES = f"""WITH {_CELLS}, per AS (SELECT feed_no, load_seq, load_id, field_name, COUNT(*) AS n, COUNT(*) - COUNT(v) AS nulls FROM c GROUP BY ALL), seq AS (SELECT *, lag(load_id) OVER w AS prev, lag(n) OVER w AS pn, lag(nulls) OVER w AS pnulls FROM per WINDOW w AS (PARTITION BY feed_no, field_name ORDER BY load_seq)),
 freq AS (SELECT load_id, field_name, v, COUNT(*) AS k FROM c WHERE v IS NOT NULL GROUP BY ALL), both_ AS (SELECT q.load_id, q.field_name, f.v, f.k AS a, 0 AS b FROM seq q JOIN freq f ON f.load_id = q.load_id AND f.field_name = q.field_name UNION ALL SELECT q.load_id, q.field_name, f.v, 0, f.k FROM seq q JOIN freq f ON f.load_id = q.prev AND f.field_name = q.field_name),
 met AS (SELECT load_id, field_name, v, SUM(a) AS a, SUM(b) AS b FROM both_ GROUP BY ALL), tot AS (SELECT load_id, field_name, SUM(a) AS na, SUM(b) AS nb FROM met GROUP BY ALL),
 sh AS (SELECT m.load_id, m.field_name, t.na, t.nb, m.a / t.na AS p, m.b / t.nb AS q, greatest(m.a / t.na, 1e-4) AS pf, greatest(m.b / t.nb, 1e-4) AS qf FROM met m JOIN tot t ON t.load_id = m.load_id AND t.field_name = m.field_name WHERE t.na > 0 AND t.nb > 0),
 d AS (SELECT load_id, field_name, SUM(abs(p - q)) / 2 AS tv, SUM((pf - qf) * ln(pf / qf)) AS psi, SUM((p - q) * (p - q) / (p + q)) * MAX(na) * MAX(nb) * 2 / (MAX(na) + MAX(nb)) AS chi FROM sh GROUP BY ALL)
 SELECT s.feed_no, s.load_seq, s.load_id, s.field_name, round(nulls / n - pnulls / pn, 9) AS null_rate_change, round(tv, 9) AS total_variation, round(psi, 9) AS stability_index, round(chi, 6) AS chi_square FROM seq s LEFT JOIN d ON d.load_id = s.load_id AND d.field_name = s.field_name"""

_REFS = f"""{CURRENT}, fam AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY loaded_at DESC) AS rn FROM family_records) WHERE rn = 1),
 ref AS (SELECT 'ipeds_directory' AS source_table, 'idx_sfa' AS field_name, ipeds_year AS ref_year, unitid AS record_key, {_id('idx_sfa')} AS ref_unitid FROM cur UNION ALL SELECT 'ipeds_directory', 'idx_f', ipeds_year, unitid, {_id('idx_f')} FROM cur
 UNION ALL SELECT 'family_records', 'unitid', TRY_CAST(substr(trim(award_year), 1, 4) AS INTEGER), record_id, CASE WHEN unitid >= 0 THEN unitid END FROM fam),
 span AS (SELECT unitid, MIN(ipeds_year) AS a, MAX(ipeds_year) AS b FROM cur GROUP BY unitid),
 orphan AS (SELECT r.*, CASE WHEN s.unitid IS NULL THEN 'never' WHEN s.a > r.ref_year THEN 'not_yet' WHEN s.b < r.ref_year THEN 'gone' ELSE 'gap' END AS kind FROM ref r LEFT JOIN cur d ON d.unitid = r.ref_unitid AND d.ipeds_year = r.ref_year LEFT JOIN span s ON s.unitid = r.ref_unitid WHERE r.ref_unitid IS NOT NULL AND r.ref_year IS NOT NULL AND d.unitid IS NULL)"""

SQL = {
    "p2_found": _TREE,
    "p2_loops": f"SELECT component, ipeds_year, unitid, tree_depth = -1 AS on_loop, root_unitid AS loop_root FROM ({_TREE}) WHERE tree_depth < 0",
    "p2_tree": f"{_PATHS} SELECT s.component, s.ipeds_year, s.unitid, s.root AS root_unitid, CAST(CASE WHEN s.loop THEN -2 ELSE s.depth END AS INTEGER) AS tree_depth, array_to_string(s.path, '/') AS path, s.n - 1 AS n_descendants, p.head, CAST(p.at AS INTEGER) AS at, p.spot AS first_position, p.spot + s.n - 1 AS last_position FROM st s JOIN pos p USING (component, ipeds_year, unitid)",
    "p2_descendants": f"{_PATHS} SELECT component, ipeds_year, here AS unitid, unitid AS descendant, CAST(dist AS INTEGER) AS distance FROM anc WHERE dist > 0",
    "p3_found": _HISTORY,
    "p3_history": _VERSIONS,
    "p4_profile": _PROFILE,
    "p4_changes": _CHANGES,
    "p4_found": _FINDINGS,
    "p5_found": f"WITH {_REFS} SELECT source_table, field_name, CAST(ref_year AS INTEGER) AS ref_year, record_key, ref_unitid, kind FROM orphan",
    "p5_report": f"WITH {_REFS} SELECT source_table, field_name, CAST(ref_year AS INTEGER) AS ref_year, kind, COUNT(*) AS n_references, COUNT(DISTINCT ref_unitid) AS n_units FROM orphan GROUP BY ALL",
}
