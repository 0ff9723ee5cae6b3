"""DuckDB SQL for every registered query (the correctness oracle).

Each statement starts from the demo views written in DuckDB's dialect (the
same shapes as ``sources/demo.py``) and states the reference semantics
directly: per-file DISTINCT, ``UNION ALL`` of years, ``NOT IN`` subqueries,
left joins with ``IS NOT DISTINCT FROM`` for the claims and coverage flags.
The grid and the matrix are written the slow way, one (condition, year) pair
at a time, so they also check the single-pass plan.
"""

from __future__ import annotations

from lookback.sources.code_text import STRIP_CHARS
from lookback.sources.demo import (DEMO_CODEBOOK, EXCL_CODEBOOK, FIRST_YEAR, LAST_YEAR,
                                   REF_YEAR, WORDS_CODEBOOK, wide_codebook)

Y, F0, L = REF_YEAR, FIRST_YEAR, LAST_YEAR
YEARS = list(range(F0, L + 1))
HIT_LO, HIT_HI = Y - 2, Y
OVERLAP_CODES = ["worthless", "idiot", "clown", "de"]

ADM = """adm AS (
  SELECT o_orderkey AS adm_id, o_custkey AS bene_id, o_orderdate AS admission_date,
         CAST(year(o_orderdate) AS INT) AS file_year,
         coalesce(list(p_brand ORDER BY l_linenumber, l_partkey, p_brand)
                  FILTER (WHERE p_brand IS NOT NULL), []) AS diagnoses
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
              LEFT JOIN part ON p_partkey = l_partkey
  GROUP BY o_orderkey, o_custkey, o_orderdate)"""

BENE = """bene AS (
  SELECT o_custkey AS bene_id, CAST(year(o_orderdate) AS INT) AS year,
         CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS INT) AS hmo_mo
  FROM orders GROUP BY 1, 2)"""

PX = """px AS (
  SELECT adm_id, bene_id, admission_date, file_year,
         CAST(generate_subscripts(diagnoses, 1) - 1 AS INT) AS pos, unnest(diagnoses) AS diag
  FROM adm)"""


def _words(code: str = "x") -> str:
    """The views over documents under the same names; ``code`` is an expression on a word ``x``."""
    return f"""adm AS (
  SELECT doc_id AS adm_id, o_custkey AS bene_id, o_orderdate AS admission_date,
         CAST(year(o_orderdate) AS INT) AS file_year, o_orderpriority AS priority,
         list_transform(string_split(text, ' '), lambda x: {code}) AS diagnoses
  FROM documents LEFT JOIN orders ON o_orderkey = doc_id),
bene AS (
  SELECT bene_id, file_year AS year, sum(CASE WHEN priority = '1-URGENT' THEN 0.5 ELSE 0 END) AS hmo_mo
  FROM adm WHERE file_year IS NOT NULL GROUP BY 1, 2)"""


def _with_words(*extra: str, code: str = "x") -> str:
    return "WITH " + ",\n".join([_words(code), PX, *extra]) + "\n"


def _with(*extra: str) -> str:
    return "WITH " + ",\n".join([ADM, BENE, PX, *extra]) + "\n"


def _q(codes) -> str:
    return ", ".join("'" + str(c).replace("'", "''") + "'" for c in dict.fromkeys(codes))


def lists(entry: dict, exclusion_codes: str = "compat"):
    """(include, exclude, ref_period, rule) of a codebook entry."""
    inc = list(entry.get("icd9") or []) + list(entry.get("icd10") or [])
    e9, e10 = list(entry.get("icd9_exclusion") or []), list(entry.get("icd10_exclusion") or [])
    if exclusion_codes == "all":
        exc = e9 + e10
    elif e9 and e10:
        exc = e9 + e10
    elif e10:
        exc = e10[:1]
    else:
        exc = []
    return inc, exc, int(entry["ref_period"]), entry.get("claims_criteria", "all")


def _hit_where(rule: str, inc) -> tuple[str, str]:
    i = _q(inc)
    if rule == "all":
        return "px", f"diag IN ({i})"
    if rule == "primary":
        return "adm", f"diagnoses[1] IN ({i})"
    return "adm", f"(diagnoses[1] IN ({i}) OR diagnoses[2] IN ({i}))"


def met_sql(entry: dict, ref_year: int, scope: str = "oldest_year", first_year: int = F0,
            exclusion_codes: str = "compat") -> str:
    inc, exc, p, rule = lists(entry, exclusion_codes)
    lo = max(ref_year - p + 1, first_year)
    src, cond = _hit_where(rule, inc)
    hit = f"SELECT DISTINCT bene_id FROM {src} WHERE {cond} AND file_year BETWEEN {lo} AND {ref_year}"
    if not exc:
        return f"SELECT bene_id, 1 AS met FROM ({hit}) h GROUP BY bene_id"
    ehi = lo if scope == "oldest_year" else ref_year
    return (f"SELECT bene_id, 1 AS met FROM ({hit}) h WHERE bene_id NOT IN "
            f"(SELECT bene_id FROM px WHERE diag IN ({_q(exc)}) AND file_year BETWEEN {lo} AND {ehi}) "
            f"GROUP BY bene_id")


def cov_sql(p: int, ref_year: int, first_year: int = F0) -> str:
    lo = max(ref_year - p + 1, first_year)
    return (f"SELECT bene_id, CAST(CASE WHEN sum(hmo_mo) = 0 THEN 1 ELSE 0 END AS INT) AS cov "
            f"FROM bene WHERE year BETWEEN {lo} AND {ref_year} GROUP BY bene_id")


def ever_sql(entry: dict, ref_year: int, scope: str = "history", first_year: int = F0) -> str:
    inc, _, p, _ = lists(entry)
    lo = first_year if scope == "history" else max(ref_year - p + 1, first_year)
    not_null = " AND bene_id IS NOT NULL" if scope == "history" else ""
    return (f"SELECT bene_id, min(admission_date) AS ever FROM px WHERE diag IN ({_q(inc)}) "
            f"AND file_year BETWEEN {lo} AND {ref_year}{not_null} GROUP BY bene_id")


STATUS = ("CAST(CASE WHEN coalesce(m.met, 0) = 0 AND c.cov = 0 THEN 0 "
          "WHEN coalesce(m.met, 0) = 1 AND c.cov = 0 THEN 1 "
          "WHEN coalesce(m.met, 0) = 0 AND c.cov = 1 THEN 2 ELSE 3 END AS INT)")


def pair_sql(cond: str, entry: dict, ref_year: int, scope: str = "oldest_year",
             ever_scope: str = "history", parts: bool = False, first_year: int = F0,
             exclusion_codes: str = "compat") -> str:
    _, _, p, _ = lists(entry)
    ever_on = "b.bene_id = e.bene_id" if ever_scope == "history" else "b.bene_id IS NOT DISTINCT FROM e.bene_id"
    if parts:
        cols = (f"b.bene_id, CAST(b.year AS INT) AS rfrnc_yr, CAST(coalesce(m.met, 0) AS INT) AS met, "
                f"c.cov AS cov, {STATUS} AS status")
    else:
        cols = f"b.bene_id, CAST(b.year AS INT) AS rfrnc_yr, {STATUS} AS {cond}, e.ever AS {cond}_ever"
    return (f"SELECT {cols} FROM bene b "
            f"LEFT JOIN ({met_sql(entry, ref_year, scope, first_year, exclusion_codes)}) m "
            f"ON b.bene_id IS NOT DISTINCT FROM m.bene_id "
            f"LEFT JOIN ({cov_sql(p, ref_year, first_year)}) c ON b.bene_id IS NOT DISTINCT FROM c.bene_id "
            f"LEFT JOIN ({ever_sql(entry, ref_year, ever_scope, first_year)}) e ON {ever_on} "
            f"WHERE b.year = {ref_year}")


def grid_sql(book: dict, years, scope: str = "oldest_year", exclusion_codes: str = "compat") -> str:
    parts = [f"SELECT bene_id, rfrnc_yr, '{c}' AS condition, {c} AS status, {c}_ever AS ever "
             f"FROM ({pair_sql(c, e, y, scope, exclusion_codes=exclusion_codes)}) g"
             for c, e in book.items() for y in years]
    return "\nUNION ALL\n".join(parts)


def matrix_year_sql(book: dict, ref_year: int) -> str:
    names = list(book)
    first = names[0]
    cols = [f"t_{first}.bene_id"]
    for c in reversed(names):
        cols += [f"t_{c}.{c}", f"t_{c}.{c}_ever"]
    cols.append(f"CAST({ref_year} AS INT) AS rfrnc_yr")
    src = f"({pair_sql(first, book[first], ref_year)}) t_{first}"
    for c in names[1:]:
        src += f" JOIN ({pair_sql(c, book[c], ref_year)}) t_{c} ON t_{c}.bene_id = t_{first}.bene_id"
    return f"SELECT {', '.join(cols)} FROM {src}"


def _codes_values(book: dict) -> str:
    rows = []
    for c, e in book.items():
        inc, exc, p, rule = lists(e)
        rows += [f"('{c}', {p}, '{rule}', 'include', '{x}')" for x in dict.fromkeys(inc)]
        rows += [f"('{c}', {p}, '{rule}', 'exclude', '{x}')" for x in dict.fromkeys(exc)]
    return ("codes(condition, ref_period, criteria, kind, code) AS (VALUES "
            + ", ".join(rows) + ")")


def _sql() -> dict[str, str]:
    d, x = DEMO_CODEBOOK, EXCL_CODEBOOK
    c1, c2, c3 = d["c1"], d["c2"], d["c3"]
    hits = {}
    for key, entry in (("q_hits_all", c1), ("q_hits_primary", c2), ("q_hits_first_two", c3)):
        inc, _, _, rule = lists(entry)
        src, cond = _hit_where(rule, inc)
        hits[key] = (_with() + f"SELECT DISTINCT bene_id, admission_date, file_year FROM {src} "
                     f"WHERE {cond} AND file_year BETWEEN {HIT_LO} AND {HIT_HI}")
    c1_inc = _q(lists(c1)[0])
    stats_body = (f"SELECT bene_id, min(admission_date) AS min_adm_date, max(admission_date) AS max_adm_date, "
                  f"count(diag) AS n FROM (SELECT DISTINCT bene_id, admission_date, file_year, diag FROM px "
                  f"WHERE diag IN ({c1_inc}) AND file_year BETWEEN {HIT_LO} AND {HIT_HI}) s GROUP BY bene_id")
    spine = f"SELECT bene_id, CAST(year AS INT) AS rfrnc_yr FROM bene WHERE year = {Y}"
    overlap = f"list_has_any(diagnoses, [{_q(OVERLAP_CODES)}])"
    strip = " || ".join(f"chr({ord(c)})" for c in STRIP_CHARS)
    w = WORDS_CODEBOOK
    up = {k: {f: [x.replace(".", "").upper() for x in v] if isinstance(v, list) else v for f, v in e.items()} for k, e in w.items()}

    def word_hits(entry: dict) -> str:
        inc, _, _, rule = lists(entry)
        src, cond = _hit_where(rule, inc)
        return f"SELECT DISTINCT bene_id, admission_date, file_year FROM {src} WHERE {cond} AND file_year BETWEEN {HIT_LO} AND {HIT_HI}"

    unique = ("SELECT CAST(count(DISTINCT bene_id) + coalesce(max(CASE WHEN bene_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) "
              "AS n_unique")
    out = {
        "q_scan_year": _with() + "SELECT adm_id, bene_id, admission_date, file_year FROM adm WHERE file_year = 1998",
        "q_scan_window": _with() + f"SELECT adm_id, bene_id, file_year FROM adm WHERE file_year BETWEEN {Y - 2} AND {Y}",
        "q_union_years": _with() + "\nUNION ALL\n".join(
            f"SELECT adm_id, bene_id, file_year FROM adm WHERE file_year = {y}" for y in range(F0, 1998)),
        "q_codebook": _with(_codes_values(d)) + (
            "SELECT k.condition, CAST(k.ref_period AS INT) AS ref_period, k.criteria, k.kind, k.code, "
            "CAST(coalesce(n.n_events, 0) AS BIGINT) AS n_events FROM codes k LEFT JOIN "
            "(SELECT diag AS code, count(*) AS n_events FROM px GROUP BY diag) n ON n.code = k.code"),
        "q_code_text": (
            "SELECT doc_id, CAST(ord - 1 AS INT) AS code_pos, code FROM ("
            f"SELECT doc_id, t.ord, trim(t.piece, {strip}) AS code "
            "FROM documents, unnest(string_split(text, ',')) WITH ORDINALITY AS t(piece, ord)) s "
            "WHERE length(code) > 0"),
        "q_spine": _with() + spine,
        "q_unnest": _with_words() + "SELECT adm_id, bene_id, file_year, pos, diag AS code FROM px",
        "q_overlap": _with_words() + (f"SELECT adm_id, bene_id, file_year, CAST(len(diagnoses) AS INT) AS n_codes "
                                f"FROM adm WHERE {overlap}"),
        **hits,
        "q_met_all": _with() + met_sql(c1, Y),
        "q_met_primary": _with() + met_sql(c2, Y),
        "q_met_first_two": _with() + met_sql(c3, Y),
        "q_met_excl": _with() + met_sql(x["x1"], Y),
        "q_met_excl_window": _with() + met_sql(x["x1"], Y, "window"),
        "q_met_excl_all": _with() + met_sql(c3, Y, "window", exclusion_codes="all"),
        "q_array_hits_all": _with_words() + word_hits(w["w1"]),
        "q_array_hits_primary": _with_words() + word_hits(w["w2"]),
        "q_array_hits_first_two": _with_words() + word_hits(w["w3"]),
        "q_array_met_primary": _with_words() + met_sql(w["w2"], Y, "window", exclusion_codes="all"),
        "q_array_met_first_two": _with_words() + met_sql(w["w3"], Y, exclusion_codes="all"),
        "q_array_pair_all": _with_words() + pair_sql("w1", w["w1"], Y),
        "q_array_pair_primary": _with_words() + pair_sql("w2", w["w2"], Y, "window", exclusion_codes="all"),
        "q_array_pair_first_two": _with_words() + pair_sql("w3", w["w3"], Y, exclusion_codes="all"),
        "q_array_pair_normalized": _with_words(code="upper(replace(x, '.', ''))") + pair_sql("w2", up["w2"], Y),
        "q_grid_window": _with() + grid_sql(d, YEARS, "window", "all"),
        "q_grid_arrays": _with_words() + grid_sql(w, range(F0, Y + 1), "window", "all"),
        "q_ever": _with() + ever_sql(c1, Y),
        "q_coverage": _with() + cov_sql(2, Y),
        "q_covered_ids": _with() + f"SELECT bene_id FROM ({cov_sql(2, Y)}) c WHERE cov = 1",
        "q_event_stats": _with() + stats_body,
        "q_unique_count": _with() + (
            f"{unique} FROM ({hits['q_hits_all'][len(_with()):]}) h"),
        "q_unique_count_none": _with_words() + f"{unique} FROM ({word_hits(w['w4'])}) h",
        "q_member_flag": _with(f"stats AS ({stats_body})", f"sp AS ({spine})") + (
            "SELECT sp.bene_id, sp.rfrnc_yr, CAST(CASE WHEN EXISTS (SELECT 1 FROM stats s WHERE "
            "s.bene_id IS NOT DISTINCT FROM sp.bene_id) THEN 1 ELSE 0 END AS INT) AS flag FROM sp"),
        "q_member_count": _with(f"stats AS ({stats_body})", f"sp AS ({spine})", f"cv AS ({cov_sql(2, Y)})") + (
            "SELECT (SELECT count(*) FROM cv WHERE EXISTS (SELECT 1 FROM sp WHERE sp.bene_id IS NOT DISTINCT "
            "FROM cv.bene_id)) AS n_cov_in_spine, (SELECT count(*) FROM stats s WHERE EXISTS (SELECT 1 FROM sp "
            "WHERE sp.bene_id IS NOT DISTINCT FROM s.bene_id)) AS n_hits_in_spine"),
        "q_step_counts": _with() + "\nUNION ALL\n".join([
            f"SELECT 'spine' AS step, count(*) AS n_rows, CAST(2 AS INT) AS n_cols FROM ({spine}) a",
            f"SELECT 'met' AS step, count(*) AS n_rows, CAST(2 AS INT) AS n_cols FROM ({met_sql(c2, Y)}) a",
            f"SELECT 'cov' AS step, count(*) AS n_rows, CAST(2 AS INT) AS n_cols FROM ({cov_sql(2, Y)}) a",
            f"SELECT 'ever' AS step, count(*) AS n_rows, CAST(2 AS INT) AS n_cols FROM ({ever_sql(c2, Y)}) a"]),
        "q_limit": _with_words() + f"SELECT adm_id, bene_id FROM adm WHERE {overlap} ORDER BY adm_id LIMIT 10",
        "q_status": _with() + pair_sql("c2", c2, Y, parts=True),
        "q_pair_all": _with() + pair_sql("c1", c1, Y),
        "q_pair_primary": _with() + pair_sql("c2", c2, Y),
        "q_pair_first_two": _with() + pair_sql("c3", c3, Y),
        "q_pair_excl": _with() + pair_sql("x1", x["x1"], Y),
        "q_pair_excl_window": _with() + pair_sql("x1", x["x1"], Y, scope="window"),
        "q_pair_window_ever": _with() + pair_sql("c1", c1, Y, ever_scope="window"),
        "q_grid_status": _with() + grid_sql(d, YEARS),
        "q_grid_summary": _with() + (
            "SELECT condition, rfrnc_yr, status, count(*) AS n, count(ever) AS n_ever FROM ("
            + grid_sql(d, YEARS) + ") g GROUP BY condition, rfrnc_yr, status"),
        "q_grid_k27": _with() + grid_sql(wide_codebook(), YEARS),
        "q_matrix_year": _with() + matrix_year_sql(d, Y),
        "q_matrix_all": _with() + "\nUNION ALL\n".join(matrix_year_sql(d, y) for y in YEARS),
        "q_matrix_k27": _with() + matrix_year_sql(wide_codebook(), Y),
        "q_merge_chain": _with() + matrix_year_sql(d, Y),
        "q_merge_bucketed": _with() + matrix_year_sql(d, Y),
        "q_grid_state": _with() + grid_sql(d, YEARS),
        "q_matrix_state": _with() + matrix_year_sql(wide_codebook(), Y),
        "q_read_years": _with() + f"SELECT bene_id, year, CAST(CASE WHEN year = {F0} THEN NULL ELSE hmo_mo END AS BIGINT) AS hmo_mo, "
                                  f"CAST(CASE WHEN year > {Y} THEN hmo_mo / 2.0 END AS DOUBLE) AS half_mo, year AS file_year FROM bene",
        "q_write_years": _with() + "\nUNION ALL\n".join(matrix_year_sql(d, y) for y in range(Y - 2, Y + 1)),
        "q_write_csv": _with() + "\nUNION ALL\n".join(matrix_year_sql(d, y) for y in range(Y - 1, Y + 1)),
        "q_write_arrow": _with() + pair_sql("c2", c2, Y),
    }
    return out


ORACLE_SQL = _sql()
