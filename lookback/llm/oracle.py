"""DuckDB forms of the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parts AS (SELECT page_id, row_number() OVER () AS rid,
  CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
urls AS (SELECT page_id, rid, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
fits AS (SELECT u.rid, r.host || r.path AS rule, r.verdict FROM urls u JOIN rules r
  ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)),
best AS (SELECT rid, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN best USING (rid)
"""



def _op10(cycles: int = 12, targets: tuple = (("source", 0.8), ("lang", 0.9), ("topic", 0.9)), seed: int = 7) -> str:
    """Raking unrolled: one CTE per cycle and dimension."""
    def share(mark: str) -> str:
        return f"CAST(length(text) - length(replace(text, '{mark}', '')) AS DOUBLE) / length(text)"

    out = [f"""docs AS (SELECT doc_id, source, lang, coalesce(source, '(null)') AS d_source, coalesce(lang, '(null)') AS d_lang,
  CASE WHEN text IS NULL OR length(text) = 0 THEN 'empty' WHEN {share('|')} > 0.02 THEN 'table' WHEN {share('!')} > 0.05 THEN 'shout'
  WHEN {share('#')} + {share('%')} + {share('$')} > 0.05 THEN 'symbols' WHEN length(text) <= 500 THEN 'brief' ELSE 'prose' END AS d_topic,
  len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r]+'), lambda w: w != '')) + 1 AS tokens FROM documents)""",
           "c0 AS (SELECT d_source, d_lang, d_topic, sum(tokens) AS tokens, CAST(sum(tokens) AS DOUBLE) AS mass FROM docs GROUP BY ALL)"]
    last = 0
    for d, t in targets:
        out.append(f"t_{d} AS (SELECT d_{d}, g / sum(g) OVER () * (SELECT sum(tokens) FROM c0) AS goal FROM "
                   f"(SELECT d_{d}, pow(sum(tokens), {t}) AS g FROM c0 GROUP BY d_{d}))")
    for _ in range(cycles):
        for d, _ in targets:
            out.append(f"c{last + 1} AS MATERIALIZED (SELECT c.* EXCLUDE (mass), mass * goal / sum(mass) OVER (PARTITION BY d_{d}) AS mass "
                       f"FROM c{last} c JOIN t_{d} USING (d_{d}))")
            last += 1
    return "WITH " + ",\n".join(out) + f"""
SELECT doc_id, source, lang, d_topic AS topic, tokens, round(weight, 6) AS weight, round(weight / top, 6) AS probability,
  CAST(CAST('0x' || substr(md5('{seed}/' || coalesce(CAST(doc_id AS VARCHAR), '(null)')), 1, 13) AS BIGINT) AS DOUBLE) / pow(16, 13) < weight / top AS kept
FROM (SELECT d.*, mass / c.tokens AS weight FROM docs d JOIN c{last} c USING (d_source, d_lang, d_topic)), (SELECT max(mass / tokens) AS top FROM c{last})
"""


ORACLE_SQL = {"op1_url_rules": OP1, "op10_mixing": _op10()}
