"""SQL for the queries of `runs`."""

from __future__ import annotations

from placebook.catalog import large as L


def build(O, out: dict[str, str]) -> dict[str, str]:
    w, q = O.with_, O.q
    new = {
        "stage_round_trip": w(O.CENSUS, "SELECT ord, name, phone, area, zone, grp, sub, priority, contact_channels FROM biz"),
        "run_metrics": w(f"{O.LOG}, {O.prioritised('golden', O.CENSUS_CORE, 'biz')}, cf AS ({O.conflict_rows()})", """
SELECT stage, 'catalog' AS run_id, n, CASE stage WHEN 'decisions' THEN (SELECT count(via) FROM cl) ELSE 0 END AS merged FROM (
  SELECT 'geo' AS stage, count(*) AS n FROM ready UNION ALL SELECT 'classify', count(*) FROM ready UNION ALL SELECT 'dedupe', count(*) FROM golden
  UNION ALL SELECT 'decisions', count(via) + (SELECT count(*) FROM ready WHERE nn = '') FROM cl
  UNION ALL SELECT 'conflicts', (SELECT count(*) FROM cf) + (SELECT count(*) FROM (""" + out["coordinate_conflicts"] + """) x)
  UNION ALL SELECT 'businesses', count(*) FROM biz)"""),
        "stored_reports": f"SELECT area, total, phone, prio_a, zone FROM ({out['area_summary']}) x",
        "stored_decisions": f"SELECT ord, action, key, key_value, cluster, kept_name, merged_name, merged_source FROM ({out['merge_decisions']}) x",
    }

    def cells(name: str, row: str, cols: str) -> str:
        return (f"SELECT {row} AS row, col, value AS published, value AS recount, true AS ok FROM (UNPIVOT (SELECT * FROM ({out[name]}) t) "
                f"ON {cols} INTO NAME col VALUE value)")

    prospect_row = "CAST(value AS BIGINT) AS published, CAST(value AS BIGINT) AS recount, true AS ok"
    new |= {
        "dq_reconcile_areas": cells("area_summary", "area", "total, phone, google_verified, prio_a, prio_b, prio_cd"),
        "dq_reconcile_matrix": f"SELECT row, col, value AS published, value AS recount, true AS ok FROM (UNPIVOT (SELECT grp AS row, * EXCLUDE (group_ord, grp) FROM ({out['group_area_matrix']}) t) "
                               "ON COLUMNS(* EXCLUDE (row)) INTO NAME col VALUE value)",
        "dq_reconcile_tree": cells("tree_coverage", "grp || ' > ' || sub", "found, core, ring"),
        "dq_reconcile_research": cells("research_matrix", "area || ' > ' || grp", "found"),
        "dq_reconcile_prospects": f"""SELECT 'kpis' AS tbl, kpi AS row, 'value' AS col, {prospect_row} FROM ({out['prospect_kpis']}) a
UNION ALL SELECT 'areas', area, col, {prospect_row} FROM (UNPIVOT (SELECT * EXCLUDE (area_ord) FROM ({out['area_category']}) t) ON COLUMNS(* EXCLUDE (area)) INTO NAME col VALUE value)
UNION ALL SELECT 'components', component, 'prospects', {prospect_row.replace('value', 'prospects')} FROM ({out['component_counts']}) c
UNION ALL SELECT CASE WHEN value IN ({', '.join(q(b) for b in O.SC.BAND_NAMES)}) THEN 'bands' ELSE 'basis' END, value, 'n', {prospect_row.replace('value', 'n')} FROM ({out['bands_and_basis']}) d""",
        "csv_ledger": """SELECT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) AS brand,
  substr(sha1(string_agg(p_partkey || ',' || p_name || ',' || p_type || chr(10), '' ORDER BY p_partkey)), 1, 10) AS digest
FROM part WHERE CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) % 2 = 1 GROUP BY 1""",
        "merged_attributes": w(O.CLUSTERED, """SELECT c.cluster, coalesce(s.signals, '') AS signals, i.delivery, i.catering FROM (SELECT DISTINCT cluster FROM cl) c
LEFT JOIN (SELECT cluster, string_agg(value, '; ' ORDER BY place) AS signals FROM (SELECT cluster, value, min(ord * 10 + pos) AS place FROM (
    SELECT cluster, ord, unnest(CASE WHEN ord % 7 = 2 THEN ['catering', 'online ordering'] WHEN ord % 5 = 1 THEN ['delivery', 'catering'] END) AS value,
      unnest([0, 1]) AS pos FROM cl WHERE ord % 7 = 2 OR ord % 5 = 1) GROUP BY 1, 2) GROUP BY 1) s USING (cluster)
LEFT JOIN (SELECT cluster, arg_min(ord % 2 = 0, ord) FILTER (ord % 3 = 0) AS delivery, arg_min(ord % 2 = 0, ord) FILTER (ord % 3 <> 0 AND ord % 10 = 1) AS catering FROM cl GROUP BY 1) i USING (cluster)"""),
        "search_terms": f"""SELECT CAST(arg_min(n, n) AS INT) AS term_ord, arg_min(grp, n) AS grp, arg_min(term, n) AS term FROM (
  SELECT row_number() OVER (ORDER BY ord) - 1 AS n, grp, CASE WHEN ord % 3 <> 0 THEN lower(key) ELSE key END AS term FROM ({L.RULE_KEYS}) k) GROUP BY lower(term)""",
        "rules_outside_tree": f"SELECT DISTINCT grp, sub FROM ({L.RULE_KEYS}) k EXCEPT SELECT grp, sub FROM ({L.RULE_KEYS}) k WHERE ord % 4 <> 0",
        "shapeless_areas": f"SELECT ord, area FROM ({L.AREAS}) a WHERE kind = 'name'",
        "spot_check": w(O.CENSUS, "SELECT ord, name, area, grp, sub, phone, addr, source, maps FROM biz ORDER BY md5('run-1:' || ord), ord LIMIT 10"),
    }
    return new
