"""Independent SQL (DuckDB dialect) for every registered query.

The prelude re-derives staging, star and views from the raw tables with
plain SQL; each query adds its final SELECT. Keys are row_number() over the
same total orders the Spark side uses, so keyed tables compare exactly.
"""

from __future__ import annotations

from vitalmart.constants import (AGGREGATE_REGION, GNI, INCOME_BAND_TEXTS, INCOME_CODES, INCOME_NAMES,
                                 INDICATORS, MORTALITY, NAME_MAP, NO_DATE, NO_INCOME)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def cents_mean(s: str, n: str) -> str:
    return (f"CASE WHEN CAST({n} AS BIGINT) > 0 THEN CAST(CAST((CAST({s} * 100 AS BIGINT) * 2 "
            f"+ CAST({n} AS BIGINT)) // (CAST({n} AS BIGINT) * 2) AS DECIMAL(18,0)) "
            f"* CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END")


def mean(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0)"


def decade_bin(y: str) -> str:
    return (f"CASE WHEN {y} BETWEEN 1960 AND 2018 THEN CAST({y} - ({y} % 10) AS VARCHAR) || 's' "
            f"ELSE CAST({y} AS VARCHAR) END")


def values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(q(v) if isinstance(v, str) else
                                     ("NULL" if v is None else str(v)) for v in r) + ")"
                     for r in rows)
    return f"(SELECT * FROM (VALUES {body}) t({', '.join(cols)}))"


def name_sides() -> str:
    rows = [(k, src, dst) for k, (src, dst) in enumerate(NAME_MAP)]
    return values(rows, ["k", "cause_name", "indicator_name"])


def map_names(c: str) -> str:
    whens = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in NAME_MAP)
    return f"(CASE {c} {whens} ELSE {c} END)"


def income_code(c: str) -> str:
    whens = " ".join(f"WHEN {c} = {q(lbl)} THEN {code}" for lbl, code in INCOME_CODES)
    return f"(CASE {whens} ELSE 0 END)"


def band_lower(v: str) -> str:
    part0 = f"(CASE WHEN regexp_matches({v}, '-|<=') THEN regexp_extract({v}, '^(.*?)(-|<=)', 1) ELSE {v} END)"
    lo = f"replace(replace({part0}, '>', ''), ',', '')"
    return f"(CASE WHEN trim({lo}) = '' THEN CAST(0 AS BIGINT) ELSE TRY_CAST(trim({lo}) AS BIGINT) END)"


def band_upper(v: str) -> str:
    part1 = f"(CASE WHEN regexp_matches({v}, '-|<=') THEN regexp_extract({v}, '(-|<=)(.*)$', 2) END)"
    hi = f"replace({part1}, ',', '')"
    return (f"(CASE WHEN {hi} IS NULL THEN CAST(1000000 AS BIGINT) "
            f"ELSE TRY_CAST(trim({hi}) AS BIGINT) END)")


def band_struct_list() -> str:
    items = ", ".join("{'income': " + q(lbl) + ", 'value': " + q(txt) + "}"
                      for lbl, txt in INCOME_BAND_TEXTS)
    return f"[{items}]"


VIEW_COLS = """fm.metric_id, fm.indicator_name, fm.indicator_metric, fm.date_year, fm.country_key,
  fr.death_metric_id, fr.reason_key, fr.death_reason_metric, dc.country_id, dc.country_name,
  dc.region_name, dc.income_name, dr.reason_id, dr.reason_desc, dd.date_string, dd.date_tens"""

PRELUDE = f"""
-- the one data pass: lines per order, then (nation, year, priority) cells
li AS (SELECT l_orderkey, SUM(CAST(l_quantity AS DECIMAL(12,2))) AS qty, COUNT(*) AS lines
       FROM lineitem GROUP BY l_orderkey),
cells AS (
  SELECT CAST(c.c_nationkey AS INTEGER) AS nationkey, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         o.o_orderpriority AS priority, SUM(li.qty) AS sum_qty,
         CAST(SUM(li.lines) AS BIGINT) AS n_lines,
         SUM(CAST(o.o_totalprice AS DECIMAL(12,2))) AS sum_price, COUNT(*) AS n_orders
  FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2, 3),
-- staging: regions (first appearance), countries (dictionary spellings), lookups
nat AS (SELECT n.n_nationkey, n.n_name, n.n_regionkey, r.r_name
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
names AS {name_sides()},
stg_region AS (SELECT CAST(row_number() OVER (ORDER BY MIN(n_nationkey)) AS INTEGER) AS region_id,
                      trim(r_name) AS region_name FROM nat GROUP BY r_name),
stg_country AS (
  SELECT CAST(nat.n_nationkey + 1 AS INTEGER) AS country_id,
         COALESCE(names.indicator_name, nat.n_name) AS country_name,
         lpad(CAST(nat.n_nationkey AS VARCHAR), 2, '0') AS iso2code,
         'N' || lpad(CAST(nat.n_nationkey AS VARCHAR), 2, '0') AS iso3Code, g.region_id
  FROM nat JOIN stg_region g ON trim(nat.r_name) = g.region_name
  LEFT JOIN names ON names.k = nat.n_nationkey),
income_group AS {values(INCOME_NAMES, ["income_group_id", "income_name"])},
indicator AS {values([(i, n, c) for i, n, c in INDICATORS], ["indicator_id", "indicator_name", "world_bank_ind_id"])},
-- staging: the two indicator series (exact half-up cents), ids in load order
ny AS (SELECT nationkey, year, SUM(sum_qty) AS sum_qty, SUM(n_lines) AS n_lines,
              SUM(sum_price) AS sum_price, SUM(n_orders) AS n_orders FROM cells GROUP BY 1, 2),
series AS (
  SELECT CAST(nationkey + 1 AS INTEGER) AS country_id, year, 1 AS indicator_id,
         {cents_mean('sum_qty', 'n_lines')} AS value
  FROM ny
  UNION ALL
  SELECT CAST(nationkey + 1 AS INTEGER), year, 2, {cents_mean('sum_price', 'n_orders')} FROM ny),
ipc AS (SELECT CAST(row_number() OVER (ORDER BY indicator_id, country_id, year) AS BIGINT)
                 AS indicator_per_country_id, value, CAST(year AS INTEGER) AS year,
               CAST(indicator_id AS INTEGER) AS indicator_id, country_id
        FROM series WHERE value IS NOT NULL),
-- staging: causes, cause values by source spelling, mapped names joined on (name, year)
death_reason AS (SELECT CAST(row_number() OVER (ORDER BY reason_name) AS INTEGER) AS death_reason_id,
                        reason_name FROM (SELECT DISTINCT priority AS reason_name FROM cells)),
rv AS (
  SELECT COALESCE(names.cause_name, nat.n_name) AS name, cells.year, cells.priority AS reason_name,
         {cents_mean('cells.sum_qty', 'cells.n_lines')} AS value_per_reason
  FROM cells JOIN nat ON cells.nationkey = nat.n_nationkey
  LEFT JOIN names ON names.k = cells.nationkey),
u5 AS (SELECT ipc.indicator_per_country_id, c.country_name AS name, ipc.year, ipc.value
       FROM ipc JOIN stg_country c ON ipc.country_id = c.country_id WHERE ipc.indicator_id = 1),
ipcr AS (
  SELECT rv.value_per_reason, d.death_reason_id AS reason_id, u5.indicator_per_country_id
  FROM rv JOIN u5 ON {map_names('rv.name')} = u5.name AND rv.year = u5.year
  JOIN death_reason d ON rv.reason_name = d.reason_name),
-- staging: band texts per year, parsed; GNI values into bands (range join)
band_years AS (SELECT DISTINCT year FROM cells),
bands AS (SELECT year, b.income AS income, b.value AS value
          FROM (SELECT year, unnest({band_struct_list()}) AS b FROM band_years)),
bounds AS (SELECT income, year, {band_lower('value')} AS lower_bound,
                  {band_upper('value')} AS upper_bound FROM bands),
igy AS (SELECT CAST(row_number() OVER (ORDER BY year, income_group_id) AS INTEGER) AS income_group_year_id,
               income_group_id, year, lower_bound, upper_bound, income AS income_group_name
        FROM (SELECT *, CAST({income_code('income')} AS INTEGER) AS income_group_id FROM bounds)),
igc AS (SELECT g.country_id, b.income_group_year_id
        FROM ipc g JOIN igy b ON g.year = b.year AND g.value BETWEEN b.lower_bound AND b.upper_bound
        WHERE g.indicator_id = 2),
-- star: dimensions (yearly snapshots), facts, and the two views
dim_date AS (
  SELECT DISTINCT CAST(year AS INTEGER) AS date_year, CAST(year AS VARCHAR) AS date_string,
         CASE WHEN year >= 1960 AND year < 2030 THEN CAST(year - (year % 10) AS VARCHAR) END AS date_tens
  FROM ipc
  UNION ALL SELECT -1, {q(NO_DATE)}, {q(NO_DATE)}),
income_of AS (
  SELECT igc.country_id, igy.year, max(income_group.income_name) AS income_name
  FROM igc JOIN igy USING (income_group_year_id) JOIN income_group USING (income_group_id)
  GROUP BY igc.country_id, igy.year, income_group.income_group_id),
dim_country AS (
  SELECT CAST(row_number() OVER (ORDER BY id NULLS FIRST, date_year NULLS FIRST,
                                 income_name NULLS FIRST) AS BIGINT) AS country_key,
         CAST(id AS VARCHAR) AS country_id, country_name,
         (SELECT r.region_name FROM stg_region r WHERE r.region_id = s.region_id) AS region_name,
         date_year, income_name
  FROM (SELECT k.country_id AS id, k.country_name, k.region_id, u5.year AS date_year,
               COALESCE(i.income_name, {q(NO_INCOME)}) AS income_name
        FROM u5 JOIN stg_country k ON k.country_name = u5.name
        LEFT JOIN income_of i ON i.country_id = k.country_id AND i.year = u5.year
        UNION ALL
        SELECT k.country_id, k.country_name, k.region_id, NULL, {q(NO_INCOME)}
        FROM stg_country k WHERE k.country_name NOT IN (SELECT name FROM u5)) s),
dim_reason AS (
  SELECT CAST(row_number() OVER (ORDER BY death_reason_id, date_year DESC) AS BIGINT) AS reason_key,
         CAST(death_reason_id AS VARCHAR) AS reason_id, reason_name AS reason_desc, date_year
  FROM death_reason CROSS JOIN (SELECT DISTINCT year AS date_year FROM u5)
  WHERE (death_reason_id, date_year) IN
        (SELECT (x.reason_id, u5.year) FROM ipcr x JOIN u5 USING (indicator_per_country_id))),
-- one metric per staged value (and snapshot of its country in that year);
-- a cause value's metrics are those of the staged value it hangs on
metric_rows AS (
  SELECT CAST(row_number() OVER (ORDER BY p.indicator_per_country_id, s.country_key NULLS FIRST) AS BIGINT)
           AS metric_id, p.*, s.country_key
  FROM ipc p LEFT JOIN dim_country s ON s.date_year = p.year AND TRY_CAST(s.country_id AS INTEGER) = p.country_id),
fact_metrics AS (
  SELECT metric_id, (SELECT i.indicator_name FROM indicator i WHERE i.indicator_id = m.indicator_id)
           AS indicator_name, value AS indicator_metric, year AS date_year, country_key
  FROM metric_rows m),
fact_reasons AS (
  SELECT CAST(row_number() OVER (ORDER BY metric_id, reason_key, death_reason_metric NULLS FIRST) AS BIGINT)
           AS death_metric_id, *
  FROM (SELECT m.metric_id, s.reason_key, x.value_per_reason AS death_reason_metric, m.year AS date_year
        FROM ipcr x JOIN metric_rows m USING (indicator_per_country_id)
        JOIN dim_reason s ON s.reason_id = CAST(x.reason_id AS VARCHAR) AND s.date_year = m.year
        GROUP BY ALL)),
v1 AS (
  SELECT {VIEW_COLS}
  FROM fact_metrics fm
  LEFT JOIN fact_reasons fr ON fm.metric_id = fr.metric_id
  LEFT JOIN dim_country dc ON fm.country_key = dc.country_key
  LEFT JOIN dim_reason dr ON fr.reason_key = dr.reason_key
  LEFT JOIN dim_date dd ON fm.date_year = dd.date_year),
v2 AS (
  SELECT {VIEW_COLS}
  FROM fact_reasons fr
  RIGHT JOIN fact_metrics fm ON fr.metric_id = fm.metric_id
  JOIN dim_reason dr ON fr.reason_key = dr.reason_key
  JOIN dim_date dd ON dr.date_year = dd.date_year AND fr.date_year = dd.date_year
                  AND fm.date_year = dd.date_year
  JOIN dim_country dc ON dd.date_year = dc.date_year AND fm.country_key = dc.country_key)
"""


def with_prelude(final: str) -> str:
    return "WITH " + PRELUDE.strip() + "\n" + final


M, G = q(MORTALITY), q(GNI)
INCOMES_SQL = "('High income', 'Upper middle income', 'Lower middle income', 'Low income')"
REGIONS_SQL = "('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')"
REASON_RANGE_SQL = "lower(reason_desc) BETWEEN '2-high' AND '4-not specified'"
INCOME_RANGE_SQL = ("(lower(income_name) BETWEEN 'high income' AND 'lower middle income' "
                    "OR income_name IN ('Upper middle income'))")

TPCH_COLS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
             "lineitem": 11}


def _shape_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT {q(t)} AS table_name, COUNT(*) AS n_rows, CAST({n} AS INTEGER) AS n_columns FROM {t}"
        for t, n in TPCH_COLS.items())


def _fk_sql() -> str:
    fks = [
        ("dim_country.date_year", "dim_country", "date_year", "dim_date", "date_year"),
        ("dim_reason.date_year", "dim_reason", "date_year", "dim_date", "date_year"),
        ("fact_metrics.country_key", "fact_metrics", "country_key", "dim_country", "country_key"),
        ("fact_metrics.date_year", "fact_metrics", "date_year", "dim_date", "date_year"),
        ("fact_metric_death_reasons.metric_id", "fact_reasons", "metric_id", "fact_metrics", "metric_id"),
        ("fact_metric_death_reasons.reason_key", "fact_reasons", "reason_key", "dim_reason", "reason_key"),
        ("fact_metric_death_reasons.date_year", "fact_reasons", "date_year", "dim_date", "date_year"),
    ]
    return " UNION ALL ".join(
        f"SELECT {q(name)} AS foreign_key, COUNT(*) AS n_violations FROM {c} x "
        f"WHERE x.{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{ck})"
        for name, c, ck, p, pk in fks)


def _key_sql() -> str:
    parts = []
    for name, source, key, not_null in [
            ("dim_date", "dim_date", "date_year", ["date_year", "date_tens"]),
            ("dim_country", "dim_country", "country_key", ["country_key", "country_id"]),
            ("dim_reason", "dim_reason", "reason_key", ["reason_key", "reason_id"]),
            ("fact_metrics", "fact_metrics", "metric_id", ["metric_id"]),
            ("fact_metric_death_reasons", "fact_reasons", "death_metric_id", ["death_metric_id"])]:
        parts.append(f"SELECT '{name}' AS table_name, 'PRIMARY KEY ({key})' AS constraint_name, COUNT(*) AS n_violations "
                     f"FROM (SELECT {key} FROM {source} WHERE {key} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)")
        parts += [f"SELECT '{name}', '{c} NOT NULL', COUNT(*) FROM {source} WHERE {c} IS NULL" for c in not_null]
    return " UNION ALL ".join(parts)


def _cause_long() -> str:
    # a pivot by year followed by a melt yields one row per (cause, country)
    # present and per year present; cells absent from the wide table are NULL
    return """
causes_long AS (
  SELECT p.reason_name, p.name, CAST(y.year AS VARCHAR) AS year_label, rv.value_per_reason
  FROM (SELECT DISTINCT reason_name, name FROM rv) p
  CROSS JOIN (SELECT DISTINCT year FROM rv) y
  LEFT JOIN rv ON rv.reason_name = p.reason_name AND rv.name = p.name AND rv.year = y.year)"""


def _yearly_price(where: str = "", year_expr: str = "CAST(year(o_orderdate) AS INTEGER)") -> str:
    return (f"SELECT {year_expr} AS year, {mean('CAST(o_totalprice AS DECIMAL(12,2))')} AS avg_totalprice "
            f"FROM orders {where} GROUP BY 1")


SQL: dict[str, str] = {
    # --- the minimum slice and worksheets over V2 ---
    "q_ws_region_rank": with_prelude(f"""
SELECT region_name, avg_indicator_metric,
       CAST(rank() OVER (ORDER BY avg_indicator_metric DESC NULLS LAST) AS INTEGER) AS rank
FROM (SELECT region_name, {mean('indicator_metric')} AS avg_indicator_metric
      FROM v2 WHERE indicator_name = {M} GROUP BY region_name)"""),
    "q_ws_income": with_prelude(f"""
SELECT income_name, {mean('death_reason_metric')} AS avg_death_reason_metric
FROM v2 WHERE {INCOME_RANGE_SQL} GROUP BY income_name"""),
    "q_ws_country_map": with_prelude(f"""
SELECT country_name, {mean('death_reason_metric')} AS avg_death_reason_metric FROM v2 GROUP BY country_name"""),
    "q_ws_trend": with_prelude(f"""
SELECT indicator_name, date_year, {mean('indicator_metric')} AS avg_indicator_metric
FROM v2 WHERE indicator_name = {M} GROUP BY indicator_name, date_year"""),
    "q_ws_reason_rank": with_prelude(f"""
SELECT reason_desc, avg_death_reason_metric,
       CAST(rank() OVER (ORDER BY avg_death_reason_metric DESC NULLS LAST) AS INTEGER) AS rank
FROM (SELECT reason_desc, {mean('death_reason_metric')} AS avg_death_reason_metric
      FROM v2 GROUP BY reason_desc)"""),
    # --- worksheets over V1 ---
    "q_ws_country_decade": with_prelude(f"""
SELECT {decade_bin('date_year')} AS decade, country_name, income_name,
       {mean('indicator_metric')} AS avg_indicator_metric
FROM v1 WHERE indicator_name = {M} GROUP BY 1, 2, 3"""),
    "q_ws_region_decade": with_prelude(f"""
SELECT region_name, {decade_bin('date_year')} AS decade, income_name,
       {mean('indicator_metric')} AS avg_indicator_metric
FROM v1 WHERE indicator_name = {M} AND income_name IN {INCOMES_SQL} GROUP BY 1, 2, 3"""),
    "q_ws_country_reason_decade": with_prelude(f"""
SELECT decade, country_name, income_name, {mean('death_reason_metric')} AS avg_death_reason_metric
FROM (SELECT *, {decade_bin('date_year')} AS decade FROM v1 WHERE indicator_name = {M})
WHERE decade IN ('1990s', '2000s') GROUP BY 1, 2, 3"""),
    "q_ws_reasons_ci": with_prelude(f"""
SELECT reason_desc, avg_death_reason_metric,
       ROUND(AVG(avg_death_reason_metric) OVER (), 6) AS pane_mean,
       ROUND(AVG(avg_death_reason_metric) OVER () - 1.96 * STDDEV_SAMP(avg_death_reason_metric) OVER ()
             / SQRT(COUNT(avg_death_reason_metric) OVER ()), 6) AS band_low,
       ROUND(AVG(avg_death_reason_metric) OVER () + 1.96 * STDDEV_SAMP(avg_death_reason_metric) OVER ()
             / SQRT(COUNT(avg_death_reason_metric) OVER ()), 6) AS band_high
FROM (SELECT reason_desc, {mean('death_reason_metric')} AS avg_death_reason_metric
      FROM v1 WHERE indicator_name = {M} AND region_name = 'ASIA' AND {REASON_RANGE_SQL}
        AND income_name IN {INCOMES_SQL}
      GROUP BY reason_desc HAVING {mean('death_reason_metric')} IS NOT NULL)"""),
    "q_ws_reasons_over_time": with_prelude(f"""
SELECT date_year, reason_desc, {mean('death_reason_metric')} AS avg_death_reason_metric
FROM v1 GROUP BY 1, 2"""),
    "q_ws_year_map": with_prelude(f"""
SELECT country_name, {mean('indicator_metric')} AS avg_indicator_metric
FROM v1 WHERE indicator_name = {G} AND date_year = 2000 GROUP BY 1"""),
    "q_ws_income_groups": with_prelude(f"""
SELECT DISTINCT country_name, income_name FROM v1 WHERE indicator_name = {G} AND date_year = 2000"""),
    "q_ws_country_map_v1": with_prelude(f"""
SELECT country_name, {mean('indicator_metric')} AS avg_indicator_metric
FROM v1 WHERE indicator_name = {M} AND income_name IN {INCOMES_SQL} GROUP BY 1"""),
    "q_ws_income_trend": with_prelude(f"""
SELECT date_year, income_name, {mean('indicator_metric')} AS avg_indicator_metric
FROM v1 WHERE indicator_name = {M} AND income_name IN {INCOMES_SQL} AND {REASON_RANGE_SQL}
GROUP BY 1, 2"""),
    "q_ws_region_gni": with_prelude(f"""
SELECT date_year, region_name, {mean('indicator_metric')} AS avg_indicator_metric
FROM v1 WHERE indicator_name = {G} AND region_name IN {REGIONS_SQL} GROUP BY 1, 2"""),
    "q_ws_region_mortality": with_prelude(f"""
SELECT date_year, region_name, {mean('indicator_metric')} AS avg_indicator_metric
FROM v1 WHERE indicator_name = {M} AND region_name IN {REGIONS_SQL} GROUP BY 1, 2"""),
    "q_ws_region_mortality_unfanned": with_prelude(f"""
SELECT fm.date_year, dc.region_name, {mean('fm.indicator_metric')} AS avg_indicator_metric
FROM fact_metrics fm JOIN dim_country dc ON fm.country_key = dc.country_key AND fm.date_year = dc.date_year
WHERE fm.indicator_name = {M} AND dc.region_name IN {REGIONS_SQL} GROUP BY 1, 2"""),
    "q_ws_calc_fields": with_prelude("""
SELECT metric_id, death_metric_id, indicator_metric AS metric_value,
       CASE WHEN income_name = 'High income' THEN 'High Income' ELSE income_name END AS income_label,
       TRY_CAST(date_tens AS DOUBLE) AS date_tens_real,
       CAST(year(make_date(date_year, 1, 1)) AS INTEGER) AS year_of_date,
       make_date(date_year, 1, 1) AS year_start
FROM v1"""),
    "q_ws_manual_order": with_prelude(f"""
SELECT income_name, {mean('indicator_metric')} AS avg_indicator_metric,
       CASE income_name WHEN 'Low income' THEN 1 WHEN 'Lower middle income' THEN 2
            WHEN 'Upper middle income' THEN 3 WHEN 'High income' THEN 4 ELSE 5 END AS sort_position
FROM v1 WHERE indicator_name = {M} GROUP BY income_name"""),
    "q_ws_param_filters": with_prelude(f"""
SELECT country_name, income_name, {mean('indicator_metric')} AS avg_indicator_metric, COUNT(*) AS n_rows
FROM v1 WHERE date_year = 1999 AND region_name = 'EUROPE' AND indicator_name = {M}
GROUP BY 1, 2"""),
    "q_ws_reason_range": with_prelude(f"""
SELECT reason_desc, COUNT(*) AS n_rows, {mean('death_reason_metric')} AS avg_death_reason_metric
FROM v1 WHERE {REASON_RANGE_SQL} GROUP BY 1"""),
    "q_ws_reason_star": with_prelude("""
SELECT date_year, reason_desc, COUNT(*) AS n_rows,
       CAST(SUM(death_reason_metric) AS DOUBLE) AS sum_death_reason_metric
FROM v2 GROUP BY 1, 2"""),
    "q_measure_menu": with_prelude("""
SELECT indicator_name, CAST(MAX(indicator_metric) AS DOUBLE) AS max_indicator_metric,
       CAST(SUM(indicator_metric) AS DOUBLE) AS sum_indicator_metric, COUNT(*) AS number_of_records,
       COUNT(country_name) AS count_country_name, CAST(MAX(date_year) AS INTEGER) AS max_year
FROM v1 GROUP BY 1"""),
    "q_region_decade_grid": with_prelude(f"""
SELECT region_name,
       {mean("CASE WHEN decade = '1990s' THEN indicator_metric END")} AS "1990s",
       {mean("CASE WHEN decade = '2000s' THEN indicator_metric END")} AS "2000s"
FROM (SELECT *, {decade_bin('date_year')} AS decade FROM v1 WHERE indicator_name = {M})
GROUP BY region_name"""),
    "q_extract": with_prelude("""
SELECT indicator_name, date_year, COUNT(*) AS n_rows FROM v1 GROUP BY 1, 2"""),
    # --- stated questions ---
    "q_above_threshold": with_prelude("""
SELECT DISTINCT country_name, date_year, death_reason_metric FROM v1
WHERE reason_desc = '1-URGENT' AND death_reason_metric > 26.0"""),
    "q_biggest_decrease": with_prelude(f"""
, mort AS (SELECT dc.country_name, fm.date_year, fm.indicator_metric FROM fact_metrics fm
           JOIN dim_country dc ON fm.country_key = dc.country_key AND fm.date_year = dc.date_year
           WHERE fm.indicator_name = {M})
SELECT a.country_name, b.date_year AS y_from, a.date_year AS y_to, b.indicator_metric AS value_from,
       a.indicator_metric AS value_to, a.indicator_metric - b.indicator_metric AS change
FROM mort a JOIN mort b ON a.country_name = b.country_name AND b.date_year = a.date_year - 5
WHERE a.date_year = (SELECT MAX(date_year) FROM mort)
ORDER BY change ASC, a.country_name ASC LIMIT 1""".replace("\n, mort", ", mort", 1)),
    "q_top_causes_by_year": with_prelude(f"""
SELECT * FROM (
  SELECT date_year, reason_desc, avg_death_reason_metric,
         CAST(rank() OVER (PARTITION BY date_year ORDER BY avg_death_reason_metric DESC NULLS LAST) AS INTEGER) AS rank
  FROM (SELECT date_year, reason_desc, {mean('death_reason_metric')} AS avg_death_reason_metric
        FROM v1 WHERE date_year IN (2001, 1997) AND reason_desc IS NOT NULL GROUP BY 1, 2))
WHERE rank <= 3"""),
    "q_corr_income": with_prelude(f"""
SELECT dc.region_name, COUNT(*) AS n_pairs,
       ROUND(CORR(CAST(m.indicator_metric AS DOUBLE), CAST(g.indicator_metric AS DOUBLE)), 6) AS corr_rate_gni
FROM fact_metrics m
JOIN fact_metrics g ON m.country_key = g.country_key AND m.date_year = g.date_year
JOIN dim_country dc ON m.country_key = dc.country_key
WHERE m.indicator_name = {M} AND g.indicator_name = {G}
GROUP BY dc.region_name"""),
    # --- staging, dimensions, facts, checks ---
    "q_dim_date": with_prelude("SELECT * FROM dim_date"),
    "q_dim_country": with_prelude("SELECT * FROM dim_country"),
    "q_dim_reason": with_prelude("SELECT * FROM dim_reason"),
    "q_fact_metrics": with_prelude("SELECT * FROM fact_metrics"),
    "q_fact_reasons": with_prelude("SELECT * FROM fact_reasons"),
    "q_fk_violations": with_prelude(_fk_sql()),
    "q_key_violations": with_prelude(_key_sql()),
    "q_quality_checks": with_prelude("""
SELECT 'dim_date.date_tens is null' AS check_name, COUNT(*) AS n_rows FROM dim_date WHERE date_tens IS NULL
UNION ALL
SELECT 'fact_metrics.country_key is null', COUNT(*) FROM fact_metrics WHERE country_key IS NULL
UNION ALL
SELECT 'dim_country.date_year is null', COUNT(*) FROM dim_country WHERE date_year IS NULL"""),
    "q_stg_indicator": with_prelude("SELECT * FROM ipc"),
    "q_stg_reason_values": with_prelude("SELECT * FROM ipcr"),
    "q_stg_country": with_prelude("SELECT * FROM stg_country"),
    "q_stg_income_group_year": with_prelude("SELECT * FROM igy"),
    "q_income_group_country": with_prelude("""
SELECT igc.country_id, igy.year, igy.income_group_name, igy.lower_bound, igy.upper_bound
FROM igc JOIN igy ON igc.income_group_year_id = igy.income_group_year_id"""),
    "q_income_by_year": with_prelude("""
SELECT igc.country_id, ing.income_name, igy.year FROM igc
JOIN igy ON igc.income_group_year_id = igy.income_group_year_id
JOIN income_group ing ON igy.income_group_id = ing.income_group_id"""),
    "q_first_seen_ids": with_prelude("SELECT * FROM stg_region"),
    "q_country_dim_src": with_prelude(f"""
SELECT country_id, country_name, iso2code, iso3Code, c.region_id FROM stg_country c
JOIN stg_region g ON c.region_id = g.region_id WHERE g.region_name IS DISTINCT FROM {q(AGGREGATE_REGION)}"""),
    "q_series": with_prelude("""
SELECT c.country_name AS name, ipc.year, ipc.value FROM ipc JOIN stg_country c ON ipc.country_id = c.country_id
WHERE ipc.indicator_id = 2"""),
    "q_row_ids": with_prelude("""
SELECT CAST(row_number() OVER (ORDER BY ipc.indicator_id, c.country_name, ipc.year) AS BIGINT) AS row_id,
       ipc.indicator_id, c.country_name AS name, ipc.year, ipc.value
FROM ipc JOIN stg_country c ON ipc.country_id = c.country_id"""),
    "q_name_map": with_prelude(f"""
SELECT DISTINCT name AS source_name, {map_names('name')} AS mapped_name FROM rv"""),
    "q_melt_causes": with_prelude(_cause_long().replace("\ncauses_long", ", causes_long", 1) + f"""
SELECT reason_name, {map_names('name')} AS name, CAST(CAST(year_label AS DOUBLE) AS INTEGER) AS year,
       value_per_reason FROM causes_long"""),
    "q_stack_causes": with_prelude(_cause_long().replace("\ncauses_long", ", causes_long", 1) + """
SELECT reason_name, name, CAST(year_label AS INTEGER) AS year, value_per_reason
FROM causes_long WHERE value_per_reason IS NOT NULL"""),
    "q_cause_file_union": with_prelude(_cause_long().replace("\ncauses_long", ", causes_long", 1) + f"""
SELECT CAST(d.death_reason_id AS INTEGER) AS reason_id, l.reason_name, {map_names('l.name')} AS name,
       CAST(CAST(l.year_label AS DOUBLE) AS INTEGER) AS year, l.value_per_reason
FROM causes_long l JOIN death_reason d ON l.reason_name = d.reason_name"""),
    "q_natural_join": with_prelude(f"""
SELECT rv.name, rv.year, rv.reason_name, rv.value_per_reason, u5.value AS under5_value
FROM (SELECT {map_names('name')} AS name, year, reason_name, value_per_reason FROM rv) rv
JOIN u5 ON rv.name IS NOT DISTINCT FROM u5.name AND rv.year IS NOT DISTINCT FROM u5.year"""),
    "q_union_missing": with_prelude("""
SELECT name, year, value_per_reason FROM rv WHERE reason_name = '1-URGENT'
UNION ALL BY NAME
SELECT name, year AS level_1, value_per_reason FROM rv WHERE reason_name <> '1-URGENT'"""),
    # --- tables through the file formats of the loads ---
    "q_country_csv": with_prelude("""
SELECT country_id, country_name, iso2code, iso3Code, region_id FROM stg_country"""),
    "q_reason_export": with_prelude("""
SELECT reason_key, reason_id, reason_desc, date_year FROM dim_reason"""),
    "q_appended_series": with_prelude("""
SELECT indicator_per_country_id, value, year, indicator_id, country_id FROM ipc"""),
    "q_declared_fact": with_prelude("""
SELECT metric_id, indicator_name, indicator_metric, date_year, country_key FROM fact_metrics"""),
    "q_quoted_documents": "SELECT doc_id, source, text FROM documents",
    "q_unlike_cause_files": with_prelude(f"""
, seen AS (SELECT DISTINCT reason_name, year, min(year) OVER (PARTITION BY reason_name) AS first_year FROM rv)
SELECT p.reason_name, {map_names('p.name')} AS name, CAST(s.year AS INTEGER) AS year,
       CAST(rv.value_per_reason AS DECIMAL(10,2)) AS value_per_reason
FROM (SELECT DISTINCT reason_name, name FROM rv) p JOIN seen s USING (reason_name) JOIN death_reason d USING (reason_name)
LEFT JOIN rv ON rv.reason_name = p.reason_name AND rv.name = p.name AND rv.year = s.year
WHERE (d.death_reason_id - 1) % 5 <> 2 OR s.year <> s.first_year"""),
    "q_retyped_year_join": with_prelude("""
SELECT f.metric_id, f.date_year, make_date(f.date_year, 1, 1) AS year_date, d.date_string, d.date_tens
FROM fact_metrics f JOIN dim_date d USING (date_year)"""),
    "q_raw_countries": with_prelude(f"""
, levelled AS (
  SELECT c.country_id, c.country_name, c.iso2code, c.iso3Code, g.region_name,
         COALESCE((SELECT arg_max(n.income_name, y.year) FROM igc JOIN igy y USING (income_group_year_id)
                   JOIN income_group n USING (income_group_id) WHERE igc.country_id = c.country_id),
                  'Not classified') AS income_name
  FROM stg_country c JOIN stg_region g USING (region_id)),
regions AS (SELECT region_name, row_number() OVER (ORDER BY MIN(country_id)) AS region_id FROM levelled GROUP BY 1),
own AS (SELECT * FROM levelled WHERE region_name IS DISTINCT FROM {q(AGGREGATE_REGION)}),
levels AS (SELECT income_name, row_number() OVER (ORDER BY MIN(country_id)) AS income_id FROM own GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY own.country_id) AS INTEGER) AS country_id, country_name, iso2code, iso3Code,
       CAST(region_id AS INTEGER) AS region_id, region_name, CAST(income_id AS INTEGER) AS income_id, income_name
FROM own JOIN regions USING (region_name) JOIN levels USING (income_name)"""),
    # --- plain table queries (no prelude needed) ---
    "q_file_ids": """
SELECT CAST(row_number() OVER (ORDER BY reason_name) AS INTEGER) AS death_reason_id, reason_name
FROM (SELECT DISTINCT o_orderpriority AS reason_name FROM orders)""",
    "q_keyword_search": """
SELECT p_partkey, p_name, p_type, p_brand FROM part WHERE contains(lower(p_name), 'red')""",
    "q_union_indicators": """
SELECT p_partkey, p_name, p_type, p_brand FROM part WHERE contains(lower(p_name), 'widget')
UNION ALL
SELECT p_partkey, p_name, p_type, p_brand FROM part WHERE contains(lower(p_name), 'bolt')""",
    "q_group_size": "SELECT p_type, p_brand, COUNT(*) AS n_rows FROM part GROUP BY 1, 2",
    "q_distinct_rows": "SELECT DISTINCT p_type, p_brand, p_size FROM part",
    "q_head": "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part ORDER BY p_partkey LIMIT 5",
    "q_mean_by_year": _yearly_price(),
    "q_tail": f"SELECT * FROM ({_yearly_price()}) ORDER BY year DESC LIMIT 5",
    "q_trend_since": _yearly_price("WHERE CAST(year(o_orderdate) AS VARCHAR) >= '1997'",
                                   "CAST(year(o_orderdate) AS VARCHAR)"),
    "q_year_parts": """
SELECT year, make_date(year, 1, 1) AS year_date, year AS year_of_date, make_date(year, 1, 1) AS year_start
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)""",
    "q_shape": _shape_sql(),
    "q_row_slice": """
SELECT * FROM (SELECT p_partkey, p_name, p_retailprice,
                      row_number() OVER (ORDER BY p_partkey) - 1 AS pos FROM part)
WHERE pos >= 4 AND pos < 9""",
    "q_drop_incomplete": f"""
SELECT c.c_custkey, c.c_name, o.n_orders, o.avg_totalprice
FROM customer c LEFT JOIN (
  SELECT o_custkey, COUNT(*) AS n_orders, {mean('CAST(o_totalprice AS DECIMAL(12,2))')} AS avg_totalprice
  FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
WHERE o.n_orders IS NOT NULL AND o.avg_totalprice IS NOT NULL""",
    "q_income_bounds": f"""
WITH bands AS (SELECT year, b.income AS income, b.value AS value
               FROM (SELECT year, unnest({band_struct_list()}) AS b
                     FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)))
SELECT income, year, {band_lower('value')} AS lower_bound, {band_upper('value')} AS upper_bound FROM bands""",
    "q_income_code": f"""
WITH bands AS (SELECT year, b.income AS income, b.value AS value
               FROM (SELECT year, unnest({band_struct_list()}) AS b
                     FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)))
SELECT income, year, {band_lower('value')} AS lower_bound, {band_upper('value')} AS upper_bound,
       {income_code('income')} AS income_group_id FROM bands""",
    "q_clean_names": "SELECT page_id, replace(trim(url), '/', '') AS clean_url FROM pages",
    "q_nan_to_null": """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE sqrt(c_acctbal) END AS sqrt_acctbal FROM customer""",
    "q_key_prefix": """
SELECT doc_id, object_key, replace(substr(object_key, 6), '.csv', '') AS name
FROM (SELECT doc_id, source || '/' || CAST(doc_id AS VARCHAR) || '.csv' AS object_key FROM documents)
WHERE substr(object_key, 1, 4) = 'src1' AND substr(object_key, 6) <> ''""",
    # lists cut out of the page, items out of the lists, then each item's first link
    "q_page_links": r"""
WITH found AS (
  SELECT page_id, regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'),
                                     '(?s)</?[A-Za-z][^\s/>]*(?:[^>"'']|"[^"]*"|''[^'']*'')*>') AS tags
  FROM pages
), placed AS (
  SELECT page_id, unnest(tags) AS tag, generate_subscripts(tags, 1) AS pos FROM found
), named AS (
  SELECT page_id, pos, tag, lower(regexp_extract(tag, '^</?([A-Za-z][^\s/>]*)', 1)) AS name, starts_with(tag, '</') AS ends FROM placed
), levels AS (
  SELECT *, sum(CASE WHEN name NOT IN ('ul', 'ol') THEN 0 WHEN ends THEN -1 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY pos) AS depth
  FROM named WHERE name IN ('ul', 'ol', 'li', 'a')
), items AS (
  SELECT i.page_id, i.pos, min(e.pos) AS until
  FROM levels i LEFT JOIN levels e ON e.page_id = i.page_id AND e.pos > i.pos
       AND ((e.name = 'li' AND e.depth = i.depth) OR (e.name IN ('ul', 'ol') AND e.ends AND e.depth < i.depth))
  WHERE i.name = 'li' AND NOT i.ends AND i.depth > 0 GROUP BY ALL
), firsts AS (
  SELECT i.page_id, i.pos, arg_min(a.tag, a.pos) AS tag
  FROM items i JOIN levels a ON a.page_id = i.page_id AND a.name = 'a' AND NOT a.ends AND a.pos > i.pos AND a.pos < coalesce(i.until, a.pos + 1)
  GROUP BY ALL
)
SELECT page_id, regexp_extract(tag, '(?is)\shref\s*=\s*"([^"]*)"', 1) AS href FROM firsts
WHERE regexp_matches(tag, '(?is)\shref\s*=')""",
}
