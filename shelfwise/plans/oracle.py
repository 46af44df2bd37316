"""The registered queries as plain SQL over the input tables.

Written apart from the DataFrame code, from the definition of each result. A statement is
a final SELECT; the common table expressions it needs are added in front of it.
"""

from __future__ import annotations

import re

from shelfwise.functions import normal

_PARTS: dict[str, str] = {}
_FINAL: dict[str, str] = {}

CATS = "('FOODS', 'HOBBIES', 'HOUSEHOLD')"
Z90, Z95, Z98 = 1.2815515655446008, 1.6448536269514715, 2.053748910631822


def r(expr: str, digits: int = 4) -> str:
    """Half-up rounding of a double; noise eight places further down is dropped first."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38, {digits + 8})), {digits}) AS DOUBLE)"


def d(value: float) -> str:
    """Literal as a double; plain literals would be decimals."""
    return f"CAST('{value!r}' AS DOUBLE)"


def rs(columns: str, digits: int = 4, alias: str = "") -> str:
    """Rounded columns keeping their names."""
    return ", ".join(f"{r(alias + c.strip(), digits)} AS {c.strip()}" for c in columns.split(","))


def with_parts(sql: str) -> str:
    """Prefix the common table expressions that a statement uses, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _PARTS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(_PARTS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({_PARTS[n].strip()})" for n in needed)
    return f"WITH {ctes}\n{sql.strip()}"


def statements() -> dict[str, str]:
    """All statements by query name."""
    return {name: with_parts(sql) for name, sql in _FINAL.items()}


# ---- star schema ---------------------------------------------------------------------

BRAND_NO = "CAST(split_part(item_id, '#', 2) AS INTEGER)"
CAT = f"(CASE {BRAND_NO} % 3 WHEN 0 THEN 'FOODS' WHEN 1 THEN 'HOBBIES' ELSE 'HOUSEHOLD' END)"
DEPT = f"({CAT} || '_' || CAST(1 + ({BRAND_NO} // 3) % 3 AS VARCHAR))"
STATE = (
    "(CASE WHEN store_id IN ('AMERICA', 'AFRICA') THEN 'CA' "
    "WHEN store_id IN ('ASIA', 'MIDDLE EAST') THEN 'TX' ELSE 'WI' END)"
)
WEEK = "CAST(floor(date_diff('day', DATE '1994-12-31', date) / 7) AS INTEGER)"

for _g, _item in (("b", "p_brand"), ("f", "p_type || '_' || p_brand")):
    _PARTS[f"obs_{_g}"] = f"""
        SELECT {_item} AS item_id, r_name AS store_id, CAST(l_shipdate AS DATE) AS date,
               CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units_sold,
               CAST(SUM(CAST(round(p_retailprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS BIGINT) AS paid,
               COUNT(*) AS n_lines
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1, 2, 3"""
    _PARTS[f"sales_{_g}"] = f"""
        SELECT g.item_id, g.store_id, g.date, COALESCE(o.units_sold, 0) AS units_sold
        FROM (SELECT k.item_id, k.store_id, cal.date
              FROM (SELECT DISTINCT item_id, store_id FROM obs_{_g}) k CROSS JOIN cal) g
        LEFT JOIN obs_{_g} o ON o.item_id = g.item_id AND o.store_id = g.store_id AND o.date = g.date"""
    _PARTS[f"price_{_g}"] = f"""
        SELECT item_id, store_id, wm_yr_wk, CAST((2 * p + 100 * n) // (200 * n) AS DOUBLE) / 100 AS sell_price
        FROM (SELECT item_id, store_id, {WEEK} AS wm_yr_wk, CAST(SUM(paid) AS BIGINT) AS p, CAST(SUM(n_lines) AS BIGINT) AS n
              FROM obs_{_g} GROUP BY 1, 2, 3)"""
    _PARTS[f"items_{_g}"] = f"SELECT DISTINCT item_id, {DEPT} AS dept_id, {CAT} AS cat_id FROM obs_{_g}"
    _PARTS[f"long_{_g}"] = f"""
        SELECT s.item_id, i.dept_id, i.cat_id, s.store_id, {STATE.replace('store_id', 's.store_id')} AS state_id,
               c.*, s.units_sold, p.sell_price
        FROM sales_{_g} s JOIN cal c ON c.date = s.date JOIN items_{_g} i ON i.item_id = s.item_id
        LEFT JOIN price_{_g} p ON p.item_id = s.item_id AND p.store_id = s.store_id AND p.wm_yr_wk = c.wm_yr_wk"""
    for _t, _days in (("d", 1), ("w", 7)):
        _PARTS[f"panel_{_g}{_t}"] = f"""
            SELECT item_id, store_id, cat_id, start AS date, CAST(SUM(units_sold) AS BIGINT) AS units_sold,
                   SUM(units_sold * CAST(COALESCE(sell_price, 0) AS DECIMAL(12, 2))) AS revenue
            FROM (SELECT *, cutoff + 1 + {_days} * CAST(floor((date_diff('day', cutoff, date) - 1) / {_days}) AS INTEGER) AS start FROM long_{_g} CROSS JOIN bounds)
            WHERE start >= lo GROUP BY ALL"""
        _PARTS[f"totals_{_g}{_t}"] = f"""
            SELECT item_id, store_id, CAST(SUM(units_sold) AS BIGINT) AS sum_units,
                   SUM(CAST(units_sold AS DOUBLE) * units_sold) AS sum_squares, COUNT(*) AS n_periods,
                   CAST(SUM(revenue) AS DECIMAL(30, 2)) AS total_revenue
            FROM panel_{_g}{_t} GROUP BY 1, 2"""
        _PARTS[f"variation_{_g}{_t}"] = f"""
            SELECT *, CASE WHEN mean_units > 0 THEN std_units / mean_units ELSE CAST('inf' AS DOUBLE) END AS cv
            FROM (SELECT *, CAST(sum_units AS DOUBLE) / n_periods AS mean_units,
                  sqrt(greatest(sum_squares / n_periods - (CAST(sum_units AS DOUBLE) / n_periods) * (CAST(sum_units AS DOUBLE) / n_periods), 0)) AS std_units
                  FROM totals_{_g}{_t})"""
        _PARTS[f"ranked_{_g}{_t}"] = f"""
            SELECT *, SUM(total_revenue) OVER (ORDER BY total_revenue DESC, item_id, store_id ROWS UNBOUNDED PRECEDING) AS cum,
                   SUM(total_revenue) OVER () AS total
            FROM variation_{_g}{_t}"""
        _PARTS[f"labels_{_g}{_t}"] = f"""
            SELECT *, abc_class || xyz_class AS abc_xyz FROM (
                SELECT *, CASE WHEN total <= 0 THEN 'C' WHEN cum * 10 <= total * 7 THEN 'A' WHEN cum * 10 <= total * 9 THEN 'B' ELSE 'C' END AS abc_class,
                       CASE WHEN cv < 0.5 THEN 'X' WHEN cv <= 1.0 THEN 'Y' ELSE 'Z' END AS xyz_class
                FROM ranked_{_g}{_t})"""

_PARTS["bounds"] = "SELECT MIN(CAST(l_shipdate AS DATE)) AS lo, MAX(CAST(l_shipdate AS DATE)) AS hi, MAX(CAST(l_shipdate AS DATE)) - 28 AS cutoff FROM lineitem"
_PARTS["days"] = "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date, lo FROM bounds"
_MD = "strftime(date, '%m-%d')"
_PARTS["cal"] = f"""
    SELECT date, {WEEK} AS wm_yr_wk, dayname(date) AS weekday, CAST((isodow(date) + 1) % 7 + 1 AS INTEGER) AS wday,
           CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
           'd_' || CAST(date_diff('day', lo, date) + 1 AS VARCHAR) AS d,
           CASE {_MD} WHEN '01-01' THEN 'NewYear' WHEN '02-14' THEN 'ValentinesDay' WHEN '07-04' THEN 'IndependenceDay'
                WHEN '10-31' THEN 'Halloween' WHEN '12-25' THEN 'Christmas' END AS event_name_1,
           CASE WHEN {_MD} IN ('01-01', '07-04', '12-25') THEN 'National' WHEN {_MD} IN ('02-14', '10-31') THEN 'Cultural' END AS event_type_1,
           CAST(NULL AS VARCHAR) AS event_name_2, CAST(NULL AS VARCHAR) AS event_type_2,
           CAST(day(date) BETWEEN 1 AND 10 AS INTEGER) AS snap_CA,
           CAST(day(date) IN (1, 3, 5, 6, 7, 9, 11, 12, 13, 15) AS INTEGER) AS snap_TX,
           CAST(day(date) IN (2, 3, 5, 6, 8, 9, 11, 12, 14, 15) AS INTEGER) AS snap_WI
    FROM days"""
DOW = "CAST(isodow(date) - 1 AS INTEGER)"
WEEKEND = "CAST(isodow(date) >= 6 AS INTEGER)"
ISO_WEEK = "CAST(weekofyear(date) AS INTEGER)"

_FINAL["scan_pruned"] = "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS units, CAST(l_shipdate AS DATE) AS date FROM lineitem"
_FINAL["store_slice"] = "SELECT item_id, cat_id, state_id, date, wm_yr_wk, units_sold, sell_price FROM long_b WHERE store_id = 'AMERICA'"
_FINAL["dataset_profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT(*) AS n_rows, COUNT({c}) AS n_known, CAST(MIN({c}) AS VARCHAR) AS least, CAST(MAX({c}) AS VARCHAR) AS greatest FROM sales_b"
    for c, t in (("item_id", "string"), ("store_id", "string"), ("date", "date"), ("units_sold", "bigint"))
)
_FINAL["dim_date"] = f"""SELECT date, d, wm_yr_wk, {DOW} AS day_of_week, {ISO_WEEK} AS week_of_year, month, year,
    event_name_1, event_type_1, event_name_2, event_type_2, snap_CA, snap_TX, snap_WI, {WEEKEND} AS is_weekend FROM cal"""
_FINAL["dim_item"] = "SELECT item_id, dept_id, cat_id FROM items_f"
_FINAL["dim_store"] = f"SELECT DISTINCT store_id, {STATE} AS state_id FROM obs_f"
_FINAL["price_scan_in"] = "SELECT item_id, store_id, wm_yr_wk, sell_price FROM price_f WHERE store_id IN ('AMERICA', 'EUROPE')"
_FINAL["melt_wide_sales"] = "SELECT s.item_id, s.store_id, cal.d, s.units_sold FROM sales_b s JOIN cal ON cal.date = s.date"
_FINAL["calendar_features"] = f"""SELECT date, {DOW} AS day_of_week, {ISO_WEEK} AS week_of_year, month, CAST(quarter(date) AS INTEGER) AS quarter, year,
    {WEEKEND} AS is_weekend, year AS fiscal_year, CAST(event_name_1 IS NOT NULL AS INTEGER) AS is_event FROM cal"""
SNAP = "CASE state_id WHEN 'CA' THEN snap_CA WHEN 'TX' THEN snap_TX ELSE snap_WI END"
_FINAL["state_flag"] = f"SELECT item_id, store_id, date, state_id, {SNAP} AS is_snap FROM long_b"
_FINAL["date_iso"] = "SELECT strftime(date, '%Y-%m-%d') AS date_text, date AS date_back, CAST(SUM(units_sold) AS BIGINT) AS units_sold FROM sales_b GROUP BY 1, 2"
_PARTS["codes"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT {e} AS label FROM obs_f)"
    for c, e in (("item_id", "item_id"), ("store_id", "store_id"), ("dept_id", DEPT), ("cat_id", CAT), ("state_id", STATE))
)
_FINAL["label_encode"] = "SELECT column_name, label, code FROM codes"
_FINAL["sales_long"] = "SELECT item_id, dept_id, cat_id, store_id, state_id, d, date, wm_yr_wk, weekday, wday, event_name_1, event_type_1, units_sold, sell_price FROM long_b"
_FINAL["time_split"] = """SELECT item_id, store_id, CASE WHEN date <= cutoff THEN 'train' ELSE 'val' END AS side, COUNT(*) AS n_rows,
    MIN(date) AS first_date, MAX(date) AS last_date, CAST(SUM(units_sold) AS BIGINT) AS units FROM long_b CROSS JOIN bounds GROUP BY 1, 2, 3"""
_FINAL["training_range"] = "SELECT MIN(date) AS training_start, MAX(date) AS training_end, COUNT(*) AS n_days FROM cal CROSS JOIN bounds WHERE date <= cutoff"

# ---- reports -------------------------------------------------------------------------

_PARTS["takings"] = """SELECT item_id, dept_id, cat_id, year, month, units_sold AS units, sell_price AS price, units_sold * CAST(round(sell_price * 100) AS BIGINT) AS cents
    FROM long_f WHERE sell_price IS NOT NULL"""
_FINAL["sales_by_category_month"] = f"""SELECT cat_id, year, month, CAST(SUM(units) AS BIGINT) AS total_units,
    {r('SUM(cents) / 100', 2)} AS total_revenue FROM takings GROUP BY cat_id, year, month"""
_FINAL["zero_sales_percentage"] = f"""SELECT item_id, store_id, COUNT(*) AS total_days,
    CAST(SUM(CASE WHEN units_sold = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_days,
    {r('100.0 * SUM(CASE WHEN units_sold = 0 THEN 1 ELSE 0 END) / COUNT(*)', 2)} AS zero_percentage
    FROM sales_f GROUP BY 1, 2 ORDER BY zero_percentage DESC, item_id, store_id LIMIT 1000"""
_PARTS["item_takings"] = """SELECT item_id, dept_id, cat_id, CAST(SUM(units) AS BIGINT) AS units, AVG(price) AS price, CAST(SUM(cents) AS DOUBLE) / 100 AS revenue
    FROM takings GROUP BY ALL"""
_FINAL["top_items_revenue"] = f"""SELECT item_id, dept_id, cat_id, units AS total_units, {r('price', 2)} AS avg_price, {r('revenue', 2)} AS total_revenue
    FROM item_takings QUALIFY row_number() OVER (ORDER BY round(revenue, 2) DESC, item_id) <= 20"""
_ON, _OFF = "AVG(CASE WHEN snap_CA = 1 THEN units_sold END)", "AVG(CASE WHEN snap_CA = 0 THEN units_sold END)"
_FINAL["snap_impact"] = f"""SELECT dept_id, {r(_ON)} AS avg_sales_snap, {r(_OFF)} AS avg_sales_nonsnap,
    {r(f'100.0 * ({_ON} - {_OFF}) / {_OFF}', 2)} AS pct_uplift FROM long_f WHERE cat_id = 'FOODS' AND state_id = 'CA' GROUP BY 1"""
_YEAR = "(SELECT year(hi) - 1 FROM bounds)"
_FINAL["category_months_of_year"] = _FINAL["sales_by_category_month"].replace("FROM takings", f"FROM takings WHERE year = {_YEAR}")
_FINAL["snap_impact_of_year"] = _FINAL["snap_impact"].replace("WHERE", f"WHERE year = {_YEAR} AND")
_FINAL["event_day_sales"] = f"""SELECT cat_id, year, month, CAST(SUM(units_sold) AS BIGINT) AS total_units,
    {r('SUM(units_sold * CAST(round(sell_price * 100) AS BIGINT)) / 100', 2)} AS total_revenue FROM long_f
    WHERE sell_price IS NOT NULL AND event_type_1 = 'National' AND date >= (SELECT date_trunc('year', hi) - INTERVAL 365 DAY FROM bounds) GROUP BY 1, 2, 3"""
_FINAL["price_trend"] = f"""SELECT cat_id, year, avg_price, num_price_points, {r('avg_price - before')} AS yoy_change,
    {r('100.0 * (avg_price - before) / before', 2)} AS yoy_pct_change FROM (
      SELECT *, LAG(avg_price) OVER (PARTITION BY cat_id ORDER BY year) AS before FROM (
        SELECT cat_id, year, {r('AVG(sell_price)')} AS avg_price, COUNT(*) AS num_price_points
        FROM price_f p JOIN items_f i ON i.item_id = p.item_id JOIN (SELECT DISTINCT wm_yr_wk, year FROM cal) w ON w.wm_yr_wk = p.wm_yr_wk
        GROUP BY 1, 2))"""
_FINAL["fc_mae_by_category"] = f"SELECT {CAT} AS category, {r('AVG(abs_error)')} AS mean_abs_error, COUNT(*) AS n FROM fact GROUP BY 1"
_FINAL["fc_count_by_segment"] = "SELECT abc_xyz, COUNT(*) AS count FROM fact GROUP BY 1"
_FINAL["fc_worst_series"] = f"""SELECT item_id, store_id, {r('avg_error')} AS avg_error FROM (SELECT item_id, store_id, AVG(abs_error) AS avg_error FROM fact GROUP BY 1, 2)
    ORDER BY 3 DESC, item_id, store_id LIMIT 10"""
_PARTS["by_abc"] = "SELECT abc_class, AVG(COLUMNS('^(safety_stock|ROP|turnover|annual_saving_pct)$')) AS 'mean_\\1' FROM costs GROUP BY ALL"
_FINAL["policy_avg_by_abc"] = f"""SELECT abc_class, {r('mean_safety_stock', 2)} AS avg_safety_stock, {r('"mean_ROP"', 2)} AS "avg_ROP",
    {r('mean_turnover', 2)} AS avg_turnover, {r('mean_annual_saving_pct', 2)} AS avg_saving_pct FROM by_abc"""
_PARTS["by_category"] = """SELECT cat_id, COUNT(*) AS n, COUNT(*) FILTER (stockout_risk = 1) AS n_risk, SUM(total_annual_cost_naive) AS naive,
    SUM(total_annual_cost_EOQ) AS optimized, SUM(annual_saving) AS saving FROM costs GROUP BY ALL"""
_FINAL["risk_by_category"] = f"SELECT cat_id, n AS total_items, n_risk AS items_at_risk, {r('100.0 * n_risk / n', 1)} AS pct_at_risk FROM by_category"
_FINAL["cost_by_category"] = f"""SELECT cat_id, {r('naive', 2)} AS naive_total, {r('optimized', 2)} AS optimized_total, {r('saving', 2)} AS total_saving,
    {r('100.0 * saving / naive', 1)} AS saving_pct FROM by_category"""
_PARTS["vendor_gain"] = "SELECT Q_star, EOQ, profit_improvement AS gain, CASE WHEN expected_profit_eoq <> 0 THEN 100.0 * profit_improvement / ABS(expected_profit_eoq) END AS gain_pct FROM vendor"
_FINAL["newsvendor_summary"] = f"""SELECT {r('AVG(Q_star)', 2)} AS avg_newsvendor_qty, {r('AVG(EOQ)', 2)} AS avg_eoq_qty, {r('AVG(gain)')} AS avg_profit_improvement,
    {r('AVG(gain_pct)', 1)} AS avg_profit_improvement_pct FROM vendor_gain"""
_FINAL["lp_fill_rate"] = f"""SELECT scenario, {r('SUM(fulfilled) / SUM(demand_mean) * 100', 1)} AS fill_rate_pct, {r('SUM(budget_spent)', 2)} AS total_spent
    FROM alloc GROUP BY 1"""
_FINAL["fact_row_counts"] = """SELECT 'fact_inventory_policy' AS table_name, COUNT(*) AS rows FROM costs UNION ALL SELECT 'fact_newsvendor', COUNT(*) FROM vendor
    UNION ALL SELECT 'fact_allocation', COUNT(*) FROM alloc UNION ALL SELECT 'fact_forecasts', COUNT(*) FROM fact"""

# ---- statistics and classes ----------------------------------------------------------

_FINAL["basic_stats"] = f"""SELECT cat_id AS category, COUNT(*) AS count, {r('AVG(units_sold)')} AS mean, CAST(MEDIAN(units_sold) AS DOUBLE) AS median,
    {r('STDDEV_POP(units_sold)')} AS std, MAX(units_sold) AS max, {r('100.0 * AVG(CAST(units_sold = 0 AS INTEGER))', 2)} AS pct_zero FROM long_f GROUP BY 1"""
_FINAL["dataset_overview"] = f"""SELECT COUNT(DISTINCT item_id) AS n_items, COUNT(DISTINCT store_id) AS n_stores, MIN(date) AS date_min, MAX(date) AS date_max,
    COUNT(*) AS total_records, {r('100.0 * AVG(CAST(units_sold = 0 AS INTEGER))', 2)} AS pct_zero FROM sales_f"""
_PARTS["shares"] = "SELECT item_id, store_id, 100.0 * SUM(CASE WHEN units_sold = 0 THEN 1 ELSE 0 END) / CAST(COUNT(*) AS DOUBLE) AS zero_pct FROM sales_f GROUP BY 1, 2"
_FINAL["zero_share_over_40"] = f"SELECT COUNT(*) AS n_pairs, {r('100.0 * AVG(CAST(zero_pct > 40 AS INTEGER))', 2)} AS pct_over_limit FROM shares"
_FINAL["zero_share_hist"] = f"""SELECT CAST(b.bin AS INTEGER) AS bin, {r('e.lo + e.width * b.bin / 50', 6)} AS bin_start, COALESCE(c.n, 0) AS n_pairs
    FROM (SELECT unnest(range(50)) AS bin) b CROSS JOIN (SELECT MIN(zero_pct) AS lo, MAX(zero_pct) - MIN(zero_pct) AS width FROM shares) e
    LEFT JOIN (SELECT least(CASE WHEN width > 0 THEN floor((zero_pct - lo) / width * 50) ELSE 0 END, 49) AS bin, COUNT(*) AS n
               FROM shares CROSS JOIN (SELECT MIN(zero_pct) AS lo, MAX(zero_pct) - MIN(zero_pct) AS width FROM shares) GROUP BY 1) c ON c.bin = b.bin"""
for _name, _key, _expr in (("seasonality_dow", "dow", DOW), ("seasonality_month", "month", "month")):
    _FINAL[_name] = f"SELECT {_expr} AS {_key}, " + ", ".join(
        f"{r(f'AVG(CASE WHEN cat_id = {c!r} THEN units_sold END)', 6)} AS {c}" for c in ("FOODS", "HOBBIES", "HOUSEHOLD")
    ) + " FROM long_f GROUP BY 1"
_FINAL["snap_lift_overall"] = f"SELECT {r(_OFF)} AS avg_non_snap, {r(_ON)} AS avg_snap, {r(f'100.0 * ({_ON} - {_OFF}) / {_OFF}', 2)} AS uplift_pct FROM long_f WHERE cat_id = 'FOODS' AND state_id = 'CA'"
_FINAL["series_cv"] = f"SELECT item_id, store_id, sum_units, n_periods, {rs('sum_squares, mean_units, std_units, cv', 6)} FROM variation_fd"
_FINAL["abc_class"] = f"SELECT item_id, store_id, CAST(total_revenue AS DOUBLE) AS total_revenue, {r('CAST(cum AS DOUBLE) / CAST(total AS DOUBLE)', 6)} AS cum_share, abc_class FROM labels_fd"
_FINAL["abc_class_by_store"] = """SELECT item_id, store_id, CASE WHEN total <= 0 THEN 'C' WHEN cum * 10 <= total * 7 THEN 'A' WHEN cum * 10 <= total * 9 THEN 'B' ELSE 'C' END AS abc_class FROM (
    SELECT *, SUM(total_revenue) OVER (PARTITION BY store_id ORDER BY total_revenue DESC, item_id ROWS UNBOUNDED PRECEDING) AS cum,
           SUM(total_revenue) OVER (PARTITION BY store_id) AS total FROM totals_fd)"""
_FINAL["abc_xyz"] = f"SELECT item_id, store_id, CAST(total_revenue AS DOUBLE) AS total_revenue, {r('cv', 6)} AS cv, abc_class, xyz_class, abc_xyz FROM labels_bw"
_FINAL["abc_xyz_matrix"] = """SELECT a.abc_class, COUNT(*) FILTER (l.xyz_class = 'X') AS X, COUNT(*) FILTER (l.xyz_class = 'Y') AS Y, COUNT(*) FILTER (l.xyz_class = 'Z') AS Z
    FROM (VALUES ('A'), ('B'), ('C')) a(abc_class) LEFT JOIN labels_bw l ON l.abc_class = a.abc_class GROUP BY 1"""
_FINAL["method_assignment"] = " UNION ALL ".join(
    f"SELECT '{m}' AS method, '{', '.join(c)}' AS segments, COUNT(*) AS n_series FROM labels_bw WHERE abc_xyz IN ({', '.join(repr(x) for x in c)})"
    for m, c in (
        ("Boosted trees (stable, high-value)", ("AX", "BX", "AY", "BY")),
        ("ETS baseline (low-value)", ("CX", "CY")),
        ("Croston/SBA (intermittent demand)", ("AZ", "BZ", "CZ")),
    )
)
_FINAL["segment_method_map"] = """SELECT item_id, store_id, abc_xyz,
    CASE abc_class WHEN 'A' THEN 'High' WHEN 'B' THEN 'Med' ELSE 'Low' END || ' value, ' || CASE xyz_class WHEN 'X' THEN 'stable' WHEN 'Y' THEN 'variable' ELSE 'intermittent' END AS description,
    CASE WHEN xyz_class = 'Z' THEN 'Croston SBA' WHEN abc_class = 'C' THEN 'ETS Baseline' ELSE 'Boosted trees' END AS forecasting_model,
    CASE WHEN abc_xyz = 'CZ' THEN 'Simple ROP' WHEN xyz_class = 'Z' THEN 'Newsvendor (if FOODS)'
         ELSE 'EOQ + SS (' || CASE abc_class WHEN 'A' THEN '98' WHEN 'B' THEN '95' ELSE '90' END || '%)' END AS inventory_policy FROM labels_bw"""
_FINAL["dq_label_coverage"] = f"""SELECT COUNT(*) AS n_rows, {r('100.0 * AVG(CAST(l.abc_class IS NOT NULL AS INTEGER))', 1)} AS pct_labelled
    FROM sales_b s LEFT JOIN labels_bw l ON l.item_id = s.item_id AND l.store_id = s.store_id"""

# ---- features ------------------------------------------------------------------------

_W = "(PARTITION BY item_id, store_id ORDER BY date)"
_LAGS = ", ".join(f"LAG(units_sold, {n}) OVER {_W} AS lag_{n}" for n in (28, 35, 42, 56, 364))
_PARTS["lagged"] = f"SELECT *, {_LAGS} FROM long_b"
_ROLLS = ", ".join(
    f"{fn}(lag_28) OVER (PARTITION BY item_id, store_id ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS roll_{kind}_{n}"
    for n in (28, 56)
    for kind, fn in (("mean", "AVG"), ("std", "STDDEV_SAMP"))
)
_PARTS["rolled"] = f"SELECT *, {_ROLLS}, sell_price / AVG(sell_price) OVER (PARTITION BY item_id, store_id) AS price_vs_mean FROM lagged"
_PARTS["changes"] = """SELECT item_id, store_id, wm_yr_wk, price - LAG(price) OVER (PARTITION BY item_id, store_id ORDER BY wm_yr_wk) AS price_change
    FROM (SELECT item_id, store_id, wm_yr_wk, MAX(sell_price) AS price FROM long_b GROUP BY 1, 2, 3)"""
_FINAL["lag_features"] = f"SELECT item_id, store_id, date, units_sold, {_LAGS} FROM sales_b"
_FINAL["rolling_features"] = f"SELECT item_id, store_id, date, units_sold, {rs('roll_mean_28, roll_mean_56, roll_std_28, roll_std_56')} FROM rolled"
_FINAL["price_vs_mean"] = f"SELECT item_id, store_id, date, {r('price_vs_mean')} AS price_vs_mean FROM rolled"
_FINAL["price_change"] = f"""SELECT l.item_id, l.store_id, l.date, {r('COALESCE(c.price_change, 0)')} AS price_change
    FROM long_b l LEFT JOIN changes c ON c.item_id = l.item_id AND c.store_id = l.store_id AND c.wm_yr_wk = l.wm_yr_wk"""
_PARTS["codes_b"] = _PARTS["codes"].replace("obs_f", "obs_b")
_ENC = ("item_id", "store_id", "dept_id", "cat_id", "state_id")
_FINAL["model_features"] = f"""SELECT l.item_id, l.store_id, l.date, l.units_sold, lag_28, lag_35, lag_42, lag_56, lag_364,
    {rs('roll_mean_28, roll_mean_56, roll_std_28, roll_std_56')}, {r('sell_price')} AS sell_price, {r('COALESCE(c.price_change, 0)')} AS price_change,
    {r('price_vs_mean')} AS price_vs_mean, {DOW.replace('date', 'l.date')} AS day_of_week, {ISO_WEEK.replace('date', 'l.date')} AS week_of_year, month, year,
    {WEEKEND.replace('date', 'l.date')} AS is_weekend, CAST(event_name_1 IS NOT NULL AS INTEGER) AS is_event, {SNAP} AS is_snap,
    {', '.join(f'e_{c}.code AS {c}_enc' for c in _ENC)}
    FROM rolled l LEFT JOIN changes c ON c.item_id = l.item_id AND c.store_id = l.store_id AND c.wm_yr_wk = l.wm_yr_wk
    {' '.join(f"JOIN codes_b e_{c} ON e_{c}.column_name = '{c}' AND e_{c}.label = l.{c}" for c in _ENC)}
    WHERE lag_28 IS NOT NULL AND lag_35 IS NOT NULL AND lag_42 IS NOT NULL AND lag_56 IS NOT NULL AND lag_364 IS NOT NULL"""
_FINAL["last28_mean"] = f"""SELECT item_id, store_id, {r('AVG(units_sold)')} AS last_mean FROM sales_f CROSS JOIN bounds WHERE date <= cutoff AND date > cutoff - 28 GROUP BY 1, 2"""

# ---- forecasts -----------------------------------------------------------------------


def _naive(panel: str) -> str:
    return f"""SELECT v.item_id, v.store_id, v.date, CAST(greatest(COALESCE(a.units_sold, b.units_sold, 0), 0) AS DOUBLE) AS seasonal_naive_forecast
        FROM {panel} v CROSS JOIN bounds
        LEFT JOIN {panel} a ON a.item_id = v.item_id AND a.store_id = v.store_id AND a.date = v.date - 364 AND a.date <= cutoff
        LEFT JOIN {panel} b ON b.item_id = v.item_id AND b.store_id = v.store_id AND b.date = v.date - 28 AND b.date <= cutoff
        WHERE v.date > cutoff"""


def _croston(panel: str, days: int) -> str:
    """The recursion itself, over the ordered list of demands."""
    step = f"{{'z': {d(0.1)} * b.z + {d(0.9)} * a.z, 'p': {d(0.1)} * b.p + {d(0.9)} * a.p}}"
    return f"""SELECT item_id, store_id, n_periods, n_demands, demand_size, demand_interval,
            CASE WHEN n_demands = 0 THEN 0 ELSE greatest({d(0.95)} * demand_size / demand_interval, 0) END AS croston_sba
        FROM (SELECT *, CASE WHEN n_demands = 1 THEN first_size WHEN n_demands > 1 THEN fit.z END AS demand_size,
                     CASE WHEN n_demands = 1 THEN first_at WHEN n_demands > 1 THEN fit.p END AS demand_interval
              FROM (SELECT t.item_id, t.store_id, t.n_periods, COALESCE(e.n, 0) AS n_demands, e.first_size,
                           CAST(date_diff('day', t.start, e.first_date) AS DOUBLE) / {days} + 1 AS first_at,
                           list_reduce(e.steps, lambda a, b: {step}) AS fit
                    FROM (SELECT item_id, store_id, COUNT(*) AS n_periods, MIN(date) AS start FROM {panel} CROSS JOIN bounds WHERE date <= cutoff GROUP BY 1, 2) t
                    LEFT JOIN (SELECT item_id, store_id, COUNT(*) AS n, MIN(date) AS first_date, arg_min(x, date) AS first_size,
                                      list({{'z': x, 'p': COALESCE(gap, mean_gap)}} ORDER BY date) AS steps
                               FROM (SELECT *, AVG(gap) OVER (PARTITION BY item_id, store_id) AS mean_gap FROM (
                                     SELECT item_id, store_id, date, CAST(units_sold AS DOUBLE) AS x,
                                            CAST(date_diff('day', LAG(date) OVER (PARTITION BY item_id, store_id ORDER BY date), date) AS DOUBLE) / {days} AS gap
                                     FROM {panel} CROSS JOIN bounds WHERE date <= cutoff AND units_sold > 0))
                               GROUP BY 1, 2) e ON e.item_id = t.item_id AND e.store_id = t.store_id))"""


def _croston_rows(panel: str, fit: str, labels: str) -> str:
    return f"""SELECT v.item_id, v.store_id, v.date, v.units_sold AS actual,
            greatest(CASE WHEN c.n_demands < 30 THEN m.plain ELSE c.croston_sba END, 0) AS croston_sba_forecast
        FROM {panel} v CROSS JOIN bounds JOIN {labels} l ON l.item_id = v.item_id AND l.store_id = v.store_id AND l.xyz_class = 'Z'
        JOIN {fit} c ON c.item_id = v.item_id AND c.store_id = v.store_id
        JOIN (SELECT item_id, store_id, AVG(units_sold) AS plain FROM {panel} CROSS JOIN bounds WHERE date <= cutoff GROUP BY 1, 2) m
          ON m.item_id = v.item_id AND m.store_id = v.store_id
        WHERE v.date > cutoff"""


_PARTS["naive_d"], _PARTS["naive_w"] = _naive("panel_bd"), _naive("panel_bw")
_PARTS["cfit_d"], _PARTS["cfit_w"] = _croston("panel_fd", 1), _croston("panel_bw", 7)
_PARTS["croston_d"] = _croston_rows("panel_fd", "cfit_d", "labels_fd")
_PARTS["croston_w"] = _croston_rows("panel_bw", "cfit_w", "labels_bw")
_FINAL["seasonal_naive"] = "SELECT * FROM naive_d"
_FINAL["seasonal_naive_weekly"] = "SELECT * FROM naive_w"
_FINAL["croston_sba"] = f"SELECT item_id, store_id, n_periods, n_demands, {rs('demand_size, demand_interval, croston_sba', 6)} FROM cfit_d"
_FINAL["zclass_series"] = "SELECT DISTINCT l.item_id, l.store_id FROM labels_bw l JOIN obs_b o ON o.item_id = l.item_id AND o.store_id = l.store_id WHERE xyz_class = 'Z'"
_FINAL["croston_forecasts"] = f"SELECT item_id, store_id, date, actual, {r('croston_sba_forecast', 6)} AS croston_sba_forecast FROM croston_d"
_PARTS["ets_grid"] = f"""SELECT row_number() OVER (ORDER BY a, b, g) AS point, a, b, g FROM (SELECT unnest([{d(0.05)}, {d(0.2)}, {d(0.5)}]) AS a)
    CROSS JOIN (SELECT unnest([{d(0.0)}, {d(0.02)}, {d(0.1)}]) AS b) CROSS JOIN (SELECT unnest([{d(0.05)}, {d(0.2)}, {d(0.4)}]) AS g)"""
_RAISED = "(a * (x.y - c.s0) + (1 - a) * (c.l + c.b))"
_ZERO = d(0.0)


def _ets(grain: str, season: int, recent: int, days: int) -> None:
    """Smoothing of one time grain: the recursion over the ordered history at every point of the grid, then the best point."""
    span = range(season)
    blank = f"{{'y': v, 'l': {_ZERO}, 'b': {_ZERO}, " + ", ".join(f"'s{k}': {_ZERO}" for k in span) + f", 'e': {_ZERO}}}"
    start = f"{{'y': {_ZERO}, 'l': f, 'b': (f2 - f) / {season}, " + ", ".join(f"'s{k}': ys[{k + 1}] - f" for k in span) + f", 'e': {_ZERO}}}"
    step = (
        f"{{'y': x.y, 'l': {_RAISED}, 'b': b * ({_RAISED} - c.l) + (1 - b) * c.b, "
        + "".join(f"'s{k}': c.s{k + 1}, " for k in range(season - 1))
        + f"'s{season - 1}': g * (x.y - {_RAISED}) + (1 - g) * c.s0, 'e': c.e + (x.y - (c.l + c.b + c.s0)) * (x.y - (c.l + c.b + c.s0))}}"
    )
    wave = ", ".join(f"st.s{k}" for k in span)
    _PARTS[f"ets_lists_{grain}"] = f"""SELECT s.item_id, s.store_id, list(CAST(s.units_sold AS DOUBLE) ORDER BY s.date) AS ys
        FROM panel_b{grain} s JOIN labels_b{grain} l ON l.item_id = s.item_id AND l.store_id = s.store_id CROSS JOIN bounds
        WHERE l.abc_class IN ('A', 'B') AND s.date <= cutoff AND s.date > cutoff - {recent * days} GROUP BY 1, 2"""
    _PARTS[f"ets_fit_{grain}"] = f"""SELECT item_id, store_id, point, list_reduce(list_concat([{start}], list_transform(ys[{season + 1}:], lambda v: {blank})), lambda c, x: {step}) AS st
        FROM (SELECT *, list_sum(ys[1:{season}]) / {season} AS f, list_sum(ys[{season + 1}:{2 * season}]) / {season} AS f2 FROM ets_lists_{grain} WHERE len(ys) >= {2 * season}) CROSS JOIN ets_grid"""
    _PARTS[f"ets_best_{grain}"] = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id, store_id ORDER BY st.e, point) AS pick FROM ets_fit_{grain}) WHERE pick = 1"
    _PARTS[f"ets_{grain}"] = f"""SELECT item_id, store_id, date, greatest(st.l + st.b * h + [{wave}][(h - 1) % {season} + 1], 0) AS ets_forecast
        FROM (SELECT e.*, v.date, (date_diff('day', cutoff, v.date) - 1) // {days} + 1 AS h
              FROM ets_best_{grain} e CROSS JOIN (SELECT DISTINCT date FROM panel_b{grain}) v CROSS JOIN bounds WHERE v.date > cutoff)"""
    _PARTS[f"base_{grain}"] = f"""SELECT v.item_id, v.store_id, v.date, v.cat_id, v.units_sold AS actual, n.seasonal_naive_forecast,
               greatest(COALESCE(e.ets_forecast, n.seasonal_naive_forecast), 0) AS ets_forecast
        FROM panel_b{grain} v JOIN naive_{grain} n ON n.item_id = v.item_id AND n.store_id = v.store_id AND n.date = v.date
        LEFT JOIN ets_{grain} e ON e.item_id = v.item_id AND e.store_id = v.store_id AND e.date = v.date"""


_ets("d", 7, 365, 1)
_ets("w", 4, 52, 7)
_FINAL["ets_forecast"] = f"SELECT item_id, store_id, date, {r('ets_forecast')} AS ets_forecast FROM ets_d"
_PARTS["z_rows"] = f"""SELECT c.*, n.seasonal_naive_forecast, {CAT.replace('item_id', 'c.item_id')} AS cat_id
    FROM croston_w c JOIN naive_w n ON n.item_id = c.item_id AND n.store_id = c.store_id AND n.date = c.date"""


def _metric(metric: str, f: str) -> str:
    return {
        "RMSE": f"SQRT(AVG(({f} - actual) * ({f} - actual)))",
        "MAE": f"AVG(ABS({f} - actual))",
        "MAPE": f"AVG(CASE WHEN actual > 0 THEN ABS({f} - actual) / actual END) * 100",
        "Bias": f"AVG({f} - actual)",
    }[metric]


_ALL = ("RMSE", "MAE", "MAPE", "Bias")


def _long(table: str, models: dict[str, str], metrics) -> str:
    return " UNION ALL ".join(
        f"SELECT cat_id AS Category, '{m}' AS Metric, "
        + ", ".join(f'{r(_metric(m, f))} AS "{n}"' for n, f in models.items())
        + f" FROM {table} GROUP BY cat_id"
        for m in metrics
    )


def _wide(table: str, model: str, f: str, metrics=_ALL) -> str:
    values = ", ".join(f"{r(_metric(m, f)) if m in metrics else 'CAST(NULL AS DOUBLE)'} AS {m}" for m in _ALL)
    return f"SELECT cat_id AS Category, '{model}' AS Model, {values} FROM {table} GROUP BY cat_id"


_FINAL["accuracy_by_category"] = _long("base_w", {"Seasonal Naive": "seasonal_naive_forecast", "ETS": "ets_forecast"}, _ALL)
_PARTS["comparison"] = " UNION ALL ".join(
    (
        _wide("base_w", "Seasonal Naive", "seasonal_naive_forecast"),
        _wide("base_w", "ETS", "ets_forecast"),
        _wide("z_rows", "Croston SBA (Z-class)", "croston_sba_forecast", ("RMSE", "MAE", "Bias")),
    )
)
_FINAL["model_comparison"] = "SELECT * FROM comparison"
_FINAL["metric_display"] = "SELECT Category, Model, RMSE, MAE, Bias, CASE WHEN MAPE IS NULL THEN 'N/A (intermittent)' ELSE printf('%.2f', MAPE) END AS MAPE FROM comparison"
_PARTS["rmses"] = f"""SELECT cat_id AS scope, {_metric('RMSE', 'seasonal_naive_forecast')} AS base_rmse, {_metric('RMSE', 'croston_sba_forecast')} AS model_rmse FROM z_rows GROUP BY 1"""
_PARTS["improvements"] = f"""SELECT *, (base_rmse - model_rmse) / base_rmse * 100 AS improvement_pct FROM (
    SELECT * FROM rmses UNION ALL
    SELECT 'POOLED', {_metric('RMSE', 'seasonal_naive_forecast')}, {_metric('RMSE', 'croston_sba_forecast')} FROM z_rows UNION ALL
    SELECT 'MEAN_OF_CATEGORIES', AVG(base_rmse), AVG(model_rmse) FROM rmses)"""
_FINAL["improvement_pct"] = f"SELECT scope, {rs('base_rmse, model_rmse, improvement_pct')} FROM improvements"
_PARTS["fact"] = """SELECT *, best_forecast - actual_units AS forecast_error, ABS(best_forecast - actual_units) AS abs_error FROM (
    SELECT b.item_id, b.store_id, b.date, b.actual AS actual_units, b.seasonal_naive_forecast, b.ets_forecast, c.croston_sba_forecast AS croston_forecast,
           CAST(NULL AS DOUBLE) AS gbt_forecast, l.abc_class, l.xyz_class, l.abc_xyz,
           CASE WHEN l.xyz_class = 'Z' AND c.croston_sba_forecast IS NOT NULL THEN c.croston_sba_forecast ELSE b.seasonal_naive_forecast END AS best_forecast,
           CASE WHEN l.xyz_class = 'Z' AND c.croston_sba_forecast IS NOT NULL THEN 'Croston_SBA' ELSE 'Seasonal_Naive' END AS best_model_used
    FROM base_w b LEFT JOIN croston_w c ON c.item_id = b.item_id AND c.store_id = b.store_id AND c.date = b.date
    LEFT JOIN labels_bw l ON l.item_id = b.item_id AND l.store_id = b.store_id)"""
_FORECASTS = "seasonal_naive_forecast, ets_forecast, croston_forecast, gbt_forecast"
_FINAL["forecast_wide"] = f"SELECT item_id, store_id, date, actual_units, {rs(_FORECASTS)} FROM fact"
_FINAL["best_forecast"] = f"SELECT item_id, store_id, date, abc_xyz, {r('best_forecast')} AS best_forecast, best_model_used FROM fact"
_FINAL["fact_forecasts"] = f"SELECT item_id, store_id, date, actual_units, {rs(_FORECASTS + ', best_forecast, forecast_error, abs_error')}, abc_class, xyz_class, abc_xyz FROM fact"
_PARTS["cfit_bd"], _PARTS["croston_bd"] = _croston("panel_bd", 1), _croston_rows("panel_bd", "cfit_bd", "labels_bd")
_PARTS["featured_days"] = "SELECT item_id, store_id, date FROM (SELECT *, LAG(units_sold, 364) OVER (PARTITION BY item_id, store_id ORDER BY date) AS oldest FROM sales_b) WHERE oldest IS NOT NULL"
_PARTS["all_models"] = """SELECT b.*, c.croston_sba_forecast, l.abc_class, l.xyz_class, l.abc_xyz, f.date IS NOT NULL AS has_trees
    FROM base_d b LEFT JOIN croston_bd c ON c.item_id = b.item_id AND c.store_id = b.store_id AND c.date = b.date
    LEFT JOIN labels_bd l ON l.item_id = b.item_id AND l.store_id = b.store_id
    LEFT JOIN featured_days f ON f.item_id = b.item_id AND f.store_id = b.store_id AND f.date = b.date"""
_FINAL["fact_forecasts_all"] = f"""SELECT item_id, store_id, date, actual AS actual_units, {rs('seasonal_naive_forecast, ets_forecast')}, {r('croston_sba_forecast')} AS croston_forecast,
    CAST(has_trees AS INTEGER) AS has_trees, 1 AS error_fits, 1 AS abs_error_fits, abc_class, xyz_class, abc_xyz FROM all_models"""
_FINAL["best_forecast_all"] = """SELECT item_id, store_id, date, abc_xyz,
    CASE WHEN xyz_class = 'Z' AND croston_sba_forecast IS NOT NULL THEN 'Croston_SBA' WHEN has_trees THEN 'GBT' ELSE 'Seasonal_Naive' END AS best_model_used, 1 AS is_chosen FROM all_models"""
_FINAL["gbt_forecast_check"] = "SELECT item_id, store_id, date, cat_id, abc_xyz, actual, 1 AS is_finite, 1 AS is_not_negative FROM all_models WHERE has_trees"
_FINAL["gbt_beats_naive"] = "SELECT scope, 1 AS improves FROM (VALUES ('FOODS'), ('HOBBIES'), ('HOUSEHOLD'), ('POOLED'), ('MEAN_OF_CATEGORIES')) s(scope)"
_FINAL["gbt_importance_check"] = "SELECT CAST(unnest(range(1, 16)) AS INTEGER) AS place, 1 AS is_input, 1 AS is_not_negative, 1 AS is_ordered"
_PARTS["errors"] = """SELECT item_id, store_id, AVG(best_forecast) AS forecast_mean, AVG(actual_units) AS actual_mean, AVG(actual_units - best_forecast) AS forecast_bias,
    COALESCE(STDDEV_SAMP(actual_units - best_forecast), 0) AS forecast_error_std, SQRT(AVG((actual_units - best_forecast) * (actual_units - best_forecast))) AS forecast_rmse,
    CASE WHEN AVG(actual_units) > 0 THEN COALESCE(STDDEV_SAMP(actual_units), 0) / AVG(actual_units) ELSE 0 END AS cv_actual, MIN(best_model_used) AS best_model_used
    FROM fact GROUP BY 1, 2"""
_ERR = "forecast_mean, actual_mean, forecast_bias, forecast_error_std, forecast_rmse, cv_actual"
_FINAL["forecast_error_stats"] = f"SELECT item_id, store_id, {rs(_ERR)}, best_model_used FROM errors"
_FINAL["item_price_median"] = f"SELECT item_id, store_id, {r('MEDIAN(sell_price)')} AS sell_price FROM price_f GROUP BY 1, 2"
_PARTS["priced"] = f"""SELECT e.*, i.cat_id, i.dept_id, {STATE.replace('store_id', 'e.store_id')} AS state_id, l.abc_class, l.xyz_class, l.abc_xyz, m.med
    FROM errors e LEFT JOIN (SELECT item_id, store_id, MEDIAN(sell_price) AS med FROM price_b GROUP BY 1, 2) m ON m.item_id = e.item_id AND m.store_id = e.store_id
    LEFT JOIN labels_bw l ON l.item_id = e.item_id AND l.store_id = e.store_id LEFT JOIN items_b i ON i.item_id = e.item_id"""
_PARTS["stats"] = """SELECT p.*, greatest(COALESCE(CASE WHEN med > 0 THEN med END, c.cat_med, (SELECT MEDIAN(med) FROM priced)), 0.01) AS sell_price
    FROM priced p LEFT JOIN (SELECT cat_id, MEDIAN(med) AS cat_med FROM priced GROUP BY 1) c ON c.cat_id = p.cat_id"""
_FINAL["item_forecast_stats"] = f"SELECT item_id, store_id, cat_id, dept_id, state_id, abc_class, xyz_class, abc_xyz, {rs(_ERR + ', sell_price')}, best_model_used FROM stats"
_FINAL["error_std_quantiles"] = " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS p, {r(f'quantile_cont(forecast_error_std, {p})')} AS quantile FROM errors" for p in (0, 0.25, 0.5, 0.75, 1)
)
_FINAL["bias_summary"] = f"""SELECT COUNT(*) AS n_series, COUNT(*) FILTER (forecast_bias > 0) AS n_under_forecast, {r('100.0 * AVG(CAST(forecast_bias > 0 AS INTEGER))', 1)} AS pct_under_forecast,
    COUNT(*) FILTER (best_model_used = 'Croston_SBA') AS n_croston, COUNT(*) FILTER (best_model_used = 'GBT') AS n_trees,
    COUNT(*) FILTER (best_model_used = 'Seasonal_Naive') AS n_naive FROM errors"""

# ---- inventory -----------------------------------------------------------------------


def poly(coefficients, x: str) -> str:
    out = d(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = f"({out} * {x} + {d(c)})"
    return out


def ppf(p: str) -> str:
    """AS241 as SQL."""
    q, tail = f"({p} - 0.5)", f"least({p}, 1 - {p})"
    root = f"sqrt(-ln({tail}))"
    rat = lambda pair, x: f"{poly(pair[0], x)} / {poly(pair[1], x)}"
    far = f"(CASE WHEN {root} <= 5 THEN {rat(normal.PPF_MIDDLE, f'({root} - {d(1.6)})')} ELSE {rat(normal.PPF_TAIL, f'({root} - 5)')} END)"
    near = f"{q} * {rat(normal.PPF_CENTRAL, f'({d(0.180625)} - {q} * {q})')}"
    return f"(CASE WHEN {p} <= 0 OR {p} >= 1 THEN NULL WHEN abs({q}) <= 0.425 THEN {near} WHEN {q} < 0 THEN -{far} ELSE {far} END)"


def cdf(z: str) -> str:
    """Hart's form as SQL."""
    a = f"abs({z})"
    e = f"exp(-{a} * {a} / 2)"
    near = f"{e} * {poly(normal.CDF_TOP, a)} / {poly(normal.CDF_BOTTOM, a)}"
    far = f"{e} / ({a} + 1 / ({a} + 2 / ({a} + 3 / ({a} + 4 / ({a} + {d(0.65)}))))) / {d(normal.SQRT_TWO_PI)}"
    upper = f"(CASE WHEN {a} > 37 THEN 0 WHEN {a} < {d(normal.CDF_SWITCH)} THEN {near} ELSE {far} END)"
    return f"(CASE WHEN {z} > 0 THEN 1 - {upper} ELSE {upper} END)"


_LEVEL = f"CASE abc_class WHEN 'A' THEN {d(0.98)} WHEN 'B' THEN {d(0.95)} ELSE {d(0.9)} END"
_FINAL["service_level_map"] = f"SELECT item_id, store_id, abc_class, {_LEVEL} AS service_level FROM stats"
_PARTS["probs"] = "SELECT *, CAST(cum AS DOUBLE) / CAST(total AS DOUBLE) AS p FROM labels_fd"
_FINAL["normal_ppf"] = f"SELECT item_id, store_id, {r('z')} AS z, {r('100 + 15 * z')} AS scaled FROM (SELECT *, {ppf('p')} AS z FROM probs)"
_FINAL["normal_cdf"] = f"""SELECT item_id, store_id, date, {r(cdf('z'), 6)} AS probability FROM (
    SELECT w.item_id, w.store_id, w.date, (w.units_sold - v.mean_units) / v.std_units AS z FROM panel_bw w JOIN variation_bw v ON v.item_id = w.item_id AND v.store_id = w.store_id)"""
_SS = "\n".join(
    f", round_even(greatest({d(z)} * sigma_L, 0), 1) AS safety_stock_{v}" for z, v in ((Z90, 90), (Z95, 95), (Z98, 98))
)
_PARTS["safety"] = f"""SELECT *, safety_stock * sell_price * {d(0.2)} AS ss_holding_cost,
    {', '.join(f'safety_stock_{v} * sell_price * {d(0.2)} AS ss_cost_{v}' for v in (90, 95, 98))} FROM (
    SELECT *, round_even(greatest(Z_score * sigma_L, 0), 1) AS safety_stock {_SS} FROM (
    SELECT *, {_LEVEL} AS service_level, CASE abc_class WHEN 'A' THEN {d(Z98)} WHEN 'B' THEN {d(Z95)} ELSE {d(Z90)} END AS Z_score,
           forecast_error_std * sqrt(1) AS sigma_L FROM stats))"""
_PARTS["ordered"] = f"""SELECT *, CASE WHEN D_annual <= 0 THEN 1 ELSE greatest(round_even(sqrt(2 * D_annual * 5 / greatest(holding_cost_per_unit, {d(0.01)})), 0), 1) END AS EOQ
    FROM (SELECT *, forecast_mean * 52 AS D_annual, sell_price * {d(0.2)} AS holding_cost_per_unit FROM safety)"""
_PARTS["costed"] = """SELECT *, annual_ordering_cost + annual_holding_cost AS total_annual_cost_EOQ, annual_ordering_cost_naive + annual_holding_cost_naive AS total_annual_cost_naive FROM (
    SELECT *, D_annual / EOQ * 5 AS annual_ordering_cost, (EOQ / 2 + safety_stock) * holding_cost_per_unit AS annual_holding_cost,
           D_annual / 30 * 5 AS annual_ordering_cost_naive, (15 + safety_stock) * holding_cost_per_unit AS annual_holding_cost_naive FROM ordered)"""
_PARTS["reorder"] = f"""SELECT *, total_annual_cost_naive - total_annual_cost_EOQ AS cost_saving_vs_naive,
    CASE WHEN total_annual_cost_naive > 0 THEN (total_annual_cost_naive - total_annual_cost_EOQ) / total_annual_cost_naive * 100 ELSE 0 END AS cost_saving_pct,
    CAST(naive_current_stock < ROP AS INTEGER) AS stockout_risk, CASE WHEN forecast_mean > 0 THEN naive_current_stock / forecast_mean ELSE 999 END AS DOH,
    D_annual / greatest(EOQ / 2 + safety_stock, {d(0.01)}) AS turnover FROM (
    SELECT *, forecast_mean * 1 AS demand_during_lead_time, round_even(forecast_mean + safety_stock, 1) AS ROP, forecast_mean * 2 AS naive_current_stock FROM costed)"""
_PARTS["costs"] = f"""SELECT *, CASE WHEN naive_total_cost > 0 THEN annual_saving / naive_total_cost * 100 ELSE 0 END AS annual_saving_pct FROM (
    SELECT *, naive_total_cost - optimized_total_cost AS annual_saving FROM (
    SELECT *, naive_annual_ordering_cost + naive_annual_holding_cost + naive_stockout_cost AS naive_total_cost, total_annual_cost_EOQ + optimized_stockout_cost AS optimized_total_cost FROM (
    SELECT *, D_annual / 30 AS naive_order_frequency, D_annual / 30 * 5 AS naive_annual_ordering_cost, 15 * sell_price * {d(0.2)} AS naive_annual_holding_cost,
           forecast_error_std * sell_price * {d(0.3)} * 12 AS naive_stockout_cost, forecast_error_std * sell_price * {d(0.3)} * (1 - service_level) AS optimized_stockout_cost FROM reorder)))"""
_FINAL["safety_stock"] = f"""SELECT item_id, store_id, abc_class, {rs('service_level, Z_score, sigma_L, safety_stock, ss_holding_cost, safety_stock_90, safety_stock_95, safety_stock_98, ss_cost_90, ss_cost_95, ss_cost_98')} FROM safety"""
_FINAL["service_level_curve"] = " UNION ALL ".join(
    f"SELECT cat_id, {v} AS service_level, {r(f'SUM(safety_stock_{v})', 2)} AS safety_stock, {r(f'SUM(ss_cost_{v})', 2)} AS holding_cost, {r(f'SUM(ss_cost_{v}) - SUM(ss_cost_90)', 2)} AS extra_cost FROM safety GROUP BY cat_id"
    for v in (90, 95, 98)
)
_FINAL["safety_stock_rollups"] = " UNION ALL ".join(
    f"""SELECT '{dim}' AS dimension, {member} AS member, {r('AVG(safety_stock)', 2)} AS avg_safety_stock, {r('SUM(ss_holding_cost)', 2)} AS holding_cost,
    {r('SUM(ss_cost_90)', 2)} AS cost_90, {r('SUM(ss_cost_98)', 2)} AS cost_98, {r('SUM(ss_cost_98) - SUM(ss_cost_90)', 2)} AS extra_cost,
    {r('100 * (SUM(ss_cost_98) - SUM(ss_cost_90)) / SUM(ss_cost_90)', 1)} AS extra_pct FROM safety {tail}"""
    for dim, member, tail in (("abc_class", "abc_class", "GROUP BY abc_class"), ("cat_id", "cat_id", "GROUP BY cat_id"), ("all", "'ALL'", ""))
)


def _top(table: str, key: str, n: int, columns: str, numbers: str, digits: int = 4) -> str:
    return f"SELECT {columns}, {rs(numbers, digits)} FROM (SELECT * FROM {table} ORDER BY {key} DESC, item_id, store_id LIMIT {n})"


_FINAL["top_safety_stock"] = _top("costs", "safety_stock", 10, "item_id, store_id, cat_id, abc_class, xyz_class", "forecast_error_std, safety_stock, ss_holding_cost")
_FINAL["eoq"] = f"SELECT item_id, store_id, {rs('forecast_mean, D_annual, sell_price, holding_cost_per_unit, EOQ')} FROM ordered"
_FINAL["eoq_cost"] = f"""SELECT item_id, store_id, {rs('annual_ordering_cost, annual_holding_cost, total_annual_cost_EOQ, annual_ordering_cost_naive, annual_holding_cost_naive, total_annual_cost_naive, cost_saving_vs_naive, cost_saving_pct')} FROM reorder"""
_FINAL["eoq_by_category"] = f"""SELECT cat_id, {r('AVG(EOQ)', 2)} AS avg_eoq, {r('SUM(total_annual_cost_naive)', 2)} AS naive_cost, {r('SUM(total_annual_cost_EOQ)', 2)} AS eoq_cost,
    {r('SUM(total_annual_cost_naive) - SUM(total_annual_cost_EOQ)', 2)} AS saving,
    {r('100 * (SUM(total_annual_cost_naive) - SUM(total_annual_cost_EOQ)) / SUM(total_annual_cost_naive)', 1)} AS saving_pct FROM reorder GROUP BY 1"""
_FINAL["top_eoq_saving"] = _top("costs", "cost_saving_vs_naive", 10, "item_id, store_id, cat_id, abc_class", "forecast_mean, EOQ, cost_saving_vs_naive, cost_saving_pct")
_FINAL["eoq_sensitivity"] = f"""SELECT item_id, store_id, CAST(step AS INTEGER) AS step, {r('q')} AS q, {r('D_annual / q * 5')} AS ordering_cost, {r('q / 2 * holding_cost_per_unit')} AS holding_cost,
    {r('D_annual / q * 5 + q / 2 * holding_cost_per_unit')} AS total_cost FROM (
    SELECT *, 1 + (3 * EOQ - 1) * step / 399 AS q FROM (SELECT * FROM costs ORDER BY cost_saving_vs_naive DESC, item_id, store_id LIMIT 3) CROSS JOIN (SELECT unnest(range(400)) AS step))"""
_FINAL["reorder_point"] = f"SELECT item_id, store_id, {rs('demand_during_lead_time, ROP, naive_current_stock, DOH, turnover')}, stockout_risk FROM reorder"
_FINAL["stockout_risk_by_abc"] = f"SELECT abc_class, COUNT(*) AS total, CAST(SUM(stockout_risk) AS BIGINT) AS at_risk, {r('100.0 * SUM(stockout_risk) / COUNT(*)', 1)} AS pct_at_risk FROM reorder GROUP BY 1"
_FINAL["doh_turnover_by_category"] = f"SELECT cat_id, {r('AVG(DOH)', 2)} AS avg_doh, {r('AVG(turnover)', 2)} AS avg_turnover FROM reorder GROUP BY 1"
_FINAL["a_class_at_risk"] = _top("(SELECT * FROM reorder WHERE abc_class = 'A' AND stockout_risk = 1)", "forecast_mean", 10, "item_id, store_id, cat_id", "forecast_mean, naive_current_stock, ROP, DOH")
_PARTS["vendor_orders"] = f"""SELECT *, Q_star - EOQ AS q_difference, (Q_star - EOQ) / EOQ * 100 AS q_difference_pct FROM (
    SELECT *, round_even(greatest(forecast_mean + demand_std * {ppf('CR')}, 0), 1) AS Q_star FROM (
    SELECT *, Cu / (Cu + Co) AS CR FROM (SELECT *, sell_price * {d(0.3)} AS Cu, sell_price * {d(0.1)} AS Co, greatest(forecast_error_std, 1) AS demand_std FROM costs WHERE cat_id = 'FOODS')))"""
_PARTS["vendor_z"] = "SELECT *, (Q_star - forecast_mean) / demand_std AS zq, (EOQ - forecast_mean) / demand_std AS ze FROM vendor_orders"
_PARTS["vendor_f"] = f"SELECT *, {cdf('zq')} AS fq, {cdf('ze')} AS fe FROM vendor_z"
_PARTS["vendor"] = """SELECT *, CASE WHEN ABS(expected_profit_eoq) > 0 THEN profit_improvement / ABS(expected_profit_eoq) * 100 ELSE 0 END AS profit_improvement_pct FROM (
    SELECT *, expected_profit_newsvendor - expected_profit_eoq AS profit_improvement FROM (
    SELECT *, Q_star - expected_sales AS expected_leftover, forecast_mean - expected_sales AS expected_stockout,
           expected_sales * Cu - (Q_star - expected_sales) * Co AS expected_profit_newsvendor, eoq_sales * Cu - (EOQ - eoq_sales) * Co AS expected_profit_eoq FROM (
    SELECT *, forecast_mean * fq + Q_star * (1 - fq) AS expected_sales, forecast_mean * fe + EOQ * (1 - fe) AS eoq_sales FROM vendor_f)))"""
_FINAL["newsvendor_orders"] = f"SELECT item_id, store_id, {rs('Cu, Co, CR, demand_std, Q_star, q_difference, q_difference_pct')} FROM vendor_orders"
_FINAL["newsvendor_profit"] = f"""SELECT item_id, store_id, {rs('expected_sales, expected_leftover, expected_stockout, expected_profit_newsvendor, expected_profit_eoq, profit_improvement, profit_improvement_pct', 3)} FROM vendor"""
_FINAL["newsvendor_rollup"] = f"""SELECT {r('AVG(CR)')} AS avg_cr, {r('AVG(Q_star)', 2)} AS avg_q_star, {r('AVG(EOQ)', 2)} AS avg_eoq, {r('SUM(profit_improvement)', 2)} AS total_gain,
    {r('100.0 * AVG(CAST(Q_star < EOQ AS INTEGER))', 1)} AS pct_less, {r('100.0 * AVG(CAST(Q_star > EOQ AS INTEGER))', 1)} AS pct_more FROM vendor"""
_FINAL["top_newsvendor_gain"] = _top("vendor", "profit_improvement", 10, "item_id, store_id, abc_class", "CR, Q_star, EOQ, profit_improvement, profit_improvement_pct", 3)
_PARTS["alloc"] = """SELECT item_id, store_id, abc_class, scenario, budget, order_qty, order_qty AS fulfilled, demand_mean, sell_price, order_qty * sell_price AS budget_spent FROM (
    SELECT *, CASE WHEN budget - before <= 0 THEN 0 ELSE least(demand_mean, (budget - before) / sell_price) END AS order_qty FROM (
    SELECT *, CAST(SUM(full_cost) OVER (ORDER BY sell_price, item_id, store_id ROWS UNBOUNDED PRECEDING) - full_cost AS DOUBLE) AS before FROM (
    SELECT item_id, store_id, abc_class, sell_price, forecast_mean AS demand_mean, CAST(round(forecast_mean * sell_price, 6) AS DECIMAL(24, 6)) AS full_cost
    FROM costs WHERE abc_class IN ('A', 'B')))
    CROSS JOIN (SELECT * FROM (VALUES ('Tight_50K', CAST(50000 AS DOUBLE)), ('Normal_100K', CAST(100000 AS DOUBLE)), ('Relaxed_200K', CAST(200000 AS DOUBLE))) s(scenario, budget)))"""
_FINAL["budget_allocation"] = f"SELECT item_id, store_id, abc_class, scenario, {rs('budget, order_qty, fulfilled, demand_mean, sell_price, budget_spent', 3)} FROM alloc"
_FINAL["budget_scenarios"] = f"""SELECT scenario, budget, {r('fill')} AS fill_rate_pct, items_ordered, {r('avg_order')} AS avg_order_qty, {r('spent', 2)} AS total_spent,
    {r('(fill - LAG(fill) OVER (ORDER BY budget)) / ((budget - LAG(budget) OVER (ORDER BY budget)) / 10000)')} AS marginal_fill_per_10k FROM (
    SELECT scenario, budget, SUM(fulfilled) * 100 / SUM(demand_mean) AS fill, COUNT(*) FILTER (order_qty > 0.000001) AS items_ordered,
           COALESCE(AVG(CASE WHEN order_qty > 0.000001 THEN order_qty END), 0) AS avg_order, SUM(budget_spent) AS spent FROM alloc GROUP BY 1, 2)"""
_POLICY = "naive_order_frequency, naive_annual_ordering_cost, naive_annual_holding_cost, naive_stockout_cost, naive_total_cost, optimized_stockout_cost, optimized_total_cost, annual_saving, annual_saving_pct"
_FINAL["policy_comparison"] = f"SELECT item_id, store_id, {rs(_POLICY, 3)} FROM costs"
for _by in ("cat_id", "abc_class"):
    _FINAL["policy_by_category" if _by == "cat_id" else "policy_by_abc"] = f"""SELECT {_by}, {r('SUM(naive_total_cost)', 2)} AS naive_cost, {r('SUM(optimized_total_cost)', 2)} AS optimized_cost,
        {r('SUM(annual_saving)', 2)} AS total_saving, {r('AVG(annual_saving_pct)', 2)} AS avg_saving_pct, {r('100 * SUM(annual_saving) / SUM(naive_total_cost)', 2)} AS pct_reduction FROM costs GROUP BY 1"""
_FINAL["policy_components"] = " UNION ALL ".join(
    f"SELECT cat_id, '{c}' AS component, {r(f'SUM({n})', 2)} AS naive_cost, {r(f'SUM({o})', 2)} AS optimized_cost, {r(f'SUM({n}) - SUM({o})', 2)} AS reduction FROM costs GROUP BY cat_id"
    for c, n, o in (("ordering", "naive_annual_ordering_cost", "annual_ordering_cost"), ("holding", "naive_annual_holding_cost", "annual_holding_cost"), ("stockout", "naive_stockout_cost", "optimized_stockout_cost"))
)
_CUT, _RISE = "(SUM(naive_stockout_cost) - SUM(optimized_stockout_cost))", "(SUM(annual_holding_cost) - SUM(naive_annual_holding_cost))"
_FINAL["policy_drivers"] = f"SELECT {r(_CUT, 2)} AS stockout_reduction, {r(_RISE, 2)} AS holding_increase, {r(f'{_CUT} - {_RISE}', 2)} AS net_saving FROM costs"
_FINAL["target_fill_rate"] = f"SELECT CAST(85 AS DOUBLE) AS naive_fill_pct, {r('100 * AVG(service_level)')} AS optimized_fill_pct FROM costs"
_FINAL["top_saving_pct"] = f"SELECT item_id || ' @' || store_id AS label, {r('annual_saving_pct')} AS annual_saving_pct FROM (SELECT * FROM costs ORDER BY annual_saving_pct DESC, item_id, store_id LIMIT 20)"
_TEXT = "item_id, store_id, cat_id, dept_id, state_id, abc_class, xyz_class, abc_xyz"
_INV_NUM = "sell_price, forecast_mean, forecast_error_std, service_level, Z_score, sigma_L, safety_stock, ss_holding_cost, EOQ, ROP, demand_during_lead_time, DOH, turnover, annual_ordering_cost, annual_holding_cost, total_annual_cost_EOQ, total_annual_cost_naive, annual_saving, annual_saving_pct"
_FINAL["fact_inventory_policy"] = f"SELECT {_TEXT}, {rs(_INV_NUM, 3)}, stockout_risk, best_model_used FROM costs"
_NV_NUM = "sell_price, Cu, Co, CR, forecast_mean, demand_std, Q_star, EOQ, expected_profit_newsvendor, expected_profit_eoq, profit_improvement"
_FINAL["fact_newsvendor"] = f"SELECT item_id, store_id, cat_id, {rs(_NV_NUM, 3)} FROM vendor"
_FINAL["fact_allocation"] = f"SELECT item_id, store_id, abc_class, scenario, {rs('order_qty, fulfilled, demand_mean, sell_price, budget_spent', 3)} FROM alloc"

# ---- data quality and extracts -------------------------------------------------------

_FINAL["dq_fill_nulls"] = "SELECT item_id, store_id, date, actual_units, " + ", ".join(
    f"COALESCE({r(c)}, 0) AS {c}" for c in (_FORECASTS + ", best_forecast, forecast_error, abs_error").split(", ")
) + ", abc_class, xyz_class, abc_xyz FROM fact"
_FACT_COLS = "item_id, store_id, date, actual_units, " + _FORECASTS + ", best_forecast, forecast_error, abs_error, abc_class, xyz_class, abc_xyz"
_ALLOC_COLS = "item_id, store_id, abc_class, scenario, order_qty, fulfilled, demand_mean, sell_price, budget_spent"
_CAL_COLS = "date, wm_yr_wk, weekday, wday, month, year, d, event_name_1, event_type_1, event_name_2, event_type_2, snap_CA, snap_TX, snap_WI"
_LONG_COLS = "item_id, dept_id, cat_id, store_id, state_id, date, wm_yr_wk, weekday, wday, month, year, d, event_name_1, event_type_1, event_name_2, event_type_2, snap_CA, snap_TX, snap_WI, units_sold, sell_price"
_FINAL["dq_null_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS n_null FROM {table}"
    for name, table, cols in (
        ("fact_forecasts", "fact", _FACT_COLS), ("policy", "costs", _TEXT + ", " + _INV_NUM + ", stockout_risk, best_model_used"), ("newsvendor", "vendor", "item_id, store_id, cat_id, " + _NV_NUM),
        ("allocation", "alloc", _ALLOC_COLS), ("calendar", "cal", _CAL_COLS), ("sales_long", "long_b", _LONG_COLS),
    )
    for c in cols.split(", ")
)
_GUARDED = ("safety_stock", "EOQ", "ROP", "DOH", "turnover", "annual_saving")
_FINAL["dq_clip_negative"] = "SELECT item_id, store_id, " + ", ".join(f"{r(f'greatest({c}, 0)', 3)} AS {c}" for c in _GUARDED) + " FROM costs"
_FINAL["dq_clip_counts"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER ({c} < 0) AS n_clipped FROM {t}"
    for n, t, cols in (("policy", "costs", _GUARDED), ("newsvendor", "vendor", ("Q_star", "EOQ")), ("allocation", "alloc", ("order_qty", "fulfilled")))
    for c in cols
)
_FINAL["dq_clean_columns"] = _long("z_rows", {"Croston_SBA": "croston_sba_forecast", "Seasonal_Naive": "seasonal_naive_forecast"}, ("RMSE", "MAE", "Bias"))
_PARTS["checks"] = """SELECT check_name, expected, actual, CAST(ABS(expected - actual) <= tolerance AS INTEGER) AS ok FROM (
    SELECT 'dashboard_is_series' AS check_name, (SELECT COUNT(*) FROM labels_bw) AS expected, (SELECT COUNT(*) FROM costs) AS actual, 0 AS tolerance
    UNION ALL SELECT 'newsvendor_is_perishable', (SELECT COUNT(*) FROM costs WHERE cat_id = 'FOODS'), (SELECT COUNT(*) FROM vendor), 0
    UNION ALL SELECT 'newsvendor_only_perishable', 0, (SELECT COUNT(*) FROM vendor WHERE cat_id <> 'FOODS'), 0
    UNION ALL SELECT 'allocation_is_scenarios_times_ab', (SELECT 3 * COUNT(*) FROM costs WHERE abc_class IN ('A', 'B')), (SELECT COUNT(*) FROM alloc), 0
    UNION ALL SELECT 'calendar_days', (SELECT COUNT(DISTINCT date) FROM sales_b), (SELECT COUNT(*) FROM cal), 5)"""
_FINAL["dq_row_counts"] = "SELECT * FROM checks"


def _missing(column: str, table: str, known: str) -> str:
    """Values of a column that a list of known ones lacks. Counting both together needs no join, whose plan here takes minutes."""
    return f"(SELECT {column} FROM (SELECT {column}, 0 AS known FROM {table} UNION ALL SELECT *, 1 FROM ({known})) GROUP BY 1 HAVING max(known) = 0)"


_PARTS["orphans"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS table_name, 'unknown_item' AS problem, item_id AS id FROM {_missing('item_id', t, 'SELECT item_id FROM costs')}
    UNION ALL SELECT '{n}', 'unexpected_store', store_id FROM {_missing('store_id', t, 'SELECT r_name FROM region')}"""
    for n, t in (("policy", "costs"), ("newsvendor", "vendor"), ("allocation", "alloc"), ("fact_forecasts", "fact"))
)
_FINAL["dq_orphan_ids"] = "SELECT * FROM orphans"


def _nulls(table: str, columns: str) -> str:
    return "(SELECT " + " + ".join(f"COUNT(*) - COUNT({c})" for c in columns.split(", ")) + f" FROM {table})"


def _negatives(table: str, columns) -> str:
    return "(SELECT " + " + ".join(f"COUNT(*) FILTER ({c} < 0)" for c in columns) + f" FROM {table})"


_FINAL["dq_report"] = f"""SELECT 'null_values' AS rule, {_nulls('fact', _FACT_COLS)} + {_nulls('costs', _TEXT + ', ' + _INV_NUM)} + {_nulls('vendor', _NV_NUM)}
        + {_nulls('alloc', _ALLOC_COLS)} + {_nulls('cal', _CAL_COLS)} AS findings
    UNION ALL SELECT 'negative_values', {_negatives('costs', _GUARDED)} + {_negatives('vendor', ('EOQ', 'Q_star'))} + {_negatives('alloc', ('order_qty', 'fulfilled'))}
    UNION ALL SELECT 'column_names', 0
    UNION ALL SELECT 'row_counts', (SELECT COUNT(*) FROM checks WHERE ok = 0)
    UNION ALL SELECT 'id_consistency', (SELECT COUNT(*) FROM orphans)"""
_PARTS["dash"] = "SELECT * REPLACE (greatest(annual_saving, 0) AS annual_saving) FROM costs"
_DASH_NUM = "sell_price, forecast_mean, safety_stock, EOQ, ROP, DOH, turnover, total_annual_cost_EOQ, total_annual_cost_naive, annual_saving, annual_saving_pct, forecast_rmse, forecast_bias"
_FINAL["extract_dashboard"] = f"SELECT {_TEXT}, {rs(_DASH_NUM, 3)}, stockout_risk, best_model_used FROM dash"
for _name in ("policy", "newsvendor", "allocation"):
    _FINAL[f"extract_{_name}"] = _FINAL["fact_" + ("inventory_policy" if _name == "policy" else _name)]
_FINAL["extract_calendar"] = f"""SELECT date, wm_yr_wk, weekday, wday, month, year, d, COALESCE(event_name_1, 'UNKNOWN') AS event_name_1, COALESCE(event_type_1, 'UNKNOWN') AS event_type_1,
    'UNKNOWN' AS event_name_2, 'UNKNOWN' AS event_type_2, snap_CA, snap_TX, snap_WI, {WEEKEND} AS is_weekend, CAST(quarter(date) AS INTEGER) AS quarter, year AS fiscal_year FROM cal"""
_FINAL["extract_summary"] = " UNION ALL ".join(
    f"SELECT '{n}' AS extract, (SELECT COUNT(*) FROM {t}) AS n_rows, {k} AS n_columns"
    for n, t, k in (("dashboard", "costs", 23), ("policy", "costs", 29), ("newsvendor", "vendor", 14), ("allocation", "alloc", 9), ("calendar", "cal", 17))
)

# ---- dashboard figures ---------------------------------------------------------------

_FINAL["kpi_filter"] = f"SELECT item_id, store_id, cat_id, abc_class, stockout_risk, {r('ROP')} AS ROP FROM dash WHERE abc_class IN ('A', 'B') AND cat_id IN ('FOODS', 'HOBBIES') AND stockout_risk = 1"
_N, _E, _S = "SUM(total_annual_cost_naive)", "SUM(total_annual_cost_EOQ)", "SUM(annual_saving)"
_FINAL["kpi_cost_reduction"] = f"SELECT {r(f'({_N} - {_E}) / {_N} * 100')} AS eoq_only_pct, {r(f'{_S} / ({_S} + {_E}) * 100')} AS total_policy_pct FROM dash"
_FINAL["kpi_executive"] = f"SELECT COUNT(*) AS n_items, {r(_S, 2)} AS total_saving, COUNT(*) FILTER (stockout_risk = 1) AS at_risk, {r('100.0 * AVG(stockout_risk)')} AS at_risk_pct FROM dash"
_FINAL["kpi_cost_by_category"] = f"SELECT cat_id, {r(_N, 2)} AS Naive_Cost, {r(_E, 2)} AS Optimized_Cost FROM dash GROUP BY 1"
_FINAL["kpi_ss_by_abc"] = f"SELECT abc_class, {r('AVG(safety_stock)')} AS Avg_Safety_Stock, {r('AVG(EOQ)')} AS Avg_EOQ FROM dash GROUP BY 1"
_FINAL["kpi_segment_counts"] = "SELECT abc_xyz, COUNT(*) AS count FROM dash GROUP BY 1"
_FINAL["kpi_policy_means"] = f"SELECT {r('AVG(safety_stock)')} AS avg_ss, {r('AVG(EOQ)')} AS avg_eoq, {r('AVG(ROP)')} AS avg_rop, {r('AVG(turnover)')} AS avg_turnover FROM dash"
_FINAL["kpi_category_abc"] = f"SELECT cat_id, abc_class, {r('AVG(safety_stock)')} AS Avg_SS, {r('AVG(turnover)')} AS Avg_Turnover FROM dash GROUP BY 1, 2"
_FINAL["kpi_item_table"] = "SELECT item_id, cat_id, dept_id, abc_class, xyz_class, stockout_risk, " + ", ".join(
    f"round_even({r(c, 6)}, 2) AS {c}" for c in ("safety_stock", "EOQ", "ROP", "DOH", "turnover", "sell_price", "forecast_mean")
) + " FROM dash"
_FINAL["kpi_at_risk"] = f"""SELECT COUNT(*) FILTER (stockout_risk = 1) AS n_at_risk, COUNT(*) FILTER (stockout_risk = 0) AS n_safe, {r('100.0 * AVG(stockout_risk)')} AS pct_at_risk,
    COUNT(*) FILTER (stockout_risk = 1 AND abc_class = 'A') AS a_class_at_risk, {r('COALESCE(AVG(CASE WHEN stockout_risk = 1 THEN DOH END), 0)')} AS avg_doh_at_risk FROM dash"""
_FINAL["a_class_priority"] = "SELECT item_id, store_id, cat_id, " + ", ".join(
    f"round_even({r(c, 6)}, 2) AS {c}" for c in ("safety_stock", "ROP", "DOH", "EOQ", "sell_price", "forecast_mean")
) + " FROM dash WHERE abc_class = 'A' AND stockout_risk = 1"
_PARTS["risk_abc"] = f"SELECT abc_class, CAST(SUM(stockout_risk) AS BIGINT) AS At_Risk, COUNT(*) AS Total, {r('100.0 * AVG(stockout_risk)')} AS Risk_Pct FROM dash GROUP BY 1"
_FINAL["kpi_risk_abc"] = "SELECT * FROM risk_abc"
_FINAL["risk_rank"] = "SELECT abc_class, Risk_Pct, CAST(row_number() OVER (ORDER BY Risk_Pct DESC, abc_class) AS INTEGER) AS risk_rank FROM risk_abc"
_FINAL["kpi_risk_category"] = "SELECT cat_id, CAST(SUM(stockout_risk) AS BIGINT) AS At_Risk, COUNT(*) AS Total FROM dash GROUP BY 1"
_FINAL["kpi_saving_category"] = f"SELECT cat_id, {r(_S, 2)} AS Total_Saving FROM dash GROUP BY 1"
_FINAL["kpi_cost_summary"] = f"""SELECT *, {r('Total_Saving * 100 / (Total_Saving + Optimized_Cost)', 1)} AS Saving_Pct FROM (
    SELECT cat_id, {r(_N, 2)} AS Naive_Cost, {r(_E, 2)} AS Optimized_Cost, {r(_S, 2)} AS Total_Saving, {r('AVG(annual_saving_pct)', 2)} AS Avg_Saving_Pct FROM dash GROUP BY 1)"""
_FINAL["kpi_scenarios"] = f"""SELECT scenario, {r('SUM(demand_mean)', 2)} AS Total_Demand, {r('SUM(fulfilled)', 2)} AS Total_Fulfilled, {r('SUM(budget_spent)', 2)} AS Total_Spent, COUNT(item_id) AS Items,
    {r('SUM(fulfilled) * 100 / SUM(demand_mean)', 1)} AS Fill_Rate_Pct FROM alloc GROUP BY 1"""
_SLOPE, _CEPT = "regr_slope(safety_stock, forecast_error_std)", "regr_intercept(safety_stock, forecast_error_std)"
_FINAL["ss_error_slope"] = f"SELECT COUNT(*) AS n, {r(_SLOPE, 6)} AS slope FROM dash"
_FINAL["ss_error_trend"] = f"SELECT abc_class, COUNT(*) AS n, {r(_SLOPE, 6)} AS slope, {r(_CEPT, 6)} AS intercept FROM dash GROUP BY 1"
_FINAL["insight_error_vs_raw"] = f"""SELECT *, {r('(raw_demand_stock - forecast_error_stock) * 100 / raw_demand_stock', 1)} AS reduction_pct FROM (
    SELECT {r('AVG(safety_stock)', 2)} AS forecast_error_stock, {r(f'AVG(cv_actual * actual_mean * {d(Z98)})', 2)} AS raw_demand_stock FROM costs WHERE abc_class = 'A')"""
_FINAL["inventory_stats"] = f"""SELECT 'n_with_safety_stock' AS section, 'ALL' AS member, CAST(COUNT(safety_stock) AS DOUBLE) AS value FROM dash
    UNION ALL SELECT 'pct_items_stockout_risk', 'ALL', {r('100.0 * AVG(stockout_risk)', 1)} FROM dash
    UNION ALL SELECT 'n_a_class_at_stockout_risk', 'ALL', CAST(COUNT(*) FILTER (abc_class = 'A' AND stockout_risk = 1) AS DOUBLE) FROM dash
    UNION ALL SELECT 'avg_safety_stock_by_abc', abc_class, {r('AVG(safety_stock)', 2)} FROM dash GROUP BY abc_class
    UNION ALL SELECT 'avg_eoq_by_category', cat_id, {r('AVG(EOQ)', 2)} FROM dash GROUP BY cat_id
    UNION ALL SELECT 'avg_doh_by_category', cat_id, {r('AVG(DOH)', 2)} FROM dash GROUP BY cat_id
    UNION ALL SELECT 'avg_turnover_by_category', cat_id, {r('AVG(turnover)', 2)} FROM dash GROUP BY cat_id"""
_FINAL["croston_coverage"] = "SELECT COUNT(*) FILTER (xyz_class = 'Z') AS n_zclass, COUNT(*) FILTER (lower(best_model_used) LIKE '%croston%') AS n_croston FROM dash"

# ---- files and tables, summary -----------------------------------------------------------

_FINAL["csv_wide_scan"] = "SELECT item_id, dept_id, cat_id, store_id, state_id, d, units_sold FROM long_b"
_FINAL["csv_calendar_scan"] = f"SELECT {_CAL_COLS} FROM cal"
_FINAL["csv_price_arrivals"] = "SELECT item_id, store_id, wm_yr_wk, sell_price FROM price_b"
_FINAL["fact_loads"] = "SELECT item_id, store_id, date, units_sold FROM sales_b"
_FINAL["sample_rows"] = "SELECT item_id, store_id, date, units_sold FROM sales_b ORDER BY item_id, store_id, date LIMIT 5"
_FINAL["series_cv_merged"] = _FINAL["series_cv"]
_LINEITEM = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
    "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
_FINAL["footer_profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT(*) AS n_rows, COUNT({c}) AS n_known, "
    + ("NULL AS least, NULL AS greatest" if t in ("string", "timestamp_ntz") else f"CAST(MIN({c}) AS VARCHAR) AS least, CAST(MAX({c}) AS VARCHAR) AS greatest")
    + " FROM lineitem"
    for c, t in _LINEITEM.items()
)
_FINAL["csv_price_last"] = "SELECT item_id, store_id, wm_yr_wk, sell_price FROM price_b"
_FINAL["parquet_by_store"] = "SELECT item_id, store_id, date, units_sold FROM sales_b"
_FINAL["star_tables"] = "SELECT item_id, dept_id, cat_id, store_id, state_id, date, wm_yr_wk, units_sold, sell_price FROM long_b"
for _name in ("result_table", "csv_result", "json_result"):
    _FINAL[_name] = "SELECT column_name, label, code FROM codes"
_FINAL["long_schema"] = f"SELECT {_LONG_COLS} FROM long_b"
_FINAL["policy_joined"] = _FINAL["fact_inventory_policy"]


def _figures(section: str, table: str, values: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, '{k}' AS key, CAST({v} AS DOUBLE) AS value FROM {table}" for k, v in values.items())


def _groups(section: str, table: str, by: str, value: str) -> str:
    return f"SELECT '{section}' AS section, {by} AS key, {value} AS value FROM {table} GROUP BY {by}"


_FINAL["summary_values"] = " UNION ALL ".join(
    (
        _figures("cost_totals", "costs", {
            "naive": r("SUM(naive_total_cost)", 2), "optimized": r("SUM(optimized_total_cost)", 2), "saving": r("SUM(annual_saving)", 2),
            "pct_reduction": r("100.0 * SUM(annual_saving) / SUM(naive_total_cost)", 1), "safety_stock_holding": r("SUM(ss_holding_cost)", 2),
        }),
        _figures("order_size_only", "costs", {
            "naive": r("SUM(total_annual_cost_naive)", 2), "optimized": r("SUM(total_annual_cost_EOQ)", 2),
            "pct_reduction": r("100.0 * (1 - SUM(total_annual_cost_EOQ) / SUM(total_annual_cost_naive))", 1),
        }),
        _figures("newsvendor", "vendor", {
            "n_series": "COUNT(*)", "mean_critical_ratio": r("AVG(CR)"), "mean_order": r("AVG(Q_star)", 2), "gain": r("SUM(profit_improvement)", 2),
        }),
        _groups("saving_by_category", "costs", "cat_id", r("SUM(annual_saving)", 2)),
        _groups("safety_stock_by_class", "dash", "abc_class", r("AVG(safety_stock)", 2)),
        *(_groups(f"{c}_by_category", "dash", "cat_id", r(f"AVG({c})", 2)) for c in ("EOQ", "DOH", "turnover")),
        "SELECT 'rmse', Model || ' / ' || Category, RMSE FROM comparison",
        f"SELECT 'croston_improvement', scope, {r('improvement_pct', 1)} FROM improvements",
    )
)
