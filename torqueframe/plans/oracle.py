"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Plain SQL windows and aggregates over the same stand-in definitions. The
dealer's group lists (``category_groups``) are taken from the vocabulary, as
they are fixed values; all else is written out."""

from __future__ import annotations

SALES = """sales AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         greatest(l_shipdate, o_orderdate) AS sell_date, least(l_shipdate, o_orderdate) AS buy_date,
         p_type AS cfg_type, split_part(p_name, ' ', 1) AS cfg_colour, split_part(p_name, ' ', 2) AS cfg_item,
         CAST(abs(date_diff('day', o_orderdate, l_shipdate)) AS BIGINT) AS stock_days,
         l_discount * 100 AS margem_percentagem,
         CAST(CASE WHEN abs(date_diff('day', o_orderdate, l_shipdate)) <= 365 AND l_discount * 100 >= 3.5
                   THEN 1 ELSE 0 END AS BIGINT) AS new_score
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)"""

KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
CFG = "cfg_type, cfg_colour, cfg_item"
ORD = f"sell_date, {KEY}"
SALE_ID = "concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"

SQL: dict[str, str] = {}

SQL["config_history"] = f"""
WITH {SALES},
h AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER p AS size,
         lag(new_score) OVER w AS lv, lag(margem_percentagem) OVER w AS lm, lag(stock_days) OVER w AS ld,
         sum(new_score) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs,
         avg(new_score) OVER p AS g_avg, min(new_score) OVER p AS g_min, max(new_score) OVER p AS g_max,
         quantile_cont(new_score, 0.75) OVER p AS g_q3, quantile_cont(new_score, 0.5) OVER p AS g_q2,
         quantile_cont(new_score, 0.25) OVER p AS g_q1
  FROM sales
  WINDOW p AS (PARTITION BY {CFG}), w AS (PARTITION BY {CFG} ORDER BY {ORD})),
d AS (SELECT *, CASE WHEN pos = 1 THEN 0.0 ELSE CAST(cs AS DOUBLE) / pos END AS dyn FROM h),
e AS (SELECT *, stddev_pop(dyn) OVER (PARTITION BY {CFG}) AS dyn_std,
             lag(dyn) OVER (PARTITION BY {CFG} ORDER BY {ORD}) AS prev_dyn FROM d),
f AS (SELECT *, lag(dyn_std) OVER (PARTITION BY {CFG} ORDER BY {ORD}) AS prev_dyn_std FROM e)
SELECT {KEY}, {CFG}, new_score,
  CAST(CASE WHEN size > 1 AND pos > 1 THEN 1 ELSE 0 END AS BIGINT) AS prev_sales_check,
  CAST(CASE WHEN size > 1 THEN pos - 1 ELSE 0 END AS BIGINT) AS number_prev_sales,
  round(CASE WHEN size > 1 THEN coalesce(CAST(lv AS DOUBLE), 0) ELSE 0 END, 6) AS last_score,
  round(CASE WHEN size > 1 THEN coalesce(lm, 0) ELSE 0 END, 6) AS last_margin,
  round(CASE WHEN size > 1 THEN coalesce(CAST(ld AS DOUBLE), 0) ELSE 0 END, 6) AS last_stock_days,
  round(CASE WHEN size > 1 THEN dyn ELSE 0 END, 6) AS average_score_dynamic,
  round(CASE WHEN size > 1 THEN dyn_std ELSE 0 END, 6) AS average_score_dynamic_std,
  round(CASE WHEN size > 1 THEN coalesce(prev_dyn, 0) ELSE 0 END, 6) AS prev_average_score_dynamic,
  round(CASE WHEN size > 1 THEN coalesce(prev_dyn_std, 0) ELSE 0 END, 6) AS prev_average_score_dynamic_std,
  round(CASE WHEN size > 1 THEN g_avg ELSE 0 END, 6) AS average_score_global,
  round(CASE WHEN size > 1 THEN CAST(g_min AS DOUBLE) ELSE 0 END, 6) AS min_score_global,
  round(CASE WHEN size > 1 THEN CAST(g_max AS DOUBLE) ELSE 0 END, 6) AS max_score_global,
  round(CASE WHEN size > 1 THEN g_q3 ELSE 0 END, 6) AS q3_score_global,
  round(CASE WHEN size > 1 THEN g_q2 ELSE 0 END, 6) AS median_score_global,
  round(CASE WHEN size > 1 THEN g_q1 ELSE 0 END, 6) AS q1_score_global
FROM f"""

SQL["config_summary"] = f"""
WITH {SALES},
g AS (SELECT {CFG}, count(*) AS n, avg(margem_percentagem) AS am, CAST(trunc(avg(stock_days)) AS BIGINT) AS ad
      FROM sales GROUP BY {CFG})
SELECT {KEY}, s.cfg_type, s.cfg_colour, s.cfg_item, CAST(n AS BIGINT) AS nr_cars_sold,
       round(am, 6) AS average_percentage_margin, ad AS average_stock_days
FROM sales s JOIN g USING ({CFG})"""

SQL["stock_days"] = f"WITH {SALES} SELECT {KEY}, buy_date, sell_date, stock_days FROM sales"

SQL["binary_target"] = f"WITH {SALES} SELECT new_score, count(*) AS n FROM sales GROUP BY new_score"

SQL["minmax_score"] = f"""
WITH {SALES},
m AS (SELECT min(stock_days) dmin, max(stock_days) dmax, min(margem_percentagem) mmin,
             max(margem_percentagem) mmax FROM sales),
n AS (SELECT s.*, (stock_days - dmin) / nullif(CAST(dmax - dmin AS DOUBLE), 0) AS dn,
             (margem_percentagem - mmin) / nullif(mmax - mmin, 0) AS mn FROM sales s, m)
SELECT {KEY}, round(dn, 6) AS stock_days_norm, round(1 - dn, 6) AS inv_stock_days_norm,
       round(mn, 6) AS margem_percentagem_norm, round((1 - dn) * mn, 6) AS score FROM n"""

SQL["bucket_classes"] = f"""
WITH {SALES},
m AS (SELECT min(stock_days) dmin, max(stock_days) dmax, min(margem_percentagem) mmin,
             max(margem_percentagem) mmax FROM sales),
n AS (SELECT stock_days, margem_percentagem / 20 AS mp,
             (1 - (stock_days - dmin) / nullif(CAST(dmax - dmin AS DOUBLE), 0))
               * ((margem_percentagem - mmin) / nullif(mmax - mmin, 0)) AS score FROM sales, m),
c AS (SELECT
  CAST(CASE WHEN stock_days <= 16 THEN 0 WHEN stock_days <= 60 THEN 1 WHEN stock_days <= 100 THEN 2
            WHEN stock_days <= 200 THEN 3 WHEN stock_days IS NOT NULL THEN 4 END AS BIGINT) AS stock_class1,
  CAST(CASE WHEN stock_days <= 16 THEN 0 WHEN stock_days <= 29 THEN 1 WHEN stock_days <= 117 THEN 2
            WHEN stock_days IS NOT NULL THEN 3 END AS BIGINT) AS stock_class2,
  CAST(CASE WHEN mp <= 0.1 THEN 3 WHEN mp <= 0.206 THEN 2 WHEN mp <= 0.349 THEN 1
            WHEN mp IS NOT NULL THEN 0 END AS BIGINT) AS margem_class1,
  CAST(CASE WHEN score >= 0.7 THEN 1 WHEN score >= 0 THEN 0 END AS BIGINT) AS score_class
  FROM n)
SELECT stock_class1, stock_class2, margem_class1, score_class, count(*) AS n FROM c GROUP BY ALL"""

SQL["zscore_pop"] = f"""
WITH {SALES},
m AS (SELECT avg(stock_days) a1, stddev_pop(stock_days) s1, avg(margem_percentagem) a2,
             stddev_pop(margem_percentagem) s2, avg(l_extendedprice) a3, stddev_pop(l_extendedprice) s3 FROM sales)
SELECT {KEY}, round((stock_days - a1) / nullif(s1, 0), 6) AS stock_days_z,
       round((margem_percentagem - a2) / nullif(s2, 0), 6) AS margem_percentagem_z,
       round((l_extendedprice - a3) / nullif(s3, 0), 6) AS l_extendedprice_z FROM sales, m"""

SQL["alt_scaling"] = f"""
WITH {SALES},
m AS (SELECT max(stock_days) AS dmax FROM sales),
a AS (SELECT s.*, (dmax * CAST(stock_days AS DOUBLE) + 1) / nullif(CAST(stock_days AS DOUBLE) + 1, 0) AS n2
      FROM sales s, m),
b AS (SELECT min(n2) lo, max(n2) hi FROM a)
SELECT {KEY}, round(n2, 6) AS stock_days_norm_2, round((n2 - lo) / nullif(hi - lo, 0), 6) AS stock_days_norm_3
FROM a, b"""

SQL["tick_labels"] = f"""
WITH {SALES}, v AS (SELECT DISTINCT stock_days FROM sales),
m AS (SELECT min(stock_days) lo, max(stock_days) hi FROM v)
SELECT stock_days, printf('%.4f', 1 - (stock_days - lo) / nullif(CAST(hi - lo AS DOUBLE), 0)) AS stock_days_tick
FROM v, m"""

SQL["category_means"] = f"""
WITH {SALES},
m AS (SELECT min(stock_days) dmin, max(stock_days) dmax, min(margem_percentagem) mmin,
             max(margem_percentagem) mmax FROM sales),
n AS (SELECT s.*, (1 - (stock_days - dmin) / nullif(CAST(dmax - dmin AS DOUBLE), 0))
                  * ((margem_percentagem - mmin) / nullif(mmax - mmin, 0)) AS score FROM sales s, m)
SELECT cfg_type, round(avg(score), 6) AS avg_score, round(avg(stock_days), 6) AS avg_stock_days,
       round(avg(margem_percentagem), 6) AS avg_margem_percentagem FROM n GROUP BY cfg_type"""

SQL["pearson_margin_days"] = f"""
WITH {SALES} SELECT round(corr(margem_percentagem, CAST(stock_days AS DOUBLE)), 6) AS pearson_r FROM sales"""

SQL["one_hot"] = f"""
WITH {SALES} SELECT {KEY},
""" + ",\n".join(f"  CAST(CASE WHEN cfg_type = '{v}' THEN 1 ELSE 0 END AS BIGINT) AS cfg_type_{v}"
                 for v in ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]) + "\nFROM sales"

SQL["reverse_one_hot"] = f"WITH {SALES} SELECT {KEY}, cfg_colour FROM sales"

_FEAT = ["stock_days", "margem_percentagem", "l_linenumber", "l_extendedprice"]
_LONG = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, CAST(new_score AS VARCHAR) AS y FROM sales" for f in _FEAT)

SQL["chi2_score"] = f"""
WITH {SALES}, l AS ({_LONG}),
per AS (SELECT feature, y, sum(x) AS obs, count(*) AS nc FROM l GROUP BY feature, y),
t AS (SELECT feature, sum(obs) AS tot, sum(nc) AS n FROM per GROUP BY feature)
SELECT feature, round(sum((obs - nc / CAST(n AS DOUBLE) * tot) ^ 2 / nullif(nc / CAST(n AS DOUBLE) * tot, 0)), 6) AS score
FROM per JOIN t USING (feature) GROUP BY feature"""

_ANOVA = f"""
WITH {SALES}, l AS ({_LONG}),
per AS (SELECT feature, y, count(*) AS nc, sum(x) AS s, sum(x * x) AS ss FROM l GROUP BY feature, y),
g AS (SELECT feature, sum(nc) AS n, count(*) AS k, sum(s) AS s, sum(ss) AS ss, sum(s * s / nc) AS br
      FROM per GROUP BY feature),
f AS (SELECT feature, ((br - s * s / n) / (k - 1)) / nullif(((ss - s * s / n) - (br - s * s / n)) / (n - k), 0) AS score
      FROM g)"""

SQL["anova_f"] = _ANOVA + "\nSELECT feature, round(score, 6) AS score FROM f"

SQL["k_best_columns"] = _ANOVA + f""",
top AS (SELECT feature FROM (SELECT feature, row_number() OVER (ORDER BY score DESC NULLS LAST, feature) AS rk
                             FROM f) WHERE rk <= 2),
lf AS ({" UNION ALL ".join(f"SELECT {KEY}, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM sales" for c in _FEAT)})
SELECT {KEY}, lf.feature, round(value, 6) AS value FROM lf JOIN top ON lf.feature = top.feature"""

SQL["keep_one_target"] = f"""
WITH {SALES}
SELECT {KEY}, stock_days, round(margem_percentagem, 6) AS margem_percentagem,
       CAST(stock_days <= 90 AS BIGINT) AS fast_sale
FROM sales"""

SQL["cast_back"] = f"""
WITH {SALES}
SELECT {KEY}, stock_days, round(margem_percentagem, 6) AS margem_percentagem, new_score FROM sales"""

SQL["top_k_rank"] = _ANOVA + """
SELECT feature, round(score, 6) AS score, rank FROM (
  SELECT feature, score, CAST(row_number() OVER (ORDER BY score DESC NULLS LAST, feature) AS BIGINT) AS rank FROM f)
WHERE rank <= 3"""

_MI_FEAT = {"stock_years": "floor(stock_days / 365)", "margem_percentagem": "margem_percentagem",
            "l_linenumber": "l_linenumber"}
_MI_LONG = " UNION ALL ".join(
    f"SELECT '{k}' AS feature, CAST({v} AS DOUBLE) AS x, CAST(new_score AS VARCHAR) AS y FROM sales"
    for k, v in _MI_FEAT.items())
SQL["mutual_info"] = f"""
WITH {SALES}, l AS ({_MI_LONG}),
j AS (SELECT feature, x, y, count(*) AS nxy FROM l GROUP BY ALL),
k AS (SELECT *, sum(nxy) OVER (PARTITION BY feature) AS n, sum(nxy) OVER (PARTITION BY feature, x) AS nx,
             sum(nxy) OVER (PARTITION BY feature, y) AS ny FROM j)
SELECT feature, round(sum(nxy / CAST(n AS DOUBLE) * ln(nxy * CAST(n AS DOUBLE) / (nx * ny))), 6) AS score
FROM k GROUP BY feature"""

SQL["stratified_split"] = f"""
WITH {SALES},
r AS (SELECT {SALE_ID} AS sale_id, new_score,
        row_number() OVER (PARTITION BY new_score ORDER BY md5({SALE_ID} || ':2'), {SALE_ID}) AS rk,
        count(*) OVER (PARTITION BY new_score) AS nc FROM sales)
SELECT sale_id, new_score, CAST(CASE WHEN rk <= nc - ceil(nc * 0.25) THEN 1 ELSE 0 END AS BIGINT) AS is_train FROM r"""

SQL["oversample"] = f"""
WITH {SALES},
r AS (SELECT {SALE_ID} AS sale_id, new_score,
        row_number() OVER (PARTITION BY new_score ORDER BY md5({SALE_ID} || ':42'), {SALE_ID}) AS rk,
        count(*) OVER (PARTITION BY new_score) AS nc FROM sales),
m AS (SELECT max(nc) AS mx FROM r)
SELECT sale_id, new_score, CAST(floor(mx / nc) + CASE WHEN rk <= mx % nc THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM r, m"""

SQL["undersample"] = f"""
WITH {SALES},
r AS (SELECT {SALE_ID} AS sale_id, new_score,
        row_number() OVER (PARTITION BY new_score ORDER BY md5({SALE_ID} || ':42'), {SALE_ID}) AS rk,
        count(*) OVER (PARTITION BY new_score) AS nc FROM sales),
m AS (SELECT min(nc) AS mn FROM r)
SELECT sale_id, new_score FROM r, m WHERE rk <= mn"""

# ---------------------------------------------------------------- visits / segmentation
VISITS = """visits AS (
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
         ELSE lpad(CAST(o_custkey AS VARCHAR), 6, '0') END AS registration_number,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'WBA' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') END AS chassis_number,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS vehicle_in_date,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
         ELSE TIMESTAMP '1994-06-01' + to_days(CAST(c_nationkey * 40 AS INTEGER)) END AS registration_date_pse,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL
         ELSE TIMESTAMP '1995-01-01' + to_days(CAST(c_nationkey * 25 AS INTEGER)) END AS registration_date_vhe,
    CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 101 WHEN 'MACHINERY' THEN 701 END AS BIGINT) AS nlr_code,
    CAST(floor(o_totalprice / 10) AS BIGINT) AS kms,
    CAST(c_nationkey AS DOUBLE) / 4 AS anos_viatura,
    CAST(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE c_nationkey END AS BIGINT) AS slr_document_account,
    nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
    o_totalprice - 100000.0 AS total
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

CONTRACTS = """contracts AS (
  SELECT CASE WHEN held THEN lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS registration_number,
    CASE WHEN held AND c_acctbal >= 0 THEN lpad(CAST(c_custkey AS VARCHAR), 7, '0') END AS chassis_number,
    CASE WHEN held THEN CAST(c_nationkey AS DOUBLE) / 5 + 1 END AS cm_years,
    CASE WHEN held THEN c_acctbal * 5 + 20000 END AS cm_km,
    CASE WHEN held THEN TIMESTAMP '1994-01-01' END AS cm_date_start,
    CASE WHEN NOT held THEN NULL
         WHEN c_acctbal < 0 THEN TIMESTAMP '1995-06-01' + to_days(CAST(c_nationkey * 20 AS INTEGER))
         ELSE TIMESTAMP '1996-01-01' + to_days(CAST(c_nationkey * 73 AS INTEGER)) END AS cm_date_end
  FROM (SELECT *, c_mktsegment <> 'HOUSEHOLD' AS held FROM customer))"""

SQL["normalise_keys"] = f"""
WITH {VISITS}
SELECT o_orderkey,
  replace(substr(registration_number, 1, 2) || '-' || substr(registration_number, 3, 2) || '-'
          || substr(registration_number, 5, 10), '-', '') AS registration_number,
  right(chassis_number, 7) AS chassis_number
FROM visits"""

SQL["null_safe_exclude"] = f"""
WITH {VISITS}
SELECT o_orderkey, slr_document_account FROM visits
WHERE slr_document_account IS DISTINCT FROM 4 AND slr_document_account IS DISTINCT FROM 6"""

SQL["model_exclusions"] = f"""
WITH {VISITS}
SELECT o_orderkey, customer, nlr_code FROM visits
WHERE NOT contains(customer, '11') AND NOT contains(customer, '7')
  AND nlr_code IS DISTINCT FROM 701 AND nlr_code IS DISTINCT FROM 999"""

SQL["unmatched_plates"] = f"""
WITH {VISITS}, {CONTRACTS}
SELECT DISTINCT registration_number FROM visits v
WHERE registration_number IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM contracts c WHERE c.registration_number = v.registration_number)"""

SQL["key_error_flag"] = f"""
WITH {VISITS},
p AS (SELECT o_orderkey, CASE WHEN priority = '3-MEDIUM' THEN substr(registration_number, 2, 10)
                              ELSE registration_number END AS registration_number FROM visits)
SELECT o_orderkey, registration_number,
  CAST(CASE WHEN length(registration_number) <> 6 OR registration_number IN ('000000', '000001', '++++++')
            THEN 1 ELSE 0 END AS BIGINT) AS registration_number_error_flag
FROM p WHERE registration_number IS NOT NULL"""

SQL["sales_cleanup"] = f"""
WITH {VISITS}
SELECT o_orderkey, registration_number, CAST(slr_document_account AS VARCHAR) AS slr_account, round(total, 6) AS total
FROM visits
WHERE length(registration_number) = 6 AND total > 0
  AND coalesce(CAST(slr_document_account AS VARCHAR) NOT IN ('6', '4', '0', '1'), true)"""

SQL["ffill_bfill"] = f"""
WITH {VISITS}
SELECT o_orderkey, registration_number,
  CASE WHEN registration_number IS NULL THEN priority ELSE coalesce(
    last_value(priority IGNORE NULLS) OVER (PARTITION BY registration_number ORDER BY o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(priority IGNORE NULLS) OVER (PARTITION BY registration_number ORDER BY o_orderkey
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) END AS priority,
  CASE WHEN registration_number IS NULL THEN registration_date_pse ELSE coalesce(
    last_value(registration_date_pse IGNORE NULLS) OVER (PARTITION BY registration_number ORDER BY o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(registration_date_pse IGNORE NULLS) OVER (PARTITION BY registration_number ORDER BY o_orderkey
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) END AS registration_date_pse
FROM visits"""

SQL["contract_left_join"] = f"""
WITH {VISITS}, {CONTRACTS}
SELECT v.o_orderkey, v.registration_number, v.chassis_number, round(c.cm_years, 6) AS cm_years,
       round(c.cm_km, 6) AS cm_km, c.cm_date_start, c.cm_date_end
FROM visits v LEFT JOIN contracts c ON v.registration_number = c.registration_number"""

SQL["tail_key_left_join"] = f"""
WITH {VISITS}, {CONTRACTS}
SELECT v.o_orderkey, right(v.chassis_number, 7) AS chassis_number, round(c.cm_years, 6) AS cm_years
FROM visits v LEFT JOIN contracts c ON right(v.chassis_number, 7) = c.chassis_number"""

SQL["semi_membership"] = f"""
WITH {VISITS}, {CONTRACTS},
u AS (SELECT DISTINCT right(chassis_number, 7) AS chassis_number FROM visits WHERE nlr_code = 701)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM contracts
        WHERE chassis_number IN (SELECT chassis_number FROM u)) AS matching_rows,
       CAST(count(chassis_number) AS BIGINT) AS distinct_keys FROM u"""

_WARRANTY = """
w AS (SELECT v.*, y.wy FROM visits v JOIN (VALUES (101, 5), (701, 2)) y(code, wy) ON v.nlr_code = y.code),
wf AS (SELECT *,
  CAST(CASE WHEN registration_date_pse IS NULL OR vehicle_in_date IS NULL THEN NULL
            WHEN vehicle_in_date < registration_date_pse + to_days(CAST(wy * 365 AS INTEGER)) THEN 1 ELSE 0 END
       AS BIGINT) AS warranty_visit_pse,
  CAST(CASE WHEN registration_date_vhe IS NULL OR vehicle_in_date IS NULL THEN NULL
            WHEN vehicle_in_date < registration_date_vhe + to_days(CAST(wy * 365 AS INTEGER)) THEN 1 ELSE 0 END
       AS BIGINT) AS warranty_visit_vhe
  FROM w)"""

SQL["warranty_flag"] = f"""
WITH {VISITS}, {_WARRANTY}
SELECT o_orderkey, nlr_code, warranty_visit_pse, warranty_visit_vhe FROM wf"""

_CONTRACT_FLAG = """CAST(CASE WHEN c.cm_date_end IS NULL OR v.vehicle_in_date IS NULL THEN NULL
  WHEN v.vehicle_in_date <= c.cm_date_end AND v.anos_viatura <= c.cm_years AND v.kms <= c.cm_km THEN 1
  ELSE 0 END AS BIGINT)"""

SQL["contract_flag"] = f"""
WITH {VISITS}, {CONTRACTS}
SELECT v.o_orderkey, {_CONTRACT_FLAG} AS contract_visit
FROM visits v LEFT JOIN contracts c ON v.registration_number = c.registration_number"""

_ABANDONED = """ab AS (
  SELECT customer, registration_number,
    CAST(CASE WHEN bool_or(vehicle_in_date IS NULL) THEN NULL
              WHEN date_diff('day', max(vehicle_in_date), TIMESTAMP '2001-08-01') / 365.25 <= 2 THEN 0
              ELSE 1 END AS BIGINT) AS abandoned
  FROM visits WHERE customer IS NOT NULL AND registration_number IS NOT NULL
  GROUP BY customer, registration_number)"""

SQL["abandoned_flag"] = f"WITH {VISITS}, {_ABANDONED} SELECT * FROM ab"

def _regular_pct_sql(reg: str) -> str:
    return f"""
WITH {VISITS},
f AS (SELECT customer, registration_number, {reg} AS reg,
        row_number() OVER (PARTITION BY customer, registration_number
                           ORDER BY vehicle_in_date ASC NULLS LAST, o_orderkey) AS rn,
        count(*) OVER (PARTITION BY customer, registration_number) AS n
      FROM visits WHERE customer IS NOT NULL AND registration_number IS NOT NULL),
e AS (SELECT *, date_diff('day', reg, TIMESTAMP '2001-08-01') / 365.25 - 1 AS expected FROM f WHERE rn = 1)
SELECT customer, registration_number,
  CASE WHEN reg IS NULL THEN 'NULL' WHEN expected < 1 THEN '<2years' ELSE 'pct' END AS regular_status,
  round(CASE WHEN expected >= 1 THEN least(100.0, n / expected * 100.0) END, 6) AS regular_pct
FROM e"""


SQL["regular_pct"] = _regular_pct_sql("registration_date_pse")

SQL["joinback_agg"] = f"""
WITH {VISITS}, {_ABANDONED}
SELECT v.o_orderkey, v.customer, v.registration_number, ab.abandoned
FROM visits v JOIN ab ON v.customer = ab.customer AND v.registration_number = ab.registration_number"""

SQL["segmentation_flags"] = f"""
WITH {VISITS}, {CONTRACTS}, {_WARRANTY}, {_ABANDONED}
SELECT v.o_orderkey, v.warranty_visit_pse, v.warranty_visit_vhe, {_CONTRACT_FLAG} AS contract_visit, ab.abandoned
FROM wf v LEFT JOIN contracts c ON v.registration_number = c.registration_number
JOIN ab ON v.customer = ab.customer AND v.registration_number = ab.registration_number"""

# ---------------------------------------------------------------- option lines / vehicles
LINES = """lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
    concat_ws(' ', p_type, p_name, CAST(p_size AS VARCHAR)) AS opcional, p_name AS cor,
    concat_ws(' ', p_name, p_type) AS interior,
    concat_ws(' ', p_brand, p_type, p_name, CAST(p_size AS VARCHAR)) AS modelo,
    l_extendedprice AS custo
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
LORD = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"


def _tok(x: str) -> str:
    return (f"list_filter(string_split_regex(trim(regexp_replace({x}, '([,;:()\\[\\]\"!?])', ' \\1 ', 'g')), "
            f"'\\s+'), lambda t: t <> '')")


def _first_match(tok: str, words) -> str:
    arr = "[" + ", ".join(f"'{w}'" for w in words) + "]"
    return f"list_filter({arr}, lambda w: list_contains({tok}, w))"


FIRST = f"""first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LORD}) AS rn FROM lines)
  WHERE rn = 1)"""

SQL["token_flags"] = f"""
WITH {LINES}, t AS (SELECT l_orderkey, {_tok('lower(opcional)')} AS tok FROM lines)
SELECT l_orderkey,
  CAST(max(CAST(list_contains(tok, 'widget') AS INT)) AS BIGINT) AS navegacao,
  CAST(max(CAST(list_contains(tok, 'gear') AS INT)) AS BIGINT) AS sensores,
  CAST(max(CAST(list_contains(tok, 'economy') AS INT)) AS BIGINT) AS caixa_auto
FROM t GROUP BY l_orderkey"""

_EXT = (f"coalesce({_first_match('tok', ['red', 'blue'])}[1], "
        f"{_first_match('tok', ['hot', 'cold', 'new'])}[1])")

SQL["first_vocab_match"] = f"""
WITH {LINES}, {FIRST}, t AS (SELECT l_orderkey, {_tok('lower(cor)')} AS tok FROM first)
SELECT l_orderkey, {_EXT} AS cor_exterior FROM t"""

_MP = _first_match("tok", ["red", "blue", "hot", "gear", "bolt"])
_MS = _first_match("tok", ["cold", "new", "ring"])
_MULTI_INTENDED = "NULL"
for _words, _res in [(["dakota"], "dakota"), (["nevada"], "nevada"), (["preto", "antracite"], "preto/antracite"),
                     (["beje", "havanna"], "beje"), (["bege", "veneto"], "bege"), (["bege", "preto"], "bege"),
                     (["bege", "sonoma/preto"], "bege"), (["dacota", "bege"], "dakota"),
                     (["bege", "zagora/preto"], "bege"), (["bege", "veneto"], "bege"),
                     (["vernasca", "anthtacite/preto"], "vernasca")]:
    _cond = " AND ".join(f"list_contains(tok, '{w}')" for w in _words)
    _MULTI_INTENDED = f"CASE WHEN {_cond} THEN '{_res}' ELSE {_MULTI_INTENDED} END"


def _interior(multi: str) -> str:
    return f"""CASE WHEN list_contains(tok, 'standard') THEN 'preto' WHEN list_contains(tok, 'truffle') THEN 'truffle'
      WHEN len(m) = 0 THEN NULL WHEN len(m) > 1 THEN {multi} ELSE m[1] END"""


INTERIOR = f"""ti AS (SELECT l_orderkey, tok, CASE WHEN len({_MP}) > 0 THEN {_MP} ELSE {_MS} END AS m
  FROM (SELECT l_orderkey, {_tok('lower(interior)')} AS tok FROM first))"""

SQL["ruleset_override"] = f"""
WITH {LINES}, {FIRST}, {INTERIOR}
SELECT l_orderkey, {_interior("'vernasca'")} AS cor_interior_as_coded,
       {_interior(_MULTI_INTENDED)} AS cor_interior_intended FROM ti"""

_SIZES = "['15', '16', '17', '18', '19', '20']"
WHEELS = f"""sz AS (SELECT l_orderkey, {LORD},
    list_max(list_transform(list_filter({_SIZES}, lambda s: list_contains(tok, s)), lambda s: CAST(s AS INTEGER))) AS size
  FROM (SELECT *, {_tok('lower(opcional)')} AS tok FROM lines)),
wl AS (SELECT l_orderkey, size FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LORD.replace(', ', ' DESC, ')} DESC) AS rn
  FROM sz WHERE size IS NOT NULL) WHERE rn = 1),
wheels AS (SELECT v.l_orderkey, coalesce(CAST(wl.size AS VARCHAR), 'standard') AS jantes
  FROM (SELECT DISTINCT l_orderkey FROM lines) v LEFT JOIN wl USING (l_orderkey))"""

SQL["last_line_max"] = f"WITH {LINES}, {WHEELS} SELECT * FROM wheels"

MODEL = f"""mt AS (SELECT l_orderkey, {_tok('modelo')} AS tok FROM first),
model AS (SELECT l_orderkey,
  array_to_string(tok[1:CASE WHEN tok[1] = 'Brand#1' THEN 2 ELSE greatest(len(tok) - 3, 0) END], ' ') AS modelo FROM mt)"""

SQL["model_shorten"] = f"WITH {LINES}, {FIRST}, {MODEL} SELECT * FROM model"

SQL["price_total"] = f"""
WITH {LINES} SELECT l_orderkey, round(sum(custo), 6) AS price_total FROM lines GROUP BY l_orderkey"""

SQL["margin_pct"] = f"""
WITH {LINES}, t AS (SELECT l_orderkey, sum(custo) AS tot FROM lines GROUP BY l_orderkey)
SELECT l.l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       round(o_totalprice * 0.05 / nullif(tot, 0) * 100.0, 6) AS margem_percentagem
FROM lines l JOIN t USING (l_orderkey) JOIN orders ON l.l_orderkey = o_orderkey"""

SQL["first_per_key"] = f"""
WITH {LINES}, {FIRST}
SELECT l_orderkey, {LORD}, opcional, round(custo, 6) AS custo FROM first"""

SQL["unmapped_report"] = f"""
WITH {LINES}, {FIRST}, t AS (SELECT l_orderkey, lower(cor) AS first_cor, {_tok('lower(cor)')} AS tok FROM first),
e AS (SELECT l_orderkey, first_cor, {_EXT} AS cor_exterior FROM t)
SELECT e.first_cor AS unknown_value, CAST(count(*) AS BIGINT) AS rows_removed,
       CAST(count(DISTINCT l_orderkey) AS BIGINT) AS keys_removed
FROM lines l JOIN e USING (l_orderkey) WHERE e.cor_exterior IS NULL GROUP BY 1"""

# raw lines with price-only lines, symbols, a model suffix and missing colours, then cleaned
CLEANED_LINES = """raw AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
    CASE WHEN l_linenumber = 7 THEN 'Preço de Venda'
         ELSE concat_ws(' ', p_type, p_name, CAST(p_size AS VARCHAR)) END AS opcional,
    CASE WHEN l_linenumber = 6 AND l_partkey % 10 = 0 THEN NULL ELSE '|' || p_name END AS cor,
    p_name || '.ind. ' || p_type AS interior,
    concat_ws(' ', p_brand, p_type, p_name, CAST(p_size AS VARCHAR))
      || CASE WHEN p_size % 2 = 0 THEN ' - não utilizar' ELSE '' END AS modelo,
    l_extendedprice AS custo
  FROM lineitem JOIN part ON l_partkey = p_partkey),
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, lower(opcional) AS opcional,
    replace(lower(cor), '|', '') AS cor,
    replace(replace(replace(replace(replace(regexp_replace(replace(lower(interior), '|', '/'), 'ind.', '', 'g'),
      ']', '/'), '.', ' '), chr(39) || 'merino' || chr(39), 'merino'),
      chr(39) || ' merino' || chr(39), 'merino'), chr(39) || 'vernasca' || chr(39), 'vernasca') AS interior,
    replace(modelo, ' - não utilizar', '') AS modelo, custo
  FROM raw WHERE lower(opcional) <> 'preço de venda' AND cor IS NOT NULL)"""

_CANON = ("CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in [
    ("black", "preto"), ("preto/silver", "preto/prateado"), ("tartufo", "truffle"),
    ("preto/laranja/preto/lara", "preto/laranja"), ("dacota", "dakota"), ("white", "branco"), ("blue", "azul"),
    ("red", "vermelho"), ("grey", "cinzento"), ("silver", "prateado"), ("orange", "laranja"), ("green", "verde"),
    ("anthrazit", "antracite"), ("antracit", "antracite"), ("brown", "castanho"), ("antracito", "antracite"),
    ("âmbar/preto/pr", "ambar/preto/preto"), ("beige", "bege"), ("kaschmirsilber", "cashmere"),
    ("beje", "bege")]) + " ELSE {c} END")

VEHICLE_CTES = f"""{CLEANED_LINES}, {FIRST}, {INTERIOR}, {WHEELS}, {MODEL},
fl AS (SELECT l_orderkey,
  CAST(max(CAST(list_contains(tok, 'widget') AS INT)) AS BIGINT) AS navegacao,
  CAST(max(CAST(list_contains(tok, 'gear') AS INT)) AS BIGINT) AS sensores,
  CAST(max(CAST(list_contains(tok, 'economy') AS INT)) AS BIGINT) AS caixa_auto,
  sum(custo) AS price_total, max(l_shipdate) AS sell_date
  FROM (SELECT *, {_tok('lower(opcional)')} AS tok FROM lines) GROUP BY l_orderkey),
ex AS (SELECT l_orderkey, {_EXT} AS c FROM (SELECT l_orderkey, {_tok('lower(cor)')} AS tok FROM first)),
it AS (SELECT l_orderkey, {_interior("'vernasca'")} AS c FROM ti),
v AS (SELECT fl.*, {_CANON.format(c='ex.c')} AS cor_exterior, {_CANON.format(c='it.c')} AS cor_interior,
        wheels.jantes, model.modelo, o_orderdate AS buy_date, o_totalprice * 0.05 AS margem
      FROM fl JOIN ex USING (l_orderkey) JOIN it USING (l_orderkey) JOIN wheels USING (l_orderkey)
      JOIN model USING (l_orderkey) LEFT JOIN orders ON fl.l_orderkey = o_orderkey
      WHERE ex.c IS NOT NULL AND it.c IS NOT NULL),
s AS (SELECT *, CAST(date_diff('day', buy_date, sell_date) AS BIGINT) AS stock_days,
             margem / nullif(price_total, 0) * 100.0 AS margem_percentagem FROM v),
m AS (SELECT min(stock_days) dmin, max(stock_days) dmax, min(margem_percentagem) mmin, max(margem_percentagem) mmax FROM s)"""

SQL["vehicle_scores"] = "WITH " + VEHICLE_CTES + """
SELECT l_orderkey, navegacao, sensores, caixa_auto, cor_exterior, cor_interior, jantes, modelo,
  round(price_total, 6) AS price_total, stock_days, round(margem_percentagem, 6) AS margem_percentagem,
  round((1 - (stock_days - dmin) / nullif(CAST(dmax - dmin AS DOUBLE), 0))
        * ((margem_percentagem - mmin) / nullif(mmax - mmin, 0)), 6) AS score,
  CAST(day(buy_date) AS BIGINT) AS buy_day, CAST(month(buy_date) AS BIGINT) AS buy_month,
  CAST(year(buy_date) AS BIGINT) AS buy_year, CAST(day(sell_date) AS BIGINT) AS sell_day,
  CAST(month(sell_date) AS BIGINT) AS sell_month, CAST(year(sell_date) AS BIGINT) AS sell_year
FROM s, m"""

# ---------------------------------------------------------------- profiles, sets, sorts
PROFILED = """prof AS (SELECT customer, registration_number, vehicle_in_date, nlr_code, kms, slr_document_account,
  priority, CAST(1 AS BIGINT) AS source_rank FROM visits)"""
_PCOLS = [("customer", "string"), ("registration_number", "string"), ("vehicle_in_date", "timestamp_ntz"),
          ("nlr_code", "bigint"), ("kms", "bigint"), ("slr_document_account", "bigint"), ("priority", "string"),
          ("source_rank", "bigint")]

SQL["value_counts"] = f"""
WITH {VISITS} SELECT priority, count(*) AS n FROM visits WHERE priority IS NOT NULL GROUP BY priority"""

SQL["null_profile"] = f"""
WITH {VISITS}, {PROFILED}, t AS (SELECT count(*) AS n FROM prof)
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS column_type, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) / CAST(count(*) AS DOUBLE) * 100, 6) AS pct_n_null FROM prof"
    for c, t in _PCOLS)

SQL["zero_profile"] = f"""
WITH {VISITS}, {PROFILED}
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS column_type, "
    + (f"CAST(count(*) FILTER (WHERE {c} = 0) AS BIGINT)" if t == "bigint" else "CAST(0 AS BIGINT)")
    + " AS n_zero, round("
    + (f"count(*) FILTER (WHERE {c} = 0)" if t == "bigint" else "0")
    + " / CAST(count(*) AS DOUBLE) * 100, 6) AS pct_n_zero FROM prof"
    for c, t in _PCOLS)

SQL["constant_columns"] = f"""
WITH {VISITS}, {PROFILED}
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM prof" for c, _ in _PCOLS)

SQL["distinct_count"] = f"""
WITH {VISITS} SELECT CAST(count(DISTINCT registration_number) AS BIGINT) AS n_distinct FROM visits"""

SQL["union_missing_cols"] = f"""
WITH {VISITS}
SELECT o_orderkey, registration_number, kms, CAST(1 AS BIGINT) AS source_rank FROM visits WHERE nlr_code = 101
UNION ALL BY NAME
SELECT o_orderkey, registration_number, round(total, 6) AS total, CAST(2 AS BIGINT) AS source_rank
FROM visits WHERE nlr_code = 701"""

SQL["sort_nulls_last"] = f"""
WITH {VISITS}
SELECT customer, slr_document_account, registration_number, o_orderkey,
  CAST(row_number() OVER (ORDER BY customer ASC NULLS LAST, slr_document_account ASC NULLS LAST,
                          registration_number ASC NULLS LAST, o_orderkey) AS BIGINT) AS position
FROM visits"""

SQL["head_preview"] = f"""
WITH {VISITS} SELECT o_orderkey, customer, vehicle_in_date FROM visits
ORDER BY vehicle_in_date DESC NULLS LAST, o_orderkey LIMIT 5"""

SQL["keep_or_other"] = f"""
WITH {VISITS} SELECT o_orderkey,
  CASE WHEN priority IS NULL OR priority IN ('1-URGENT', '2-HIGH') THEN priority ELSE 'outros' END AS priority_new
FROM visits"""

SQL["group_map"] = f"""
WITH {SALES} SELECT {KEY}, cfg_colour,
  CASE cfg_colour WHEN 'hot' THEN 'warm' WHEN 'blue' THEN 'cool' WHEN 'cold' THEN 'cool' WHEN 'large' THEN 'size'
    WHEN 'small' THEN 'size' WHEN 'red' THEN 'outros' WHEN 'new' THEN 'outros' END AS cfg_colour_new
FROM sales"""

SQL["lookup_map"] = f"""
WITH {SALES} SELECT {KEY},
  CASE cfg_colour WHEN 'red' THEN 'vermelho' WHEN 'blue' THEN 'azul' WHEN 'old' THEN 'antigo' ELSE cfg_colour END
    AS cfg_colour
FROM sales"""

SQL["date_parts"] = f"""
WITH {SALES} SELECT {KEY},
  CAST(day(buy_date) AS BIGINT) AS buy_day, CAST(month(buy_date) AS BIGINT) AS buy_month,
  CAST(year(buy_date) AS BIGINT) AS buy_year, CAST(day(sell_date) AS BIGINT) AS sell_day,
  CAST(month(sell_date) AS BIGINT) AS sell_month, CAST(year(sell_date) AS BIGINT) AS sell_year,
  CAST(make_date(year(sell_date), month(sell_date), day(sell_date)) AS TIMESTAMP) AS sell_date_rebuilt
FROM sales"""

_CLEAN = ("replace(replace(replace(replace(replace(replace(regexp_replace(replace(lower(text), '|', '/'), "
          "'ind.', '', 'g'), ']', '/'), '.', ' '), '''merino''', 'merino'), ''' merino''', 'merino'), "
          "'''vernasca''', 'vernasca'), ' - não utilizar', '')")
SQL["symbol_replace"] = f"""
SELECT doc_id, CAST(length({_CLEAN}) AS BIGINT) AS n_chars_clean, md5({_CLEAN}) AS md5_clean FROM documents"""

# ---------------------------------------------------------------- metrics
PRED = """pred AS (SELECT l.doc_id, quality AS gt, toxic AS pred, CAST(n_chars AS DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

SQL["confusion"] = f"""
WITH {PRED}, c AS (SELECT gt, pred, count(*) AS n FROM pred GROUP BY gt, pred)
SELECT gt, pred, n, round(n / CAST(sum(n) OVER (PARTITION BY gt) AS DOUBLE), 6) AS rate FROM c"""

SQL["binary_confusion"] = f"""
WITH {PRED}, c AS (SELECT
  CAST(count(*) FILTER (WHERE gt <> 1 AND pred <> 1) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE gt <> 1 AND pred = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE gt = 1 AND pred <> 1) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE gt = 1 AND pred = 1) AS BIGINT) AS tp FROM pred)
SELECT tn, fp, fn, tp, round(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 6) AS specificity FROM c"""

PER_LABEL = """lab AS (SELECT label, sum(hit) AS tp, sum(in_gt) AS support, sum(in_pred) AS predicted FROM (
  SELECT gt AS label, 1 AS in_gt, 0 AS in_pred, CAST(gt = pred AS INT) AS hit FROM pred
  UNION ALL SELECT pred, 0, 1, 0 FROM pred) GROUP BY label)"""

SQL["f1_report"] = f"""
WITH {PRED}, {PER_LABEL},
p AS (SELECT tp, predicted - tp AS fp, support - tp AS fn FROM lab WHERE predicted > 0)
SELECT round(2.0 * sum(tp) / nullif(2 * sum(tp) + sum(fp) + sum(fn), 0), 6) AS micro_f1,
  round(avg(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)), 6) AS macro_f1,
  round((SELECT avg(CAST(gt = pred AS DOUBLE)) FROM pred), 6) AS accuracy FROM p"""

SQL["class_report"] = f"""
WITH {PRED}, {PER_LABEL},
r AS (SELECT CAST(label AS VARCHAR) AS class, coalesce(tp / nullif(CAST(predicted AS DOUBLE), 0), 0) AS precision,
        coalesce(tp / nullif(CAST(support AS DOUBLE), 0), 0) AS recall, support FROM lab),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1_score FROM r)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, CAST(support AS BIGINT) AS support,
       round(f1_score, 6) AS f1_score FROM f
UNION ALL
SELECT 'avg/total', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT), round(sum(f1_score * support) / sum(support), 6) FROM f"""

ROC = """t AS (SELECT score AS threshold, sum(CAST(gt = 1 AS BIGINT)) AS pos, sum(CAST(gt <> 1 AS BIGINT)) AS neg
  FROM pred GROUP BY score),
tot AS (SELECT sum(pos) AS p, sum(neg) AS n FROM t),
roc AS (SELECT threshold, pos, neg,
  sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
  sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn FROM t)"""

SQL["roc_points"] = f"""
WITH {PRED}, {ROC}
SELECT round(threshold, 6) AS threshold, pos, neg, round(cn / nullif(CAST(n AS DOUBLE), 0), 6) AS fpr,
       round(cp / nullif(CAST(p AS DOUBLE), 0), 6) AS tpr FROM roc, tot"""

SQL["auc"] = f"""
WITH {PRED}, {ROC},
pts AS (SELECT roc.*, lag(cn, 1, 0) OVER (ORDER BY threshold DESC) AS cn0,
               lag(cp, 1, 0) OVER (ORDER BY threshold DESC) AS cp0 FROM roc)
SELECT round(sum((cn - cn0) * (cp + cp0) / 2.0) / (max(p) * max(n)), 6) AS auc FROM pts, tot"""

PRICED = """pl AS (SELECT l_extendedprice, l_quantity, l_quantity * p_retailprice AS pred
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

SQL["mse_r2"] = f"""
WITH {PRICED}, k AS (SELECT l_extendedprice / 1000 AS y, pred / 1000 AS p FROM pl),
m AS (SELECT avg(y) AS my FROM k)
SELECT round(avg((y - p) ^ 2), 6) AS mse, round(1 - sum((y - p) ^ 2) / nullif(sum((y - my) ^ 2), 0), 6) AS r2
FROM k, m"""

_MEAS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SQL["corr_matrix"] = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for a in _MEAS for b in _MEAS)

SQL["simple_regression"] = f"""
WITH {PRICED} SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept FROM pl"""

SQL["dense_calendar_total"] = """
WITH cal AS (SELECT CAST(m AS DATE) AS month FROM generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 MONTH) g(m)),
cats AS (SELECT DISTINCT o_orderpriority AS category FROM orders WHERE o_orderpriority IS NOT NULL),
cnt AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS category, count(*) AS n
        FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY ALL),
dense AS (SELECT cal.month, cats.category, coalesce(cnt.n, 0) AS n FROM cal, cats
          LEFT JOIN cnt ON cnt.month = cal.month AND cnt.category = cats.category)
SELECT strftime(month, '%Y-%m') AS month, category, CAST(n AS BIGINT) AS n FROM dense
UNION ALL
SELECT strftime(month, '%Y-%m'), 'Month Total', CAST(sum(n) AS BIGINT) FROM dense GROUP BY month"""

SQL["silhouette_squared"] = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
pq AS (SELECT vec_id, label, list_sum(list_transform(v, lambda t: t * t)) AS sq FROM e),
cs AS (SELECT label AS c, i, sum(x) AS s FROM d GROUP BY label, i),
cn AS (SELECT label AS c, count(*) AS n, sum(sq) AS sq FROM pq GROUP BY label),
dots AS (SELECT d.vec_id, cs.c, sum(d.x * cs.s) AS dot FROM d JOIN cs ON d.i = cs.i GROUP BY d.vec_id, cs.c),
m AS (SELECT pq.vec_id, pq.label, dots.c, cn.n, pq.sq * cn.n - 2 * dots.dot + cn.sq AS tot
      FROM pq JOIN dots ON pq.vec_id = dots.vec_id JOIN cn ON dots.c = cn.c),
ab AS (SELECT vec_id, label, max(CASE WHEN c = label THEN tot / nullif(n - 1, 0) END) AS a,
         min(CASE WHEN c <> label THEN tot / n END) AS b, max(CASE WHEN c = label THEN n END) AS own_n
       FROM m GROUP BY vec_id, label)
SELECT vec_id, label, round(a, 6) AS a, round(b, 6) AS b,
  round(CASE WHEN own_n <= 1 THEN 0.0 ELSE (b - a) / nullif(greatest(a, b), 0) END, 6) AS silhouette FROM ab"""

SQL["cluster_sizes"] = "SELECT label, count(*) AS size FROM embeddings GROUP BY label"

SQL["sigmoid_values"] = f"""
WITH {SALES}, x AS (SELECT {KEY}, margem_percentagem - 5 AS x FROM sales),
s AS (SELECT *, 1 / (1 + exp(-x)) AS sig FROM x)
SELECT {KEY}, round(sig, 6) AS sig, round(sig * (1 - sig), 6) AS sig_deriv FROM s"""

SQL["knn_vote"] = """
WITH r AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
             row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR) || ':2'), vec_id) AS rk,
             count(*) OVER (PARTITION BY label) AS nc FROM embeddings),
s AS (SELECT vec_id, label, v, rk <= nc - ceil(nc * 0.25) AS is_train FROM r),
tl AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM s WHERE is_train),
ql AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM s WHERE NOT is_train),
d AS (SELECT ql.vec_id AS qid, tl.vec_id AS tid, tl.label, sum((ql.x - tl.x) * (ql.x - tl.x)) AS d2
      FROM ql JOIN tl ON ql.i = tl.i GROUP BY ql.vec_id, tl.vec_id, tl.label),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, tid) AS rn FROM d) WHERE rn <= 5),
votes AS (SELECT qid, label, count(*) AS n FROM nn GROUP BY qid, label),
best AS (SELECT qid, label AS predicted_label FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY n DESC, label) AS rn FROM votes) WHERE rn = 1)
SELECT b.qid AS vec_id, b.predicted_label, s.label FROM best b JOIN s ON b.qid = s.vec_id"""


def _group_case(col: str, groups) -> str:
    mapping = {}
    for name, members in groups:      # a later list overrides an earlier one
        for m in members:
            mapping[m] = name
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def _category_groups_sql() -> str:
    from ..operators import vocab as V
    return ("WITH " + VEHICLE_CTES + "\nSELECT l_orderkey, "
            + _group_case("cor_exterior", V.EXTERIOR_GROUPS) + " AS cor_exterior_new, "
            + _group_case("cor_interior", V.INTERIOR_GROUPS) + " AS cor_interior_new, "
            + _group_case("jantes", V.WHEEL_GROUPS) + " AS jantes_new, "
            + _group_case("modelo", V.MODEL_GROUPS) + " AS modelo_new FROM s")


SQL["category_groups"] = _category_groups_sql()


SQL["last7_key"] = f"WITH {VISITS} SELECT o_orderkey, chassis_number, right(chassis_number, 7) AS chassis_7 FROM visits"

SQL["coalesce_update"] = f"WITH {CONTRACTS} SELECT registration_number, cm_date_end FROM contracts"

SQL["regular_pct_vhe"] = _regular_pct_sql("registration_date_vhe")

SQL["undo_oversample"] = f"""
WITH {SALES} SELECT new_score, count(*) AS n, count(DISTINCT {SALE_ID}) AS n_ids FROM sales GROUP BY new_score"""


def _horner(coefs, v: str) -> str:
    out = repr(coefs[0])
    for k in coefs[1:]:
        out = f"(({out}) * {v} + {k!r})"
    return out


# fixed values: Acklam's published coefficients, written out here so that a slip
# in the operator's copy shows
_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01]
_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
_P_LOW = 0.02425


def _probit_sql(p: str) -> str:
    ql, qu, q = f"sqrt(-2.0 * ln({p}))", f"sqrt(-2.0 * ln(1.0 - {p}))", f"({p} - 0.5)"
    return (f"CASE WHEN {p} IS NULL OR {p} <= 0 OR {p} >= 1 THEN NULL "
            f"WHEN {p} < {_P_LOW!r} THEN {_horner(_C, ql)} / ({_horner(_D, ql)} * {ql} + 1.0) "
            f"WHEN {p} <= {1 - _P_LOW!r} THEN {_horner(_A, f'({q} * {q})')} * {q} / "
            f"({_horner(_B, f'({q} * {q})')} * ({q} * {q}) + 1.0) "
            f"ELSE -{_horner(_C, qu)} / ({_horner(_D, qu)} * {qu} + 1.0) END")


SQL["probit_scaling"] = f"""
WITH {SALES},
e AS (SELECT {KEY}, stock_days,
             CASE WHEN stock_days < 0 THEN 0.0 ELSE 1.0 - exp(-CAST(stock_days AS DOUBLE)) END AS p FROM sales)
SELECT {KEY}, stock_days, round({_probit_sql("p")}, 6) AS stock_days_norm_4 FROM e"""

_SPLIT = f"""{SALES},
id AS (SELECT *, {SALE_ID} AS sale_id FROM sales),
rk AS (SELECT *, row_number() OVER (PARTITION BY new_score ORDER BY md5(sale_id || ':2'), sale_id) AS r,
              count(*) OVER (PARTITION BY new_score) AS nc FROM id),
train AS (SELECT * FROM rk WHERE r <= nc - ceil(nc * 0.25))"""

SQL["class_weights"] = f"""
WITH {_SPLIT}
SELECT {KEY}, new_score, round((SELECT count(*) FROM train)::DOUBLE
       / ((SELECT count(DISTINCT new_score) FROM train) * count(*) OVER (PARTITION BY new_score)), 6) AS weight
FROM train"""

SQL["cv_folds"] = f"""
WITH {_SPLIT}
SELECT {KEY}, new_score, CAST((row_number() OVER (PARTITION BY new_score
       ORDER BY md5(sale_id || ':42'), sale_id) - 1) % 10 AS BIGINT) AS fold FROM train"""

_MEMBERS = f"""{SALES},
m AS (SELECT *, least(1.0, margem_percentagem / 10) AS p_margin, greatest(0.0, 1 - stock_days / 1000.0) AS p_days,
             CASE WHEN l_extendedprice > 30000 THEN 0.75 ELSE 0.25 END AS p_price FROM sales)"""

SQL["soft_vote"] = f"""
WITH {_MEMBERS}, v AS (SELECT {KEY}, (p_margin + p_days + p_price) / 3.0 AS p FROM m)
SELECT {KEY}, round(1 - p, 6) AS proba_0, round(p, 6) AS proba_1,
       CAST(p > 0.5 AS INT)::DOUBLE AS score_class_pred FROM v"""

SQL["run_comparison"] = f"""
WITH {_MEMBERS},
p AS (SELECT 'margin' AS model, new_score AS y, CAST(p_margin > 0.5 AS INT) AS h FROM m
      UNION ALL SELECT 'days', new_score, CAST(p_days > 0.5 AS INT) FROM m
      UNION ALL SELECT 'price', new_score, CAST(p_price > 0.5 AS INT) FROM m),
c AS (SELECT model, count(*) FILTER (y = 1 AND h = 1)::DOUBLE AS tp, count(*) FILTER (y = 0 AND h = 1)::DOUBLE AS fp,
             count(*) FILTER (y = 1 AND h = 0)::DOUBLE AS fn, count(*) FILTER (y = 0 AND h = 0)::DOUBLE AS tn
      FROM p GROUP BY model),
f AS (SELECT *, CASE WHEN tp + fp > 0 THEN coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) END AS f1,
             CASE WHEN tn + fn > 0 THEN coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) END AS f0,
             CASE WHEN tp + fp > 0 THEN tp ELSE 0 END + CASE WHEN tn + fn > 0 THEN tn ELSE 0 END AS hits,
             CASE WHEN tp + fp > 0 THEN fp + fn ELSE 0 END + CASE WHEN tn + fn > 0 THEN fn + fp ELSE 0 END AS misses
      FROM c)
SELECT 'classification' AS approach, model, 'new_score' AS target, 'recall' AS scoring,
  round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
  round((coalesce(f1, 0) + coalesce(f0, 0)) / ((f1 IS NOT NULL)::INT + (f0 IS NOT NULL)::INT), 6) AS macro_f1,
  round(2 * hits / (2 * hits + misses), 6) AS micro_f1, round(tn / nullif(tn + fp, 0), 6) AS specificity
FROM f"""

# two features: the normal equations have a closed form
SQL["regression_coefficients"] = f"""
WITH {SALES},
x AS (SELECT margem_percentagem AS y, stock_days::DOUBLE AS a, l_extendedprice / 1000 AS b FROM sales),
s AS (SELECT var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb,
             avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM x),
w AS (SELECT (ay * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS wb, ma, mb, my FROM s)
SELECT 'stock_days' AS feature, round(wa, 5) AS coefficient FROM w
UNION ALL SELECT 'price_k', round(wb, 5) FROM w
UNION ALL SELECT 'intercept', round(my - wa * ma - wb * mb, 5) FROM w"""

_BRANCH = """SELECT * REPLACE (
    coalesce(last_value(customer IGNORE NULLS) OVER w, first_value(customer IGNORE NULLS) OVER b) AS customer,
    coalesce(last_value(registration_date_pse IGNORE NULLS) OVER w,
             first_value(registration_date_pse IGNORE NULLS) OVER b) AS registration_date_pse)
  FROM cleaned WHERE nlr_code = {code}
  WINDOW w AS (PARTITION BY registration_number ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         b AS (PARTITION BY registration_number ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""

SQL["visit_merge"] = f"""
WITH {VISITS}, {CONTRACTS},
cleaned AS (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE customer END AS customer,
                              right(chassis_number, 7) AS chassis_number),
    CAST(CASE WHEN length(registration_number) <> 6 OR registration_number IN ('000000', '000001', '++++++')
              THEN 1 ELSE 0 END AS BIGINT) AS registration_number_error_flag
  FROM visits WHERE registration_number IS NOT NULL
    AND slr_document_account IS DISTINCT FROM 4 AND slr_document_account IS DISTINCT FROM 6),
ca AS ({_BRANCH.format(code=101)}), crp AS ({_BRANCH.format(code=701)}),
u AS (SELECT ca.*, c.cm_years, c.cm_km, c.cm_date_start, c.cm_date_end
      FROM ca LEFT JOIN contracts c ON ca.registration_number = c.registration_number
      UNION ALL SELECT crp.*, c.cm_years, c.cm_km, c.cm_date_start, c.cm_date_end
      FROM crp LEFT JOIN contracts c ON crp.chassis_number = c.chassis_number)
SELECT row_number() OVER (ORDER BY customer NULLS LAST, slr_document_account NULLS LAST,
                          registration_number NULLS LAST, o_orderkey) AS position,
  o_orderkey, customer, slr_document_account, registration_number, chassis_number, registration_number_error_flag,
  registration_date_pse, nlr_code, round(cm_years, 6) AS cm_years, round(cm_km, 6) AS cm_km, cm_date_start, cm_date_end
FROM u"""


# ---------------------------------------------------------------- the prepared feature table
def _prepared_sql() -> str:
    groups = {
        "cor_exterior": [("vermelho", ["vermelho"]), ("azul", ["azul"]), ("outros", ["hot", "cold", "new"])],
        "cor_interior": [("preto", ["preto"]), ("quente", ["vermelho", "hot"]), ("azul", ["azul", "cold"]),
                         ("outros", ["vernasca", "new", "gear", "bolt", "ring"])],
        "jantes": [("Standard", ["standard", "15", "16"]), ("17", ["17"]), ("18", ["18"]), ("19/20", ["19", "20"])],
        "local_da_venda": [("norte", ["DCC - Feira", "DCN-Porto"]), ("centro", ["DCC - Aveiro"]),
                           ("sul", ["DCS-Cascais", "DCS-Lisboa Usados"]), ("algarve", ["DCA - Faro"])]}
    cfg = "navegacao, sensores, caixa_auto, cor_exterior_new, cor_interior_new, jantes_new, modelo_new"
    words = ", ".join(f"'{w}'" for w in ["STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO"])
    plain = ["navegacao", "sensores", "caixa_auto", "prev_sales_check", "last_score", "average_score_dynamic",
             "average_score_dynamic_std", "prev_average_score_dynamic", "prev_average_score_dynamic_std",
             "average_score_global", "min_score_global", "max_score_global", "q3_score_global", "median_score_global",
             "q1_score_global"]
    scaled = ["price_total", "number_prev_sales", "last_margin", "last_stock_days"]
    coded = ["jantes_new", "cor_interior_new", "cor_exterior_new", "local_da_venda_new", "modelo_new", "prov_new",
             "buy_day", "buy_month", "buy_year"]
    numbers = " UNION ALL ".join(
        [f"SELECT l_orderkey, new_score, is_train, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM split" for c in plain]
        + [f"SELECT l_orderkey, new_score, is_train, '{c}', coalesce(({c} - (SELECT avg({c}) FROM split WHERE is_train = 1)) "
           f"/ nullif((SELECT stddev_pop({c}) FROM split WHERE is_train = 1), 0), 0) FROM split" for c in scaled])
    blocks = " UNION ALL ".join(
        f"SELECT l_orderkey, new_score, is_train, '{c}_' || CAST({c} AS VARCHAR), 1.0 FROM split "
        f"WHERE {c} IN (SELECT {c} FROM split WHERE is_train = 1)" for c in coded)
    return "WITH " + VEHICLE_CTES + f""",
pl AS (SELECT s.*, ['DCC - Feira', 'DCC - Aveiro', 'DCS-Cascais', 'DCA - Faro', 'DCN-Porto', 'DCS-Lisboa Usados'][o_custkey % 6 + 1]
         AS local_da_venda,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'Em utilização'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Demonstração'
              WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Novos' ELSE 'Usados' END AS prov_new
       FROM s JOIN orders ON l_orderkey = o_orderkey),
cl AS (SELECT l_orderkey, navegacao, sensores, caixa_auto, price_total, sell_date, stock_days, margem_percentagem, prov_new,
         {", ".join(_group_case(c, g) + f" AS {c}_new" for c, g in groups.items())},
         CASE WHEN split_part(modelo, ' ', 2) IN ({words}) AND len(string_split(modelo, ' ')) = 2
               AND CAST(regexp_extract(modelo, '^Brand#([0-9]+) ', 1) AS INT) BETWEEN 1 AND 25
              THEN 'S' || ((CAST(regexp_extract(modelo, '^Brand#([0-9]+) ', 1) AS INT) - 1) % 5 + 1) END AS modelo_new,
         day(buy_date) AS buy_day, month(buy_date) AS buy_month, year(buy_date) AS buy_year,
         CASE WHEN stock_days <= 365 AND margem_percentagem >= 3.5 THEN 1 ELSE 0 END AS new_score
       FROM pl WHERE NOT contains(modelo, 'PROMO') AND prov_new NOT IN ('Demonstração', 'Em utilização')),
h AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER p AS size,
         lag(new_score) OVER w AS lv, lag(margem_percentagem) OVER w AS lm, lag(stock_days) OVER w AS ld,
         sum(new_score) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs,
         avg(new_score) OVER p AS g_avg, min(new_score) OVER p AS g_min, max(new_score) OVER p AS g_max,
         quantile_cont(new_score, 0.75) OVER p AS g_q3, quantile_cont(new_score, 0.5) OVER p AS g_q2,
         quantile_cont(new_score, 0.25) OVER p AS g_q1
  FROM cl WHERE cor_exterior_new IS NOT NULL AND cor_interior_new IS NOT NULL AND jantes_new IS NOT NULL AND modelo_new IS NOT NULL
  WINDOW p AS (PARTITION BY {cfg}), w AS (PARTITION BY {cfg} ORDER BY sell_date, l_orderkey)),
d AS (SELECT *, CASE WHEN pos = 1 THEN 0.0 ELSE CAST(cs AS DOUBLE) / pos END AS dyn FROM h),
e AS (SELECT *, stddev_pop(dyn) OVER (PARTITION BY {cfg}) AS dyn_std,
             lag(dyn) OVER (PARTITION BY {cfg} ORDER BY sell_date, l_orderkey) AS prev_dyn FROM d),
hist AS (SELECT l_orderkey, {cfg}, local_da_venda_new, prov_new, buy_day, buy_month, buy_year, price_total, new_score,
  CASE WHEN size > 1 AND pos > 1 THEN 1 ELSE 0 END AS prev_sales_check,
  CASE WHEN size > 1 THEN pos - 1 ELSE 0 END AS number_prev_sales,
  CASE WHEN size > 1 THEN coalesce(CAST(lv AS DOUBLE), 0) ELSE 0 END AS last_score,
  CASE WHEN size > 1 THEN coalesce(lm, 0) ELSE 0 END AS last_margin,
  CASE WHEN size > 1 THEN coalesce(CAST(ld AS DOUBLE), 0) ELSE 0 END AS last_stock_days,
  CASE WHEN size > 1 THEN dyn ELSE 0 END AS average_score_dynamic,
  CASE WHEN size > 1 THEN dyn_std ELSE 0 END AS average_score_dynamic_std,
  CASE WHEN size > 1 THEN coalesce(prev_dyn, 0) ELSE 0 END AS prev_average_score_dynamic,
  CASE WHEN size > 1 AND pos > 1 THEN dyn_std ELSE 0 END AS prev_average_score_dynamic_std,
  CASE WHEN size > 1 THEN g_avg ELSE 0 END AS average_score_global,
  CASE WHEN size > 1 THEN g_min ELSE 0 END AS min_score_global, CASE WHEN size > 1 THEN g_max ELSE 0 END AS max_score_global,
  CASE WHEN size > 1 THEN g_q3 ELSE 0 END AS q3_score_global, CASE WHEN size > 1 THEN g_q2 ELSE 0 END AS median_score_global,
  CASE WHEN size > 1 THEN g_q1 ELSE 0 END AS q1_score_global FROM e),
split AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY new_score ORDER BY md5(l_orderkey || ':2'), l_orderkey)
    <= count(*) OVER (PARTITION BY new_score) - ceil(count(*) OVER (PARTITION BY new_score) * 0.25) THEN 1 ELSE 0 END AS is_train
  FROM hist),
feat AS MATERIALIZED ({numbers} UNION ALL {blocks}),
cls AS (SELECT new_score, count(*) AS nc FROM split WHERE is_train = 1 GROUP BY new_score),
per AS (SELECT feature, new_score, sum(value) AS s, sum(value * value) AS ss FROM feat WHERE is_train = 1 GROUP BY ALL),
st AS (SELECT feature, sum(s) AS s, sum(ss) AS ss, sum(s * s / nc) AS between_raw FROM per JOIN cls USING (new_score) GROUP BY feature),
sc AS (SELECT feature, round(((between_raw - s * s / n) / (k - 1))
           / nullif((ss - s * s / n - (between_raw - s * s / n)) / (n - k), 0), 9) AS score
       FROM st, (SELECT sum(nc) AS n, count(*) AS k FROM cls)),
best AS (SELECT feature FROM sc ORDER BY score DESC NULLS LAST, feature LIMIT 12),
cop AS (SELECT l_orderkey, unnest(generate_series(0, mx // nc + CASE WHEN r <= mx % nc THEN 1 ELSE 0 END - 1)) AS copy_index FROM (
    SELECT l_orderkey, nc, (SELECT max(nc) FROM cls) AS mx,
           row_number() OVER (PARTITION BY new_score ORDER BY md5(l_orderkey || ':42'), l_orderkey) AS r
    FROM split JOIN cls USING (new_score) WHERE is_train = 1))
SELECT l_orderkey, CASE is_train WHEN 1 THEN 'train' ELSE 'test' END AS part,
       CAST(coalesce(copy_index, 0) AS BIGINT) AS copy_index, feature, round(value, 6) AS value
FROM feat JOIN best USING (feature) LEFT JOIN cop USING (l_orderkey) WHERE value <> 0"""


SQL["prepared_features"] = _prepared_sql()

SQL["run_report"] = f"""
WITH {_MEMBERS},
p AS (SELECT 'margin' AS model, new_score AS y, CAST(p_margin > 0.5 AS INT) AS h FROM m
      UNION ALL SELECT 'days', new_score, CAST(p_days > 0.5 AS INT) FROM m
      UNION ALL SELECT 'price', new_score, CAST(p_price > 0.5 AS INT) FROM m),
lab AS (SELECT model, label, count(*) FILTER (y = label AND h = label)::DOUBLE AS tp, count(*) FILTER (y = label)::DOUBLE AS support,
               count(*) FILTER (h = label)::DOUBLE AS predicted FROM p, (SELECT unnest([0, 1]) AS label) GROUP BY ALL),
r AS (SELECT model, CAST(label AS VARCHAR) AS class, coalesce(tp / nullif(predicted, 0), 0) AS pr,
             coalesce(tp / nullif(support, 0), 0) AS rc, support,
             coalesce(2 * tp / nullif(predicted + support, 0), 0) AS f1 FROM lab WHERE support + predicted > 0),
rep AS (SELECT * FROM r UNION ALL
        SELECT model, 'avg/total', sum(pr * support) / sum(support), sum(rc * support) / sum(support), sum(support),
               sum(f1 * support) / sum(support) FROM r GROUP BY model),
c AS (SELECT model, sum(tp) AS hits, max(tp) FILTER (label = 0) AS tn, max(predicted) FILTER (label = 1) AS p1,
             max(tp) FILTER (label = 1) AS tp1, sum(support) AS n,
             sum(tp) FILTER (predicted > 0) AS mtp, sum(predicted + support - 2 * tp) FILTER (predicted > 0) AS miss,
             avg(coalesce(2 * tp / nullif(predicted + support, 0), 0)) FILTER (predicted > 0) AS macro FROM lab GROUP BY model),
long AS MATERIALIZED (SELECT new_score AS y, unnest(['stock_days', 'margem_percentagem', 'l_extendedprice']) AS feature,
                unnest([stock_days::DOUBLE, margem_percentagem, l_extendedprice]) AS x FROM m),
g AS (SELECT feature, sum(nc) AS n, count(*) AS k, sum(s) AS s, sum(ss) AS ss, sum(s * s / nc) AS br FROM (
        SELECT feature, y, count(*) AS nc, sum(x) AS s, sum(x * x) AS ss FROM long GROUP BY ALL) GROUP BY feature),
f AS (SELECT feature, round(((br - s * s / n) / (k - 1)) / ((ss - s * s / n - (br - s * s / n)) / (n - k)), 6) AS score FROM g)
SELECT model, 'class' AS kind, class AS name, 'precision' AS metric, round(pr, 6) AS value FROM rep
UNION ALL SELECT model, 'class', class, 'recall', round(rc, 6) FROM rep
UNION ALL SELECT model, 'class', class, 'f1_score', round(f1, 6) FROM rep
UNION ALL SELECT model, 'class', class, 'support', support FROM rep
UNION ALL SELECT model, 'run', 'all', 'accuracy', round(hits / n, 6) FROM c
UNION ALL SELECT model, 'run', 'all', 'micro_f1', round(2 * mtp / (2 * mtp + miss), 6) FROM c
UNION ALL SELECT model, 'run', 'all', 'macro_f1', round(macro, 6) FROM c
UNION ALL SELECT model, 'run', 'all', 'specificity', round(tn / nullif(tn + p1 - tp1, 0), 6) FROM c
UNION ALL SELECT models.model, 'feature', feature, 'rank', row_number() OVER (PARTITION BY models.model ORDER BY score DESC, feature)::DOUBLE
FROM f, (SELECT DISTINCT model FROM p) models"""


SQL["knn_grid"] = """
WITH r AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
             row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR) || ':2'), vec_id) AS rk,
             count(*) OVER (PARTITION BY label) AS nc FROM embeddings),
s AS (SELECT vec_id, label, v, (row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42'), vec_id) - 1) % 10
        AS fold FROM r WHERE rk <= nc - ceil(nc * 0.25)),
l AS (SELECT vec_id, label, fold, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM s),
d AS (SELECT a.vec_id AS qid, b.vec_id AS tid, b.label, sum((a.x - b.x) * (a.x - b.x)) AS d2
      FROM l a JOIN l b ON a.i = b.i AND a.fold <> b.fold GROUP BY a.vec_id, b.vec_id, b.label),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, tid) AS rn FROM d) WHERE rn <= 49),
votes AS (SELECT qid, k, label, count(*) AS n FROM nn, (SELECT unnest(generate_series(1, 49)) AS k) WHERE rn <= k GROUP BY ALL),
best AS (SELECT qid, k, label AS predicted FROM (
  SELECT *, row_number() OVER (PARTITION BY qid, k ORDER BY n DESC, label) AS rn FROM votes) WHERE rn = 1),
acc AS (SELECT k, fold, avg(CAST(predicted = s.label AS INT)) AS a FROM best JOIN s ON qid = vec_id GROUP BY k, fold)
SELECT CAST(k AS INT) AS k, round(avg(a), 6) AS score FROM acc GROUP BY k"""


def _digamma_sql(x: str) -> str:
    z = f"({x} + 8.0)"
    return (f"(ln({z}) - 1 / (2 * {z}) - 1 / (12 * {z} ** 2) + 1 / (120 * {z} ** 4) - 1 / (252 * {z} ** 6) + 1 / (240 * {z} ** 8)"
            + "".join(f" - 1 / ({x} + {i}.0)" for i in range(8)) + ")")


_NEAR = [f"{fn}(x, {i}) OVER w" for fn in ("lag", "lead") for i in (1, 2, 3)]
SQL["mutual_info_continuous"] = f"""
WITH {SALES},
l AS (SELECT unnest(['stock_days', 'margem_percentagem', 'l_extendedprice']) AS feature,
             unnest([stock_days::DOUBLE, margem_percentagem, l_extendedprice]) AS x, new_score AS y FROM sales),
c AS (SELECT *, count(*) OVER (PARTITION BY feature, y) AS nc FROM l),
g AS (SELECT *, [{", ".join(_NEAR[:3])}] AS before, [{", ".join(_NEAR[3:])}] AS after FROM c WHERE nc > 1
      WINDOW w AS (PARTITION BY feature, y ORDER BY x)),
k AS (SELECT feature, x, nc, before, after, least(3, nc - 1) AS near,
        list_sort([v for v in list_transform(before, lambda v: x - v) if v IS NOT NULL]
                  || [v for v in list_transform(after, lambda v: v - x) if v IS NOT NULL]) AS dist FROM g),
r AS (SELECT *, dist[near] AS r FROM k),
e AS (SELECT row_number() OVER () AS id, feature, x, nc, near, r,
        CASE WHEN r = 0 THEN x ELSE coalesce(list_max([v for v in before if x - v = r]), x - r) END AS lo,
        CASE WHEN r = 0 THEN x ELSE coalesce(list_min([v for v in after if v - x = r]), x + r) END AS hi FROM r),
ev AS (SELECT id, feature, x AS v, 1 AS tie, 1 AS c, 0 AS sign FROM e
       UNION ALL SELECT id, feature, lo, CASE WHEN r = 0 THEN 0 ELSE 2 END, 0, -1 FROM e
       UNION ALL SELECT id, feature, hi, CASE WHEN r = 0 THEN 2 ELSE 0 END, 0, 1 FROM e),
run AS (SELECT id, sign, sum(c) OVER (PARTITION BY feature ORDER BY v, tie) AS cum FROM ev),
m AS (SELECT id, sum(sign * cum) AS m FROM run WHERE sign <> 0 GROUP BY id)
SELECT feature, round(greatest(0.0, {_digamma_sql("count(*)")}
  + avg({_digamma_sql("near")} - {_digamma_sql("nc")} - {_digamma_sql("m")})), 6) AS score
FROM e JOIN m USING (id) GROUP BY feature"""

SQL["group_quantiles"] = f"""
WITH {SALES} SELECT new_score, round(quantile_cont(l_extendedprice, 0.25), 6) AS q0, round(quantile_cont(l_extendedprice, 0.5), 6) AS q1,
  round(quantile_cont(l_extendedprice, 0.75), 6) AS q2, round(quantile_cont(l_extendedprice, 0.9), 6) AS q3
FROM sales GROUP BY new_score"""

SQL["sparse_encoding"] = """
SELECT CAST(l_partkey AS VARCHAR) AS part, CAST(l_partkey AS VARCHAR) AS part_value, count(*) AS n FROM lineitem GROUP BY 1"""

SQL["vehicle_handover"] = f"""
WITH {CLEANED_LINES}, {FIRST},
t AS (SELECT l_orderkey, sum(custo) AS price_total FROM lines GROUP BY l_orderkey)
SELECT l_orderkey, round(price_total, 6) AS price_total,
       round(o_totalprice * 0.05 / nullif(price_total, 0) * 100.0, 6) AS margem_percentagem, opcional
FROM t JOIN first USING (l_orderkey) JOIN orders ON l_orderkey = o_orderkey"""
