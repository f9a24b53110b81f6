"""SQL fragments that state the inputs and the salary statistics without using any operator of this package."""

from __future__ import annotations

FLOW = """f AS (
  SELECT strftime(l_shipdate, '%Y%m') AS competence, strftime(o_orderdate, '%Y%m') AS declared,
         n_name AS uf, r_name AS region, p_brand AS cbo_familia, p_brand || '/' || p_type AS cbo_codigo,
         CAST(l_suppkey AS VARCHAR) AS municipio_codigo_caged, l_quantity, kind, sgn,
         CASE WHEN sgn = 1 THEN fac ELSE 0 END AS adm, CASE WHEN sgn = -1 THEN fac ELSE 0 END AS dis, sgn * fac AS bal,
         floor(l_extendedprice / 1000) * 1000 AS pay,
         sgn = 1 AND floor(l_extendedprice / 1000) * 1000 BETWEEN 9000 AND 99000 AND l_tax <> 0 AS elig
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS sgn,
               CASE WHEN l_linenumber = 7 THEN 'FOR' WHEN l_linenumber = 6 AND l_quantity < 5 THEN 'EXC'
                    ELSE 'MOV' END AS kind,
               CASE WHEN l_linenumber = 6 AND l_quantity < 5 THEN -1 ELSE 1 END AS fac
        FROM lineitem) l
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)"""

COUNTS = (
    "CAST(SUM(adm) AS BIGINT) AS admissions, CAST(SUM(dis) AS BIGINT) AS dismissals, CAST(SUM(bal) AS BIGINT) AS balance"
)


def group_ctes(keys: str) -> str:
    """CTEs ``f`` and ``g``: counts and net-weighted salary statistics per key, median by a running weight."""
    return f"""WITH {FLOW},
freq AS (SELECT {keys}, pay, SUM(adm) AS w FROM f WHERE elig GROUP BY {keys}, pay HAVING SUM(adm) > 0),
pos AS (SELECT *, SUM(w) OVER (PARTITION BY {keys} ORDER BY pay) AS cum, SUM(w) OVER (PARTITION BY {keys}) AS tot FROM freq),
st AS (SELECT {keys}, CAST(SUM(w) AS BIGINT) AS n, SUM(pay * w) / SUM(w) AS mean,
              (MIN(CASE WHEN 2 * cum >= tot THEN pay END) + MIN(CASE WHEN 2 * cum > tot THEN pay END)) / 2 AS median
       FROM pos GROUP BY {keys}),
tab AS (SELECT {keys}, {COUNTS}, COUNT(*) AS records FROM f GROUP BY {keys}),
g AS (SELECT tab.*, round(mean, 6) AS salary_mean_admissions, round(median, 6) AS salary_median_admissions,
             COALESCE(n, 0) AS salary_eligible_admissions FROM tab LEFT JOIN st USING ({keys}))
"""


TEXT = """t AS (
  SELECT *, sgn_raw IN ('1', '-1') AS sgn_ok,
         NOT COALESCE(uf IN ('RO','AC','AM','RR','PA','AP','TO','MA','PI','CE','RN','PB','PE','AL','SE','BA','MG','ES',
           'RJ','SP','PR','SC','RS','MS','MT','GO','DF','NI'), false) AS erro_uf,
         length(cbo) < 4 AS erro_cbo, NOT sgn_raw IN ('1', '-1') AS erro_saldo,
         COALESCE(salary < 0, false) AS erro_salario,
         CASE WHEN sgn_raw IN ('1', '-1') THEN CAST(sgn_raw AS INTEGER) END AS sgn,
         CASE WHEN kind = 'EXC' THEN -1 ELSE 1 END AS fac, substr(cbo, 1, 4) AS fam
  FROM (
    SELECT l_linenumber, strftime(l_shipdate, '%Y%m') AS competence, strftime(o_orderdate, '%Y%m') AS declared,
           CASE WHEN s_acctbal > 9500 THEN NULL WHEN s_acctbal < 0 THEN 'NI' ELSE CASE s_nationkey + 11
             WHEN 11 THEN 'RO' WHEN 12 THEN 'AC' WHEN 13 THEN 'AM' WHEN 14 THEN 'RR' WHEN 15 THEN 'PA' WHEN 16 THEN 'AP'
             WHEN 17 THEN 'TO' WHEN 21 THEN 'MA' WHEN 22 THEN 'PI' WHEN 23 THEN 'CE' WHEN 24 THEN 'RN' WHEN 25 THEN 'PB'
             WHEN 26 THEN 'PE' WHEN 27 THEN 'AL' WHEN 28 THEN 'SE' WHEN 29 THEN 'BA' WHEN 31 THEN 'MG' WHEN 32 THEN 'ES'
             WHEN 33 THEN 'RJ' WHEN 35 THEN 'SP' ELSE CAST(s_nationkey + 11 AS VARCHAR) END END AS uf,
           CASE WHEN l_returnflag = 'R' THEN '-1' WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN '1.0' ELSE '1'
             END AS sgn_raw,
           CASE WHEN p_type = 'SMALL' THEN '21' ELSE '21' || lpad(regexp_replace(p_brand, '\\D', '', 'g'), 2, '0')
             || lpad(CAST(p_size AS VARCHAR), 2, '0') END AS cbo,
           CASE WHEN l_tax = 0 THEN NULL WHEN l_tax = 0.08 THEN -l_extendedprice ELSE l_extendedprice END AS salary,
           CASE WHEN l_linenumber = 7 THEN 'FOR' WHEN l_linenumber = 6 AND l_quantity < 5 THEN 'EXC' ELSE 'MOV' END AS kind
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey
         LEFT JOIN orders ON l_orderkey = o_orderkey)),
q AS (SELECT *, erro_uf OR erro_cbo OR erro_saldo OR erro_salario AS bad,
             NOT (erro_uf OR erro_cbo OR erro_saldo OR erro_salario) AND fam IN ('2122','2123','2124','3171','3172') AS tech
      FROM t)"""

_STATE_OF_PREFIX = (
    "CASE substr(mun, 1, 2) WHEN '11' THEN 'RO' WHEN '12' THEN 'AC' WHEN '13' THEN 'AM' WHEN '14' THEN 'RR' "
    "WHEN '15' THEN 'PA' WHEN '16' THEN 'AP' WHEN '17' THEN 'TO' WHEN '21' THEN 'MA' WHEN '22' THEN 'PI' "
    "WHEN '23' THEN 'CE' WHEN '24' THEN 'RN' WHEN '25' THEN 'PB' WHEN '26' THEN 'PE' WHEN '27' THEN 'AL' "
    "WHEN '28' THEN 'SE' WHEN '29' THEN 'BA' WHEN '31' THEN 'MG' WHEN '32' THEN 'ES' WHEN '33' THEN 'RJ' "
    "WHEN '35' THEN 'SP' END"
)

STOCK = f"""s0 AS (
  SELECT COALESCE(r_name, 'NI') AS source_file, o_orderstatus AS st, o_totalprice, o_orderpriority,
         CASE WHEN o_orderpriority = '5-LOW' THEN '1' WHEN o_orderpriority = '3-MEDIUM' AND c_acctbal < 0 THEN ''
              ELSE '0' END AS ab,
         CASE WHEN c_mktsegment = 'BUILDING' AND o_orderpriority = '1-URGENT'
                THEN '012' || substr(o_orderpriority, 1, 1) || right('0' || CAST(o_orderkey AS VARCHAR), 2)
              WHEN c_mktsegment = 'FURNITURE' AND o_orderpriority = '2-HIGH' THEN NULL
              ELSE '212' || substr(o_orderpriority, 1, 1) || right('0' || CAST(o_orderkey AS VARCHAR), 2) END AS cbo,
         CASE WHEN c_acctbal > 9000 THEN '999999'
              ELSE CAST(c_nationkey + 11 AS VARCHAR) || right('0000' || CAST(o_custkey AS VARCHAR), 4) END AS mun
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey),
s1 AS (SELECT *, CASE WHEN mun = '999999' THEN 'NI' ELSE {_STATE_OF_PREFIX} END AS uf, substr(cbo, 1, 4) AS fam FROM s0),
s AS (SELECT *, st = 'P' AS bad_active, ab = '' AS bad_ab, cbo IS NULL AS bad_cbo, uf IS NULL AS bad_uf,
             st = 'P' OR ab = '' OR cbo IS NULL OR uf IS NULL AS bad,
             NOT (st = 'P' OR ab = '' OR cbo IS NULL OR uf IS NULL) AND st = 'O' AND ab = '0' AS active,
             NOT (st = 'P' OR ab = '' OR cbo IS NULL OR uf IS NULL) AND st = 'O' AND ab = '0'
               AND fam IN ('2122', '2123', '2124') AS tech FROM s1)"""

PLACES = f"""places AS (
  SELECT mun, MIN(c_name) AS nome, ANY_VALUE({_STATE_OF_PREFIX}) AS dim_uf
  FROM (SELECT CAST(c_nationkey + 11 AS VARCHAR) || right('0000' || CAST(c_custkey AS VARCHAR), 4) AS mun, c_name
        FROM customer WHERE c_mktsegment <> 'MACHINERY') GROUP BY mun)"""

COUNTERS = """COUNT(*) AS rows_read, COUNT(*) FILTER (NOT bad) AS rows_valid, COUNT(*) FILTER (bad) AS rows_rejected,
  COUNT(*) FILTER (active) AS rows_active, COUNT(*) FILTER (NOT bad AND st = 'F') AS rows_inactive,
  COUNT(*) FILTER (st = 'O') AS rows_active_source, COUNT(*) FILTER (st = 'O' AND ab = '1') AS rows_abandoned_source,
  COUNT(*) FILTER (st = 'O' AND ab = '0') AS rows_stock_eligible_source,
  COUNT(*) FILTER (st = 'O' AND ab = '') AS rows_unknown_abandoned_source,
  COUNT(*) FILTER (st = 'F') AS rows_inactive_source, COUNT(*) FILTER (st = 'P') AS rows_unknown_status_source,
  CAST(0 AS BIGINT) AS rows_year_mismatch_source, COUNT(*) FILTER (mun = '999999') AS rows_residual_municipality,
  COUNT(*) FILTER (tech) AS rows_tech, COUNT(*) FILTER (bad_active) AS invalid_active_status,
  COUNT(*) FILTER (bad_ab) AS invalid_abandoned_status, COUNT(*) FILTER (bad_cbo) AS invalid_cbo,
  CAST(0 AS BIGINT) AS invalid_municipality, COUNT(*) FILTER (bad_uf) AS invalid_uf"""
