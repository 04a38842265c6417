"""Oracle SQL per registered query (DuckDB dialect)."""

from __future__ import annotations

from tontine.oracle.chain import with_ctes

M = "2000-04"                   # report month


def month_shift(month: str, by: int) -> str:
    year, number = divmod(int(month[:4]) * 12 + int(month[5:7]) - 1 + by, 12)
    return f"{year:04d}-{number + 1:02d}"



def mb(c: str, b: str) -> str:
    """months_between for DATE expressions (day-of-month rule, rounded to 8 digits)."""
    return (f"((year({c}) - year({b})) * 12 + month({c}) - month({b}) + "
            f"CASE WHEN day({c}) = day({b}) OR ({c} = last_day({c}) AND {b} = last_day({b})) THEN 0 "
            f"ELSE round((day({c}) - day({b})) / 31.0::DOUBLE, 8) END)")


def ceil12(c: str, b: str) -> str:
    return f"CAST(ceil({mb(c, b)} / 12) AS BIGINT)"


def mdate(m: str) -> str:
    return f"DATE '{m}-01'"


def ratio(num: str, den: str, dec: str) -> str:
    return f"CAST(CAST(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) AS VARCHAR) AS {dec})"


PY_M = ceil12(mdate(M), "CAST(buy_datetime AS DATE)")

ORACLE_SQL: dict[str, str] = {}


def add(name: str, final_sql: str, extra: dict | None = None):
    ORACLE_SQL[name] = with_ctes(final_sql, extra)


add("policy_grid", "SELECT sex, CAST(ppp AS SMALLINT) AS ppp, CAST(age_buy AS SMALLINT) AS age_buy, "
    "CAST(t_age AS SMALLINT) AS t_age, CAST(bpp AS SMALLINT) AS bpp, CAST(policy_year AS SMALLINT) AS policy_year, "
    "CAST(age AS SMALLINT) AS age, coalesce(n, 0) AS n_policies FROM grid LEFT JOIN sold USING (sex, ppp, age_buy)")


# Columns of the detail reports that are shown with fewer decimals than they are kept with.
_VECTORS = "qx kx qx_d qx_ci dx_d dx_ci lx lx_d cx cx_ ci_cx ci_cx_ dx dx_d_".split()
_SHORTER = {
    "prem_src": ("DECIMAL(17,9)", [*_VECTORS, "expense", "db1", "db2_factor", "db2", "db3", "db5"]),
    "cv_src": ("DECIMAL(17,4)", "pvnp pvdb1 pvdb2 pvdb3 pvdb4 pvdb5 pvr np sur_ben cv_1a cv_1b cv_2".split()),
    "rsv_src": ("DECIMAL(17,4)", "pvnp pvdb1 pvdb2 pvdb3 pvdb4 pvdb5 prem_rsv alpha beta rsv1 rsv2 rsv1_re rsv2_re".split()),
    "policy_actuary": ("DECIMAL(17,4)", "cv_1a cv_1b sur_ben np rsv2_re rsv1_re".split()),
    "policy_result": ("DECIMAL(17,4)", "cv_1a cv_1b sur_ben np rsv2_re rsv1_re".split()),
}


def report_sql(table: str, name: str) -> str:
    kind, columns = _SHORTER[name]
    return f"SELECT * REPLACE ({', '.join(f'CAST({c} AS {kind}) AS {c}' for c in columns)}) FROM {table}"


add("prem_src", report_sql("prem_src", "prem_src"))
add("prem_std", "SELECT * FROM prem_std")
add("prem_cv", "SELECT * FROM prem_cv")
add("cv_src", report_sql("cv_src", "cv_src"))
add("rsv_src", report_sql("rsv_src", "rsv_src"))
add("policy_actuary", report_sql("policy_actuary", "policy_actuary"))

POLICY_RESULT = f"""
SELECT a.pol_no, a.user_id, b.name, b.sex, b.birthday, a.ppp, a.age_buy, a.buy_datetime, a.insur_name,
       a.insur_code, b.province, b.city, b.direction, c.bpp, CAST(a.py AS SMALLINT) AS policy_year, c.sa,
       c.cv_1a, c.cv_1b, c.sur_ben, c.np, c.rsv2_re, c.rsv1_re, c.np_, d.prem AS prem_std,
       CAST(if(a.py <= CAST(a.ppp AS INTEGER) AND substr('{M}', 6, 2) = substr(a.buy_datetime, 6, 2),
               d.prem, 0) AS DECIMAL(14,6)) AS prem_thismonth,
       '{M}' AS month
FROM policy_client b
JOIN (SELECT *, {PY_M} AS py FROM policy_benefit) a ON a.user_id = b.user_id
LEFT JOIN policy_actuary c ON CAST(a.age_buy AS SMALLINT) = c.age_buy AND b.sex = c.sex
     AND CAST(a.ppp AS SMALLINT) = c.ppp AND a.py = c.policy_year
LEFT JOIN prem_std_real d ON CAST(a.age_buy AS SMALLINT) = d.age_buy AND d.sex = b.sex
     AND CAST(a.ppp AS SMALLINT) = d.ppp
WHERE substr(a.buy_datetime, 1, 7) <= '{M}'"""
add("policy_actuary_left", report_sql("policy_actuary", "policy_actuary"), {"policy_actuary": """
SELECT a.age_buy, a.sex, a.ppp, a.bpp, a.policy_year, a.sa, a.cv_1a, a.cv_1b, a.sur_ben, a.np, b.rsv2_re, b.rsv1_re, b.np_
FROM cv_src a LEFT JOIN rsv_src b
  ON a.age_buy = b.age_buy AND a.sex = b.sex AND a.ppp = b.ppp AND a.policy_year = b.policy_year"""})
add("policy_result", report_sql("policy_result", "policy_result"), {"policy_result": POLICY_RESULT})
PY_M_FLOOR1 = f"CAST(floor({mb(mdate(M), 'CAST(buy_datetime AS DATE)')} / 12) + 1 AS BIGINT)"
add("policy_result_floor1", report_sql("policy_result", "policy_result"),
    {"policy_result": POLICY_RESULT.replace(PY_M, PY_M_FLOOR1).replace("prem_std_real d", "prem_std d")})

PRICED = """
SELECT a.*, c.sex, r.prem, r.nbev FROM policy_benefit a JOIN policy_client c ON a.user_id = c.user_id
JOIN PRICE r ON CAST(a.age_buy AS SMALLINT) = r.age_buy AND c.sex = r.sex AND CAST(a.ppp AS SMALLINT) = r.ppp"""


def priced(price: str, left: bool = False) -> str:
    s = PRICED.replace("PRICE", price)
    if price == "prem_std":
        s = s.replace("r.nbev", "NULL AS nbev")
    if left:
        s = s.replace("\nJOIN " + price, "\nLEFT JOIN " + price)
    return s


def due_sql(first: str, last: str, price: str) -> str:
    """Premium due per month in [first, last]: policy x anniversary months in the window."""
    months = f"SELECT strftime(d, '%Y-%m') AS month FROM range({mdate(first)}, {mdate(last)} + INTERVAL 1 MONTH, INTERVAL 1 MONTH) t(d)"
    py = ceil12("CAST(m.month || '-01' AS DATE)", "CAST(p.buy_datetime AS DATE)")
    return f"""
SELECT m.month, p.insur_code, p.insur_name,
       if({py} <= CAST(p.ppp AS INTEGER) AND substr(m.month, 6, 2) = substr(p.buy_datetime, 6, 2), p.prem, 0) AS prem_thismonth
FROM ({priced(price)}) p JOIN ({months}) m ON substr(p.buy_datetime, 1, 7) <= m.month
  AND substr(m.month, 6, 2) = substr(p.buy_datetime, 6, 2)"""


PREV = month_shift(M, -1)
add("kpi_premium_growth", f"""
SELECT CAST(a.prem AS DECIMAL(24,6)) AS prem, CAST(b.last_prem AS DECIMAL(24,6)) AS last_prem,
       {ratio("a.prem - b.last_prem", "b.last_prem", "DECIMAL(8,6)")} AS prem_incre_rate
FROM (SELECT sum(prem_thismonth) AS prem FROM due WHERE month = '{M}' AND prem_thismonth > 0) a
JOIN (SELECT sum(prem_thismonth) AS last_prem FROM due WHERE month = '{PREV}' AND prem_thismonth > 0) b ON 1 = 1""",
    {"due": due_sql(PREV, M, "prem_std_real")})

BEFORE_ALL = "1980-01"          # earlier than any purchase
add("kpi_premium_growth_history", f"""
SELECT month, prem, last_prem, {ratio("prem - last_prem", "last_prem", "DECIMAL(10,4)")} AS prem_incre_rate
FROM (SELECT month, prem, lag(prem) OVER (ORDER BY month) AS last_prem
      FROM (SELECT month, CAST(sum(prem_thismonth) AS DECIMAL(24,6)) AS prem FROM due GROUP BY month) t1) t2""",
    {"due": due_sql(BEFORE_ALL, M, "prem_std")})

HELD = ceil12("CAST(elapse_date AS DATE)", "CAST(buy_datetime AS DATE)")
add("kpi_first_year_ratio", f"""
SELECT CAST(sum(first_prem) AS DECIMAL(24,6)) AS first_prem, CAST(sum(total_prem) AS DECIMAL(24,6)) AS total_prem,
       {ratio("sum(first_prem)", "sum(total_prem)", "DECIMAL(8,6)")} AS first_of_total_prem
FROM (SELECT prem AS first_prem, least({PY_M}, CAST(ppp AS BIGINT), {HELD}) * prem AS total_prem
      FROM ({priced("prem_std_real")}) p WHERE substr(buy_datetime, 1, 7) <= '{M}') t""")

add("kpi_first_year_ratio_left", f"""
SELECT CAST(sum(first_prem) AS DECIMAL(24,6)) AS first_prem, CAST(sum(total_prem) AS DECIMAL(24,6)) AS total_prem,
       {ratio("sum(first_prem)", "sum(total_prem)", "DECIMAL(8,6)")} AS first_of_total_prem
FROM (SELECT prem AS first_prem, least({PY_M}, CAST(ppp AS BIGINT), {HELD}) * prem AS total_prem
      FROM ({priced("prem_std", left=True)}) p WHERE substr(buy_datetime, 1, 7) <= '{M}') t""")

M13 = month_shift(M, -13)
add("kpi_persistency13", f"""
SELECT insur_code, insur_name, eff13_num, total_eff_num,
       {ratio("eff13_num", "total_eff_num", "DECIMAL(8,6)")} AS rate_eff13
FROM (SELECT insur_code, insur_name,
             CAST(sum(if(elapse_date > '{M}' OR elapse_date IS NULL, 1, 0)) AS BIGINT) AS eff13_num,
             count(pol_no) AS total_eff_num
      FROM policy_benefit
      WHERE buy_datetime <= '{M13}' AND (elapse_date > '{M13}' OR elapse_date IS NULL)
      GROUP BY insur_code, insur_name) t""")

P13 = month_shift(M, 13)
add("kpi_persistency13_forward", f"""
SELECT insur_code, insur_name, cnt_eff13, cnt_all, {ratio("cnt_eff13", "cnt_all", "DECIMAL(10,5)")} AS rate_eff13
FROM (SELECT insur_code, insur_name,
             CAST(sum(if(elapse_date IS NULL OR substr(elapse_date, 1, 7) >= '{P13}', 1, 0)) AS BIGINT) AS cnt_eff13,
             count(1) AS cnt_all
      FROM policy_benefit pb JOIN policy_client c ON pb.user_id = c.user_id
      WHERE '{M}' >= pb.buy_datetime AND ('{M}' < pb.elapse_date OR pb.elapse_date IS NULL)
      GROUP BY insur_code, insur_name) t""")

add("kpi_persistency13_history", f"""
SELECT insur_code, insur_name, month, cnt_eff13, cnt_all, {ratio("cnt_eff13", "cnt_all", "DECIMAL(10,5)")} AS rate_eff13
FROM (SELECT insur_code, insur_name, b.month,
             CAST(sum(if(elapse_date IS NULL OR substr(elapse_date, 1, 7) >=
                    strftime(CAST(b.month || '-01' AS DATE) + INTERVAL 13 MONTH, '%Y-%m'), 1, 0)) AS BIGINT) AS cnt_eff13,
             count(1) AS cnt_all
      FROM (SELECT strftime({mdate(M)} - to_months(CAST(i AS INTEGER)), '%Y-%m') AS month FROM range(1, 37) t(i)) b
      JOIN policy_benefit pb ON b.month >= pb.buy_datetime AND (b.month < pb.elapse_date OR pb.elapse_date IS NULL)
      JOIN policy_client c ON pb.user_id = c.user_id
      GROUP BY insur_code, insur_name, b.month) t""")

add("kpi_premium_per_policy", f"""
SELECT insur_code, insur_name, {ratio("sum(prem)", "count(pol_no)", "DECIMAL(38,2)")} AS prem_per_pol
FROM ({priced("prem_std_real")}) p WHERE substr(buy_datetime, 1, 7) = '{M}'
GROUP BY insur_code, insur_name""")

add("kpi_premium_per_policy_history", f"""
SELECT insur_code, insur_name, substr(buy_datetime, 1, 7) AS month,
       {ratio("sum(prem)", "count(1)", "DECIMAL(38,2)")} AS prem_per_pol
FROM ({priced("prem_std", left=True)}) p
GROUP BY insur_code, insur_name, substr(buy_datetime, 1, 7)""")

add("kpi_cooloff", f"""
SELECT insur_code, insur_name, CAST(sum(if(s.keep_days <= 20, p.prem, 0)) AS DECIMAL(26,6)) AS cooloff,
       CAST(sum(p.prem) AS DECIMAL(24,6)) AS cnt_all,
       {ratio("sum(if(s.keep_days <= 20, p.prem, 0))", "sum(p.prem)", "DECIMAL(8,6)")} AS cooloff_rate
FROM ({priced("prem_std_real")}) p LEFT JOIN policy_surrender s ON p.pol_no = s.pol_no
WHERE substr(p.buy_datetime, 1, 7) = '{M}'
GROUP BY insur_code, insur_name""")

add("kpi_cooloff_history", f"""
SELECT insur_code, insur_name, substr(p.buy_datetime, 1, 7) AS month,
       CAST(sum(if(s.keep_days <= 20, p.prem, 0)) AS DECIMAL(26,6)) AS cooloff,
       CAST(sum(p.prem) AS DECIMAL(24,6)) AS cnt_all,
       {ratio("sum(if(s.keep_days <= 20, p.prem, 0))", "sum(p.prem)", "DECIMAL(10,4)")} AS cooloff_rate
FROM ({priced("prem_std", left=True)}) p LEFT JOIN policy_surrender s ON p.pol_no = s.pol_no
GROUP BY insur_code, insur_name, substr(p.buy_datetime, 1, 7)""")

M14 = month_shift(M, -14)
add("kpi_surrender", f"""
SELECT insur_code, insur_name, cnt_surr, cnt_all, {ratio("cnt_surr", "cnt_all", "DECIMAL(8,6)")} AS surr_rate
FROM (SELECT a.insur_code, a.insur_name,
             CAST(sum(if(s.elapse_date > '{M14}' AND s.elapse_date < '{M}', 1, 0)) AS BIGINT) AS cnt_surr,
             count(a.pol_no) AS cnt_all
      FROM policy_benefit a LEFT JOIN policy_surrender s ON a.pol_no = s.pol_no
      WHERE '{M14}' >= substr(a.buy_datetime, 1, 7) AND ('{M14}' < a.elapse_date OR a.elapse_date IS NULL)
      GROUP BY a.insur_code, a.insur_name) t""")

add("kpi_surrender_on_predicate", f"""
SELECT insur_code, insur_name, cnt_surr, cnt_all, {ratio("cnt_surr", "cnt_all", "DECIMAL(10,4)")} AS surr_rate
FROM (SELECT insur_code, insur_name, count(s.pol_no) AS cnt_surr, count(pb.pol_no) AS cnt_all
      FROM policy_client c JOIN policy_benefit pb ON c.user_id = pb.user_id
      LEFT JOIN policy_surrender s ON pb.pol_no = s.pol_no
           AND substr(pb.elapse_date, 1, 7) > '{M14}' AND substr(pb.elapse_date, 1, 7) <= '{M}'
      WHERE substr(pb.buy_datetime, 1, 7) <= '{M14}' AND (pb.elapse_date > '{M14}' OR pb.elapse_date IS NULL)
      GROUP BY insur_code, insur_name) t""")

AGE_AT_CLAIM = f"CAST({ceil12('CAST(c.claim_date AS DATE)', 'CAST(b.birthday AS DATE)')} AS INTEGER)"


def mort_sql(where: str, on_extra: str = "") -> str:
    return f"""
SELECT insur_code, insur_name, age, sg_cnt, sc_cnt, all_cnt,
       {ratio("sg_cnt", "all_cnt", "DECIMAL(8,6)")} AS sg_rate, {ratio("sc_cnt", "all_cnt", "DECIMAL(8,6)")} AS sc_rate
FROM (SELECT a.insur_code, a.insur_name, {AGE_AT_CLAIM} AS age,
             CAST(sum(if(c.claim_item LIKE '%sgbxj%', 1, 0)) AS BIGINT) AS sg_cnt,
             CAST(sum(if(c.claim_item LIKE '%scbxj%', 1, 0)) AS BIGINT) AS sc_cnt,
             CAST(sum(count(1)) OVER () AS BIGINT) AS all_cnt
      FROM policy_benefit a JOIN policy_client b ON a.user_id = b.user_id
      LEFT JOIN claim_events c ON a.pol_no = c.pol_no {on_extra}
      WHERE {where}
      GROUP BY a.insur_code, a.insur_name, {AGE_AT_CLAIM}) t"""


add("kpi_mortality_disability", mort_sql("a.elapse_date IS NULL"))
add("kpi_mortality_disability_month", mort_sql(
    f"substr(a.buy_datetime, 1, 7) <= '{M}' AND (a.elapse_date IS NULL OR substr(a.elapse_date, 1, 7) >= '{M}')",
    f"AND substr(c.claim_date, 1, 7) <= '{M}'"))

add("kpi_region", """
SELECT direction, count(user_id) AS sum_users, CAST(sum(prem_thismonth) AS DECIMAL(24,6)) AS sum_prem,
       CAST(sum(cv_1b) AS DECIMAL(27,7)) AS sum_cv_1b, CAST(sum(sur_ben) AS DECIMAL(27,7)) AS sum_sur_ben,
       CAST(sum(rsv2_re) AS DECIMAL(27,7)) AS sum_rsv2_re
FROM policy_result GROUP BY direction""", {"policy_result": POLICY_RESULT})

add("kpi_region_rounded", """
SELECT direction, count(user_id) AS sum_users, CAST(round(sum(prem_thismonth), 2) AS DECIMAL(24,2)) AS sum_prem,
       CAST(round(sum(cv_1b), 2) AS DECIMAL(27,2)) AS sum_cv_1b, CAST(round(sum(sur_ben), 2) AS DECIMAL(27,2)) AS sum_sur_ben,
       CAST(round(sum(rsv2_re), 2) AS DECIMAL(27,2)) AS sum_rsv2_re
FROM policy_result GROUP BY direction""", {"policy_result": POLICY_RESULT})

add("kpi_high_net_worth", f"""
SELECT {ratio("sum(if(income >= 10000000, 1, 0))", "count(1)", "DECIMAL(8,6)")} AS high_net_rate FROM policy_client""")

add("kpi_nbev_month", f"""
SELECT insur_code, insur_name, {ratio("sum(prem * nbev)", "sum(prem)", "DECIMAL(38,11)")} AS nbev
FROM ({priced("prem_std_real")}) p WHERE substr(buy_datetime, 1, 7) <= '{M}' GROUP BY insur_code, insur_name""")
add("kpi_nbev", f"""
SELECT insur_code, insur_name, {ratio("sum(prem * nbev)", "sum(prem)", "DECIMAL(38,11)")} AS nbev
FROM ({priced("prem_std_real")}) p GROUP BY insur_code, insur_name""")


# ---------------------------------------------------------------- incremental growth
add("kpi_premium_growth_incremental", f"""
SELECT a.prem, b.last_prem, {ratio("a.prem - b.last_prem", "b.last_prem", "DECIMAL(10,4)")} AS prem_incre_rate
FROM (SELECT CAST(sum(prem_thismonth) AS DECIMAL(24,6)) AS prem FROM due WHERE month = '{M}') a
LEFT JOIN (SELECT CAST(sum(prem_thismonth) AS DECIMAL(24,6)) AS last_prem FROM due WHERE month = '{PREV}') b ON 1 = 1""",
    {"due": due_sql(PREV, M, "prem_std_real")})

# ---------------------------------------------------------------- single-operator queries
LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"
LINE_ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
V = "CAST(l_extendedprice AS DECIMAL(18,2))"
WL = f"PARTITION BY l_orderkey ORDER BY {LINE_ORDER}"

add("win_tail_sum", f"""
SELECT {LINE_ID}, CAST(sum({V}) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC,
       l_suppkey DESC, l_shipdate DESC, l_extendedprice DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS DECIMAL(28,2)) AS tail_sum FROM lineitem""")
add("win_tail_sum_exclusive", f"""
SELECT {LINE_ID}, CAST(sum({V}) OVER ({WL} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS DECIMAL(28,2))
       AS tail_sum_excl FROM lineitem""")
add("win_group_total", f"""
SELECT {LINE_ID}, CAST(sum({V}) OVER (PARTITION BY l_orderkey) AS DECIMAL(28,2)) AS order_total FROM lineitem""")
add("win_lead", f"SELECT {LINE_ID}, lead(l_extendedprice) OVER ({WL}) AS next_price FROM lineitem")
add("win_lag", f"SELECT {LINE_ID}, lag(l_extendedprice) OVER ({WL}) AS prev_price FROM lineitem")
add("win_row_number", """
SELECT o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
       AS INTEGER) AS rn FROM orders""")
PREV_ROWS = f"{WL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
from tontine.oracle.chain import dec, prev_product  # noqa: E402

add("recur_survival", f"""
SELECT {LINE_ID}, {dec(prev_product("1 - l_discount", "l_orderkey", LINE_ORDER), "DECIMAL(20,9)")}
       AS survival FROM lineitem""")
add("recur_multi_decrement", f"""
SELECT {LINE_ID}, {dec("l", "DECIMAL(20,9)")} AS l, {dec("l * l_discount", "DECIMAL(20,9)")} AS d_a,
       {dec("l * l_tax", "DECIMAL(20,9)")} AS d_b
FROM (SELECT *, {prev_product("1 - (l_discount + l_tax)", "l_orderkey", LINE_ORDER)} AS l FROM lineitem) t""")


ORACLE_SQL["ordered_fold_states"] = f"""
WITH RECURSIVE o AS (SELECT {LINE_ID}, l_discount, l_tax, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS rn FROM lineitem),
r AS (SELECT {LINE_ID}, rn, 1.0::DOUBLE AS l, l_discount AS d_a, l_tax AS d_b FROM o WHERE rn = 1
      UNION ALL
      SELECT o.l_orderkey, o.l_linenumber, o.l_partkey, o.l_suppkey, o.rn, r.l - r.d_a - r.d_b, (r.l - r.d_a - r.d_b) * o.l_discount,
             (r.l - r.d_a - r.d_b) * o.l_tax
      FROM r JOIN o ON o.l_orderkey = r.l_orderkey AND o.rn = r.rn + 1)
SELECT {LINE_ID}, CAST({dec("l", "DECIMAL(22,13)")} AS DECIMAL(20,9)) AS l, CAST({dec("d_a", "DECIMAL(22,13)")} AS DECIMAL(20,9)) AS d_a, CAST({dec("d_b", "DECIMAL(22,13)")} AS DECIMAL(20,9)) AS d_b FROM r"""


def _fold_sql(a: str, seed: str, b_expr: str, out: str, exact: str, dec: str) -> str:
    return f"""
WITH RECURSIVE o AS (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders),
r AS (
  SELECT o_custkey, o_orderkey, rn, {seed} AS x FROM o WHERE rn = 1
  UNION ALL
  SELECT o.o_custkey, o.o_orderkey, o.rn, {a} * r.x + {b_expr}
  FROM r JOIN o ON o.o_custkey = r.o_custkey AND o.rn = r.rn + 1)
SELECT o_custkey, o_orderkey, CAST(CAST(CAST(x AS VARCHAR) AS {exact}) AS {dec}) AS {out} FROM r"""


ORACLE_SQL["recur_affine"] = _fold_sql("0.5::DOUBLE", "1.0::DOUBLE", "0.5::DOUBLE * o.o_totalprice", "c4",
                                       "DECIMAL(28,9)", "DECIMAL(24,6)")
ORACLE_SQL["ordered_fold"] = _fold_sql("0.7::DOUBLE", "o_totalprice", "0.3::DOUBLE * o.o_totalprice", "smooth",
                                       "DECIMAL(28,7)", "DECIMAL(24,4)")
ORDERS_IN_TURN = """o AS (SELECT o_custkey, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
     row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)"""
ORACLE_SQL["fold_capped_balance"] = f"""
WITH RECURSIVE {ORDERS_IN_TURN},
r AS (SELECT o_custkey, o_orderkey, rn, least(cents, 50000000) AS x FROM o WHERE rn = 1
      UNION ALL SELECT o.o_custkey, o.o_orderkey, o.rn, greatest(0, least(50000000, r.x + o.cents - 15000000))
      FROM r JOIN o ON o.o_custkey = r.o_custkey AND o.rn = r.rn + 1)
SELECT o_custkey, o_orderkey, CAST(CAST(x AS DECIMAL(24,0)) / 100 AS DECIMAL(24,2)) AS balance FROM r"""
ORACLE_SQL["fold_best_run"] = f"""
WITH RECURSIVE {ORDERS_IN_TURN},
r AS (SELECT o_custkey, o_orderkey, rn, cents - 15000000 AS run, cents - 15000000 AS best FROM o WHERE rn = 1
      UNION ALL SELECT o.o_custkey, o.o_orderkey, o.rn, o.cents - 15000000 + greatest(0, r.run),
                       greatest(r.best, o.cents - 15000000 + greatest(0, r.run))
      FROM r JOIN o ON o.o_custkey = r.o_custkey AND o.rn = r.rn + 1)
SELECT o_custkey, o_orderkey, run AS run_cents, best AS best_cents FROM r"""
ORACLE_SQL["fold_payouts"] = f"""
WITH RECURSIVE {ORDERS_IN_TURN},
r AS (SELECT o_custkey, o_orderkey, rn, cents AS x, 0 AS payouts FROM o WHERE rn = 1
      UNION ALL SELECT o.o_custkey, o.o_orderkey, o.rn, CASE WHEN r.x + o.cents > 60000000 THEN (r.x + o.cents) // 2 ELSE r.x + o.cents END,
                       r.payouts + CASE WHEN r.x + o.cents > 60000000 THEN 1 ELSE 0 END
      FROM r JOIN o ON o.o_custkey = r.o_custkey AND o.rn = r.rn + 1)
SELECT o_custkey, o_orderkey, x AS balance_cents, CAST(payouts AS INTEGER) AS payouts FROM r"""
ORACLE_SQL["agg_user_defined"] = """
WITH v AS (SELECT l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS c, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) AS k
           FROM lineitem)
SELECT l_suppkey, max(c) AS largest, max(c) FILTER (k = 2) AS second, count(*) FILTER (k = 1) AS n_largest,
       max(c) - max(c) FILTER (k = 2) AS gap FROM v GROUP BY l_suppkey"""
add("join_interval_rows", """
SELECT pol_no, event_id, CAST(greatest(bought, first_day) AS INTEGER) AS from_day, CAST(least(elapsed, last_day) AS INTEGER) AS to_day
FROM (SELECT pol_no, CAST(buy_datetime AS DATE) - DATE '1970-01-01' AS bought, CAST(elapse_date AS DATE) - DATE '1970-01-01' AS elapsed FROM policy_surrender) p
JOIN (SELECT event_id, DATE '1995-01-01' - DATE '1970-01-01' + event_id * 7 % 2400 AS first_day,
             DATE '1995-01-01' - DATE '1970-01-01' + event_id * 7 % 2400 + CAST(floor(value) AS INTEGER) % 30 AS last_day
      FROM events WHERE event_type = 'error') e ON bought <= last_day AND first_day <= elapsed""")
ORACLE_SQL["compare_two_sided"] = """
WITH mine AS (SELECT o_orderkey, o_totalprice * (1 + (o_orderkey % 7) * 0.0005::DOUBLE) AS m FROM orders WHERE o_orderkey % 50 <> 0),
golden AS (SELECT o_orderkey, o_totalprice AS r FROM orders WHERE o_orderkey % 70 <> 3),
merged AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, m, r, (m - r) / r AS d FROM mine a FULL JOIN golden b ON a.o_orderkey = b.o_orderkey)
SELECT o_orderkey, CASE WHEN m IS NULL THEN 'missing' WHEN r IS NULL THEN 'extra' ELSE 'differs' END AS status,
       CASE WHEN m IS NOT NULL AND r IS NOT NULL THEN 'o_totalprice' END AS "column", CAST(d AS DECIMAL(10,6)) AS rate
FROM merged WHERE m IS NULL OR r IS NULL OR abs(d) > 0.001"""
add("win_lag_over_months", f"""
SELECT month, CAST(revenue AS DECIMAL(28,2)) AS revenue, CAST(last_revenue AS DECIMAL(28,2)) AS last_revenue,
       {ratio("revenue - last_revenue", "last_revenue", "DECIMAL(12,6)")} AS growth
FROM (SELECT month, revenue, lag(revenue) OVER (ORDER BY month) AS last_revenue
      FROM (SELECT strftime(l_shipdate, '%Y-%m') AS month, sum({V}) AS revenue FROM lineitem GROUP BY 1) a) b""")
add("join_detail_to_aggregate", f"""
SELECT {LINE_ID}, {ratio(V, "t.order_total", "DECIMAL(12,10)")} AS share
FROM lineitem l JOIN (SELECT l_orderkey AS k, sum({V}) AS order_total FROM lineitem GROUP BY 1) t
  ON l.l_orderkey = t.k""")
add("join_cross", f"""
SELECT l_returnflag, CAST(revenue AS DECIMAL(28,2)) AS revenue,
       CAST(CAST(revenue AS DOUBLE) / (1 + i.interest_rate) AS DECIMAL(28,4)) AS pv, i.sa
FROM (SELECT l_returnflag, sum({V}) AS revenue FROM lineitem GROUP BY 1) a
JOIN (SELECT 0.035::DOUBLE AS interest_rate, 10000.0::DOUBLE AS sa) i ON 1 = 1""")
add("join_scalar_pair", f"""
SELECT CAST(a.this_year AS DECIMAL(28,2)) AS this_year, CAST(b.last_year AS DECIMAL(28,2)) AS last_year,
       {ratio("a.this_year - b.last_year", "b.last_year", "DECIMAL(12,6)")} AS growth
FROM (SELECT sum({V}) AS this_year FROM lineitem WHERE year(l_shipdate) = 1997) a
JOIN (SELECT sum({V}) AS last_year FROM lineitem WHERE year(l_shipdate) = 1996) b ON 1 = 1""")
add("join_composite_equi", f"SELECT pol_no, sex, ppp, age_buy, prem FROM ({priced('prem_std_real')}) p")
add("join_left_lookup", """
SELECT b.pol_no, b.buy_datetime, s.keep_days, s.elapse_date
FROM policy_benefit b LEFT JOIN policy_surrender s ON b.pol_no = s.pol_no""")
add("join_left_on_predicate", f"""
SELECT b.pol_no, b.elapse_date, s.pol_no AS s_pol_no
FROM policy_benefit b LEFT JOIN policy_surrender s ON b.pol_no = s.pol_no
  AND substr(b.elapse_date, 1, 7) > '{M14}' AND substr(b.elapse_date, 1, 7) <= '{M}'""")


def _computed_key_sql(py: str) -> str:
    return f"""
SELECT p.pol_no, CAST(p.py AS INTEGER) AS policy_year, CAST(a.cv_1b AS DECIMAL(17,4)) AS cv_1b
FROM (SELECT b.pol_no, c.sex, CAST(b.age_buy AS SMALLINT) AS ab, CAST(b.ppp AS SMALLINT) AS pp, {py} AS py
      FROM policy_benefit b JOIN policy_client c ON b.user_id = c.user_id
      WHERE substr(b.buy_datetime, 1, 7) <= '{M}') p
LEFT JOIN policy_actuary a ON p.ab = a.age_buy AND p.sex = a.sex AND p.pp = a.ppp AND p.py = a.policy_year"""


add("join_left_computed_key", _computed_key_sql(PY_M))
add("join_left_computed_key_floor1", _computed_key_sql(
    f"CAST(floor({mb(mdate(M), 'CAST(b.buy_datetime AS DATE)')} / 12) + 1 AS BIGINT)"))
add("join_month_inforce", f"""
SELECT b.month, count(*) AS n_inforce
FROM (SELECT strftime({mdate(M)} - to_months(CAST(i AS INTEGER)), '%Y-%m') AS month FROM range(1, 37) t(i)) b
JOIN policy_benefit pb ON b.month >= pb.buy_datetime AND (b.month < pb.elapse_date OR pb.elapse_date IS NULL)
GROUP BY b.month""")
add("join_range_expand", f"""
SELECT CAST(y.year AS INTEGER) AS year, count(*) AS n_policies
FROM (SELECT {PY_M} AS py FROM policy_benefit WHERE substr(buy_datetime, 1, 7) <= '{M}') p
JOIN range(1, 200) y(year) ON y.year <= p.py GROUP BY y.year""")
add("join_status_flag", """
SELECT b.pol_no, CAST(if(s.pol_no IS NULL, 1, 0) AS SMALLINT) AS pol_flag, s.elapse_date
FROM policy_benefit b LEFT JOIN policy_surrender s ON b.pol_no = s.pol_no""")
add("agg_conditional_sum", """
SELECT l_returnflag,
       CAST(sum(if(l_linestatus = 'O', CAST(l_quantity AS DECIMAL(18,2)), 0)) AS DECIMAL(28,2)) AS open_qty,
       CAST(sum(if(l_linestatus = 'F', CAST(l_quantity AS DECIMAL(18,2)), 0)) AS DECIMAL(28,2)) AS filled_qty
FROM lineitem GROUP BY l_returnflag""")
add("agg_sumproduct", """
SELECT l_orderkey,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,4)) AS qty_x_price,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DECIMAL(38,4)) AS net_revenue
FROM lineitem GROUP BY l_orderkey""")
add("agg_ratio", f"""
SELECT l_returnflag, {ratio("net", "gross", "DECIMAL(12,10)")} AS net_ratio
FROM (SELECT l_returnflag, sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS net,
             sum({V}) AS gross FROM lineitem GROUP BY l_returnflag) t""")
add("agg_global", f"""
SELECT count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS qty,
       CAST(sum({V}) AS DECIMAL(28,2)) AS revenue, count(DISTINCT l_orderkey) AS n_orders FROM lineitem""")
add("agg_count_variants", """
SELECT c.c_nationkey, count(1) AS n_rows, count(o.o_orderkey) AS n_orders
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_nationkey""")
add("agg_distinct_rows", """
SELECT DISTINCT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders""")
add("agg_group_by_alias_expr", """
SELECT strftime(l_shipdate, '%Y-%m') AS ship_month, count(1) AS n_lines FROM lineitem GROUP BY 1""")
add("agg_of_agg_window", """
SELECT o_orderpriority, count(1) AS n, CAST(sum(count(1)) OVER () AS BIGINT) AS all_n,
       CAST(count(1) / sum(count(1)) OVER () AS DECIMAL(10,8)) AS share
FROM orders GROUP BY o_orderpriority""")
add("agg_max", "SELECT CAST(ppp AS SMALLINT) AS ppp, CAST(max(policy_year) AS SMALLINT) AS max_policy_year "
               "FROM grid GROUP BY ppp")
add("dim_stack", """
SELECT s.sex, j.ppp, coalesce(c.n, 0) AS n_policies
FROM (VALUES ('M'), ('F')) s(sex) CROSS JOIN (VALUES (10), (15), (20), (30)) j(ppp)
LEFT JOIN (SELECT c.sex, CAST(b.ppp AS INTEGER) AS ppp, count(*) AS n
           FROM policy_benefit b JOIN policy_client c ON b.user_id = c.user_id GROUP BY 1, 2) c
  ON s.sex = c.sex AND j.ppp = c.ppp""")
add("union_literals", """
SELECT o.o_orderpriority, l.level, count(*) AS n
FROM orders o LEFT JOIN (SELECT '1-URGENT' AS p, 1 AS level UNION ALL SELECT '2-HIGH', 2 UNION ALL SELECT '3-MEDIUM', 3
                         UNION ALL SELECT '4-NOT SPECIFIED', 4 UNION ALL SELECT '5-LOW', 5) l ON l.p = o.o_orderpriority
GROUP BY o.o_orderpriority, l.level""")
add("int_sequence_rownum", """
SELECT CAST(t.age AS INTEGER) AS age, count(b.pol_no) AS n_policies
FROM range(1, 106) t(age) LEFT JOIN policy_benefit b ON b.age_buy = t.age GROUP BY t.age""")
add("int_sequence", """
SELECT CAST(y.pay_year AS INTEGER) AS pay_year, count(*) AS n_policies
FROM policy_benefit b JOIN range(1, 31) y(pay_year) ON y.pay_year <= CAST(b.ppp AS INTEGER)
GROUP BY y.pay_year""")
add("param_table", """
SELECT count(*) AS n_policies, 0.035::DOUBLE AS interest_rate, 0.055::DOUBLE AS interest_rate_cv,
       10000.0::DOUBLE AS sa, 1.0::DOUBLE AS disability_ratio, 0.1::DOUBLE AS nursing_ratio,
       CAST(75 AS INTEGER) AS nursing_age, CAST(count(*) * 10000.0::DOUBLE AS DECIMAL(24,2)) AS exposure
FROM policy_benefit""")
add("month_param", """
SELECT month, strftime(d - INTERVAL 1 MONTH, '%Y-%m') AS prev_month, strftime(d - INTERVAL 13 MONTH, '%Y-%m') AS back13,
       strftime(d - INTERVAL 14 MONTH, '%Y-%m') AS back14, strftime(d + INTERVAL 13 MONTH, '%Y-%m') AS ahead13
FROM (SELECT DISTINCT substr(buy_datetime, 1, 7) AS month, CAST(substr(buy_datetime, 1, 7) || '-01' AS DATE) AS d
      FROM policy_benefit) t""")
add("age_band_rate_pick", f"""
SELECT b.ppp, b.band, b.n, CAST(([0.55, 0.35, 0.25, 0.15, 0.10, 0.10])[b.band] AS DECIMAL(10,8)) AS expense_rate
FROM (SELECT CAST(ppp AS SMALLINT) AS ppp, CAST(least(greatest({PY_M}, 1), 6) AS INTEGER) AS band, count(*) AS n
      FROM policy_benefit WHERE substr(buy_datetime, 1, 7) <= '{M}' GROUP BY 1, 2) b""")
add("sort_multi", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders "
                  "ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
add("topk_count", """
SELECT province, count(*) AS n FROM policy_client GROUP BY province ORDER BY n DESC, province LIMIT 20""")
add("limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
add("product_slice", report_sql("prem_src", "prem_src") + " WHERE sex = 'M' AND ppp = 10 AND age_buy = 18 "
                                                          "ORDER BY policy_year")
add("union_year0", "SELECT sex, ppp, age_buy, CAST(policy_year AS SMALLINT) AS policy_year, "
                   "CAST(lx AS DECIMAL(17,9)) AS lx FROM cv1")
add("rsv_forms_agree", """
SELECT d.age_buy, d.sex, d.ppp, count(*) AS n_rows, CAST(any_value(net) AS DECIMAL(17,4)) AS prem_rsv,
       CAST(any_value(if(d.ppp = 1, net, cost)) AS DECIMAL(17,4)) AS alpha,
       CAST(any_value(if(d.ppp = 1, 0, net + (net - cost) * per_renewal)) AS DECIMAL(17,4)) AS beta,
       CAST(max(abs(net - CAST(d.prem_rsv AS DOUBLE))) AS DECIMAL(17,4)) AS prem_rsv_diff,
       CAST(max(abs(if(d.ppp = 1, net, cost) - CAST(d.alpha AS DOUBLE))) AS DECIMAL(17,4)) AS alpha_diff,
       CAST(max(abs(if(d.ppp = 1, 0, net + (net - cost) * per_renewal) - CAST(d.beta AS DOUBLE))) AS DECIMAL(17,4)) AS beta_diff
FROM rsv_src d JOIN factors k ON k.sex = d.sex AND k.ppp = d.ppp AND k.age_buy = d.age_buy
GROUP BY d.age_buy, d.sex, d.ppp""")
CHECK = """
SELECT p.age_buy, p.sex, p.ppp, p.{c} AS my_{c}, r.{c} AS real_{c},
       CAST((CAST(p.{c} AS DOUBLE) - CAST(r.{c} AS DOUBLE)) / CAST(r.{c} AS DOUBLE) AS DECIMAL(12,8)) AS diff_rate_{c}
FROM {a} p JOIN {b} r ON p.age_buy = r.age_buy AND p.sex = r.sex AND p.ppp = r.ppp
WHERE {cond}((CAST(p.{c} AS DOUBLE) - CAST(r.{c} AS DOUBLE)) / CAST(r.{c} AS DOUBLE)) > 0.001"""
add("prem_check", CHECK.format(c="prem", a="prem_std", b="prem_std_real", cond="abs"))
PREM_CV_REAL = """
SELECT age_buy, sex, ppp, CAST(CAST(prem_cv AS DOUBLE) * (1 + (age_buy % 7) * 0.0007::DOUBLE) AS DECIMAL(15,7)) AS prem_cv
FROM prem_cv"""
add("cv_check", CHECK.format(c="prem_cv", a="prem_cv", b="prem_cv_real", cond=""), {"prem_cv_real": PREM_CV_REAL})
add("cv_check_two_sided", CHECK.format(c="prem_cv", a="prem_cv", b="prem_cv_real", cond="abs"),
    {"prem_cv_real": PREM_CV_REAL})
add("count_reconcile", """
SELECT a.source_cnt, b.target_cnt, a.source_cnt = b.target_cnt AS matched
FROM (SELECT count(*) AS source_cnt FROM orders) a JOIN (SELECT count(*) AS target_cnt FROM policy_benefit) b ON 1 = 1""")

# ---------------------------------------------------------------- preparation
add("policy_number_assign", """
SELECT pol_no, buy_datetime,
       'P' || repeat('0', greatest(0, 9 - length(CAST(n AS VARCHAR)))) || CAST(n AS VARCHAR) AS new_pol_no
FROM (SELECT *, row_number() OVER (ORDER BY buy_datetime, pol_no) AS n FROM policy_benefit)""")
add("client_id_assign", """
SELECT c.user_id, a.id AS area_id,
       CAST(a.id AS VARCHAR) || '-' || CAST(row_number() OVER (PARTITION BY a.id ORDER BY CAST(c.user_id AS BIGINT)) AS VARCHAR) AS client_id
FROM policy_client c JOIN area a ON c.province = a.province""")
_LAYERS = [("ods", "mort_10_13", 7, "mort"), ("ods", "dd_table", 5, "dd"), ("ods", "pre_add_exp_ratio", 9, "expn"), ("ods", "prem_std_real", 6, "prem_std_real"),
           ("ods", "prem_cv_real", 4, "prem_cv"), ("ods", "area", 4, "area"), ("ods", "policy_client", 10, "policy_client"),
           ("ods", "policy_benefit", 9, "policy_benefit"), ("ods", "claim_info", 7, "claim_events"), ("ods", "policy_surrender", 5, "policy_surrender"),
           ("dw", "prem_src", 33, "prem_src"), ("dw", "prem_std", 5, "prem_std"), ("dw", "cv_src", 47, "cv8"), ("dw", "prem_cv", 4, "prem_cv"),
           ("dw", "rsv_src", 46, "prem_src")]
add("warehouse_catalog", " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, CAST({columns} AS INTEGER) AS n_columns, count(*) AS n_rows FROM {source}"
    for layer, name, columns, source in _LAYERS))
add("policy_number_incremental", """
SELECT pol_no, 'P' || repeat('0', greatest(0, 9 - length(CAST(n AS VARCHAR)))) || CAST(n AS VARCHAR) AS new_pol_no
FROM (SELECT pol_no, row_number() OVER (ORDER BY CASE WHEN buy_datetime < '1997-01-01' THEN 1 WHEN buy_datetime < '1999-07-01' THEN 2 ELSE 3 END,
             buy_datetime, pol_no) AS n FROM policy_benefit)""")
add("client_id_incremental", """
SELECT c.user_id, a.id AS area_id, CAST(a.id AS VARCHAR) || '-' || CAST(row_number() OVER (
       PARTITION BY a.id ORDER BY CAST(c.user_id AS BIGINT) % 2, CAST(c.user_id AS BIGINT)) AS VARCHAR) AS client_id
FROM policy_client c JOIN area a ON c.province = a.province""")
add("surrender_extract", f"""
SELECT b.pol_no, b.user_id, b.buy_datetime, s.keep_days, s.elapse_date
FROM policy_benefit b JOIN policy_surrender s ON b.pol_no = s.pol_no
WHERE CAST(b.buy_datetime AS DATE) + CAST(b.ppp AS INTEGER) * 365 > {mdate(M)}""")
add("policy_status", ORACLE_SQL["join_status_flag"].split("WITH ", 1)[0] + """
SELECT b.pol_no, CAST(if(s.pol_no IS NULL, 1, 0) AS SMALLINT) AS pol_flag, s.elapse_date
FROM policy_benefit b LEFT JOIN policy_surrender s ON b.pol_no = s.pol_no""")
add("split_client_policy", """
SELECT DISTINCT c.user_id, c.name, c.sex, c.birthday, c.province, c.city, c.direction, c.income
FROM policy_client c JOIN policy_benefit b ON c.user_id = b.user_id""")
add("claim_amount", """
SELECT e.pol_no, e.user_id, e.buy_datetime, e.insur_code, e.claim_date, e.claim_item,
       CAST(CASE WHEN e.claim_item IN ('sgbxj', 'scbxj0') THEN r.prem * least(e._ppp, CAST(ceil(e._days / 365) AS BIGINT))
                 WHEN e.claim_item IN ('scbxj1', 'scbxj2') THEN 10000 ELSE 1000 END AS DECIMAL(35,6)) AS claim_mnt
FROM claim_events e JOIN policy_client c ON e.user_id = c.user_id
LEFT JOIN prem_std_real r ON CAST(e._age_buy AS SMALLINT) = r.age_buy AND c.sex = r.sex AND CAST(e._ppp AS SMALLINT) = r.ppp""")
add("area_enrich", """
SELECT c.user_id, a.id AS area_id, c.province, a.direction,
       if(c.income >= 10000000, 'high', 'standard') AS income_tier
FROM policy_client c JOIN area a ON c.province = a.province""")
add("area_topk", """
SELECT a.id AS area_id, count(*) AS n
FROM policy_benefit b JOIN policy_client c ON b.user_id = c.user_id JOIN area a ON c.province = a.province
GROUP BY a.id ORDER BY n DESC, area_id LIMIT 20""")

# ---------------------------------------------------------------- sources and sinks
add("conform_schema", """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS o_totalprice,
       o_orderpriority FROM orders""")
add("delimited_scan", "SELECT * FROM policy_surrender")
add("partition_overwrite_static", f"""
SELECT month, count(*) AS n, CAST(sum(prem_thismonth) AS DECIMAL(24,6)) AS prem FROM due GROUP BY month""",
    {"due": due_sql(BEFORE_ALL, M, "prem_std_real")})
add("partition_inventory", "SELECT month, count(*) AS n FROM due GROUP BY month",
    {"due": due_sql(BEFORE_ALL, M, "prem_std_real")})
ORACLE_SQL["conform_table"] = """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_totalprice AS DECIMAL(7,2)) AS o_totalprice, o_orderpriority
FROM orders WHERE CAST(o_totalprice AS DECIMAL(18,2)) < 100000"""
ORACLE_SQL["conform_rejects"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, 'o_totalprice' AS "column", CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS raw,
       'does not fit decimal(7,2)' AS reason FROM orders WHERE CAST(o_totalprice AS DECIMAL(18,2)) >= 100000"""
TEXT_LINES = """WITH faults AS (SELECT *, l_partkey % 23 = 0 AS word, l_partkey % 29 = 0 AS day, l_partkey % 31 = 0 AS less, l_partkey % 37 = 0 AS more,
     CAST(CAST(l_quantity AS DECIMAL(7,2)) AS VARCHAR) AS q, strftime(l_shipdate, '%Y-%m-%d') AS d FROM lineitem),
counted AS (SELECT *, less <> more AS fields FROM faults)"""
ORACLE_SQL["delimited_table"] = f"""
{TEXT_LINES}
SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, CAST(l_quantity AS DECIMAL(7,2)) AS l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate,
       CASE WHEN less THEN 'more' ELSE l_returnflag END AS l_returnflag
FROM counted WHERE NOT fields AND NOT word AND NOT day"""
ORACLE_SQL["delimited_rejects"] = f"""
{TEXT_LINES},
errors AS (SELECT NULL AS "column", 'has a wrong number of fields' AS reason,
                  concat_ws(chr(9), l_orderkey, l_linenumber, CASE WHEN word THEN 'ten' ELSE q END, CASE WHEN day THEN '1998-13-01' ELSE d END,
                            CASE WHEN less THEN NULL ELSE l_returnflag END, CASE WHEN more THEN 'more' END) AS raw FROM counted WHERE fields
           UNION ALL SELECT 'l_quantity', 'is no decimal(7,2)', 'ten' FROM counted WHERE NOT fields AND word
           UNION ALL SELECT 'l_shipdate', 'is no date', '1998-13-01' FROM counted WHERE NOT fields AND day)
SELECT "column", reason, count(*) AS n, min(raw) AS least_raw, max(raw) AS greatest_raw FROM errors GROUP BY ALL"""
add("partition_overwrite_dynamic", """
SELECT substr(buy_datetime, 1, 7) AS month, count(*) AS n FROM policy_benefit GROUP BY 1""")
add("overwrite_from_self", "SELECT * FROM policy_surrender WHERE keep_days <= 20")
add("jdbc_ingest", """
SELECT 'POLICY_SURRENDER' AS table_name, count(*) AS source_cnt, count(*) AS target_cnt, true AS matched
FROM policy_surrender""")
add("jdbc_export", "SELECT * FROM area")


# ---------------------------------------------------------------- the 33 model steps
def _step_sql():
    from tontine.plans.steps import CELL, KEY, STEPS, SUM_TYPE
    from tontine.schema import report_types
    for name, (stage, cols) in STEPS.items():
        if stage in ("prem_sums", "cv_sums"):
            src = "pstd11" if stage == "prem_sums" else "pcv17"
            sel = ", ".join(CELL + [f"CAST(CAST({c} AS VARCHAR) AS {SUM_TYPE.upper()}) AS {c}" for c in cols])
            add(name, f"SELECT {sel} FROM {src}")
            continue
        types = dict(report_types(stage))
        keys = CELL if stage in ("prem_std", "prem_cv") else KEY
        sel = ", ".join([f"CAST({k} AS {types[k].upper()}) AS {k}" for k in keys]
                        + [f"CAST({c} AS {types[c].upper()}) AS {c}" for c in cols])
        add(name, f"SELECT {sel} FROM {stage}")


_step_sql()


add("split_client_policy_policies", """
SELECT b.pol_no, b.user_id, b.ppp, b.age_buy, b.buy_datetime, b.insur_name, b.insur_code, b.pol_flag, b.elapse_date
FROM policy_client c JOIN policy_benefit b ON c.user_id = b.user_id""")
add("scalar_functions", f"""
SELECT pol_no,
       CAST(CAST({mb(mdate(M), "CAST(buy_datetime AS DATE)")} AS VARCHAR) AS DECIMAL(20,8)) AS months_held,
       strftime(CAST(buy_datetime AS DATE) + INTERVAL 13 MONTH, '%Y-%m-%d') AS plus13m,
       CAST(month(CAST(buy_datetime AS DATE)) AS INTEGER) AS buy_month,
       CAST(date_diff('day', CAST(buy_datetime AS DATE), CAST(coalesce(elapse_date, buy_datetime) AS DATE)) AS INTEGER) AS days_held,
       strftime(CAST(buy_datetime AS DATE) + 30 - 7, '%Y-%m-%d') AS plus23d,
       substr(buy_datetime, 1, 7) AS buy_ym,
       insur_code || '-' || repeat('x', CAST(ppp AS INTEGER) // 10) AS code_tag,
       CAST(length(replace(insur_name, '-', '')) AS INTEGER) AS name_len,
       insur_name LIKE '%URGENT%' AS is_urgent,
       CAST(ppp AS INTEGER) IN (10, 20) AS even_term,
       (['a', 'b', 'c', 'd'])[CAST(CAST(ppp AS INTEGER) // 10 AS INTEGER)] AS term_band,
       greatest(CAST(NULL AS INTEGER), CAST(ppp AS INTEGER), 12) AS term_floor12,
       least(CAST(NULL AS INTEGER), CAST(ppp AS INTEGER), 12) AS term_cap12,
       CAST(CAST(pow(1.035::DOUBLE, -CAST(ppp AS INTEGER)) AS VARCHAR) AS DECIMAL(20,12)) AS v_ppp,
       CAST(ceil(age_buy / 7) AS INTEGER) AS age_band_ceil,
       CAST(floor(age_buy / 7) AS INTEGER) AS age_band_floor,
       abs(CAST(ppp AS INTEGER) - age_buy) AS gap,
       CAST(age_buy % 7 AS INTEGER) AS age_mod7,
       CAST(round(CAST(age_buy AS DECIMAL(10,3)) / 7, 2) AS DECIMAL(10,2)) AS age_round
FROM policy_benefit""")
