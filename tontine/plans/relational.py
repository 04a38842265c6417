"""Single-operator queries on the order/lineitem tables.

Each function exercises one operator of the inventory (joins, aggregates,
windows, recurrences, sorts, unions) on scalable input so that it is checked
on real volumes, not only inside the actuarial pipeline.  Money columns are
summed as exact decimals (order-independent, so any partitioning gives the
same digits).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.operators.aggregate import TopTwo, aggregate
from tontine.operators.fold import Clamp, MaxPlus, sequential_fold
from tontine.operators.fold import ordered_fold as folded
from tontine.operators.grid import int_series, literal_dim
from tontine.operators.intervals import overlap_join
from tontine.operators.joins import broadcast_bounded, expand_range
from tontine.operators.quality import compare_tables
from tontine.operators.scan import affine_recurrence, linear_recurrence, ordered_scan
from tontine.params import DEFAULT
from tontine.sources import fixtures
from tontine.sources.sinks import materialize
from tontine.sources.tables import table

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ORDER_ORDER = ["o_orderdate", "o_orderkey"]


def _lines(spark, sf_dir, *extra) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*dict.fromkeys(LINE_ID + LINE_ORDER + list(extra)))


# Exact money types sized to the columns' domains (price < 1e9, quantity < 1e5,
# discount < 1): products of two such decimals stay within 18 digits, Spark's
# fast fixed-point path.
PRICE_T, QTY_T, RATE_T = "decimal(11,2)", "decimal(7,2)", "decimal(4,2)"


def _price_dec(col: str = "l_extendedprice") -> str:
    return f"cast({col} as {PRICE_T})"


# ---------------------------------------------------------------- windows (skew-safe scan)
def win_tail_sum(spark, sf_dir) -> DataFrame:
    """Sum of the extended price from this line to the order's last line."""
    d = _lines(spark, sf_dir).withColumn("v", F.expr(_price_dec()))
    s = ordered_scan(d, ["l_orderkey"], LINE_ORDER, sums=["v"])
    return s.selectExpr(*LINE_ID, "cast(v__total - v__cum + v as decimal(28,2)) as tail_sum")


def win_tail_sum_exclusive(spark, sf_dir) -> DataFrame:
    """Sum over strictly later lines; null on the order's last line (empty frame)."""
    d = _lines(spark, sf_dir).withColumn("v", F.expr(_price_dec()))
    s = ordered_scan(d, ["l_orderkey"], LINE_ORDER, sums=["v"])
    return s.selectExpr(*LINE_ID, "cast(if(_pos = _n, null, v__total - v__cum) as decimal(28,2)) as tail_sum_excl")


def win_group_total(spark, sf_dir) -> DataFrame:
    """Order total beside each line."""
    d = _lines(spark, sf_dir).withColumn("v", F.expr(_price_dec()))
    s = ordered_scan(d, ["l_orderkey"], LINE_ORDER, sums=["v"])
    return s.selectExpr(*LINE_ID, "cast(v__total as decimal(28,2)) as order_total")


def win_lead(spark, sf_dir) -> DataFrame:
    d = _lines(spark, sf_dir)
    s = ordered_scan(d, ["l_orderkey"], LINE_ORDER, leads=["l_extendedprice"])
    return s.selectExpr(*LINE_ID, "l_extendedprice__lead as next_price")


def win_lag(spark, sf_dir) -> DataFrame:
    d = _lines(spark, sf_dir)
    s = ordered_scan(d, ["l_orderkey"], LINE_ORDER, lags=["l_extendedprice"])
    return s.selectExpr(*LINE_ID, "l_extendedprice__lag as prev_price")


def win_row_number(spark, sf_dir) -> DataFrame:
    """Position of each order within its customer, by (date, key)."""
    d = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    s = ordered_scan(d, ["o_custkey"], ORDER_ORDER)
    return s.selectExpr("o_orderkey", "o_custkey", "cast(_pos as int) as rn")


def recur_survival(spark, sf_dir) -> DataFrame:
    """l_1 = 1, l_t = l_{t-1} * (1 - discount_{t-1}) along the lines of an order."""
    d = _lines(spark, sf_dir, "l_discount").withColumn("keep", F.expr("1 - l_discount"))
    s = ordered_scan(d, ["l_orderkey"], LINE_ORDER, products=["keep"])
    return s.selectExpr(*LINE_ID, "cast(coalesce(keep__cumprod_prev, 1D) as decimal(20,9)) as survival")


def recur_multi_decrement(spark, sf_dir) -> DataFrame:
    """Two decrements (discount, tax) from one population along the lines of an order."""
    d = _lines(spark, sf_dir, "l_discount", "l_tax").withColumn("keep", F.expr("1 - (l_discount + l_tax)"))
    s = ordered_scan(d, ["l_orderkey"], LINE_ORDER, products=["keep"])
    s = s.withColumn("l", F.expr("coalesce(keep__cumprod_prev, 1D)"))
    return s.selectExpr(*LINE_ID, "cast(l as decimal(20,9)) as l",
                        "cast(l * l_discount as decimal(20,9)) as d_a",
                        "cast(l * l_tax as decimal(20,9)) as d_b")


# Recurrences are reported through an exact decimal of three or four more digits: halves at the
# report's last digit (a mean of means has many) then round up whatever the order of the sums.
def recur_affine(spark, sf_dir) -> DataFrame:
    """c4_1 = 1, c4_t = (c4_{t-1} + price_t) / 2 along a customer's orders."""
    d = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    r = linear_recurrence(d, ["o_custkey"], ORDER_ORDER, a="0.5D", b="0.5D * o_totalprice", seed="1D", out="c4")
    return r.selectExpr("o_custkey", "o_orderkey", "cast(cast(c4 as decimal(28,9)) as decimal(24,6)) as c4")


def ordered_fold(spark, sf_dir) -> DataFrame:
    """Exponential smoothing of order value per customer: x_1 = p_1, x_t = 0.7 x_{t-1} + 0.3 p_t."""
    d = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    r = linear_recurrence(d, ["o_custkey"], ORDER_ORDER, a="0.7D", b="0.3D * o_totalprice",
                          seed="o_totalprice", out="smooth")
    return r.selectExpr("o_custkey", "o_orderkey", "cast(cast(smooth as decimal(28,7)) as decimal(24,4)) as smooth")


def ordered_fold_states(spark, sf_dir) -> DataFrame:
    """Three coupled states along the lines of an order, folded as one vector: the remaining
    part l and the parts d_a, d_b that leave it, l_t = l - d_a - d_b of the line before,
    d_a = l_t * discount, d_b = l_t * tax."""
    d = _lines(spark, sf_dir, "l_discount", "l_tax")
    left = ["1D", "-1D", "-1D"]
    a = [left, [f"l_discount * {c}" for c in left], [f"l_tax * {c}" for c in left]]
    r = affine_recurrence(d, ["l_orderkey"], LINE_ORDER, a, ["0D"] * 3, ["1D", "l_discount", "l_tax"], ["l", "d_a", "d_b"])
    return r.selectExpr(*LINE_ID, *[f"cast(cast({c} as decimal(22,13)) as decimal(20,9)) as {c}" for c in ("l", "d_a", "d_b")])


# Money of the folds below is whole cents, exact in every order of the additions.
_CENTS = "cast(round(o_totalprice * 100) as bigint)"
#: Fixed values of the stand-in account rules: an order's cost, a balance's ceiling, the limit of a payout (cents).
ORDER_COST, CEILING, PAYOUT = 15_000_000, 50_000_000, 60_000_000


def _customer_orders(spark, sf_dir) -> DataFrame:
    return (table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
            .withColumn("cents", F.expr(_CENTS)))


def fold_capped_balance(spark, sf_dir) -> DataFrame:
    """A customer's balance along the orders: each adds its price less a cost, never under 0 or over a ceiling."""
    d = _customer_orders(spark, sf_dir)
    r = folded(d, ["o_custkey"], ORDER_ORDER, Clamp(f"cents - {ORDER_COST}", "0", str(CEILING)), [f"least(cents, {CEILING})"], ["x"])
    return r.selectExpr("o_custkey", "o_orderkey", "cast(cast(x as bigint) as decimal(24,0)) / 100 as balance").selectExpr(
        "o_custkey", "o_orderkey", "cast(balance as decimal(24,2)) as balance")


def fold_best_run(spark, sf_dir) -> DataFrame:
    """The best sum of consecutive orders over their cost, ending here and up to here, along a customer's orders."""
    d = _customer_orders(spark, sf_dir).withColumn("v", F.expr(f"cents - {ORDER_COST}"))
    best = MaxPlus([["v", "null"], ["v", "0"]], ["v", "v"])
    r = folded(d, ["o_custkey"], ORDER_ORDER, best, ["v", "v"], ["run", "best"])
    return r.selectExpr("o_custkey", "o_orderkey", "cast(run as bigint) as run_cents", "cast(best as bigint) as best_cents")


def _first_balance(cents: int) -> tuple:
    return cents, 0


def _paid_balance(state: tuple, cents: int) -> tuple:
    balance = state[0] + cents
    return (balance // 2, state[1] + 1) if balance > PAYOUT else (balance, state[1])


def fold_payouts(spark, sf_dir) -> DataFrame:
    """A balance that pays out half when it passes a limit, and the payouts so far: a step that does not compose."""
    d = _customer_orders(spark, sf_dir)
    r = sequential_fold(d, ["o_custkey"], ORDER_ORDER, ["cents"], _first_balance, _paid_balance, "balance_cents bigint, payouts int")
    return r.select("o_custkey", "o_orderkey", "balance_cents", "payouts")


def agg_user_defined(spark, sf_dir) -> DataFrame:
    """The two largest different prices of a supplier's lines, in cents, by a user-defined mergeable aggregate."""
    d = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice")
    return aggregate(d, ["l_suppkey"], {"value": "cast(round(l_extendedprice * 100) as bigint)"}, TopTwo())


def win_lag_over_months(spark, sf_dir) -> DataFrame:
    """Revenue per ship month and growth against the previous month (lag over <= a few
    hundred aggregated months, a bounded single-partition window)."""
    d = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_extendedprice")
    m = d.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(
        F.expr(f"sum({_price_dec()}) as revenue"))
    return m.selectExpr("month", "cast(revenue as decimal(28,2)) as revenue",
                        "cast(lag(revenue) over (order by month) as decimal(28,2)) as last_revenue").selectExpr(
        "*", "cast(try_divide(cast(revenue - last_revenue as double), cast(last_revenue as double)) "
             "as decimal(12,6)) as growth")


# ---------------------------------------------------------------- joins
def join_detail_to_aggregate(spark, sf_dir) -> DataFrame:
    """Each line's share of its order total: group aggregate re-joined to the detail.

    Totals are pre-aggregated map-side and written (one row an order), so that both sides of
    the join are exchanges of its own and AQE can split the detail of a hot order; an
    aggregate between join and exchange would rule that out."""
    d = _lines(spark, sf_dir).withColumn("v", F.expr(_price_dec()))
    tot = materialize(d.groupBy("l_orderkey").agg(F.sum("v").alias("order_total")), name="order-totals")
    return d.join(tot, "l_orderkey").selectExpr(
        *LINE_ID, "cast(try_divide(cast(v as double), cast(order_total as double)) as decimal(12,10)) as share")


def join_cross(spark, sf_dir) -> DataFrame:
    """Aggregate x the one-row parameter table.  The parameters enter as literals, so
    Catalyst folds them (no join at all; the parameter row never ships)."""
    agg = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.expr(f"sum({_price_dec()}) as revenue"))
    return agg.selectExpr(
        "l_returnflag", "cast(revenue as decimal(28,2)) as revenue",
        f"cast(cast(revenue as double) / (1 + {DEFAULT.interest_rate}D) as decimal(28,4)) as pv",
        f"{DEFAULT.sa}D as sa")


def join_interval_rows(spark, sf_dir) -> DataFrame:
    """Surrendered policies with every coverage interval that falls into their time in force, pair by pair.  The
    stand-in intervals come from the error events: a day by the event's number, and a length by its value."""
    held = fixtures.policy_surrender(spark, sf_dir).selectExpr(
        "pol_no", "unix_date(to_date(buy_datetime)) as bought", "unix_date(to_date(elapse_date)) as elapsed")
    cover = table(spark, sf_dir, "events").where("event_type = 'error'").selectExpr(
        "event_id", "unix_date(date'1995-01-01') + cast(event_id * 7 % 2400 as int) as first_day", "cast(floor(value) as int) % 30 as days")
    cover = cover.selectExpr("event_id", "first_day", "first_day + days as last_day")
    pairs = overlap_join(held, cover, ("bought", "elapsed"), ("first_day", "last_day"))
    return pairs.selectExpr("pol_no", "event_id", "greatest(bought, first_day) as from_day", "least(elapsed, last_day) as to_day")


def compare_two_sided(spark, sf_dir) -> DataFrame:
    """Orders against a copy with planted faults: prices off by up to 0.3 %, orders lost on either side."""
    real = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    mine = real.where("o_orderkey % 50 <> 0").selectExpr("o_orderkey", "o_totalprice * (1 + (o_orderkey % 7) * 0.0005D) as o_totalprice")
    found = compare_tables(mine, real.where("o_orderkey % 70 <> 3"), ["o_orderkey"], ["o_totalprice"])
    return found.selectExpr("o_orderkey", "status", "column", "cast(rate as decimal(10,6)) as rate")


def join_scalar_pair(spark, sf_dir) -> DataFrame:
    """Two scalar aggregates side by side (revenue shipped in 1996 and in 1997), computed
    as one conditional aggregate in a single scan instead of joining two one-row results."""
    d = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_extendedprice")
    ab = d.agg(F.expr(f"sum(if(year(l_shipdate) = 1997, {_price_dec()}, null)) as this_year"),
               F.expr(f"sum(if(year(l_shipdate) = 1996, {_price_dec()}, null)) as last_year"))
    return ab.selectExpr(
        "cast(this_year as decimal(28,2)) as this_year", "cast(last_year as decimal(28,2)) as last_year",
        "cast(try_divide(cast(this_year - last_year as double), cast(last_year as double)) as decimal(12,6)) as growth")


def join_composite_equi(spark, sf_dir, price: DataFrame) -> DataFrame:
    """Policies priced by the composite key (age_buy, sex, ppp) (broadcast price table)."""
    from tontine.plans.kpi import _benefit_client, _priced
    return _priced(_benefit_client(spark, sf_dir), price).select("pol_no", "sex", "ppp", "age_buy", "prem")


def join_left_lookup(spark, sf_dir) -> DataFrame:
    """Every policy with its surrender record if any (unmatched kept, nulls)."""
    b = fixtures.policy_benefit(spark, sf_dir).select("pol_no", "buy_datetime")
    s = fixtures.policy_surrender(spark, sf_dir).select(F.col("pol_no").alias("_s"), "keep_days", "elapse_date")
    return b.join(s, b.pol_no == s._s, "left").select("pol_no", "buy_datetime", "keep_days", "elapse_date")


def join_left_on_predicate(spark, sf_dir, calc_month: str) -> DataFrame:
    """Left join with extra date predicates in the join condition (not a filter)."""
    from tontine.functions.dates import month_shift
    m14 = month_shift(calc_month, -14)
    b = fixtures.policy_benefit(spark, sf_dir).select("pol_no", "elapse_date")
    s = fixtures.policy_surrender(spark, sf_dir).select(F.col("pol_no").alias("s_pol_no"))
    cond = ((b.pol_no == s.s_pol_no) & (F.substring(b.elapse_date, 1, 7) > m14)
            & (F.substring(b.elapse_date, 1, 7) <= calc_month))
    return b.join(s, cond, "left").select("pol_no", "elapse_date", "s_pol_no")


def join_left_computed_key(spark, sf_dir, calc_month: str, actuary: DataFrame, rule: str = "ceil") -> DataFrame:
    """Policies left-joined to the actuarial row of their policy year at the report month."""
    from tontine.functions.dates import policy_year_sql
    from tontine.plans.kpi import _benefit_client
    p = _benefit_client(spark, sf_dir, last_month=calc_month).where(
        F.substring("buy_datetime", 1, 7) <= calc_month).selectExpr(
        "pol_no", "sex", "cast(age_buy as smallint) as _ab", "cast(ppp as smallint) as _pp",
        f"cast({policy_year_sql(calc_month, rule=rule)} as int) as policy_year")
    a = broadcast_bounded(actuary.select(
        F.col("age_buy").alias("_a_ab"), F.col("sex").alias("_a_sex"), F.col("ppp").alias("_a_pp"),
        F.col("policy_year").alias("_a_py"), "cv_1b"), DEFAULT.grid_row_bound() + DEFAULT.group_bound())
    j = p.join(a, (p._ab == a._a_ab) & (p.sex == a._a_sex) & (p._pp == a._a_pp) & (p.policy_year == a._a_py), "left")
    return j.selectExpr("pol_no", "policy_year", "cast(cv_1b as decimal(17,4)) as cv_1b")


def join_month_inforce(spark, sf_dir, calc_month: str, months: int = 36) -> DataFrame:
    """Policies in force per month of the last ``months`` months: the month x policy
    interval join, evaluated as interval events (no pairing of rows with months)."""
    from tontine.functions.dates import month_shift
    from tontine.operators.joins import index_to_month, interval_counts, month_index
    lo = month_index(F.lit(month_shift(calc_month, -months)))
    hi = month_index(F.lit(month_shift(calc_month, -1)))
    b = fixtures.policy_benefit(spark, sf_dir).withColumn("_g", F.lit(0))
    start = month_index(F.col("buy_datetime")) + 1
    stop = F.coalesce(month_index(F.col("elapse_date")), hi)
    t = interval_counts(b, ["_g"], lo, hi, {"n_inforce": (start, stop)})
    return t.select(index_to_month(F.col("month_idx")).alias("month"), F.col("n_inforce").cast("long"))


def join_range_expand(spark, sf_dir, calc_month: str) -> DataFrame:
    """Policy-years held: each policy x years 1..policy_year at the report month.

    Pre-aggregated: policies are counted per policy year first (bounded number
    of groups), and only the counts are expanded over the year series.
    """
    from tontine.functions.dates import policy_year_sql
    b = fixtures.policy_benefit(spark, sf_dir, **fixtures.month_bounds(last_month=calc_month)).where(
        F.substring("buy_datetime", 1, 7) <= calc_month)
    py = b.selectExpr(f"cast({policy_year_sql(calc_month)} as int) as py").groupBy("py").agg(
        F.count(F.lit(1)).alias("n"))
    e = expand_range(py.where("py >= 1"), F.lit(1), F.col("py"), "year")
    return e.groupBy("year").agg(F.sum("n").alias("n_policies"))


def join_status_flag(spark, sf_dir) -> DataFrame:
    from tontine.plans.prepare import policy_status
    return policy_status(spark, sf_dir)


# ---------------------------------------------------------------- aggregates
def agg_conditional_sum(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "lineitem")
    return d.groupBy("l_returnflag").agg(
        F.expr(f"cast(sum(if(l_linestatus = 'O', cast(l_quantity as {QTY_T}), 0)) as decimal(28,2)) as open_qty"),
        F.expr(f"cast(sum(if(l_linestatus = 'F', cast(l_quantity as {QTY_T}), 0)) as decimal(28,2)) as filled_qty"))


def agg_sumproduct(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "lineitem")
    return d.groupBy("l_orderkey").agg(
        F.expr(f"cast(sum(cast(l_quantity as {QTY_T}) * {_price_dec()}) as decimal(38,4)) as qty_x_price"),
        F.expr(f"cast(sum({_price_dec()} * (1 - cast(l_discount as {RATE_T}))) as decimal(38,4)) as net_revenue"))


def agg_ratio(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "lineitem")
    g = d.groupBy("l_returnflag").agg(
        F.expr(f"sum({_price_dec()} * (1 - cast(l_discount as {RATE_T}))) as net"),
        F.expr(f"sum({_price_dec()}) as gross"))
    return g.selectExpr("l_returnflag",
                        "cast(try_divide(cast(net as double), cast(gross as double)) as decimal(12,10)) as net_ratio")


def agg_global(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "lineitem")
    return d.agg(F.expr("count(1) as n_lines"),
                 F.expr(f"cast(sum(cast(l_quantity as {QTY_T})) as decimal(28,2)) as qty"),
                 F.expr(f"cast(sum({_price_dec()}) as decimal(28,2)) as revenue"),
                 F.expr("count(distinct l_orderkey) as n_orders"))


def agg_count_variants(spark, sf_dir) -> DataFrame:
    """count(1) vs count(col) after a left join (unmatched customers count once, add no orders).

    Orders are counted per customer before the join (map-side), so a customer who owns a third
    of them is one row when it meets the customers."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.expr("count(1) as _rows"), F.expr("count(o_orderkey) as _orders"))
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    return j.groupBy("c_nationkey").agg(F.expr("sum(coalesce(_rows, 1)) as n_rows"),
                                        F.expr("sum(coalesce(_orders, 0)) as n_orders"))


def agg_distinct_rows(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.selectExpr("o_orderstatus", "o_orderpriority", "year(o_orderdate) as o_year").distinct()


def agg_group_by_alias_expr(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "lineitem")
    return d.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("ship_month")).agg(
        F.expr("count(1) as n_lines"))


def agg_of_agg_window(spark, sf_dir) -> DataFrame:
    """Group counts with the grand total beside them (window over the aggregated groups)."""
    o = table(spark, sf_dir, "orders")
    g = o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return g.selectExpr("*", "sum(n) over () as all_n").selectExpr(
        "o_orderpriority", "n", "all_n", "cast(n / all_n as decimal(10,8)) as share")


def agg_max(spark, sf_dir, grid: DataFrame) -> DataFrame:
    """Longest projection per payment term of the product."""
    return grid.groupBy("ppp").agg(F.max("policy_year").alias("max_policy_year"))


# ---------------------------------------------------------------- generators / literals
def dim_stack(spark, sf_dir, params=DEFAULT) -> DataFrame:
    """Literal sex x payment-term grid with the policy count per cell (zero-filled)."""
    terms = broadcast_bounded(literal_dim(spark, params.payment_terms, "ppp", "int"), len(params.payment_terms))
    cells = terms.withColumn("sex", F.explode(F.array(*[F.lit(s) for s in params.sexes])))
    from tontine.plans.kpi import _benefit_client
    cnt = _benefit_client(spark, sf_dir).groupBy("sex", F.col("ppp").cast("int").alias("ppp")).agg(
        F.count(F.lit(1)).alias("n"))
    return cells.join(cnt, ["sex", "ppp"], "left").selectExpr("sex", "ppp", "coalesce(n, 0) as n_policies")


def union_literals(spark, sf_dir) -> DataFrame:
    """A table written as a union of literal rows (order priority, level), beside the orders of each."""
    rows = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]
    one = [spark.range(1).select(F.lit(p).alias("o_orderpriority"), F.lit(n).alias("level")) for p, n in rows]
    levels = one[0]
    for r in one[1:]:
        levels = levels.unionByName(r)
    n = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return broadcast_bounded(levels, len(rows)).join(n, "o_orderpriority", "right").select("o_orderpriority", "level", "n")


def int_sequence(spark, sf_dir, params=DEFAULT) -> DataFrame:
    """Premium schedule: policies paying in each payment year 1..max term.

    Policies are counted per term first; only those few counts are expanded
    over the years of their term (a generator on the aggregated rows).
    """
    by_term = fixtures.policy_benefit(spark, sf_dir).groupBy(F.col("ppp").cast("int").alias("ppp")).agg(
        F.count(F.lit(1)).alias("n"))
    years = expand_range(by_term, F.lit(1), F.col("ppp"), "pay_year")
    return years.groupBy("pay_year").agg(F.sum("n").alias("n_policies"))


def int_sequence_rownum(spark, sf_dir, params=DEFAULT) -> DataFrame:
    """The numbers 1..terminal age (a range scan in place of numbering a table's rows), with the
    policies bought at each age (0 if none)."""
    ages = broadcast_bounded(int_series(spark, params.terminal_age - 1, "age"), params.terminal_age)
    n = fixtures.policy_benefit(spark, sf_dir).groupBy(F.col("age_buy").cast("int").alias("age")).agg(F.count(F.lit(1)).alias("n"))
    return ages.join(n, "age", "left").selectExpr("age", "coalesce(n, 0) as n_policies")


def param_table(spark, sf_dir, params=DEFAULT) -> DataFrame:
    """The parameter row beside the policy count and sum-assured exposure (parameters
    as literal columns, folded by Catalyst)."""
    n = fixtures.policy_benefit(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_policies"))
    return n.selectExpr(
        "n_policies", f"{params.interest_rate}D as interest_rate", f"{params.interest_rate_cv}D as interest_rate_cv",
        f"{params.sa}D as sa", f"{params.disability_ratio}D as disability_ratio",
        f"{params.nursing_ratio}D as nursing_ratio", f"{params.nursing_age} as nursing_age",
        f"cast(n_policies * {params.sa}D as decimal(24,2)) as exposure")


def month_param(spark, sf_dir) -> DataFrame:
    """Report-month arithmetic per purchase month: previous, 13 and 14 back, 13 ahead."""
    from tontine.functions.dates import month_shift_col
    m = fixtures.policy_benefit(spark, sf_dir).select(F.substring("buy_datetime", 1, 7).alias("month")).distinct()
    return m.select("month", month_shift_col(F.col("month"), -1).alias("prev_month"),
                    month_shift_col(F.col("month"), -13).alias("back13"),
                    month_shift_col(F.col("month"), -14).alias("back14"),
                    month_shift_col(F.col("month"), 13).alias("ahead13"))


def age_band_rate_pick(spark, sf_dir, calc_month: str, params=DEFAULT) -> DataFrame:
    """Expense loading of each policy at its policy year: r1..r5, r6 from year 6 on."""
    from tontine.functions.dates import policy_year_sql
    b = fixtures.policy_benefit(spark, sf_dir, **fixtures.month_bounds(last_month=calc_month)).where(
        F.substring("buy_datetime", 1, 7) <= calc_month)
    band = b.selectExpr("cast(ppp as smallint) as ppp",
                        f"cast(least(greatest({policy_year_sql(calc_month)}, 1), 6) as int) as band").groupBy(
        "ppp", "band").agg(F.count(F.lit(1)).alias("n"))
    e = F.broadcast(fixtures.expense_table(spark, params.payment_terms))
    return band.join(e, "ppp").selectExpr(
        "ppp", "band", "n", "element_at(array(r1, r2, r3, r4, r5, r6_), band) as expense_rate")


# ---------------------------------------------------------------- sort / limit / union
def sort_multi(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return o.orderBy(F.col("o_orderpriority").asc(), F.col("o_totalprice").desc(), F.col("o_orderkey").asc())


def topk_count(spark, sf_dir, k: int = 20) -> DataFrame:
    """Top-k provinces by client count (tie-break by name): the limit is the feature."""
    c = fixtures.policy_client(spark, sf_dir)
    g = c.groupBy("province").agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.col("n").desc(), F.col("province").asc()).limit(k)


def limit_n(spark, sf_dir, n: int = 10) -> DataFrame:
    """The n most valuable orders (ordered limit with a unique tie-break)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc()).limit(n)


# ---------------------------------------------------------------- scalar functions
def scalar_functions(spark, sf_dir, calc_month: str) -> DataFrame:
    """The scalar functions of the model on every policy: date arithmetic on ISO
    text, text functions, array pick, null-skipping least/greatest, numeric rounding."""
    from tontine.functions.dates import month_start
    day = month_start(calc_month).isoformat()
    b = fixtures.policy_benefit(spark, sf_dir)
    return b.selectExpr(
        "pol_no",
        f"cast(months_between(date'{day}', to_date(buy_datetime)) as decimal(20,8)) as months_held",
        "date_format(add_months(to_date(buy_datetime), 13), 'yyyy-MM-dd') as plus13m",
        "month(to_date(buy_datetime)) as buy_month",
        "datediff(to_date(coalesce(elapse_date, buy_datetime)), to_date(buy_datetime)) as days_held",
        "date_format(date_sub(date_add(to_date(buy_datetime), 30), 7), 'yyyy-MM-dd') as plus23d",
        "substr(buy_datetime, 1, 7) as buy_ym",
        "concat(insur_code, '-', repeat('x', cast(ppp as int) div 10)) as code_tag",
        "length(replace(insur_name, '-', '')) as name_len",
        "insur_name like '%URGENT%' as is_urgent",
        "cast(ppp as int) in (10, 20) as even_term",
        "element_at(array('a', 'b', 'c', 'd'), cast(cast(ppp as int) / 10 as int)) as term_band",
        "greatest(cast(null as int), cast(ppp as int), 12) as term_floor12",
        "least(cast(null as int), cast(ppp as int), 12) as term_cap12",
        "cast(pow(1.035D, -cast(ppp as int)) as decimal(20,12)) as v_ppp",
        "cast(ceil(age_buy / 7) as int) as age_band_ceil",
        "cast(floor(age_buy / 7) as int) as age_band_floor",
        "abs(cast(ppp as int) - age_buy) as gap",
        "cast(age_buy % 7 as int) as age_mod7",
        "cast(round(cast(age_buy as decimal(10,3)) / 7, 2) as decimal(10,2)) as age_round")
