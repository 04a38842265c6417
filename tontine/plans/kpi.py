"""Monthly indicators (marts) over policies, clients, surrenders and claims.

Every indicator is a grouped aggregate over policy-scale data with a handful
of groups (products, months, regions); Spark pre-aggregates map-side, so a hot
product or month never lands whole in one task.  Lookup tables (prices) are
bounded by the product grid and broadcast.  Ratios use ``try_divide``
(null instead of an ANSI error on an empty denominator) and are computed in
double, then cast to the declared decimal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.functions.dates import month_shift, policy_year_sql
from tontine.operators.joins import broadcast_bounded, index_to_month, month_index
from tontine.params import DEFAULT, Params
from tontine.sources import fixtures


def _price(price: DataFrame, params: Params = DEFAULT, cols=("prem",)) -> DataFrame:
    return broadcast_bounded(
        price.select(F.col("age_buy").alias("_r_ab"), F.col("sex").alias("_r_sex"),
                     F.col("ppp").alias("_r_pp"), *cols), params.group_bound())


def _priced(pol: DataFrame, price: DataFrame, how: str = "inner", cols=("prem",)) -> DataFrame:
    """Attach the cell price to policies that already carry ``sex`` (broadcast join)."""
    r = _price(price, cols=cols)
    cond = ((F.col("age_buy").cast("smallint") == r._r_ab) & (pol.sex == r._r_sex)
            & (F.col("ppp").cast("smallint") == r._r_pp))
    return pol.join(r, cond, how)


def _benefit_client(spark, sf_dir, client_cols=("sex",), first_month=None, last_month=None) -> DataFrame:
    bounds = fixtures.month_bounds(first_month, last_month)
    both = fixtures.policy_with_client(spark, sf_dir)
    if both is not None:                   # the run has joined them already
        if "buy_from" in bounds:
            both = both.where(F.col("buy_datetime") >= bounds["buy_from"])
        if "buy_before" in bounds:
            both = both.where(F.col("buy_datetime") < bounds["buy_before"])
        return both.select("pol_no", "user_id", "ppp", "age_buy", "buy_datetime", "insur_name", "insur_code", "pol_flag",
                           "elapse_date", *client_cols)
    b = fixtures.policy_benefit(spark, sf_dir, **bounds)
    if not client_cols:                    # only that there is a client
        return b.join(fixtures.policy_client(spark, sf_dir).select("user_id"), "user_id", "left_semi")
    c = fixtures.policy_client(spark, sf_dir).select("user_id", *client_cols)
    return b.join(c, "user_id")


def _ratio(num: str, den: str, dec: str) -> str:
    return f"cast(try_divide(cast({num} as double), cast({den} as double)) as {dec})"


# ------------------------------------------------------------------ premium due
def premium_due(spark: SparkSession, sf_dir: str, first_month: str | None, last_month: str,
                price: DataFrame, rule: str = "ceil") -> DataFrame:
    """Premium falling due per report month in [first_month, last_month] (no first month: since purchase).

    A premium is due in month m when m is a policy anniversary month (same
    month of year as the purchase) and the policy year at m is within the
    payment term.  Instead of pairing every policy with every month, each policy
    generates only its anniversary months inside the window (at most
    ceil(window / 12) rows), which are then aggregated per month map-side.
    """
    hi = month_index(F.lit(last_month))
    pol = _priced(_benefit_client(spark, sf_dir, last_month=last_month), price)
    bidx = month_index(F.col("buy_datetime"))
    k0 = (F.lit(0) if first_month is None
          else F.greatest(F.lit(0), F.ceil((month_index(F.lit(first_month)) - bidx) / 12)).cast("int"))
    first = bidx + 12 * k0
    pol = pol.where(bidx <= hi).withColumn(
        "_m", F.explode(F.sequence(first, F.greatest(first, hi), F.lit(12)))).where(F.col("_m") <= hi)
    pol = pol.withColumn("month", index_to_month(F.col("_m")))
    mb = "months_between(to_date(concat(month, '-01')), to_date(buy_datetime))"
    py = f"ceil({mb} / 12)" if rule == "ceil" else f"floor({mb} / 12) + 1"
    return pol.selectExpr("month", "insur_code", "insur_name",
                          f"if({py} <= cast(ppp as int), prem, 0) as prem_thismonth")


def kpi_premium_growth(spark, sf_dir, calc_month, price) -> DataFrame:
    """Premium income this month vs last month (only positive premiums)."""
    prev = month_shift(calc_month, -1)
    due = premium_due(spark, sf_dir, prev, calc_month, price).where("prem_thismonth > 0")
    t = due.groupBy().agg(
        F.expr(f"cast(sum(if(month = '{calc_month}', prem_thismonth, null)) as decimal(24,6)) as prem"),
        F.expr(f"cast(sum(if(month = '{prev}', prem_thismonth, null)) as decimal(24,6)) as last_prem"))
    return t.selectExpr("prem", "last_prem", _ratio("prem - last_prem", "last_prem", "decimal(8,6)")
                        + " as prem_incre_rate")


def kpi_premium_growth_history(spark, sf_dir, calc_month, price) -> DataFrame:
    """Month totals since the first purchase and growth by lag (an ordered window over the
    aggregated months, a few hundred rows)."""
    due = premium_due(spark, sf_dir, None, calc_month, price)
    t = due.groupBy("month").agg(F.expr("cast(sum(prem_thismonth) as decimal(24,6)) as prem"))
    return t.selectExpr("month", "prem", "lag(prem) over (order by month) as last_prem").selectExpr(
        "month", "prem", "last_prem", _ratio("prem - last_prem", "last_prem", "decimal(10,4)")
        + " as prem_incre_rate")


# ------------------------------------------------------------------ first-year ratio
def kpi_first_year_ratio(spark, sf_dir, calc_month, price, month_filter: bool = True,
                         how: str = "inner") -> DataFrame:
    """First-year premium over premium received so far (per policy: price x years paid).

    ``how="left"`` keeps unpriced policies (they add nothing to either sum)."""
    pol = _priced(_benefit_client(spark, sf_dir, last_month=calc_month if month_filter else None), price, how)
    if month_filter:
        pol = pol.where(F.substring("buy_datetime", 1, 7) <= calc_month)
    py = policy_year_sql(calc_month)
    held = "ceil(months_between(to_date(elapse_date), to_date(buy_datetime)) / 12)"
    t = pol.selectExpr("prem as first_prem",
                       f"least({py}, cast(ppp as bigint), {held}) * prem as total_prem")
    return t.groupBy().agg(
        F.expr("cast(sum(first_prem) as decimal(24,6)) as first_prem"),
        F.expr("cast(sum(total_prem) as decimal(24,6)) as total_prem")).selectExpr(
        "first_prem", "total_prem", _ratio("first_prem", "total_prem", "decimal(8,6)") + " as first_of_total_prem")


# ------------------------------------------------------------------ persistency
def kpi_persistency13(spark, sf_dir, calc_month) -> DataFrame:
    """Of policies in force 13 months ago, the share still in force at the report month.

    Month text is compared with ISO day text as strings, as the report defines it.
    """
    m13 = month_shift(calc_month, -13)
    b = fixtures.policy_benefit(spark, sf_dir, buy_before=f"{m13}-01").where(
        f"buy_datetime <= '{m13}' and (elapse_date > '{m13}' or elapse_date is null)")
    t = b.groupBy("insur_code", "insur_name").agg(
        F.expr(f"sum(if(elapse_date > '{calc_month}' or elapse_date is null, 1, 0)) as eff13_num"),
        F.expr("count(pol_no) as total_eff_num"))
    return t.selectExpr("insur_code", "insur_name", "eff13_num", "total_eff_num",
                        _ratio("eff13_num", "total_eff_num", "decimal(8,6)") + " as rate_eff13")


def kpi_persistency13_forward(spark, sf_dir, calc_month) -> DataFrame:
    """Of policies in force at the report month, the share surviving to month + 13."""
    p13 = month_shift(calc_month, 13)
    b = _benefit_client(spark, sf_dir, (), last_month=calc_month).where(
        f"'{calc_month}' >= buy_datetime and ('{calc_month}' < elapse_date or elapse_date is null)")
    t = b.groupBy("insur_code", "insur_name").agg(
        F.expr(f"sum(if(elapse_date is null or substr(elapse_date, 1, 7) >= '{p13}', 1, 0)) as cnt_eff13"),
        F.expr("count(1) as cnt_all"))
    return t.selectExpr("insur_code", "insur_name", "cnt_eff13", "cnt_all",
                        _ratio("cnt_eff13", "cnt_all", "decimal(10,5)") + " as rate_eff13")


def kpi_persistency13_history(spark, sf_dir, calc_month, months: int = 36) -> DataFrame:
    """Forward 13-month persistency for each of the ``months`` months before the report month.

    Month m counts a policy when m >= buy text and m < elapse text (string
    order), i.e. for month indexes buy+1 .. elapse; it counts as persisting when
    the elapse month is at least m + 13.  Both are intervals per policy, counted
    per month with events (:func:`interval_counts`), not by pairing policies
    with months.
    """
    from tontine.operators.joins import interval_counts
    lo = month_index(F.lit(month_shift(calc_month, -months)))
    hi = month_index(F.lit(month_shift(calc_month, -1)))
    b = _benefit_client(spark, sf_dir, (), last_month=calc_month)
    start = month_index(F.col("buy_datetime")) + 1
    el = month_index(F.col("elapse_date"))
    stop = F.coalesce(el, hi)
    stop13 = F.coalesce(F.least(el - 13, stop), stop)
    t = interval_counts(b, ["insur_code", "insur_name"], lo, hi,
                        {"cnt_all": (start, stop), "cnt_eff13": (start, stop13)})
    t = t.where("cnt_all > 0").withColumn("month", index_to_month(F.col("month_idx")))
    return t.selectExpr("insur_code", "insur_name", "month", "cnt_eff13", "cnt_all",
                        _ratio("cnt_eff13", "cnt_all", "decimal(10,5)") + " as rate_eff13")


# ------------------------------------------------------------------ premium per policy
def kpi_premium_per_policy(spark, sf_dir, calc_month, price) -> DataFrame:
    """Average first-year premium of the policies bought in the report month."""
    pol = _benefit_client(spark, sf_dir, first_month=calc_month, last_month=calc_month).where(
        F.substring("buy_datetime", 1, 7) == calc_month)
    t = _priced(pol, price).groupBy("insur_code", "insur_name").agg(
        F.expr("sum(prem) as _s"), F.expr("count(pol_no) as _n"))
    return t.selectExpr("insur_code", "insur_name", _ratio("_s", "_n", "decimal(38,2)") + " as prem_per_pol")


def kpi_premium_per_policy_history(spark, sf_dir, price) -> DataFrame:
    """Average premium per purchase month (left join: unpriced policies count, add nothing)."""
    pol = _priced(_benefit_client(spark, sf_dir), price, "left")
    t = pol.groupBy("insur_code", "insur_name", F.substring("buy_datetime", 1, 7).alias("month")).agg(
        F.expr("sum(prem) as _s"), F.expr("count(1) as _n"))
    return t.selectExpr("insur_code", "insur_name", "month",
                        _ratio("_s", "_n", "decimal(38,2)") + " as prem_per_pol")


# ------------------------------------------------------------------ cool-off / surrender
def kpi_cooloff(spark, sf_dir, calc_month, price) -> DataFrame:
    """Premium of policies bought this month and cancelled within 20 days, over all new premium."""
    pol = _benefit_client(spark, sf_dir, first_month=calc_month, last_month=calc_month).where(
        F.substring("buy_datetime", 1, 7) == calc_month)
    s = fixtures.policy_surrender(spark, sf_dir, **fixtures.month_bounds(calc_month, calc_month)).select(
        F.col("pol_no").alias("_s_pol"), "keep_days")
    j = _priced(pol.join(s, pol.pol_no == s._s_pol, "left"), price)
    t = j.groupBy("insur_code", "insur_name").agg(
        F.expr("cast(sum(if(keep_days <= 20, prem, 0)) as decimal(26,6)) as cooloff"),
        F.expr("cast(sum(prem) as decimal(24,6)) as cnt_all"))
    return t.selectExpr("insur_code", "insur_name", "cooloff", "cnt_all",
                        _ratio("cooloff", "cnt_all", "decimal(8,6)") + " as cooloff_rate")


def kpi_cooloff_history(spark, sf_dir, price) -> DataFrame:
    """Cool-off rate per purchase month (left joins to price and surrender)."""
    pol = _priced(_benefit_client(spark, sf_dir), price, "left")
    s = fixtures.policy_surrender(spark, sf_dir).select(F.col("pol_no").alias("_s_pol"), "keep_days")
    j = pol.join(s, pol.pol_no == s._s_pol, "left")
    t = j.groupBy("insur_code", "insur_name", F.substring("buy_datetime", 1, 7).alias("month")).agg(
        F.expr("cast(sum(if(keep_days <= 20, prem, 0)) as decimal(26,6)) as cooloff"),
        F.expr("cast(sum(prem) as decimal(24,6)) as cnt_all"))
    return t.selectExpr("insur_code", "insur_name", "month", "cooloff", "cnt_all",
                        _ratio("cooloff", "cnt_all", "decimal(10,4)") + " as cooloff_rate")


def kpi_surrender(spark, sf_dir, calc_month) -> DataFrame:
    """Of policies in force 14 months ago, the share surrendered since (month text bounds)."""
    m14 = month_shift(calc_month, -14)
    b = fixtures.policy_benefit(spark, sf_dir, **fixtures.month_bounds(last_month=m14)).where(
        f"'{m14}' >= substr(buy_datetime, 1, 7) and ('{m14}' < elapse_date or elapse_date is null)")
    s = fixtures.policy_surrender(spark, sf_dir, **fixtures.month_bounds(last_month=m14)).select(
        F.col("pol_no").alias("_s_pol"), F.col("elapse_date").alias("_s_elapse"))
    j = b.join(s, b.pol_no == s._s_pol, "left")
    t = j.groupBy("insur_code", "insur_name").agg(
        F.expr(f"sum(if(_s_elapse > '{m14}' and _s_elapse < '{calc_month}', 1, 0)) as cnt_surr"),
        F.expr("count(pol_no) as cnt_all"))
    return t.selectExpr("insur_code", "insur_name", "cnt_surr", "cnt_all",
                        _ratio("cnt_surr", "cnt_all", "decimal(8,6)") + " as surr_rate")


def kpi_surrender_on_predicate(spark, sf_dir, calc_month) -> DataFrame:
    """Variant with the date bounds inside the left-join condition; counts non-null matches."""
    m14 = month_shift(calc_month, -14)
    b = _benefit_client(spark, sf_dir, (), last_month=m14).where(
        f"substr(buy_datetime, 1, 7) <= '{m14}' and (elapse_date > '{m14}' or elapse_date is null)")
    s = fixtures.policy_surrender(spark, sf_dir, **fixtures.month_bounds(last_month=m14)).select(F.col("pol_no").alias("_s_pol"))
    cond = ((b.pol_no == s._s_pol) & (F.substring(b.elapse_date, 1, 7) > m14)
            & (F.substring(b.elapse_date, 1, 7) <= calc_month))
    t = b.join(s, cond, "left").groupBy("insur_code", "insur_name").agg(
        F.expr("count(_s_pol) as cnt_surr"), F.expr("count(pol_no) as cnt_all"))
    return t.selectExpr("insur_code", "insur_name", "cnt_surr", "cnt_all",
                        _ratio("cnt_surr", "cnt_all", "decimal(10,4)") + " as surr_rate")


# ------------------------------------------------------------------ claims
def kpi_mortality_disability(spark, sf_dir, calc_month: str | None = None) -> DataFrame:
    """Deaths and disabilities by product and age at claim, over the grand total count.

    Policies without a claim form the age-null group.  The grand total beside
    every group is a window over the aggregated groups (products x ages, a
    bounded table), never over policy rows.
    With ``calc_month`` the month-bounded variant is used.
    """
    pol = _benefit_client(spark, sf_dir, ("birthday",), last_month=calc_month)
    if calc_month is None:
        pol = pol.where("elapse_date is null")
    else:
        pol = pol.where(f"substr(buy_datetime, 1, 7) <= '{calc_month}' and "
                        f"(elapse_date is null or substr(elapse_date, 1, 7) >= '{calc_month}')")
    cl = fixtures.claim_info(spark, sf_dir).select(F.col("pol_no").alias("_c_pol"), "claim_date", "claim_item")
    cond = pol.pol_no == cl._c_pol
    if calc_month is not None:
        cond = cond & (F.substring(cl.claim_date, 1, 7) <= calc_month)
    j = pol.join(cl, cond, "left").selectExpr(
        "insur_code", "insur_name",
        "cast(ceil(months_between(to_date(claim_date), to_date(birthday)) / 12) as int) as age", "claim_item")
    g = j.groupBy("insur_code", "insur_name", "age").agg(
        F.expr("sum(if(claim_item like '%sgbxj%', 1, 0)) as sg_cnt"),
        F.expr("sum(if(claim_item like '%scbxj%', 1, 0)) as sc_cnt"),
        F.expr("count(1) as _n"))
    # grand total beside every group: a window over the already aggregated groups
    # (products x ages, bounded), as the report defines it
    return g.selectExpr("*", "sum(_n) over () as all_cnt").selectExpr(
        "insur_code", "insur_name", "age", "sg_cnt", "sc_cnt", "all_cnt",
        _ratio("sg_cnt", "all_cnt", "decimal(8,6)") + " as sg_rate",
        _ratio("sc_cnt", "all_cnt", "decimal(8,6)") + " as sc_rate")


# ------------------------------------------------------------------ region, income, value
def kpi_region(policy_result: DataFrame, scale: int | None = None) -> DataFrame:
    """Totals of the month's policy result by region, rounded to ``scale`` decimals if given."""
    money = {"sum_prem": ("prem_thismonth", 24, 6), "sum_cv_1b": ("cv_1b", 27, 7),
             "sum_sur_ben": ("sur_ben", 27, 7), "sum_rsv2_re": ("rsv2_re", 27, 7)}

    def total(column: str, digits: int, places: int) -> str:
        s = f"sum({column})" if scale is None else f"round(sum({column}), {scale})"
        return f"cast({s} as decimal({digits},{places if scale is None else scale}))"
    return policy_result.groupBy("direction").agg(
        F.expr("count(user_id) as sum_users"), *[F.expr(f"{total(*v)} as {k}") for k, v in money.items()])


def kpi_high_net_worth(spark, sf_dir) -> DataFrame:
    """Share of clients with income >= 10,000,000."""
    c = fixtures.policy_client(spark, sf_dir)
    return c.groupBy().agg(F.expr(
        _ratio(f"sum(if(income >= {fixtures.HIGH_INCOME}, 1, 0))", "count(1)", "decimal(8,6)")
        + " as high_net_rate"))


def kpi_nbev(spark, sf_dir, price_real, calc_month: str | None = None) -> DataFrame:
    """Premium-weighted new-business embedded value ratio by product."""
    pol = _benefit_client(spark, sf_dir, last_month=calc_month)
    if calc_month is not None:
        pol = pol.where(F.substring("buy_datetime", 1, 7) <= calc_month)
    t = _priced(pol, price_real, cols=("prem", "nbev")).groupBy("insur_code", "insur_name").agg(
        F.expr("sum(prem * nbev) as _pv"), F.expr("sum(prem) as _p"))
    return t.selectExpr("insur_code", "insur_name", _ratio("_pv", "_p", "decimal(38,11)") + " as nbev")
