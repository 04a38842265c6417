"""Per-policy marts: the product actuarial table and the monthly policy result.

``policy_result`` is the scale operator: every policy (orders-scale) joins its
client (customer-scale, shuffle join on user_id, skew split by AQE) and then
two bounded tables - the actuarial table (<= grid rows + one year-0 row per
cell) and the price table (<= 274 rows) - both broadcast, so the policy side
is shuffled once, for the client join only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.functions.dates import policy_year_sql
from tontine.operators.joins import broadcast_bounded
from tontine.params import DEFAULT, Params
from tontine.schema import conform
from tontine.sources import fixtures


def policy_actuary(cv_src_q: DataFrame, rsv_src_q: DataFrame, how: str = "inner") -> DataFrame:
    """Product actuarial table: cash values beside reserves per cell and year."""
    keys = ["age_buy", "sex", "ppp", "policy_year"]
    cv = cv_src_q.select(*keys, "bpp", "sa", "cv_1a", "cv_1b", "sur_ben", "np")
    rsv = rsv_src_q.select(*keys, "rsv2_re", "rsv1_re", "np_")
    return conform(cv.join(rsv, keys, how), "policy_actuary")


def policies_with_client(spark: SparkSession, sf_dir: str, calc_month: str | None = None,
                         policies: DataFrame | None = None, clients: DataFrame | None = None) -> DataFrame:
    """Policies (bought up to ``calc_month``) joined to their client; the one big shuffle.

    ``policies`` / ``clients`` may be given as warehouse tables bucketed by
    ``user_id`` (``plans.monthly.write_warehouse(buckets=n)``); the join then
    reads matching buckets and shuffles nothing.
    """
    both = fixtures.policy_with_client(spark, sf_dir) if policies is None and clients is None else None
    if both is not None:                   # the run has joined them already
        if calc_month is not None:
            both = both.where(F.substring("buy_datetime", 1, 7) <= calc_month)
        return both
    if policies is None:
        b = fixtures.policy_benefit(spark, sf_dir, **fixtures.month_bounds(last_month=calc_month))
    else:
        b = policies
    if calc_month is not None:
        b = b.where(F.substring("buy_datetime", 1, 7) <= calc_month)
    c = (clients if clients is not None else fixtures.policy_client(spark, sf_dir)).select(
        "user_id", "name", "sex", "birthday", "province", "city", "direction", "income")
    return c.join(b, "user_id")


def policy_result(spark: SparkSession, sf_dir: str, calc_month: str, actuary: DataFrame,
                  price: DataFrame, rule: str = "ceil", params: Params = DEFAULT,
                  policies: DataFrame | None = None, clients: DataFrame | None = None) -> DataFrame:
    """Monthly policy result (25 declared columns + ``month``)."""
    pc = policies_with_client(spark, sf_dir, calc_month, policies, clients)
    py = policy_year_sql(calc_month, "buy_datetime", rule)
    pc = pc.selectExpr("*", f"cast({py} as int) as _py",
                       "cast(age_buy as smallint) as _ab", "cast(ppp as smallint) as _pp")
    act = broadcast_bounded(
        actuary.select(F.col("age_buy").alias("_a_ab"), F.col("sex").alias("_a_sex"),
                       F.col("ppp").alias("_a_pp"), F.col("policy_year").alias("_a_py"),
                       "bpp", "sa", "cv_1a", "cv_1b", "sur_ben", "np", "rsv2_re", "rsv1_re", "np_"),
        params.grid_row_bound() + params.group_bound())
    prc = broadcast_bounded(
        price.select(F.col("age_buy").alias("_p_ab"), F.col("sex").alias("_p_sex"),
                     F.col("ppp").alias("_p_pp"), F.col("prem").alias("prem_std")),
        params.group_bound())
    j = (pc.join(act, (pc._ab == act._a_ab) & (pc.sex == act._a_sex) & (pc._pp == act._a_pp)
                 & (pc._py == act._a_py), "left")
           .join(prc, (pc._ab == prc._p_ab) & (pc.sex == prc._p_sex) & (pc._pp == prc._p_pp), "left"))
    j = j.selectExpr(
        "*", "_py as policy_year",
        f"if(_py <= cast(ppp as int) and substr('{calc_month}', 6, 2) = substr(buy_datetime, 6, 2), "
        f"prem_std, 0) as prem_thismonth")
    return conform(j, "policy_result").withColumn("month", F.lit(calc_month))
