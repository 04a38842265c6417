"""Policy-data preparation: numbering, status, splits, claim amounts, area enrichment.

The modelled application made its policy data with a random simulator; the
relational steps of it are rebuilt here as deterministic Spark jobs over the
input tables.  Global and per-group numbering use the skew-safe ordered scan
(range partitioning + per-partition offsets), never a single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.functions.dates import month_start
from tontine.operators.joins import broadcast_bounded
from tontine.operators.scan import ordered_scan
from tontine.params import DEFAULT
from tontine.sources import fixtures


def policy_number_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'P' + number of at least 9 digits in purchase order (date, then order key as tie-break)."""
    o = (fixtures.policy_benefit(spark, sf_dir).select("pol_no", "buy_datetime")
         .withColumn("_all", F.lit(0)))
    s = ordered_scan(o, ["_all"], ["buy_datetime", "pol_no"])
    return s.select("pol_no", "buy_datetime",
                    F.expr("concat('P', lpad(cast(_pos as string), greatest(9, length(cast(_pos as string))), '0'))")
                    .alias("new_pol_no"))


def client_id_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client id = area id + '-' + running number of the client within the area."""
    c = fixtures.policy_client(spark, sf_dir).select("user_id", "province")
    a = broadcast_bounded(fixtures.area(spark, sf_dir).select(F.col("id").alias("area_id"), "province"),
                          fixtures.NATION_ROWS_BOUND)
    j = c.join(a, "province").withColumn("_ck", F.col("user_id").cast("long"))
    s = ordered_scan(j, ["area_id"], ["_ck"])
    return s.select("user_id", "area_id",
                    F.concat(F.col("area_id").cast("string"), F.lit("-"), F.col("_pos").cast("string")).alias("client_id"))


def surrender_extract(spark: SparkSession, sf_dir: str, calc_month: str) -> DataFrame:
    """Surrenders of the rule-selected policies still within their payment term at the report date."""
    b = fixtures.policy_benefit(spark, sf_dir)
    s = fixtures.policy_surrender(spark, sf_dir).select("pol_no", "keep_days", "elapse_date")
    day = month_start(calc_month).isoformat()
    j = b.select("pol_no", "user_id", "buy_datetime", "ppp").join(s, "pol_no")
    return j.where(F.expr(f"date_add(to_date(buy_datetime), cast(ppp as int) * 365) > date'{day}'")).select(
        "pol_no", "user_id", "buy_datetime", "keep_days", "elapse_date")


def policy_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pol_flag (1 in force, 0 surrendered) and elapse date by left join to surrenders."""
    o = fixtures.policy_benefit(spark, sf_dir).select("pol_no")
    s = fixtures.policy_surrender(spark, sf_dir).select(F.col("pol_no").alias("_s"), "elapse_date")
    return o.join(s, o.pol_no == s._s, "left").select(
        "pol_no", F.when(F.col("_s").isNull(), 1).otherwise(0).cast("short").alias("pol_flag"), "elapse_date")


def split_client_policy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One wide client-policy table -> (client table, policy table), two projections."""
    from tontine.plans.marts import policies_with_client
    wide = policies_with_client(spark, sf_dir)
    clients = wide.select("user_id", "name", "sex", "birthday", "province", "city", "direction",
                          "income").distinct()
    policies = wide.select("pol_no", "user_id", "ppp", "age_buy", "buy_datetime", "insur_name",
                           "insur_code", "pol_flag", "elapse_date")
    return clients, policies


# Claim items paid as a multiple of the annual premium, and the fixed sums.
PREMIUM_MULTIPLE_ITEMS = ("sgbxj", "scbxj0")
FIXED_10000_ITEMS = ("scbxj1", "scbxj2")


def claim_amount(ev: DataFrame, clients: DataFrame, price: DataFrame) -> DataFrame:
    """Claim amount by item: premium x min(term, years since purchase), 10000, or 1000."""
    c = clients.select(F.col("user_id").alias("_u"), F.col("sex").alias("_sex"))
    p = broadcast_bounded(price.select(F.col("age_buy").alias("_p_ab"), F.col("sex").alias("_p_sex"),
                                       F.col("ppp").alias("_p_pp"), "prem"), DEFAULT.group_bound())
    j = ev.join(c, ev.user_id == c._u).join(
        p, (F.col("_age_buy").cast("smallint") == p._p_ab) & (F.col("_sex") == p._p_sex)
        & (F.col("_ppp").cast("smallint") == p._p_pp), "left")
    multiple = ", ".join(f"'{x}'" for x in PREMIUM_MULTIPLE_ITEMS)
    fixed = ", ".join(f"'{x}'" for x in FIXED_10000_ITEMS)
    return j.withColumn("claim_mnt", F.expr(
        f"cast(case when claim_item in ({multiple}) then prem * least(_ppp, ceil(_days / 365)) "
        f"when claim_item in ({fixed}) then 10000 else 1000 end as decimal(35,6))"))


def area_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients with their area id and region, and an income tier."""
    c = fixtures.policy_client(spark, sf_dir).select("user_id", "province", "income")
    a = broadcast_bounded(fixtures.area(spark, sf_dir), fixtures.NATION_ROWS_BOUND)
    return c.join(a, "province").select(
        "user_id", F.col("id").alias("area_id"), "province", "direction",
        F.when(F.col("income") >= fixtures.HIGH_INCOME, "high").otherwise("standard").alias("income_tier"))


def area_topk(spark: SparkSession, sf_dir: str, k: int = 20) -> DataFrame:
    """Top-k areas by number of policies (tie-break by area id)."""
    from tontine.plans.marts import policies_with_client
    a = broadcast_bounded(fixtures.area(spark, sf_dir).select(F.col("id").alias("area_id"), "province"),
                          fixtures.NATION_ROWS_BOUND)
    g = policies_with_client(spark, sf_dir).select("province").join(a, "province").groupBy("area_id").agg(
        F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.col("n").desc(), F.col("area_id").asc()).limit(k)
