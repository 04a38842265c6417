"""Policy-side and rate tables of the actuarial model, derived from the inputs.

The modelled application reads its policy, client, surrender, claim and rate
tables from a warehouse that is not part of this repository.  The stand-ins
here are deterministic functions of the input parquet tables (customers become
clients, orders become policies) so that every job reads real, scalable input,
and so that an independent SQL engine can rebuild them with the same rules.

Every policy-side table is a narrow projection of ``orders`` or ``customer``
(no join, no shuffle); the only joins are to ``nation``/``region``, which are
small by definition of the schema and broadcast.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.operators.joins import broadcast_bounded
from tontine.sources.tables import table

# Fixed values of the stand-in data rules.
PAYMENT_TERM_BY_KEY_MOD4 = (10, 15, 20, 30)          # o_orderkey % 4 -> ppp
CLAIM_ITEMS = ("sgbxj", "scbxj0", "scbxj1", "scbxj2", "cqhlbxj", "gaylj")
HIGH_INCOME = 10_000_000
BIRTHDAY_ORIGIN = "1950-01-01"
NATION_ROWS_BOUND = 25      # TPC-H nation has exactly 25 rows at every scale
REGION_ROWS_BOUND = 5


# Warehouse tables bound in place of the derived ones, per (application, input folder):
# see ``bound_tables`` (the monthly job reads its own tables through it).
_BOUND: dict = {}


@contextmanager
def bound_tables(spark: SparkSession, sf_dir: str, tables: dict):
    """Within this block ``policy_benefit``, ``policy_client`` and ``policy_with_client`` of ``sf_dir``
    are the given warehouse tables instead of being derived from the raw inputs."""
    key = (spark.sparkContext.applicationId, sf_dir)
    before = _BOUND.get(key, {})
    _BOUND[key] = before | tables
    try:
        yield
    finally:
        _BOUND[key] = before


def policy_with_client(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """Policies with their client's columns, where a run has them as one table."""
    return _bound(spark, sf_dir, "policy_with_client")


def _bound(spark: SparkSession, sf_dir: str, name: str):
    return _BOUND.get((spark.sparkContext.applicationId, sf_dir), {}).get(name)


PPP_SQL = (f"case o_orderkey % 4 when 0 then {PAYMENT_TERM_BY_KEY_MOD4[0]} when 1 then {PAYMENT_TERM_BY_KEY_MOD4[1]} "
           f"when 2 then {PAYMENT_TERM_BY_KEY_MOD4[2]} else {PAYMENT_TERM_BY_KEY_MOD4[3]} end")
KEEP_DAYS_SQL = "if(o_orderkey % 45 = 4, 1 + (o_orderkey * 13) % 25, 1 + (o_orderkey * 13) % 900)"
# padded to nine digits, never cut: longer keys keep all of theirs
POL_NO_SQL = ("concat('P', lpad(cast(o_orderkey as string), "
              "greatest(9, length(cast(o_orderkey as string))), '0'))")
CODE_SQL = "concat('886', substr(o_orderpriority, 1, 1))"


def policy_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One client per customer (user_id, name, sex, birthday, province, city, direction, income)."""
    bound = _bound(spark, sf_dir, "policy_client")
    if bound is not None:
        return bound.select("user_id", "name", "sex", "birthday", "province", "city", "direction", "income")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = broadcast_bounded(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"),
                          NATION_ROWS_BOUND)
    r = broadcast_bounded(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                          REGION_ROWS_BOUND)
    j = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.selectExpr(
        "cast(c_custkey as string) as user_id", "c_name as name",
        "if(c_custkey % 2 = 0, 'M', 'F') as sex",
        f"date_format(date_add(date'{BIRTHDAY_ORIGIN}', cast((c_custkey * 37) % 12000 as int)), 'yyyy-MM-dd') as birthday",
        "n_name as province", "c_mktsegment as city", "r_name as direction",
        f"cast(if(c_acctbal >= 9000, {HIGH_INCOME}, 100000 * (1 + c_custkey % 3)) as int) as income")


def _orders(spark: SparkSession, sf_dir: str, buy_from: str | None = None,
            buy_before: str | None = None) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    # purchase-date bounds on the source column, so the parquet scan skips row groups
    if buy_from or buy_before:
        ts = o.schema["o_orderdate"].dataType.simpleString()
        if buy_from:
            o = o.where(f"o_orderdate >= cast(date'{buy_from}' as {ts})")
        if buy_before:
            o = o.where(f"o_orderdate < cast(date'{buy_before}' as {ts})")
    return o


def month_bounds(first_month: str | None = None, last_month: str | None = None) -> dict:
    """Purchase-date bounds (ISO days) covering purchase months first_month..last_month."""
    from tontine.functions.dates import month_shift
    out = {}
    if first_month:
        out["buy_from"] = f"{first_month[:7]}-01"
    if last_month:
        out["buy_before"] = f"{month_shift(last_month[:7], 1)}-01"
    return out


def policy_benefit(spark: SparkSession, sf_dir: str, buy_from: str | None = None,
                   buy_before: str | None = None) -> DataFrame:
    """One policy per order.  ``ppp`` is text, as in the declared table.

    ``buy_from`` / ``buy_before`` (ISO days) bound the purchase date on the
    source column (pushed into the scan); callers keep their own exact filters.
    Surrender status is a function of the order key, so no join to the
    surrender table is needed here (``plans.prepare.policy_status`` derives the
    same two columns by the left join and is tested to agree).
    """
    bound = _bound(spark, sf_dir, "policy_benefit")
    if bound is not None:                  # ISO text compares like the date it holds
        if buy_from:
            bound = bound.where(F.col("buy_datetime") >= buy_from)
        if buy_before:
            bound = bound.where(F.col("buy_datetime") < buy_before)
        return bound
    o = _orders(spark, sf_dir, buy_from, buy_before)
    return o.selectExpr(
        f"{POL_NO_SQL} as pol_no", "cast(o_custkey as string) as user_id",
        f"cast({PPP_SQL} as string) as ppp",
        f"cast(18 + o_orderkey % (53 - {PPP_SQL}) as bigint) as age_buy",
        "date_format(o_orderdate, 'yyyy-MM-dd') as buy_datetime",
        "o_orderpriority as insur_name", f"{CODE_SQL} as insur_code",
        "cast(if(o_orderkey % 15 = 4, 0, 1) as smallint) as pol_flag",
        f"if(o_orderkey % 15 = 4, date_format(date_add(to_date(o_orderdate), cast({KEEP_DAYS_SQL} as int)), "
        f"'yyyy-MM-dd'), null) as elapse_date")


def policy_surrender(spark: SparkSession, sf_dir: str, buy_from: str | None = None,
                     buy_before: str | None = None) -> DataFrame:
    """Surrender records: one per surrendered policy (purchase-date bounds as in ``policy_benefit``)."""
    o = _orders(spark, sf_dir, buy_from, buy_before).where("o_orderkey % 15 = 4")
    return o.selectExpr(
        f"{POL_NO_SQL} as pol_no", "cast(o_custkey as string) as user_id",
        "date_format(o_orderdate, 'yyyy-MM-dd') as buy_datetime",
        f"cast({KEEP_DAYS_SQL} as smallint) as keep_days",
        f"date_format(date_add(to_date(o_orderdate), cast({KEEP_DAYS_SQL} as int)), 'yyyy-MM-dd') as elapse_date")


def claim_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims without amounts (pol_no, user_id, buy_datetime, insur_code, claim_date, claim_item)
    plus the internal columns ``_ppp``/``_age_buy``/``_days`` used to price them."""
    o = _orders(spark, sf_dir).where("o_orderkey % 30 = 7")
    items = ", ".join(f"'{x}'" for x in CLAIM_ITEMS)
    days = "30 + (o_orderkey * 17) % 1000"
    return o.selectExpr(
        f"{POL_NO_SQL} as pol_no", "cast(o_custkey as string) as user_id",
        "date_format(o_orderdate, 'yyyy-MM-dd') as buy_datetime", f"{CODE_SQL} as insur_code",
        f"date_format(date_add(to_date(o_orderdate), cast({days} as int)), 'yyyy-MM-dd') as claim_date",
        f"element_at(array({items}), cast((o_orderkey - 7) % 180 div 30 as int) + 1) as claim_item",
        f"cast({PPP_SQL} as int) as _ppp",
        f"cast(18 + o_orderkey % (53 - {PPP_SQL}) as bigint) as _age_buy",
        f"cast({days} as int) as _days")


def claim_info(spark: SparkSession, sf_dir: str, price: DataFrame | None = None) -> DataFrame:
    """Claims table; with ``price`` (prem_std_real) the amount column is added (operator P6)."""
    ev = claim_events(spark, sf_dir)
    base = ["pol_no", "user_id", "buy_datetime", "insur_code", "claim_date", "claim_item"]
    if price is None:
        return ev.select(*base)
    from tontine.plans.prepare import claim_amount
    return claim_amount(ev, policy_client(spark, sf_dir), price).select(*base, "claim_mnt")


def area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area dimension: one row per nation."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = broadcast_bounded(table(spark, sf_dir, "region").select("r_regionkey", "r_name"), REGION_ROWS_BOUND)
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "cast(n_nationkey as smallint) as id", "n_name as province", "n_name as city", "r_name as direction")


# ---------------------------------------------------------------- rate tables
# The product's own rate files are not available; these stand-ins are exact
# decimals given by closed formulas of age (ages 1..105), so that every engine
# builds identical tables.  They are dimension tables of 105 rows.

RATE_MIN_AGE, RATE_MAX_AGE = 1, 105


def _dec8(unscaled: Column) -> Column:
    return (unscaled / F.lit(100000000.0)).cast("decimal(10,8)")


def mortality_table(spark: SparkSession) -> DataFrame:
    """mort_10_13: age, cl1..cl6 (cl1 male, cl2 female)."""
    age = F.col("id")
    a3 = age * age * age
    cl1 = F.when(age == 105, F.lit(1).cast("decimal(10,8)")).otherwise(_dec8(30000 + 20 * a3))
    cl2 = F.when(age == 105, F.lit(1).cast("decimal(10,8)")).otherwise(_dec8(20000 + 14 * a3))
    return (spark.range(RATE_MIN_AGE, RATE_MAX_AGE + 1)
            .select(age.cast("short").alias("age"), cl1.alias("cl1"), cl2.alias("cl2"),
                    cl1.alias("cl3"), cl2.alias("cl4"), cl1.alias("cl5"), cl2.alias("cl6")))


def disease_table(spark: SparkSession) -> DataFrame:
    """dd_table: age, male, female (critical illness), k_male, k_female (share of deaths)."""
    age = F.col("id")
    a2 = age * age
    return (spark.range(RATE_MIN_AGE, RATE_MAX_AGE + 1)
            .select(age.cast("short").alias("age"),
                    _dec8(5000 + 60 * a2).alias("male"),
                    _dec8(4000 + 50 * a2).alias("female"),
                    _dec8(50000000 - 200000 * age).alias("k_male"),
                    _dec8(48000000 - 190000 * age).alias("k_female")))


# Expense loading by policy year 1..5 and 6+, average and maximum.
EXPENSE_RATES = (0.55, 0.35, 0.25, 0.15, 0.10, 0.10)
EXPENSE_AVG, EXPENSE_MAX = 0.20, 0.60


def expense_table(spark: SparkSession, payment_terms=PAYMENT_TERM_BY_KEY_MOD4) -> DataFrame:
    """pre_add_exp_ratio: ppp, r1..r5, r6_, r_avg, r_max."""
    from tontine.operators.grid import literal_rows
    names = ["ppp", "r1", "r2", "r3", "r4", "r5", "r6_", "r_avg", "r_max"]
    rows = [(p, *EXPENSE_RATES, EXPENSE_AVG, EXPENSE_MAX) for p in payment_terms]
    return literal_rows(spark, rows, names, ["smallint"] + ["decimal(10,8)"] * 8)
