"""Registry of runnable queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the input tables of ``sf_dir`` (or stage tables Spark
derives from them) and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tontine.params import DEFAULT
from tontine.schema import report

CALC_MONTH = "2000-04"          # report month of the registered queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _act(spark, sf_dir):
    from tontine.plans import actuarial
    return actuarial.run(spark, sf_dir, DEFAULT)


# ---------------------------------------------------------------- actuarial chain
@register("policy_grid")
def q_policy_grid(spark, sf_dir):
    from tontine.operators.grid import policy_grid
    return policy_grid(_act(spark, sf_dir).products, DEFAULT).select(
        "sex", "ppp", "age_buy", "t_age", "bpp", "policy_year", "age", "n_policies")


@register("prem_src")
def q_prem_src(spark, sf_dir):
    return report(_act(spark, sf_dir).prem_src, "prem_src")


@register("prem_std")
def q_prem_std(spark, sf_dir):
    return _act(spark, sf_dir).prem_std


@register("prem_cv")
def q_prem_cv(spark, sf_dir):
    return _act(spark, sf_dir).prem_cv


@register("cv_src")
def q_cv_src(spark, sf_dir):
    return report(_act(spark, sf_dir).cv_src, "cv_src")


@register("rsv_src")
def q_rsv_src(spark, sf_dir):
    return report(_act(spark, sf_dir).rsv_src, "rsv_src")


@register("policy_actuary")
def q_policy_actuary(spark, sf_dir):
    return report(_act(spark, sf_dir).policy_actuary, "policy_actuary")


@register("policy_result")
def q_policy_result(spark, sf_dir):
    from tontine.plans.marts import policy_result
    a = _act(spark, sf_dir)
    return report(policy_result(spark, sf_dir, CALC_MONTH, a.policy_actuary, a.prem_std_real), "policy_result")


@register("policy_result_floor1")
def q_policy_result_floor1(spark, sf_dir):
    """Variant: policy year floor(months / 12) + 1, priced with the computed premium table."""
    from tontine.plans.marts import policy_result
    a = _act(spark, sf_dir)
    return report(policy_result(spark, sf_dir, CALC_MONTH, a.policy_actuary, a.prem_std, rule="floor1"),
                  "policy_result")


# ---------------------------------------------------------------- KPIs
@register("kpi_premium_growth")
def q_kpi_premium_growth(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_premium_growth(spark, sf_dir, CALC_MONTH, _act(spark, sf_dir).prem_std_real)


@register("kpi_premium_growth_history")
def q_kpi_premium_growth_history(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_premium_growth_history(spark, sf_dir, CALC_MONTH, _act(spark, sf_dir).prem_std)


@register("kpi_first_year_ratio")
def q_kpi_first_year_ratio(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_first_year_ratio(spark, sf_dir, CALC_MONTH, _act(spark, sf_dir).prem_std_real)


@register("kpi_first_year_ratio_left")
def q_kpi_first_year_ratio_left(spark, sf_dir):
    """Variant: left join to the computed premium table."""
    from tontine.plans import kpi
    return kpi.kpi_first_year_ratio(spark, sf_dir, CALC_MONTH, _act(spark, sf_dir).prem_std, how="left")


@register("kpi_nbev_month")
def q_kpi_nbev_month(spark, sf_dir):
    """Variant: policies bought up to the report month."""
    from tontine.plans import kpi
    return kpi.kpi_nbev(spark, sf_dir, _act(spark, sf_dir).prem_std_real, CALC_MONTH)


@register("kpi_persistency13")
def q_kpi_persistency13(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_persistency13(spark, sf_dir, CALC_MONTH)


@register("kpi_persistency13_forward")
def q_kpi_persistency13_forward(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_persistency13_forward(spark, sf_dir, CALC_MONTH)


@register("kpi_persistency13_history")
def q_kpi_persistency13_history(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_persistency13_history(spark, sf_dir, CALC_MONTH)


@register("kpi_premium_per_policy")
def q_kpi_premium_per_policy(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_premium_per_policy(spark, sf_dir, CALC_MONTH, _act(spark, sf_dir).prem_std_real)


@register("kpi_premium_per_policy_history")
def q_kpi_premium_per_policy_history(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_premium_per_policy_history(spark, sf_dir, _act(spark, sf_dir).prem_std)


@register("kpi_cooloff")
def q_kpi_cooloff(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_cooloff(spark, sf_dir, CALC_MONTH, _act(spark, sf_dir).prem_std_real)


@register("kpi_cooloff_history")
def q_kpi_cooloff_history(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_cooloff_history(spark, sf_dir, _act(spark, sf_dir).prem_std)


@register("kpi_surrender")
def q_kpi_surrender(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_surrender(spark, sf_dir, CALC_MONTH)


@register("kpi_surrender_on_predicate")
def q_kpi_surrender_on_predicate(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_surrender_on_predicate(spark, sf_dir, CALC_MONTH)


@register("kpi_mortality_disability")
def q_kpi_mortality_disability(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_mortality_disability(spark, sf_dir)


@register("kpi_mortality_disability_month")
def q_kpi_mortality_disability_month(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_mortality_disability(spark, sf_dir, CALC_MONTH)


@register("kpi_region")
def q_kpi_region(spark, sf_dir):
    from tontine.plans import kpi
    from tontine.plans.marts import policy_result
    a = _act(spark, sf_dir)
    return kpi.kpi_region(policy_result(spark, sf_dir, CALC_MONTH, a.policy_actuary, a.prem_std_real))


@register("kpi_region_rounded")
def q_kpi_region_rounded(spark, sf_dir):
    """Variant: totals rounded to two decimals, as the monthly mart stores them."""
    from tontine.plans import kpi
    from tontine.plans.marts import policy_result
    a = _act(spark, sf_dir)
    return kpi.kpi_region(policy_result(spark, sf_dir, CALC_MONTH, a.policy_actuary, a.prem_std_real), scale=2)


@register("policy_actuary_left")
def q_policy_actuary_left(spark, sf_dir):
    """Variant: cash values kept without a reserve (the year-0 rows)."""
    from tontine.plans.marts import policy_actuary
    a = _act(spark, sf_dir)
    return report(policy_actuary(a.cv_src, a.rsv_src, how="left"), "policy_actuary")


@register("kpi_high_net_worth")
def q_kpi_high_net_worth(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_high_net_worth(spark, sf_dir)


@register("kpi_nbev")
def q_kpi_nbev(spark, sf_dir):
    from tontine.plans import kpi
    return kpi.kpi_nbev(spark, sf_dir, _act(spark, sf_dir).prem_std_real)


@register("kpi_premium_growth_incremental")
def q_kpi_premium_growth_incremental(spark, sf_dir):
    """The report month's total against what the previous month's run has left in the table."""
    from tontine.plans import storage
    return storage.premium_growth_incremental(spark, sf_dir, CALC_MONTH, _act(spark, sf_dir).prem_std_real)


# ---------------------------------------------------------------- single-operator queries
def _rel(fn_name, *args):
    def q(spark, sf_dir):
        from tontine.plans import relational
        return getattr(relational, fn_name)(spark, sf_dir, *args)
    return q


for _k in ("win_tail_sum", "win_tail_sum_exclusive", "win_group_total", "win_lead", "win_lag",
           "win_row_number", "recur_survival", "recur_multi_decrement", "recur_affine", "ordered_fold", "ordered_fold_states",
           "fold_capped_balance", "fold_best_run", "fold_payouts", "agg_user_defined",
           "join_interval_rows", "compare_two_sided",
           "win_lag_over_months", "join_detail_to_aggregate", "join_cross", "join_scalar_pair",
           "join_left_lookup", "join_status_flag", "agg_conditional_sum", "agg_sumproduct", "agg_ratio",
           "agg_global", "agg_count_variants", "agg_distinct_rows", "agg_group_by_alias_expr",
           "agg_of_agg_window", "dim_stack", "int_sequence", "int_sequence_rownum", "param_table", "month_param", "sort_multi",
           "topk_count", "limit_n", "union_literals"):
    register(_k)(_rel(_k))
for _k in ("join_left_on_predicate", "join_month_inforce", "join_range_expand", "age_band_rate_pick"):
    register(_k)(_rel(_k, CALC_MONTH))


@register("join_composite_equi")
def q_join_composite_equi(spark, sf_dir):
    from tontine.plans import relational
    return relational.join_composite_equi(spark, sf_dir, _act(spark, sf_dir).prem_std_real)


@register("join_left_computed_key")
def q_join_left_computed_key(spark, sf_dir):
    from tontine.plans import relational
    return relational.join_left_computed_key(spark, sf_dir, CALC_MONTH, _act(spark, sf_dir).policy_actuary)


@register("join_left_computed_key_floor1")
def q_join_left_computed_key_floor1(spark, sf_dir):
    from tontine.plans import relational
    return relational.join_left_computed_key(spark, sf_dir, CALC_MONTH, _act(spark, sf_dir).policy_actuary,
                                             rule="floor1")


@register("agg_max")
def q_agg_max(spark, sf_dir):
    from tontine.operators.grid import policy_grid
    from tontine.plans import relational
    return relational.agg_max(spark, sf_dir, policy_grid(_act(spark, sf_dir).products, DEFAULT))


@register("product_slice")
def q_product_slice(spark, sf_dir):
    from tontine.operators.quality import slice_product
    return slice_product(report(_act(spark, sf_dir).prem_src, "prem_src"), "M", 10, 18)


@register("union_year0")
def q_union_year0(spark, sf_dir):
    from tontine.plans.cashvalue import with_year0
    from tontine.schema import as_double
    u = with_year0(as_double(_act(spark, sf_dir).prem_src), DEFAULT)
    return u.selectExpr("sex", "ppp", "age_buy", "policy_year", "cast(lx as decimal(17,9)) as lx")


@register("rsv_forms_agree")
def q_rsv_forms_agree(spark, sf_dir):
    """The reserve factors of each cell by grouping, and how far the detail rows' differ from them."""
    from tontine.plans.reserve import compare_forms, reserve_factors_by_group
    a = _act(spark, sf_dir)
    return compare_forms(a.rsv_src, reserve_factors_by_group(a.prem_src, a.prem_std_real))


@register("prem_check")
def q_prem_check(spark, sf_dir):
    from tontine.operators.quality import relative_diff_check
    a = _act(spark, sf_dir)
    return relative_diff_check(a.prem_std, a.prem_std_real, ["age_buy", "sex", "ppp"], "prem")


@register("cv_check")
def q_cv_check(spark, sf_dir):
    from tontine.operators.quality import relative_diff_check
    a = _act(spark, sf_dir)
    return relative_diff_check(a.prem_cv, a.prem_cv_real, ["age_buy", "sex", "ppp"], "prem_cv",
                               two_sided=False)


@register("cv_check_two_sided")
def q_cv_check_two_sided(spark, sf_dir):
    from tontine.operators.quality import relative_diff_check
    a = _act(spark, sf_dir)
    return relative_diff_check(a.prem_cv, a.prem_cv_real, ["age_buy", "sex", "ppp"], "prem_cv")


@register("count_reconcile")
def q_count_reconcile(spark, sf_dir):
    """Orders against the policy table as it is written and read back."""
    from tontine.operators.quality import reconcile_counts
    from tontine.sources import fixtures
    from tontine.sources.sinks import materialize
    from tontine.sources.tables import table
    return reconcile_counts(table(spark, sf_dir, "orders"), materialize(fixtures.policy_benefit(spark, sf_dir), name="policies"))


# ---------------------------------------------------------------- preparation
def _prep(fn_name, *args):
    def q(spark, sf_dir):
        from tontine.plans import prepare
        return getattr(prepare, fn_name)(spark, sf_dir, *args)
    return q


for _k in ("policy_number_assign", "client_id_assign", "policy_status", "area_enrich", "area_topk"):
    register(_k)(_prep(_k))
register("surrender_extract")(_prep("surrender_extract", CALC_MONTH))


@register("split_client_policy")
def q_split_client_policy(spark, sf_dir):
    from tontine.plans.prepare import split_client_policy
    return split_client_policy(spark, sf_dir)[0]


@register("split_client_policy_policies")
def q_split_client_policy_policies(spark, sf_dir):
    from tontine.plans.prepare import split_client_policy
    return split_client_policy(spark, sf_dir)[1]


@register("scalar_functions")
def q_scalar_functions(spark, sf_dir):
    from tontine.plans.relational import scalar_functions
    return scalar_functions(spark, sf_dir, CALC_MONTH)


@register("claim_amount")
def q_claim_amount(spark, sf_dir):
    from tontine.sources import fixtures
    return fixtures.claim_info(spark, sf_dir, _act(spark, sf_dir).prem_std_real)


# ---------------------------------------------------------------- sources and sinks
@register("conform_schema")
def q_conform_schema(spark, sf_dir):
    from tontine.schema import conform
    from tontine.sources.tables import table
    from pyspark.sql.types import DecimalType, IntegerType, StringType, StructField, StructType
    st = StructType([StructField("o_orderkey", IntegerType()), StructField("o_totalprice", DecimalType(7, 2)),
                     StructField("o_orderpriority", StringType())])
    return conform(table(spark, sf_dir, "orders"), st, overflow="null")


@register("delimited_scan")
def q_delimited_scan(spark, sf_dir):
    import os
    import uuid

    from tontine.schema import struct
    from tontine.sources import fixtures
    from tontine.sources.delimited import read_delimited, write_delimited
    from tontine.sources.sinks import stage_dir
    path = os.path.join(stage_dir(spark), f"policy_surrender-{uuid.uuid4().hex}")
    write_delimited(fixtures.policy_surrender(spark, sf_dir), path)
    return read_delimited(spark, path, struct("policy_surrender"))


@register("partition_overwrite_static")
def q_partition_overwrite_static(spark, sf_dir):
    """Premium due of every month written by month, the report month twice."""
    from tontine.plans import storage
    return storage.partition_overwrite_static(spark, sf_dir, CALC_MONTH, _act(spark, sf_dir).prem_std_real)


@register("partition_inventory")
def q_partition_inventory(spark, sf_dir):
    """The same table's months and their rows, from file metadata."""
    from tontine.plans import storage
    return storage.partition_inventory(spark, sf_dir, CALC_MONTH, _act(spark, sf_dir).prem_std_real)


@register("partition_overwrite_dynamic")
def q_partition_overwrite_dynamic(spark, sf_dir):
    """Purchases per purchase month written with dynamic partition overwrite, then the
    months of one year rewritten: the other months must stay as they were."""
    import os
    import uuid

    from pyspark.sql import functions as F

    from tontine.sources import fixtures
    from tontine.sources.sinks import stage_dir, write_months
    path = os.path.join(stage_dir(spark), f"purchases-{uuid.uuid4().hex}")
    b = fixtures.policy_benefit(spark, sf_dir).select(
        "pol_no", "insur_code", F.substring("buy_datetime", 1, 7).alias("month"))
    write_months(b, path)
    write_months(b.where(F.col("month").startswith("1999")), path)
    return spark.read.parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


def _storage(name):
    def q(spark, sf_dir):
        from tontine.plans import storage
        return getattr(storage, name)(spark, sf_dir)
    return q


for _k in ("overwrite_from_self", "conform_table", "conform_rejects", "delimited_table", "delimited_rejects",
           "policy_number_incremental", "client_id_incremental", "warehouse_catalog"):
    register(_k)(_storage(_k))


def _derby_url(spark, name: str) -> str:
    """In-memory database inside the driver JVM (no server, no port); its log goes to the stage folder."""
    import os
    import uuid

    from tontine.sources.sinks import stage_dir
    d = stage_dir(spark)
    if d.startswith("file:"):
        d = d[len("file:"):]
    if "://" not in d:                     # a local folder: keep the database log out of the cwd
        os.makedirs(d, exist_ok=True)
        spark.sparkContext._jvm.java.lang.System.setProperty("derby.stream.error.file",
                                                              os.path.join(d, "derby.log"))
    return f"jdbc:derby:memory:{name}{uuid.uuid4().hex[:8]};create=true"


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@register("jdbc_ingest")
def q_jdbc_ingest(spark, sf_dir):
    """Export a table to an in-process database, import it back to parquet and reconcile counts."""
    import os
    import uuid

    from tontine.sources import fixtures
    from tontine.sources.jdbc import export_jdbc, ingest_jdbc
    from tontine.sources.sinks import stage_dir
    url = _derby_url(spark, "ods")
    export_jdbc(fixtures.policy_surrender(spark, sf_dir), url, "POLICY_SURRENDER", DERBY)
    root = os.path.join(stage_dir(spark), f"ods-{uuid.uuid4().hex}")
    return ingest_jdbc(spark, url, ["POLICY_SURRENDER"], DERBY, root)


@register("jdbc_export")
def q_jdbc_export(spark, sf_dir):
    """Write a mart to a database table, read it back."""
    from tontine.sources import fixtures
    from tontine.sources.jdbc import export_jdbc, read_jdbc
    url = _derby_url(spark, "app")
    export_jdbc(fixtures.area(spark, sf_dir), url, "AREA", DERBY)
    return read_jdbc(spark, url, "AREA", DERBY).selectExpr(
        "cast(ID as smallint) as id", "PROVINCE as province", "CITY as city", "DIRECTION as direction")


# ---------------------------------------------------------------- the 33 model steps
def _step(name):
    def q(spark, sf_dir):
        from tontine.plans.steps import step_query
        return step_query(_act(spark, sf_dir), name)
    return q


def _register_steps():
    from tontine.plans.steps import STEPS
    for name in STEPS:
        register(name)(_step(name))


_register_steps()
