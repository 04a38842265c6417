"""The monthly batch: stage tables, policy result and every mart for one report month.

Writes each mart under ``out_root/app/<table>`` with static partition overwrite of
``month=calc_month`` (re-running a month replaces only that month), the
product actuarial table unpartitioned, and optionally exports one mart over
JDBC.  Returns the list of (table, path) written.  Nothing is collected.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from tontine.params import DEFAULT, Params
from tontine.plans import actuarial, kpi
from tontine.plans.marts import policies_with_client, policy_result
from tontine.plans.warehouse import Warehouse
from tontine.schema import DDL, NOT_SUPPLIED, conform
from tontine.sources.fixtures import bound_tables
from tontine.sources.sinks import materialize, write_month


BUCKETED = ("policy_benefit", "policy_client")      # joined on user_id every month


def ods_table_name(name: str) -> str:
    return f"ods_{name}"


def write_warehouse(spark: SparkSession, sf_dir: str, root: str, params: Params = DEFAULT,
                    buckets: int | None = None, catalog: Warehouse | None = None) -> list[tuple[str, str]]:
    """Write the ODS (input stand-ins) and DW (stage tables) layers under ``root/ods`` and
    ``root/dw``, each conformed to its declared schema; overwrite per table.

    With ``buckets`` the policy and client tables are written as external catalog
    tables bucketed and sorted by ``user_id`` with the same bucket count, so the
    monthly policy-client join (``read_ods`` + ``run_month(ods=...)``) is
    co-located: no shuffle of either side, month after month.  With ``catalog`` (registered
    over the same ``root``) the rows go through its checked inserts.
    """
    from tontine.sources import fixtures
    a = actuarial.run(spark, sf_dir, params)
    ods = {
        "mort_10_13": fixtures.mortality_table(spark),
        "dd_table": fixtures.disease_table(spark),
        "pre_add_exp_ratio": fixtures.expense_table(spark, params.payment_terms),
        "prem_std_real": a.prem_std_real,
        "prem_cv_real": a.prem_cv_real,
        "area": fixtures.area(spark, sf_dir),
        "policy_client": fixtures.policy_client(spark, sf_dir),
        "policy_benefit": fixtures.policy_benefit(spark, sf_dir),
        "claim_info": fixtures.claim_info(spark, sf_dir, a.prem_std_real),
        "policy_surrender": fixtures.policy_surrender(spark, sf_dir),
    }
    dw = {"prem_src": a.prem_src, "prem_std": a.prem_std, "cv_src": a.cv_src, "prem_cv": a.prem_cv,
          "rsv_src": a.rsv_src}
    out = []
    for layer, tables in (("ods", ods), ("dw", dw)):
        for name, df in tables.items():
            path = os.path.join(root, layer, name)
            if catalog and not (buckets and name in BUCKETED):
                catalog.insert(df, name)
                out.append((name, path))
                continue
            w = conform(df, name, missing=NOT_SUPPLIED.get(name, ())).write.mode("overwrite")
            if buckets and name in BUCKETED:
                (w.bucketBy(buckets, "user_id").sortBy("user_id").format("parquet")
                  .option("path", path).saveAsTable(ods_table_name(name)))
            else:
                w.parquet(path)
            out.append((name, path))
    return out


def read_ods(spark: SparkSession, root: str) -> dict:
    """The bucketed policy and client tables (catalog tables carry the bucket spec)."""
    out = {}
    for name in BUCKETED:
        if spark.catalog.tableExists(ods_table_name(name)):
            out[name] = spark.table(ods_table_name(name))
    return out


def run_month(spark: SparkSession, sf_dir: str, calc_month: str, out_root: str,
              params: Params = DEFAULT, jdbc: dict | None = None, ods: dict | None = None,
              catalog: Warehouse | None = None) -> list[tuple[str, str]]:
    """With ``catalog`` (registered over the same ``out_root``) every mart goes through its checked inserts."""
    a = actuarial.run(spark, sf_dir, params)
    price = a.prem_std_real
    written: list[tuple[str, str]] = []

    def put(name, df, partitioned=True):
        path = os.path.join(out_root, "app", name)
        if catalog:
            catalog.insert(df, name, calc_month if partitioned else None)
        elif partitioned:
            write_month(df, path, calc_month)
        else:
            df.write.mode("overwrite").parquet(path)
        written.append((name, path))

    put("policy_actuary", a.policy_actuary, partitioned=False)
    with bound_tables(spark, sf_dir, ods or {}):
        # the one policy-client join of the run; every mart below reads its result
        both = materialize(policies_with_client(spark, sf_dir), name="policy_with_client")
    with bound_tables(spark, sf_dir, (ods or {}) | {"policy_with_client": both}):
        pr = policy_result(spark, sf_dir, calc_month, a.policy_actuary, price, params=params)
        put("policy_result", pr.drop("month"))
        pr_month = spark.read.parquet(os.path.join(out_root, "app", "policy_result")).where(f"month = '{calc_month}'")
        marts = {
            "app_agg_month_incre_rate": kpi.kpi_premium_growth(spark, sf_dir, calc_month, price),
            "app_agg_month_first_of_total_prem": kpi.kpi_first_year_ratio(spark, sf_dir, calc_month, price),
            "app_agg_month_rate_eff13": kpi.kpi_persistency13(spark, sf_dir, calc_month),
            "app_agg_month_premperpol": kpi.kpi_premium_per_policy(spark, sf_dir, calc_month, price),
            "app_agg_month_cooloff_surr": kpi.kpi_cooloff(spark, sf_dir, calc_month, price),
            "app_agg_month_surr_rate": kpi.kpi_surrender(spark, sf_dir, calc_month),
            "app_agg_month_mort_dis_rate": kpi.kpi_mortality_disability(spark, sf_dir),
            "app_agg_month_dir": kpi.kpi_region(pr_month, scale=2),
            "app_agg_month_high_net_rate": kpi.kpi_high_net_worth(spark, sf_dir),
            "app_agg_month_nbev": kpi.kpi_nbev(spark, sf_dir, price),
        }
        for name, df in marts.items():
            put(name, df.select(*[c for c, _ in DDL[name]]) if catalog else conform(df, name))
    if jdbc:
        from tontine.sources.jdbc import export_jdbc
        export_jdbc(a.policy_actuary, jdbc["url"], jdbc.get("table", "POLICY_ACTUARY"), jdbc["props"])
    return written
