"""End-to-end monthly batch: every mart written month-partitioned; a re-run replaces only its month."""

import os
import tempfile

from tontine.plans.monthly import run_month
from tontine.schema import DDL

SF = "/root/testdata/sf0.001"


def test_run_two_months_and_rerun(spark):
    root = tempfile.mkdtemp(dir="/tmp")
    url = "jdbc:derby:memory:tontine_monthly;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    written = run_month(spark, SF, "2000-03", root, jdbc={"url": url, "props": props})
    run_month(spark, SF, "2000-04", root)
    run_month(spark, SF, "2000-04", root)          # idempotent re-run of one month
    names = {n for n, _ in written}
    assert len(names) == 12
    for name, path in written:
        df = spark.read.parquet(path)
        expect = [c for c, _ in DDL[name]]
        assert [c for c in df.columns if c != "month"] == expect, name
        if name != "policy_actuary":
            months = sorted(r.month for r in df.select("month").distinct().collect())
            assert months == ["2000-03", "2000-04"], name
    pr = spark.read.parquet(os.path.join(root, "app", "policy_result"))
    assert pr.where("month = '2000-04'").count() == pr.where("month = '2000-04'").select("pol_no").distinct().count()
    from tontine.sources.jdbc import read_jdbc
    assert read_jdbc(spark, url, "POLICY_ACTUARY", props).count() > 0


def test_warehouse_layers(spark):
    from tontine.plans.monthly import write_warehouse
    from tontine.schema import struct
    root = tempfile.mkdtemp(dir="/tmp")
    out = write_warehouse(spark, SF, root)
    assert len(out) == 15
    for name, path in out:
        assert spark.read.parquet(path).schema == struct(name), name


def test_bucketed_warehouse_join_is_colocated(spark):
    from tontine.plans import actuarial
    from tontine.plans.marts import policy_result
    from tontine.plans.monthly import read_ods, write_warehouse
    root = tempfile.mkdtemp(dir="/tmp")
    write_warehouse(spark, SF, root, buckets=4)
    ods = read_ods(spark, root)
    assert set(ods) == {"policy_benefit", "policy_client"}
    a = actuarial.run(spark, SF)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pr = policy_result(spark, SF, "2000-04", a.policy_actuary, a.prem_std_real,
                           policies=ods["policy_benefit"], clients=ods["policy_client"])
        plan = pr._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning(user_id" not in plan
        base = policy_result(spark, SF, "2000-04", a.policy_actuary, a.prem_std_real)
        assert pr.exceptAll(base).count() == 0 and base.exceptAll(pr).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bound_warehouse_tables_serve_all_marts(spark):
    from tontine.plans.kpi import kpi_premium_per_policy
    from tontine.plans.monthly import read_ods, write_warehouse
    from tontine.plans import actuarial
    from tontine.sources.fixtures import bound_tables
    root = tempfile.mkdtemp(dir="/tmp")
    write_warehouse(spark, SF, root, buckets=4)
    a = actuarial.run(spark, SF)
    base = kpi_premium_per_policy(spark, SF, "2000-04", a.prem_std_real).collect()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bound_tables(spark, SF, read_ods(spark, root)):
            df = kpi_premium_per_policy(spark, SF, "2000-04", a.prem_std_real)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(user_id" not in plan
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, base))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_run_joins_policies_and_clients_once(spark, tmp_path, monkeypatch):
    """Of all tables that a monthly run writes, one plan shuffles policies and clients on user_id."""
    import re

    from pyspark.sql.readwriter import DataFrameWriter

    from tontine.plans.monthly import run_month
    plans, write = [], DataFrameWriter.parquet

    def noted(self, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kwargs)
    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run_month(spark, SF, "2000-04", str(tmp_path))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [p for p in plans if re.search(r"hashpartitioning\(user_id", p) and "orders.parquet" in p]
    assert len(plans) >= 13 and len(joins) <= 2, len(joins)      # the run's join; the sold counts of a first run
