"""A client holding a third of all policies: the policy-client join is split by AQE, results stay whole."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tontine.plans.marts import policies_with_client
from tontine.sources import fixtures
from tools.check_oracle import compare

SF = "/root/testdata/sf0.01"


def test_hot_client_join_is_split(spark):
    pol = fixtures.policy_benefit(spark, SF)
    # many input splits, as a large table has (AQE splits a skewed partition along map outputs)
    hot = pol.withColumn("user_id", F.when(F.col("pol_no").substr(-1, 1).isin("0", "3", "6"), F.lit("7"))
                         .otherwise(F.col("user_id"))).repartition(8)
    n_hot = hot.where("user_id = '7'").count()
    assert n_hot * 3 >= pol.count() * 0.9          # about a third of all policies
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        j = policies_with_client(spark, SF, policies=hot)
        rows = j.collect()                          # runs this frame's own adaptive plan
        final = j._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final, final[:2000]
        assert len(rows) == hot.count()             # every policy kept, none sampled or dropped
        assert sum(1 for r in rows if r.user_id == "7") == n_hot
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_detail_of_a_hot_order_is_split(spark, tmp_path):
    """A third of all lines on one order: the join of details to their total is split, shares stay right."""
    from tontine.plans.relational import join_detail_to_aggregate
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    hot = lines.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("l_orderkey")))
    hot.repartition(8).write.parquet(str(tmp_path / "lineitem.parquet"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.files.maxPartitionBytes": "128k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        j = join_detail_to_aggregate(spark, str(tmp_path))
        rows = j.collect()
        final = j._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final, final[:2000]
        assert len(rows) == lines.count()
        share = sum(r.share for r in rows if r.l_orderkey == 1)
        assert abs(float(share) - 1) < 1e-3
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


ALONG_ORDERS = ["win_tail_sum", "win_tail_sum_exclusive", "win_group_total", "win_lead", "win_lag", "recur_survival", "recur_multi_decrement"]


@pytest.fixture(scope="module")
def hot_order(tmp_path_factory):
    """The tables of sf0.01 with a third of all lines on one order, and a third of all orders of one customer."""
    folder = tmp_path_factory.mktemp("hot")
    for name in os.listdir(SF):
        os.symlink(os.path.join(SF, name), folder / name)
    changes = {"lineitem": "CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey",
               "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey"}
    for name, change in changes.items():
        os.unlink(folder / f"{name}.parquet")
        duckdb.sql(f"COPY (SELECT * REPLACE ({change}) FROM '{SF}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", [*ALONG_ORDERS, "win_row_number", "fold_capped_balance", "fold_best_run", "fold_payouts", "agg_user_defined"])
def test_queries_along_a_hot_key_are_whole(spark, hot_order, name):
    res = compare(spark, hot_order, [name], verbose=False)[name]
    assert res[0] == "OK", res
