"""Plan shape: what is shuffled, what is broadcast, what reaches the parquet scan."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_auto_broadcast(spark):
    """Plan as at scale: no side is small enough for size-based broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_policy_result_shuffles_policies_once(spark, no_auto_broadcast):
    df = E.queries()["policy_result"](spark, SF)
    p = plan(df)
    # only the client join shuffles (both sides on user_id); actuarial and price tables are broadcast
    hashed = re.findall(r"Exchange hashpartitioning\(([^,]+)", p)
    assert hashed and all("user_id" in h for h in hashed), hashed
    assert p.count("BroadcastExchange") >= 2
    assert "LessThan(o_orderdate" in p            # purchase-month bound pushed into the scan


def test_premium_windows_need_one_exchange(spark):
    from tontine.plans import premium
    p = plan(premium.premium_detail(spark))
    assert len(re.findall(r"Exchange (hash|range)partitioning", p)) == 1
    assert "Window" in p


def test_kpi_pre_aggregates_before_shuffle(spark, no_auto_broadcast):
    df = E.queries()["kpi_persistency13"](spark, SF)
    p = plan(df)
    assert "partial_sum" in p and "partial_count" in p


def test_scan_moves_its_rows_to_their_range_once(spark, no_auto_broadcast):
    """One exchange by range number, a range a task; the carries (a row a partition) come by broadcast."""
    for name in ("policy_number_assign", "win_row_number", "win_tail_sum"):
        p = plan(E.queries()[name](spark, SF))
        assert len(re.findall(r"Exchange shufflepartitionidpassthrough\(direct_shuffle_partition_id\(_pid", p)) >= 1
        top = p[:p.index("BroadcastExchange")] + p[p.index("shufflepartitionidpassthrough"):].split("BroadcastExchange")[0]
        assert "SortMergeJoin [_pid" not in top and "hashpartitioning(_all" not in p


def test_history_counts_events_not_month_pairs(spark):
    p = plan(E.queries()["kpi_persistency13_history"](spark, SF))
    assert "Generate explode" in p and "partial_sum" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
