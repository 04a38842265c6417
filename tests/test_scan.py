"""Skew-safe ordered scans equal plain per-key windows, also for a key spanning all partitions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tontine.operators.scan import affine_recurrence, linear_recurrence, ordered_scan


@pytest.fixture(scope="module")
def skewed(spark):
    # key 0 holds half of the rows, so it spans every range partition
    random.seed(7)
    rows = [(0, i, round(random.random() * 100, 2)) for i in range(3000)]
    rows += [(k, i, round(random.random() * 100, 2)) for k in range(1, 400) for i in range(random.randint(1, 12))]
    return spark.createDataFrame(rows, "k long, t long, v double").withColumn(
        "vd", F.col("v").cast("decimal(18,2)")).withColumn("keep", 1 - F.col("v") / 1000)


def test_scan_matches_plain_windows(spark, skewed):
    s = ordered_scan(skewed, ["k"], ["t"], sums=["vd"], products=["keep"], lags=["v"], leads=["v"],
                     partitions=6)
    w = Window.partitionBy("k").orderBy("t")
    ref = skewed.select(
        "k", "t", F.row_number().over(w).alias("pos"), F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n"),
        F.sum("vd").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
        F.sum("vd").over(Window.partitionBy("k")).alias("tot"),
        F.lag("v").over(w).alias("lag"), F.lead("v").over(w).alias("lead"),
        F.product("keep").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("prod"))
    got = {(r.k, r.t): r for r in s.collect()}
    assert len(got) == skewed.count()
    for r in ref.collect():
        g = got[(r.k, r.t)]
        assert (g._pos, g._n, g.vd__cum, g.vd__total, g.v__lag, g.v__lead) == (r.pos, r.n, r.cum, r.tot, r.lag, r.lead)
        if r.prod is None:
            assert g.keep__cumprod_prev is None
        else:
            assert abs(g.keep__cumprod_prev - r.prod) <= 1e-12 * abs(r.prod)


def test_recurrence_on_hot_key(spark, skewed):
    out = linear_recurrence(skewed, ["k"], ["t"], a="0.9D", b="v", seed="v", out="x", partitions=6)
    got = {(r.k, r.t): r.x for r in out.collect()}
    exp = {}
    for r in skewed.orderBy("k", "t").collect():
        prev = exp.get((r.k, r.t - 1)) if (r.k, r.t - 1) in exp else None
        exp[(r.k, r.t)] = r.v if prev is None else 0.9 * prev + r.v
    assert got.keys() == exp.keys()
    for key, v in exp.items():
        assert abs(got[key] - v) <= 1e-9 * max(1.0, abs(v))


def test_null_values_and_null_keys_equal_plain_windows(spark):
    """A null key and a key of null runs that span all partitions, leading nulls, bigint above 2^53."""
    rnd = random.Random(3)
    rows = [(None, i, rnd.choice([None, 1, 2]), 2**53 + 2 * i + 1) for i in range(900)]
    rows += [(5, i, None if i < 250 or 400 < i < 800 else rnd.randrange(9), -i) for i in range(1000)]
    rows += [(k, i, rnd.choice([None, 3]), None) for k in range(6, 40) for i in range(rnd.randrange(1, 9))]
    df = spark.createDataFrame(rows, "k int, t int, v int, big long").withColumn("f", 1 + F.col("v") / 1000)
    w = Window.partitionBy("k").orderBy("t")
    want = df.select("k", "t", F.row_number().over(w), F.count(F.lit(1)).over(Window.partitionBy("k")),
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.sum("v").over(Window.partitionBy("k")),
                     F.lag("big").over(w), F.lead("big").over(w),
                     F.round(F.product(F.col("f")).over(w.rowsBetween(Window.unboundedPreceding, -1)), 9))
    for partitions in (1, 4, 7):
        got = ordered_scan(df, ["k"], ["t"], sums=["v"], products=["f"], lags=["big"], leads=["big"], partitions=partitions)
        got = got.select("k", "t", "_pos", "_n", "v__cum", "v__total", "big__lag", "big__lead", F.round("f__cumprod_prev", 9))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_recurrence_over_null_keys_and_wide_columns(spark):
    rows = [(None, i, 9007199254740993 + i, "x") for i in range(700)] + [(1, i, i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "k int, t int, big long, s string")
    out = linear_recurrence(df, ["k"], ["t"], a="0.5D", b="1D", seed="8D", partitions=5).orderBy("k", "t").collect()
    x = 8.0
    for i in range(700):
        assert out[i].k is None and out[i].big == 9007199254740993 + i and abs(out[i].x - x) < 1e-12
        x = 0.5 * x + 1
    assert [r.x for r in out[700:]] == [8.0, 5.0, 3.5, 2.75, 2.375] and out[700].s is None


def test_coupled_states(spark, skewed):
    """Two states against a sequential loop, on a key that spans all partitions."""
    a = [["0.5D", "0.25D"], ["-0.25D", "v / 100"]]
    out = affine_recurrence(skewed, ["k"], ["t"], a, ["v", "1D"], ["v", "0D"], ["x", "y"], partitions=6).collect()
    got = {(r.k, r.t): (r.x, r.y) for r in out}
    last = None
    for r in skewed.orderBy("k", "t").collect():
        if r.t == 0:
            last = (r.v, 0.0)
        else:
            last = (0.5 * last[0] + 0.25 * last[1] + r.v, -0.25 * last[0] + r.v / 100 * last[1] + 1)
        x, y = got[(r.k, r.t)]
        assert abs(x - last[0]) <= 1e-7 * max(1, abs(last[0])) and abs(y - last[1]) <= 1e-7 * max(1, abs(last[1]))


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@given(st.lists(st.tuples(st.integers(0, 5), st.integers(-1000, 1000)), min_size=1, max_size=300, unique=True),
       st.integers(1, 7))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_split_scan_random(spark, rows, parts):
    df = spark.createDataFrame([(k, t, float(t % 17)) for k, t in rows], "k int, t int, v double")
    s = ordered_scan(df, ["k"], ["t"], sums=["v"], lags=["v"], partitions=parts).collect()
    by = {}
    for k, t in sorted(rows):
        by.setdefault(k, []).append(t)
    for r in s:
        ts = by[r.k]
        i = ts.index(r.t)
        assert r._pos == i + 1 and r._n == len(ts)
        assert r.v__cum == sum(float(x % 17) for x in ts[: i + 1])
        assert r.v__lag == (None if i == 0 else float(ts[i - 1] % 17))


@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 500), st.integers(-50, 50)), min_size=1, max_size=200,
                unique_by=lambda r: (r[0], r[1])),
       st.integers(1, 6))
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_recurrence_random(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, t int, v int")
    out = linear_recurrence(df, ["k"], ["t"], a="0.5D", b="v", seed="v * 2D", out="x", partitions=parts).collect()
    exp = {}
    for k, t, v in sorted(rows):
        prev = [x for (kk, tt), x in exp.items() if kk == k]
        exp[(k, t)] = 2.0 * v if not prev else 0.5 * prev[-1] + v
    got = {(r.k, r.t): r.x for r in out}
    assert got.keys() == exp.keys()
    for key, v in exp.items():
        assert abs(got[key] - v) <= 1e-9 * max(1.0, abs(v))
