"""Recurrences: closed forms, the ordered fold and the driver-loop form agree."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tontine.functions import windows as W
from tontine.operators.grid import literal_rows
from tontine.operators.scan import linear_recurrence

# The demonstration rows of the affine recurrence (c1 group, c2 order, c3 value)
DEMO = [(1, 1, 6), (1, 2, 23), (1, 3, 8), (1, 4, 4), (2, 1, 32), (2, 2, 9), (2, 3, 15), (2, 4, 8)]


def demo(spark):
    return literal_rows(spark, DEMO, ["c1", "c2", "c3"], ["int", "int", "double"])


def test_affine_fold_demo(spark):
    out = linear_recurrence(demo(spark), ["c1"], ["c2"], a="0.5D", b="0.5D * c3", seed="1D", out="c4")
    got = {(r.c1, r.c2): r.c4 for r in out.collect()}
    assert [got[(1, k)] for k in range(1, 5)] == [1.0, 12.0, 10.0, 7.0]
    assert [got[(2, k)] for k in range(1, 5)] == [1.0, 5.0, 10.0, 9.0]


def test_affine_fold_equals_driver_loop(spark):
    """The iterative form: c4 = if(c2 = i, (lag(c4) + c3) / 2, c4), one pass per order position."""
    df = demo(spark).withColumn("c4", F.when(F.col("c2") == 1, F.lit(1.0)))
    w = Window.partitionBy("c1").orderBy("c2")
    for i in range(2, 5):
        df = df.withColumn("c4", F.when(F.col("c2") == i, (F.lag("c4").over(w) + F.col("c3")) / 2)
                           .otherwise(F.col("c4")))
    loop = {(r.c1, r.c2): r.c4 for r in df.collect()}
    fold = linear_recurrence(demo(spark), ["c1"], ["c2"], a="0.5D", b="0.5D * c3", seed="1D", out="c4")
    assert loop == {(r.c1, r.c2): r.c4 for r in fold.collect()}


def test_survival_closed_form_equals_sequential(spark):
    rows = [(1, t, q) for t, q in enumerate([0.1, 0.2, 0.0, 0.5, 1.0, 0.3], start=1)]
    df = literal_rows(spark, rows, ["g", "policy_year", "qx"], ["int", "int", "double"])
    got = [r.lx for r in df.withColumn("lx", W.survival("qx", ["g"])).orderBy("policy_year").collect()]
    exp, l = [], 1.0
    for _, _, q in rows:
        exp.append(l)
        l = l * (1 - q)
    assert got == exp


def test_multi_decrement_equals_sequential(spark):
    qd = [0.01, 0.02, 0.03, 0.5]
    qc = [0.001, 0.002, 0.004, 0.5]
    rows = [(1, t + 1, a, b) for t, (a, b) in enumerate(zip(qd, qc))]
    df = literal_rows(spark, rows, ["g", "policy_year", "qx_d", "qx_ci"], ["int", "int", "double", "double"])
    out = df.withColumn("m", W.multi_decrement("qx_d", "qx_ci", ["g"])).orderBy("policy_year").collect()
    l, dd, dc = 1.0, qd[0], qc[0]
    for t, r in enumerate(out):
        if t > 0:
            l = l - dd - dc
            dd, dc = l * qd[t], l * qc[t]
        assert abs(r.m.l - l) < 1e-15 and abs(r.m.d_a - dd) < 1e-15 and abs(r.m.d_b - dc) < 1e-15
