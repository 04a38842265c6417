"""General ordered folds against plain loops, on keys that span all partitions."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tontine.operators.fold import Clamp, MaxPlus, ordered_fold, sequential_fold


@pytest.fixture(scope="module")
def moves(spark):
    """(k, t, v) where key 0 has half of the rows, a null key fills several partitions and v has nulls."""
    rnd = random.Random(11)
    rows = [(0, i, rnd.choice([None, *range(-50, 60)])) for i in range(2500)] + [(None, i, rnd.randint(-9, 9)) for i in range(700)]
    rows += [(k, i, rnd.randint(-50, 50)) for k in range(1, 300) for i in range(rnd.randint(1, 9))]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k int, t int, v int").withColumn("other", F.lit("x"))


def loop(rows, first, step):
    out = {}
    for k, of in groupby(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])), key=lambda r: r[0]):
        state = None
        for _, t, v in of:
            state = first(v) if state is None else step(state, v)
            out[k, t] = state
    return out


@pytest.mark.parametrize("partitions", [1, 6])
def test_clamp_equals_a_loop(moves, partitions):
    rows, df = moves
    out = ordered_fold(df, ["k"], ["t"], Clamp("v", "0", "100"), ["least(v, 40)"], ["x"], partitions=partitions)
    want = loop(rows, lambda v: min(v, 40) if v is not None else 40, lambda x, v: max(0, min(100, x + (v or 0))))
    assert {(r.k, r.t): r.x for r in out.collect()} == want
    assert out.columns == ["k", "t", "v", "other", "x"]


def test_bounds_that_change_and_cross_and_null_bounds(spark):
    rnd = random.Random(12)
    rows = [(1, i, rnd.randint(-9, 9), rnd.choice([None, -5, 3]), rnd.choice([None, 2, 9])) for i in range(800)]
    df = spark.createDataFrame(rows, "k int, t int, v int, lo int, hi int")
    got = {r.t: r.x for r in ordered_fold(df, ["k"], ["t"], Clamp("v", "lo", "hi"), ["v"], ["x"], partitions=5).collect()}
    x = None
    for _, t, v, lo, hi in rows:
        x = v if x is None else max(-10**9 if lo is None else lo, min(10**9 if hi is None else hi, x + v))
        assert got[t] == x


def test_max_plus_best_run(moves):
    """Best sum of consecutive rows: two coupled states."""
    rows, df = moves
    best = MaxPlus([["w", None], ["w", "0D"]], ["w", "w"])
    best.expressions = [e if e is not None else "null" for e in best.expressions]
    out = ordered_fold(df.withColumn("w", F.coalesce("v", F.lit(0))), ["k"], ["t"], best, ["w", "w"], ["run", "best"], partitions=6)
    want = loop(rows, lambda v: (v or 0, v or 0), lambda s, v: (max(v or 0, s[0] + (v or 0)), max(s[1], v or 0, s[0] + (v or 0))))
    assert {(r.k, r.t): (r.run, r.best) for r in out.collect()} == want


@pytest.mark.parametrize("partitions", [1, 5])
def test_any_step_hands_its_state_from_run_to_run(moves, partitions):
    """A step that does not compose: halving above a limit, with a text state beside."""
    rows, df = moves
    first = lambda v: (v or 0, "a")

    def step(state, v):
        x = state[0] + (v or 0)
        return (x // 2 if x > 60 or x < -60 else x, "b" if state[1] == "a" else "a")
    out = sequential_fold(df, ["k"], ["t"], ["v"], first, step, "x long, side string", partitions=partitions)
    assert {(r.k, r.t): (r.x, r.side) for r in out.collect()} == loop(rows, first, step)
    assert out.columns == ["k", "t", "v", "other", "x", "side"]


def test_empty_tables(moves):
    _, df = moves
    none = df.where("false")
    assert ordered_fold(none, ["k"], ["t"], Clamp("v"), ["v"], ["x"]).count() == 0
    assert sequential_fold(none, ["k"], ["t"], ["v"], lambda v: (v,), lambda s, v: (v,), "x int").count() == 0
