"""User-defined mergeable aggregates: any cut of the rows gives the same result, hot keys meet as a few states."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import tontine.operators.aggregate as module
from tontine.operators.aggregate import Aggregator, TopTwo, aggregate


def brute(rows):
    out = {}
    for key in {r[0] for r in rows}:
        values = sorted((v for k, v in rows if k == key and v is not None), reverse=True)
        kinds = sorted(set(values), reverse=True)
        top, second = (kinds + [None, None])[:2]
        out[key] = (top, second, values.count(top) if values else 0, None if second is None else top - second)
    return out


@pytest.mark.parametrize(("partitions", "fan"), [(1, 64), (9, 64), (23, 3)])
def test_any_cut_gives_the_same_result(spark, partitions, fan):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, 0, 0, 0, *range(60)]), rnd.choice([None, rnd.randrange(50)])) for _ in range(4000)] + [(99, None)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(partitions)
    out = aggregate(df, ["k"], {"value": "v"}, TopTwo(), fan=fan, held=20)        # tasks hand out their states
    assert {r.k: tuple(r[1:]) for r in out.collect()} == brute(rows)


def test_without_keys_and_empty(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 1)], "k int, v int")
    assert [tuple(r) for r in aggregate(df, [], {"value": "v"}, TopTwo()).collect()] == [(5, 1, 2, 4)]
    none = df.where("false")
    assert [tuple(r) for r in aggregate(none, [], {"value": "v"}, TopTwo()).collect()] == [(None, None, 0, None)]
    assert aggregate(none, ["k"], {"value": "v"}, TopTwo()).count() == 0


def test_several_inputs_and_two_keys(spark):
    class Moments(Aggregator):
        """A state of mixed types: count, sum, and the shortest text, with several inputs."""

        state, result = "n bigint, total double, least string", "mean double, least string"

        def initial(self):
            return 0, 0.0, None

        def update(self, state, rows):
            texts = [t for t in rows["text"].to_pylist() if t is not None]
            return self.merge(state, (len(rows["x"]), float(sum(rows["x"].to_pylist())), min(texts, default=None)))

        def merge(self, a, b):
            return a[0] + b[0], a[1] + b[1], min((t for t in (a[2], b[2]) if t is not None), default=None)

        def evaluate(self, state):
            return state[1] / state[0] if state[0] else None, state[2]

    df = spark.range(1000).selectExpr("id % 3 as a", "if(id % 2 = 0, 'e', null) as b", "id as x", "concat('t', id) as text").repartition(7)
    got = {(r.a, r.b): (r.mean, r.least) for r in aggregate(df, ["a", "b"], {"x": "cast(x as double)", "text": "text"}, Moments()).collect()}
    want = {(r.a, r.b): (r.mean, r.least) for r in df.groupBy("a", "b").agg(F.avg("x").alias("mean"), F.min("text").alias("least")).collect()}
    assert got == want


def test_hot_key_meets_as_a_few_states(spark, monkeypatch):
    """A third of all rows on one key: what is written for the merge is one state a task, not rows."""
    written = []
    real = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, **o: written.append(real(df, **o)) or written[-1])
    df = spark.range(90_000).selectExpr("if(id % 3 = 0, 0, id % 1000) as k", "id as v").repartition(12)
    out = aggregate(df, ["k"], {"value": "v"}, TopTwo(), fan=4)
    assert out.where("k = 0").first().largest == 89_999 // 3 * 3
    assert [w.where("k = 0").count() for w in written] == [12, 3]
    assert out.count() == 1000


def test_many_keys_cost_no_call_a_key(spark, monkeypatch):
    """Most keys have a row or two: they are folded, merged and evaluated together, whatever is handed out."""
    class Watched(TopTwo):
        def update(self, state, rows):
            raise AssertionError("a call a block")

        merge = evaluate = update

    df = spark.range(5_000).selectExpr("if(id % 50 = 0, null, id * 7919 % 2000) as k", "if(id % 11 = 0, null, id % 101) as v").repartition(9)
    rows = [(r.k, r.v) for r in df.collect()]
    for held in (100, 1_000_000):
        out = aggregate(df, ["k"], {"value": "v"}, Watched(), fan=3, held=held)
        assert {r.k: tuple(r[1:]) for r in out.collect()} == brute(rows)


def test_blocks_equal_single_calls():
    """The vectorised methods against those of the base class, with nulls, empty blocks, ties and least and greatest values."""
    rnd, agg = random.Random(4), TopTwo()
    for _ in range(60):
        sizes = [rnd.choice([1, 1, 2, 3, 9]) for _ in range(rnd.randint(1, 30))]
        starts = np.cumsum([0, *sizes[:-1]])
        values = pa.array([rnd.choice([None, 0, 1, -5, 2**63 - 1, -2**63, rnd.randrange(4)]) for _ in range(sum(sizes))], pa.int64())
        types = [pa.int64()] * 3
        states = [pa.array(c, t) for c, t in zip(Aggregator.update_blocks(agg, {"value": values}, starts), types, strict=True)]
        assert [c.to_pylist() for c in agg.update_blocks({"value": values}, starts)] == [c.to_pylist() for c in states]
        cuts = np.unique([0, *[rnd.randrange(len(sizes)) for _ in range(5)]])
        merged = [list(c) for c in Aggregator.merge_blocks(agg, states, cuts)]
        assert [c.to_pylist() for c in agg.merge_blocks(states, cuts)] == merged
        near = [pa.array([None if v is None else v // 4 for v in c.to_pylist()], pa.int64()) for c in states]
        assert [c.to_pylist() for c in agg.evaluate_all(near)] == [list(c) for c in Aggregator.evaluate_all(agg, near)]
