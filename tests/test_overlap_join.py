"""Interval overlap join against pairing by hand: levels, bins, odd rows, a hot bin."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import tontine.operators.intervals as intervals
from tontine.operators.intervals import _levels, _placed, overlap_join


def pairs(a, b, keyed):
    return sorted((x[0], y[0]) for x in a for y in b
                  if None not in (x[1], x[2], y[1], y[2]) and x[1] <= x[2] and y[1] <= y[2] and max(x[1], y[1]) <= min(x[2], y[2])
                  and (not keyed or (x[3] is not None and x[3] == y[3])))


def noise(rnd, n, far):
    out = []
    for k in range(n):
        start = rnd.choice([None, *[rnd.randint(-far, far)] * 30])
        length = rnd.choice([0, 0, 1, 2, 7, 8, 9, rnd.randint(0, 40), rnd.randint(0, far), -1])
        stop = None if start is None or rnd.random() < 0.02 else start + length
        out.append((k, start, stop, rnd.choice(["x", "y", None])))
    return out


@pytest.mark.parametrize("keyed", [False, True])
def test_every_pair_once(spark, keyed):
    rnd = random.Random(21)
    a, b = noise(rnd, 250, 500), noise(rnd, 220, 300)
    a.append((999, -2**40, 2**40, "x"))
    b += [(998, 5, 5, "x"), (998, 5, 5, "x")]
    left = spark.createDataFrame(a, "i long, s long, t long, k string")
    right = spark.createDataFrame(b, "j long, u long, v long, k string")
    if not keyed:
        left, right = left.drop("k"), right.drop("k")
    out = overlap_join(left, right, ("s", "t"), ("u", "v"), ["k"] if keyed else [])
    assert sorted((r.i, r.j) for r in out.collect()) == pairs(a, b, keyed)
    assert out.columns == (["i", "s", "t", "k", "j", "u", "v"] if keyed else ["i", "s", "t", "j", "u", "v"])


def test_plan_and_copies_are_bounded(spark):
    df = spark.range(2000).selectExpr("id as i", "id * 3 as s", "id * 3 + pmod(id * 7919, 5000) as t")
    other = df.selectExpr("i as j", "s as u", "t as v")
    plan = overlap_join(df, other, ("s", "t"), ("u", "v"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    given = df.selectExpr("i", "s as _start", "t as _stop", "length(bin(t - s)) as _level")
    levels = _levels(given)
    most = _placed(given, levels, from_own=True).groupBy("i").count().agg(F.max("count")).first()[0]
    assert most <= 2 * len(levels) + 2


def test_empty_sides_and_clashing_names(spark):
    df = spark.createDataFrame([(1, 0, 9)], "i long, s long, t long")
    other = df.selectExpr("i as j", "s as u", "t as v")
    assert overlap_join(df.limit(0), other, ("s", "t"), ("u", "v")).count() == 0
    assert overlap_join(df, other.limit(0), ("s", "t"), ("u", "v")).count() == 0
    with pytest.raises(ValueError, match="i, s, t"):
        overlap_join(df, df, ("s", "t"), ("s", "t"))


def test_hot_bin_is_split(spark, tmp_path):
    """Two thirds of the rows in one bin of one level: the join deals the bin's rows to several tasks."""
    spark.range(60_000).selectExpr("id as i", "if(id % 3 > 0, 1000, id * 50) as s", "uuid() as pad").repartition(12).write.parquet(str(tmp_path / "a"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.files.maxPartitionBytes": "256k", "spark.sql.files.openCostInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        a = spark.read.parquet(str(tmp_path / "a")).withColumn("t", F.col("s") + 2)
        b = spark.createDataFrame([(1, 1001, 1001), (2, 900, 999), (3, 1002, 1003)], "j long, u long, v long")
        out = overlap_join(a, b, ("s", "t"), ("u", "v")).select("i", "j", "pad")
        found = out.collect()
        assert len(found) == sum(2 if k % 3 > 0 else int(998 <= k * 50 <= 1001) + int(898 <= k * 50 <= 999) + int(1000 <= k * 50 <= 1003)
                                 for k in range(60_000))
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_bin_of_many_pairs_is_dealt_to_many_tasks(spark, monkeypatch):
    """Few rows, but every pair of them meets in one bin: no task gives out more than a small part of the pairs."""
    monkeypatch.setattr(intervals, "CHUNK", 20)
    a = [(k, 1000, 1000 + 2000 * (k < 3), "x") for k in range(400)] + [(400, 5, 6, "x"), (401, None, 6, "x")]
    b = [(k, 1000, 1001, "x") for k in range(300)] + [(7, 1000, 1001, "x"), (301, 6, 6, "x"), (302, 6, 5, "x")]
    left, right = spark.createDataFrame(a, "i long, s long, t long, k string"), spark.createDataFrame(b, "j long, u long, v long, k string")
    for keys in ([], ["k"]):
        out = overlap_join(left.drop(*{"k"} - set(keys)), right.drop(*{"k"} - set(keys)), ("s", "t"), ("u", "v"), keys)
        found = out.withColumn("task", F.spark_partition_id()).collect()
        assert sorted((r.i, r.j) for r in found) == pairs(a, b, bool(keys))
        most = max(Counter(r.task for r in found).values())
        assert most < len(found) / 3                       # one task had them all


def test_copies_of_one_row_are_dealt_too(spark, monkeypatch):
    monkeypatch.setattr(intervals, "CHUNK", 20)
    left = spark.range(500).selectExpr("1 as i", "10L as s", "12L as t")
    right = spark.range(400).selectExpr("2 as j", "11L as u", "11L as v")
    tasks = overlap_join(left, right, ("s", "t"), ("u", "v")).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 200_000 and max(r["count"] for r in tasks) < 80_000


def test_copies_grow_with_the_rows_and_not_with_the_pairs(spark, monkeypatch):
    """All rows meet in one bin: four times the rows are sixteen times the pairs, but about four times the copies."""
    monkeypatch.setattr(intervals, "CHUNK", 5)
    copies, real = [], intervals._dealt
    monkeypatch.setattr(intervals, "_dealt", lambda *a: copies.append((out := real(*a)).count()) or out)
    for n in (400, 1600):
        left = spark.range(n).selectExpr("id as i", "10L as s", "12L as t")
        right = spark.range(n).selectExpr("id as j", "11L as u", "11L as v")
        out = overlap_join(left, right, ("s", "t"), ("u", "v"))
        assert out.groupBy().agg(F.count("*"), F.countDistinct("i", "j")).first()[:] == (n * n, n * n)
    assert len(copies) == 4 and sum(copies[2:]) < 6 * sum(copies[:2])


def test_chunks_have_a_greatest_size(spark, monkeypatch):
    monkeypatch.setattr(intervals, "CHUNK", 5)
    monkeypatch.setattr(intervals, "LARGEST", 20)
    monkeypatch.setattr(intervals, "CELLS", 1)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        left = spark.range(700).selectExpr("id as i", "10L as s", "12L as t")
        right = spark.range(500).selectExpr("id as j", "11L as u", "11L as v")
        tasks = overlap_join(left, right, ("s", "t"), ("u", "v")).groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in tasks) == 350_000
        sizes = left.select(F.lit(0).alias("_l")), right.select(F.lit(0).alias("_l"))
        assert intervals._crowded(*sizes, ["_l"])[0].first()[1:] == (35, 25)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
