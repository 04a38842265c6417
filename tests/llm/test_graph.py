"""Components of links: by hand, and a hub whose links AQE deals out."""

import random


from tontine.llm.graph import _toward_least, components


def by_hand(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        if a != b and None not in (a, b):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def test_components_by_hand(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)] + [(k, k + 1) for k in range(1000, 1060)]
    links += [(5000, k) for k in range(5001, 5400)] + [(7, 7), (None, 3), (3, None), (1, 2), (2, 1), (1, 2)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == by_hand(links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hub_is_split(spark, tmp_path):
    spark.range(1, 300_001).selectExpr("if(id % 10 > 0, 400000, id) as u", "id - 1 as v").repartition(16).write.parquet(str(tmp_path / "links"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.files.maxPartitionBytes": "256k", "spark.sql.files.openCostInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = _toward_least(spark.read.parquet(str(tmp_path / "links")))
        assert out.where("u = 400000 and m = 0").count() == 270_000
        whole = out.select("u", "v", "m")
        assert len(whole.collect()) == 300_000
        assert "skew=true" in whole._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


