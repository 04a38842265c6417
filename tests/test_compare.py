from tontine.operators.quality import compare_tables


def test_planted_faults_are_found(spark):
    real = spark.createDataFrame([(k, str(k % 2), 100.0 + k, float(k)) for k in range(20)] + [(None, "x", 5.0, None)], "a int, b string, v double, w double")
    rows = {(r.a, r.b): [r.v, r.w] for r in real.collect()}
    del rows[3, "1"]
    rows[99, "1"] = [1.0, 1.0]
    rows[4, "0"][0] *= 1.01
    rows[5, "1"][0] *= 1.0005
    rows[6, "0"][1] = None
    rows[0, "0"][1] = 1e-9                                 # against zero there is no rate
    rows[None, "x"][0] = 6.0
    mine = spark.createDataFrame([(a, b, v, w) for (a, b), (v, w) in rows.items()] + [(7, "1", 107.0, 7.0)], "a int, b string, v double, w double")
    out = compare_tables(mine, real, ["a", "b"], ["v", "w"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    found = {(r.a, r.b, r.status, r.column) for r in out.collect()}
    assert found == {(3, "1", "missing", None), (99, "1", "extra", None), (4, "0", "differs", "v"), (6, "0", "differs", "w"),
                     (0, "0", "differs", "w"), (None, "x", "differs", "v"), (7, "1", "repeated", None)}
    assert compare_tables(real, real, ["a", "b"], ["v", "w"]).count() == 0
    assert compare_tables(real.limit(0), real, ["a", "b"], ["v"]).count() == 21
