"""interval_counts (events + running sums) equals brute-force pairing of rows with months."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tontine.operators.joins import interval_counts

LO, HI = 100, 136


@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(80, 150), st.integers(80, 160),
                          st.integers(80, 160)), min_size=1, max_size=60))
@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_interval_counts_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g string, s int, e1 int, e2 int")
    got = interval_counts(df, ["g"], LO, HI, {"n1": (F.col("s"), F.col("e1")), "n2": (F.col("s"), F.col("e2"))})
    got = {(r.g, r.month_idx): (r.n1, r.n2) for r in got.collect()}
    exp = {}
    for g, s, e1, e2 in rows:
        for m in range(LO, HI + 1):
            a, b = int(s <= m <= e1), int(s <= m <= e2)
            if a or b:
                c = exp.get((g, m), (0, 0))
                exp[(g, m)] = (c[0] + a, c[1] + b)
    assert got == exp
