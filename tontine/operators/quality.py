"""Data-quality operators: tolerance check against a golden table, count reconciliation, spot slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def relative_diff_check(computed: DataFrame, golden: DataFrame, keys: Sequence[str], col: str,
                        golden_col: str | None = None, tol: float = 0.001,
                        two_sided: bool = True) -> DataFrame:
    """Rows whose relative difference to the golden value exceeds ``tol``.

    An empty result means the computation agrees.  ``two_sided=False``
    reproduces a one-sided check (only computed > golden is reported).
    """
    g = golden.select(*keys, F.col(golden_col or col).alias("_real"))
    j = computed.select(*keys, F.col(col).alias("_mine")).join(g, list(keys))
    d = F.expr("try_divide(cast(_mine as double) - cast(_real as double), cast(_real as double))")
    cond = F.abs(d) > tol if two_sided else d > tol
    return j.where(cond).select(*keys, F.col("_mine").alias(f"my_{col}"),
                                F.col("_real").alias(f"real_{col}"),
                                d.cast("decimal(12,8)").alias(f"diff_rate_{col}"))


def compare_tables(mine: DataFrame, real: DataFrame, keys: Sequence[str], cols: Sequence[str], tol: float = 0.001) -> DataFrame:
    """Both tables merged by key in one shuffle: a row for every cell that does not agree.

    ``status`` is ``missing`` (a key that only the real table has), ``extra`` (only mine has it), ``repeated`` (a key
    that a side has more than once; its cells are not compared) or ``differs`` (``column`` with both values, their
    relative difference beyond ``tol``, or a null on one side).  Keys are compared null-safely.  Sides meet as one
    aggregate of the union, so a repeated key is summed up before the shuffle.
    """
    values = [F.col(c).cast("double").alias(f"_c{k}") for k, c in enumerate(cols)]
    both = mine.select(*keys, *values, F.lit(1).alias("_side")).unionByName(real.select(*keys, *values, F.lit(2).alias("_side")))
    side = lambda n, c: F.max(F.when(F.col("_side") == n, F.col(c)))
    merged = both.groupBy(*keys).agg(
        F.count_if(F.col("_side") == 1).alias("_mine"), F.count_if(F.col("_side") == 2).alias("_real"),
        *[side(n, f"_c{k}").alias(f"_{name}{k}") for k in range(len(cols)) for n, name in ((1, "m"), (2, "r"))])
    whole = (F.when((F.col("_mine") > 1) | (F.col("_real") > 1), "repeated").when(F.col("_mine") == 0, "missing").when(F.col("_real") == 0, "extra"))
    cells = []
    for k, c in enumerate(cols):
        m, r = F.col(f"_m{k}"), F.col(f"_r{k}")
        rate = F.try_divide(m - r, r)
        bad = (m.isNull() != r.isNull()) | F.coalesce(F.abs(rate) > tol, m != r, F.lit(False))
        cells.append(F.when(bad, F.struct(F.lit("differs").alias("status"), F.lit(c).alias("column"), m.alias("mine"), r.alias("real"), rate.alias("rate"))))
    none = F.lit(None).cast("double")
    lost = F.struct(whole.alias("status"), F.lit(None).cast("string").alias("column"), none.alias("mine"), none.alias("real"), none.alias("rate"))
    found = F.when(whole.isNotNull(), F.array(lost)).otherwise(F.filter(F.array(*cells), lambda c: c.isNotNull()))
    return merged.select(*keys, F.explode(found).alias("_f")).select(*keys, "_f.status", "_f.column", "_f.mine", "_f.real", "_f.rate")


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: source_cnt, target_cnt, matched (two distributed counts, no collect)."""
    sides = (source.select(F.lit(1).alias("_src")).unionByName(target.select(F.lit(0).alias("_src"))))
    return sides.agg(F.expr("count_if(_src = 1) as source_cnt"), F.expr("count_if(_src = 0) as target_cnt")) \
        .withColumn("matched", F.col("source_cnt") == F.col("target_cnt"))


def slice_product(df: DataFrame, sex: str, ppp: int, age_buy: int, order: str = "policy_year") -> DataFrame:
    """Spot check of one product cell, ordered along the projection."""
    return df.where((F.col("sex") == sex) & (F.col("ppp") == ppp) & (F.col("age_buy") == age_buy)).orderBy(order)
