"""Generators: literal dimensions, integer series and the product grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.params import Params


def literal_dim(spark: SparkSession, values: Sequence, name: str, type_: str | None = None) -> DataFrame:
    """A literal list as a one-column table (``stack`` in SQL), built JVM-side."""
    return literal_rows(spark, [(v,) for v in values], [name], [type_] if type_ else None)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str],
                 types: Sequence[str | None] | None = None) -> DataFrame:
    """A small literal table (``VALUES``) without a Python-side RDD."""
    types = types or [None] * len(names)

    def lit(v, t):
        c = F.lit(v)
        return c.cast(t) if t else c

    structs = [F.struct(*[lit(v, t).alias(n) for v, n, t in zip(r, names, types)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def int_series(spark: SparkSession, n: int, name: str = "id", start: int = 1) -> DataFrame:
    """Rows ``start..n`` (a range scan: no single-task window numbering)."""
    return spark.range(start, n + 1).select(F.col("id").cast("int").alias(name))


def all_products(spark: SparkSession, params: Params) -> DataFrame:
    """Every product cell (sex, ppp, age_buy) the parameter set allows."""
    cells = literal_rows(spark, [(s, p) for s in params.sexes for p in params.payment_terms],
                         ["sex", "ppp"], [None, "smallint"])
    return (cells.withColumn("age_buy", F.explode(F.sequence(
        F.lit(params.min_entry_age), (params.max_entry_end - F.col("ppp")).cast("int"))))
        .select("sex", "ppp", F.col("age_buy").cast("smallint").alias("age_buy")))


def policy_grid(products: DataFrame, params: Params) -> DataFrame:
    """Product grid: every cell x policy years 1..(terminal_age - age_buy), with the
    cell constants (t_age, bpp, nursing_age, interest_rate, sa), attained age and whatever
    else the products carry.

    The year range is a per-row generator, not a range join against a series table.
    """
    ta = params.terminal_age
    return (products
            .withColumn("policy_year", F.explode(F.sequence(F.lit(1), (ta - F.col("age_buy")).cast("int"))))
            .select("sex", "ppp", "age_buy",
                    F.lit(params.nursing_age).cast("smallint").alias("nursing_age"),
                    F.lit(params.interest_rate).alias("interest_rate"),
                    F.lit(params.sa).alias("sa"),
                    F.lit(ta).cast("smallint").alias("t_age"),
                    (ta - F.col("age_buy")).cast("smallint").alias("bpp"),
                    F.col("policy_year").cast("smallint").alias("policy_year"),
                    (F.col("age_buy") + F.col("policy_year") - 1).cast("smallint").alias("age"),
                    *[F.col(c) for c in products.columns if c not in ("sex", "ppp", "age_buy")]))
