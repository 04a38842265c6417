"""Ordered-window Column builders for projection vectors.

A projection vector is the ordered run of rows ``order`` (policy year) inside
one key (a product cell).  Builders return Columns made from one SQL
expression each (cheap to build, evaluated in Spark's Window operator, no
Python per row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def _by(keys: Sequence[str]) -> str:
    return ", ".join(keys)


def tail_sum_sql(x: str, keys: Sequence[str], order: str = "policy_year") -> str:
    """Sum of ``x`` from this row to the end of the vector.

    A running sum in descending order (one pass, O(n)); an ascending
    ``current row .. unbounded following`` frame would re-sum per row.
    """
    return (f"sum({x}) over (partition by {_by(keys)} order by {order} desc "
            f"rows between unbounded preceding and current row)")


def tail_sum_exclusive_sql(x: str, keys: Sequence[str], order: str = "policy_year") -> str:
    """Sum of ``x`` over strictly later rows; null on the last row (empty frame)."""
    return (f"sum({x}) over (partition by {_by(keys)} order by {order} desc "
            f"rows between unbounded preceding and 1 preceding)")


def group_total_sql(x: str, keys: Sequence[str]) -> str:
    """Whole-vector sum beside every row (no ordering)."""
    return f"sum({x}) over (partition by {_by(keys)})"


def lead_sql(x: str, keys: Sequence[str], order: str = "policy_year") -> str:
    return f"lead({x}) over (partition by {_by(keys)} order by {order})"


def lag_sql(x: str, keys: Sequence[str], order: str = "policy_year") -> str:
    return f"lag({x}) over (partition by {_by(keys)} order by {order})"


def tail_sum(x: str, keys: Sequence[str], order: str = "policy_year") -> Column:
    return F.expr(tail_sum_sql(x, keys, order))


def tail_sum_exclusive(x: str, keys: Sequence[str], order: str = "policy_year") -> Column:
    return F.expr(tail_sum_exclusive_sql(x, keys, order))


def group_total(x: str, keys: Sequence[str]) -> Column:
    return F.expr(group_total_sql(x, keys))


def lead(x: str, keys: Sequence[str], order: str = "policy_year") -> Column:
    return F.expr(lead_sql(x, keys, order))


def lag(x: str, keys: Sequence[str], order: str = "policy_year") -> Column:
    return F.expr(lag_sql(x, keys, order))


def survival(q: str, keys: Sequence[str], order: str = "policy_year") -> Column:
    """l_1 = 1, l_t = l_{t-1} * (1 - q_{t-1}): product of (1 - q) over earlier rows.

    A product, not exp(sum(log)), so q = 1 (certain decrement) is exact.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.product(F.expr(f"1 - ({q})")).over(w), F.lit(1.0))


def multi_decrement(q_a: str, q_b: str, keys: Sequence[str], order: str = "policy_year") -> Column:
    """Two competing decrements from one population.

    l_1 = 1; l_t = l_{t-1} - d^a_{t-1} - d^b_{t-1}; d^a = l * q_a; d^b = l * q_b.
    Since d^a + d^b = l * (q_a + q_b), l is the survival product of q_a + q_b.
    Returns a struct column (l, d_a, d_b).
    """
    l = survival(f"({q_a}) + ({q_b})", keys, order)
    return F.struct(l.alias("l"), (l * F.expr(q_a)).alias("d_a"), (l * F.expr(q_b)).alias("d_b"))


def with_sql(df, cols: dict):
    """``withColumns`` from SQL expression text (one parse per column)."""
    return df.withColumns({k: (F.expr(v) if isinstance(v, str) else v) for k, v in cols.items()})
