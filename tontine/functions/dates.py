"""Month arithmetic on 'yyyy-MM' report months and ISO date text.

Dates stay ISO text at the table interface (as declared); conversions happen
inside expressions.  The report month is a Python argument, never spliced from
data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_shift(calc_month: str, n: int) -> str:
    """'yyyy-MM' shifted by ``n`` months (n may be negative)."""
    y, m = int(calc_month[:4]), int(calc_month[5:7])
    idx = y * 12 + (m - 1) + n
    return f"{idx // 12:04d}-{idx % 12 + 1:02d}"


def month_start(calc_month: str) -> _dt.date:
    return _dt.date(int(calc_month[:4]), int(calc_month[5:7]), 1)


def month_shift_col(month_text: Column, n: int) -> Column:
    """Column form: ``substr(add_months(m, n), 1, 7)`` for a 'yyyy-MM...' column."""
    first = F.to_date(F.concat(F.substring(month_text, 1, 7), F.lit("-01")))
    return F.date_format(F.add_months(first, n), "yyyy-MM")


def policy_year_sql(calc_month: str, buy_col: str = "buy_datetime", rule: str = "ceil") -> str:
    """Policy year of a purchase at report month ``calc_month`` (SQL text).

    ``ceil``   ceil(months_between(M, buy) / 12)   (0 in the purchase month)
    ``floor1`` floor(months_between(M, buy) / 12) + 1
    """
    mb = f"months_between(date'{month_start(calc_month).isoformat()}', to_date({buy_col}))"
    if rule == "ceil":
        return f"ceil({mb} / 12)"
    if rule == "floor1":
        return f"floor({mb} / 12) + 1"
    raise ValueError(rule)
