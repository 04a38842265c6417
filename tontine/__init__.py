"""tontine — actuarial pricing, valuation and monthly KPIs as Spark DataFrame jobs.

Layout:
  params       the product assumptions (one frozen dataclass)
  schema       declared table types and by-name conformance
  sources/     fixture tables derived from the input parquet, delimited text, JDBC, sinks
  functions/   small Column builders (tail sums, survival products, month arithmetic)
  operators/   reusable DataFrame -> DataFrame operators (grid, recurrences, joins, checks)
  plans/       the pipeline stages: premium, cash value, reserve, marts, KPIs, preparation
"""

from tontine.params import Params

__all__ = ["Params"]
