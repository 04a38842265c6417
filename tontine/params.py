"""Product assumptions: one immutable parameter set.

The values are the product's published assumptions and must stay as they are
for results to agree.  Only interest_rate, interest_rate_cv, sa,
mortratio_prem_0, disability_ratio, nursing_ratio and nursing_age enter the
calculations; the others are carried for completeness of the parameter table.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Params:
    # Fixed values (product assumptions), in their natural order.
    interest_rate: float = 0.035
    interest_rate_cv: float = 0.055
    acci_qx: float = 0.0004
    rdr: float = 0.115
    sa: float = 10000.0
    average_size: float = 1.0
    mortratio_prem_0: float = 1.0
    mortratio_rsv_0: float = 1.0
    mortratio_cv_0: float = 1.0
    ci_ratio: float = 1.0
    b_time1_b: int = 6
    b_time1_t: int = 59
    b_ratio_1: float = 0.1
    b_time2_b: int = 60
    b_time2_t: int = 106
    b_ratio_2: float = 0.1
    mb_time: int = 70
    mb_ration: float = 0.2
    rb_per: float = 0.7
    tb_per: float = 0.7
    disability_ratio: float = 1.0
    nursing_ratio: float = 0.1
    nursing_age: int = 75
    # Product shape (also fixed): cover ends at this age, entry ages start here,
    # the last entry age is max_entry_end - ppp, the payment terms offered,
    # and the cash-value ramp coefficient (applied as written in the product sheet).
    terminal_age: int = 106
    min_entry_age: int = 18
    max_entry_end: int = 70
    payment_terms: tuple = field(default=(10, 15, 20, 30))
    sexes: tuple = field(default=("M", "F"))
    rt_slope: float = 0.8
    # "null": a sum over an empty exclusive frame (last policy year) stays null, as
    # the product sheet computes it; "zero": it counts as 0.
    empty_frame: str = "null"

    def grid_row_bound(self) -> int:
        """Upper bound of rows of the product grid (sex x ppp x entry age x year)."""
        rows = 0
        for ppp in self.payment_terms:
            for age in range(self.min_entry_age, self.max_entry_end - ppp + 1):
                rows += self.terminal_age - age
        return rows * len(self.sexes)

    def group_bound(self) -> int:
        """Upper bound of product cells (sex, ppp, age_buy)."""
        return len(self.sexes) * sum(
            self.max_entry_end - ppp - self.min_entry_age + 1 for ppp in self.payment_terms)

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The one-row parameter table (23 assumption columns), built JVM-side."""
        from tontine.operators.grid import literal_rows
        d = asdict(self)
        cols = list(d)[:23]
        types = ["int" if isinstance(d[c], int) else "double" for c in cols]
        return literal_rows(spark, [tuple(d[c] for c in cols)], cols, types)


DEFAULT = Params()
