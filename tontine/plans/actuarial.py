"""The actuarial stage tables of one run, built once and materialised.

prem_src -> prem_std -> (prem_std_real) -> prem_cv / cv_src -> rsv_src -> policy_actuary.
Each is bounded by the product grid (<= Params.grid_row_bound() rows, whatever
the policy volume).  The warehouse stage tables (prem_src, prem_std, prem_cv,
cv_src, rsv_src) and the actuarial table that every policy join broadcasts are
written once under the shared checkpoint folder and re-read (lineage cut); the
cheap derivations (golden prices) stay plans.
Products are all cells on offer, with the policies sold of each.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tontine.params import DEFAULT, Params
from tontine.plans import cashvalue, premium, reserve
from tontine.schema import conform
from tontine.sources.sinks import materialize
from tontine.sources.stages import StageStore
from tontine.sources.tables import version

_RUNS: dict = {}


@dataclass
class Actuarial:
    spark: SparkSession
    sf_dir: str
    params: Params = DEFAULT
    how: str = "write"
    store: StageStore | None = None
    _t: dict = field(default_factory=dict)

    def _get(self, name, build, how: str | None = None):
        """Stage ``name``: materialised (DW tables) or kept as a plan (cheap derivations)."""
        if name not in self._t:
            if self.store and not how:
                self._t[name] = self.store.table(name, build, inputs(self.sf_dir), self.params)
            else:
                self._t[name] = materialize(build(), how or self.how, name)
        return self._t[name]

    @property
    def products(self) -> DataFrame:
        return self._get("products", lambda: premium.products_from_inputs(self.spark, self.sf_dir, self.params))

    @property
    def prem_src(self) -> DataFrame:
        return self._get("prem_src", lambda: premium.prem_src(self.spark, self.products, self.params))

    @property
    def prem_std(self) -> DataFrame:
        return self._get("prem_std", lambda: premium.prem_std(self.spark, params=self.params, src=self.prem_src))

    @property
    def prem_std_real(self) -> DataFrame:
        return self._get("prem_std_real", lambda: premium.golden_premium(self.prem_std), "none")

    @property
    def cv_base(self) -> DataFrame:
        """Steps 13-16 (read by step 17 and by steps 19-23).  Kept as a plan: on the
        bounded grid recomputing it inside each reader's stage is cheaper than a
        write, a re-read and a second exchange."""
        if "cv_base" not in self._t:
            self._t["cv_base"] = cashvalue.cv_steps_13_16(self.prem_src, self.params)
        return self._t["cv_base"]

    @property
    def prem_cv(self) -> DataFrame:
        return self._get("prem_cv", lambda: cashvalue.prem_cv_table(self.prem_src, self.prem_std, self.params,
                                                                     base=self.cv_base))

    @property
    def prem_cv_real(self) -> DataFrame:
        return self._get("prem_cv_real", lambda: premium.golden_cv_premium(self.prem_cv), "none")

    @property
    def cv_src(self) -> DataFrame:
        return self._get("cv_src", lambda: conform(
            cashvalue.cv_detail(self.prem_src, self.prem_std, self.params, self.prem_cv, base=self.cv_base),
            "cv_src"))

    @property
    def rsv_src(self) -> DataFrame:
        return self._get("rsv_src", lambda: reserve.rsv_src(self.prem_src, self.prem_std_real,
                                                             self.cv_src, self.params))

    @property
    def policy_actuary(self) -> DataFrame:
        from tontine.plans.marts import policy_actuary
        return self._get("policy_actuary", lambda: policy_actuary(self.cv_src, self.rsv_src))


def forget(spark: SparkSession) -> None:
    """Drop the runs of a session (their stage tables are gone)."""
    for key in [k for k in _RUNS if k[:2] == (spark.sparkContext.applicationId, id(spark))]:
        del _RUNS[key]


def inputs(sf_dir: str) -> list[str]:
    """The files that the stages are made from."""
    return [os.path.join(sf_dir, f"{t}.parquet") for t in ("orders", "customer", "nation", "region")]


def run(spark: SparkSession, sf_dir: str, params: Params = DEFAULT, how: str = "write", store: StageStore | None = None) -> Actuarial:
    """The stage tables for ``sf_dir`` (one per session, version of the input files and parameter set).  With
    a ``store`` they are shared with other sessions: what one has built, the next reads."""
    versions = tuple(version(spark, p) for p in inputs(sf_dir))
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, versions, params, how, store.root if store else None)
    if key not in _RUNS:
        _RUNS[key] = Actuarial(spark, sf_dir, params, how, store)
    return _RUNS[key]
