"""The 33 numbered steps of the pricing model as separate report queries.

Every step's output columns are columns of a stage table (prem_src, prem_std,
prem_cv, cv_src, rsv_src), so a step query is the cell key, the policy year and
the columns that step adds, read from the materialised stage.  Steps 11 and 17
are the per-cell commutation sums, recomputed from the stage they read.
"""

from __future__ import annotations

KEY = ["sex", "ppp", "age_buy", "policy_year"]
CELL = ["age_buy", "sex", "ppp"]

# step -> (stage table, columns added by the step)
STEPS: dict[str, tuple[str, list[str]]] = {
    "prem_s01": ("prem_src", ["ppp_", "bpp_"]),
    "prem_s02": ("prem_src", ["qx", "kx", "qx_ci"]),
    "prem_s03": ("prem_src", ["qx_d"]),
    "prem_s04": ("prem_src", ["lx"]),
    "prem_s05": ("prem_src", ["lx_d", "dx_d", "dx_ci"]),
    "prem_s06": ("prem_src", ["cx"]),
    "prem_s07": ("prem_src", ["cx_", "ci_cx"]),
    "prem_s08": ("prem_src", ["ci_cx_", "dx", "dx_d_"]),
    "prem_s09": ("prem_src", ["expense", "db1", "db2_factor"]),
    "prem_s10": ("prem_src", ["db2", "db3", "db4", "db5"]),
    "prem_s11": ("prem_sums", ["T11", "V11", "W11", "Q11", "T9", "V9", "S11", "X11", "Y11"]),
    "prem_s12": ("prem_std", ["bpp", "prem"]),
    "cv_s13": ("cv_src", ["interest_rate_cv", "age", "lx", "lx_d", "cx"]),
    "cv_s14": ("cv_src", ["cx_", "ci_cx"]),
    "cv_s15": ("cv_src", ["ci_cx_", "dx", "dx_d_"]),
    "cv_s16": ("cv_src", ["db2", "db5"]),
    "cv_s17": ("cv_sums", ["T11", "V11", "W11", "Q11", "T9", "V9", "S11", "X11", "Y11"]),
    "cv_s18": ("prem_cv", ["prem_cv"]),
    "cv_s19": ("cv_src", ["np_", "pvnp", "pvdb1", "pvdb2", "pvdb3", "pvdb4", "pvdb5"]),
    "cv_s20": ("cv_src", ["pvr", "rt"]),
    "cv_s21": ("cv_src", ["np", "sur_ben", "cv_1b"]),
    "cv_s22": ("cv_src", ["cv_1a"]),
    "cv_s23": ("cv_src", ["cv_2"]),
    "rsv_s24": ("rsv_src", ["db1", "db2", "db3", "db4", "db5"]),
    "rsv_s25": ("rsv_src", ["pvdb1", "pvdb2", "pvdb3", "pvdb4", "pvdb5"]),
    "rsv_s26": ("rsv_src", ["prem_rsv"]),
    "rsv_s27": ("rsv_src", ["alpha"]),
    "rsv_s28": ("rsv_src", ["beta"]),
    "rsv_s29": ("rsv_src", ["np_"]),
    "rsv_s30": ("rsv_src", ["pvnp"]),
    "rsv_s31": ("rsv_src", ["rsv1"]),
    "rsv_s32": ("rsv_src", ["rsv2"]),
    "rsv_s33": ("rsv_src", ["rsv1_re", "rsv2_re"]),
}

SUM_TYPE = "decimal(20,9)"


def step_query(a, name: str):
    """Spark DataFrame of one step from the run's stage tables ``a`` (plans.actuarial.Actuarial)."""
    from tontine.plans.premium import commutation_sums
    from tontine.schema import as_double, report
    stage, cols = STEPS[name]
    if stage == "prem_sums":
        s = commutation_sums(as_double(a.prem_src), a.params.interest_rate)
        return s.selectExpr(*CELL, *[f"cast({c} as {SUM_TYPE}) as {c}" for c in cols])
    if stage == "cv_sums":
        s = commutation_sums(a.cv_base, a.params.interest_rate_cv)
        return s.selectExpr(*CELL, *[f"cast({c} as {SUM_TYPE}) as {c}" for c in cols])
    df = getattr(a, stage)
    keys = CELL if stage in ("prem_std", "prem_cv") else KEY
    return report(df.select(*keys, *cols), stage)
