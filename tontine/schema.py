"""Declared table types and by-name conformance.

Stage outputs are quantised to their declared types at the stage boundary
(decimal HALF_UP rounding), as a warehouse insert would do, and read back as
double for further arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

_D12 = "decimal(17,12)"
_D7 = "decimal(8,7)"
_P7 = "decimal(17,7)"
_M2 = "decimal(12,2)"


def _cols(spec: str) -> list[tuple[str, str]]:
    out = []
    for part in spec.split(";"):
        part = part.strip()
        if part:
            name, typ = part.split(None, 1)
            out.append((name, typ.strip()))
    return out


_HEAD = "age_buy smallint; nursing_age smallint; sex string; t_age smallint; ppp smallint; bpp smallint"
_VEC12 = ";".join(f"{c} {_D12}" for c in
                  "qx kx qx_d qx_ci dx_d dx_ci lx lx_d cx cx_ ci_cx ci_cx_ dx dx_d_".split())
_VEC7 = ";".join(f"{c} {_D7}" for c in
                 "qx kx qx_d qx_ci dx_d dx_ci lx lx_d cx cx_ ci_cx ci_cx_ dx dx_d_".split())

DDL: dict[str, list[tuple[str, str]]] = {
    # ODS
    "mort_10_13": _cols("age smallint;" + ";".join(f"cl{i} decimal(10,8)" for i in range(1, 7))),
    "dd_table": _cols("age smallint; male decimal(10,8); female decimal(10,8); "
                      "k_male decimal(10,8); k_female decimal(10,8)"),
    "pre_add_exp_ratio": _cols("ppp smallint;" + ";".join(
        f"{c} decimal(10,8)" for c in "r1 r2 r3 r4 r5 r6_ r_avg r_max".split())),
    "prem_std_real": _cols("age_buy smallint; sex string; ppp smallint; bpp string; "
                           "prem decimal(14,6); nbev decimal(10,8)"),
    "prem_cv_real": _cols("age_buy smallint; sex string; ppp smallint; prem_cv decimal(15,7)"),
    "area": _cols("id smallint; province string; city string; direction string"),
    "policy_client": _cols("user_id string; name string; id_card string; phone string; sex string; "
                           "birthday string; province string; city string; direction string; income int"),
    "policy_benefit": _cols("pol_no string; user_id string; ppp string; age_buy bigint; "
                            "buy_datetime string; insur_name string; insur_code string; "
                            "pol_flag smallint; elapse_date string"),
    "claim_info": _cols("pol_no string; user_id string; buy_datetime string; insur_code string; "
                        "claim_date string; claim_item string; claim_mnt decimal(35,6)"),
    "policy_surrender": _cols("pol_no string; user_id string; buy_datetime string; "
                              "keep_days smallint; elapse_date string"),
    # DW
    "prem_src": _cols(_HEAD + "; interest_rate decimal(6,4); sa decimal(12,2); policy_year smallint; "
                      "age smallint;" + _VEC12 + "; ppp_ smallint; bpp_ smallint; "
                      f"expense {_D12}; db1 {_D12}; db2_factor {_D12}; db2 {_D12}; db3 {_D12}; "
                      f"db4 decimal(5,2); db5 {_D12}"),
    "prem_std": _cols("age_buy smallint; sex string; ppp smallint; bpp string; prem decimal(14,6)"),
    "cv_src": _cols(_HEAD + "; interest_rate_cv decimal(6,4); sa decimal(12,2); policy_year smallint; "
                    "age smallint;" + _VEC7 + "; ppp_ smallint; bpp_ smallint; "
                    f"expense {_D7}; db1 {_M2}; db2_factor {_D7}; db2 {_M2}; db3 {_M2}; db4 {_M2}; "
                    f"db5 {_M2}; np_ {_M2}; pvnp {_P7}; pvdb1 {_P7}; pvdb2 {_P7}; pvdb3 {_P7}; "
                    f"pvdb4 {_P7}; pvdb5 {_P7}; pvr {_P7}; rt decimal(6,3); np {_P7}; "
                    f"sur_ben {_P7}; cv_1a {_P7}; cv_1b {_P7}; cv_2 {_P7}"),
    "prem_cv": _cols("age_buy smallint; sex string; ppp smallint; prem_cv decimal(15,7)"),
    "rsv_src": _cols(_HEAD + "; interest_rate decimal(6,4); sa decimal(12,2); policy_year smallint; "
                     "age smallint;" + _VEC7 + "; ppp_ smallint; bpp_ smallint; "
                     f"db1 {_M2}; db2_factor {_D7}; db2 {_M2}; db3 {_M2}; db4 {_M2}; db5 {_M2}; "
                     f"np_ {_M2}; pvnp {_P7}; pvdb1 {_P7}; pvdb2 {_P7}; pvdb3 {_P7}; pvdb4 {_P7}; "
                     f"pvdb5 {_P7}; prem_rsv {_P7}; alpha {_P7}; beta {_P7}; rsv1 {_P7}; "
                     f"rsv2 {_P7}; rsv1_re {_P7}; rsv2_re {_P7}"),
    # APP (scale-0 decimals of the original declaration are given their intended scale)
    "policy_actuary": _cols("age_buy smallint; sex string; ppp smallint; bpp smallint; "
                            "policy_year smallint; sa decimal(12,2); cv_1a decimal(17,7); "
                            "cv_1b decimal(17,7); sur_ben decimal(17,7); np decimal(17,7); "
                            "rsv2_re decimal(17,7); rsv1_re decimal(17,7); np_ decimal(12,2)"),
    "policy_result": _cols("pol_no string; user_id string; name string; sex string; birthday string; "
                           "ppp string; age_buy bigint; buy_datetime string; insur_name string; "
                           "insur_code string; province string; city string; direction string; "
                           "bpp smallint; policy_year smallint; sa decimal(12,2); cv_1a decimal(17,7); "
                           "cv_1b decimal(17,7); sur_ben decimal(17,7); np decimal(17,7); "
                           "rsv2_re decimal(17,7); rsv1_re decimal(17,7); np_ decimal(12,2); "
                           "prem_std decimal(14,6); prem_thismonth decimal(14,6)"),
    "app_agg_month_incre_rate": _cols("prem decimal(24,6); last_prem decimal(24,6); "
                                      "prem_incre_rate decimal(8,6)"),
    "app_agg_month_first_of_total_prem": _cols("first_prem decimal(24,6); total_prem decimal(24,6); "
                                               "first_of_total_prem decimal(8,6)"),
    "app_agg_month_rate_eff13": _cols("insur_code string; insur_name string; rate_eff13 decimal(8,6)"),
    "app_agg_month_premperpol": _cols("insur_code string; insur_name string; prem_per_pol decimal(38,2)"),
    "app_agg_month_cooloff_surr": _cols("insur_code string; insur_name string; cooloff decimal(26,6); "
                                        "cnt_all decimal(24,6); cooloff_rate decimal(8,6)"),
    "app_agg_month_surr_rate": _cols("insur_code string; insur_name string; cnt_surr decimal(26,6); "
                                     "cnt_all decimal(24,6); surr_rate decimal(8,6)"),
    "app_agg_month_mort_dis_rate": _cols("insur_code string; insur_name string; age int; sg_cnt bigint; "
                                         "sc_cnt bigint; all_cnt bigint; sg_rate decimal(8,6); "
                                         "sc_rate decimal(8,6)"),
    "app_agg_month_dir": _cols("direction string; sum_users bigint; sum_prem decimal(24,6); "
                               "sum_cv_1b decimal(27,2); sum_sur_ben decimal(27,2); "
                               "sum_rsv2_re decimal(27,2)"),
    "app_agg_month_nbev": _cols("insur_code string; insur_name string; nbev decimal(38,11)"),
    "app_agg_month_high_net_rate": _cols("high_net_rate decimal(8,6)"),
}

# Column descriptions (attached as StructField metadata "comment").
COMMENTS: dict[str, str] = {
    "age": "attained age", "age_buy": "age at purchase", "sex": "M or F", "ppp": "premium payment term (years)",
    "bpp": "benefit period (years)", "t_age": "terminal age of cover", "nursing_age": "end age of nursing benefit",
    "policy_year": "policy year (1 = first)", "interest_rate": "pricing/reserving interest rate",
    "interest_rate_cv": "cash-value interest rate", "sa": "basic sum assured",
    "qx": "mortality rate", "kx": "share of deaths after disability", "qx_d": "mortality net of disability",
    "qx_ci": "disability (critical illness) rate", "lx": "policies in force", "lx_d": "healthy lives",
    "dx_d": "healthy deaths", "dx_ci": "disabilities", "cx": "discounted deaths", "cx_": "cx mid-year adjusted",
    "ci_cx": "discounted disabilities", "ci_cx_": "ci_cx mid-year adjusted", "dx": "discounted survivors",
    "dx_d_": "discounted healthy survivors", "ppp_": "1 within payment term", "bpp_": "1 within cover",
    "expense": "expense loading", "db1": "disability benefit", "db2_factor": "nursing benefit factor",
    "db2": "nursing benefit", "db3": "elderly care benefit", "db4": "death benefit", "db5": "premium waiver factor",
    "prem": "annual premium", "prem_cv": "cash-value gross premium", "np_": "net premium", "pvnp": "PV of net premiums",
    "pvdb1": "PV of disability benefit", "pvdb2": "PV of nursing benefit", "pvdb3": "PV of care benefit",
    "pvdb4": "PV of death benefit", "pvdb5": "PV of premium waiver", "pvr": "policy value reserve",
    "rt": "cash-value ramp", "np": "smoothed net premium", "sur_ben": "survival benefit",
    "cv_1a": "year-end cash value before survival benefit", "cv_1b": "year-end cash value after survival benefit",
    "cv_2": "mid-year cash value", "prem_rsv": "net level premium (reserve)", "alpha": "modified first-year premium",
    "beta": "modified renewal premium", "rsv1": "year-end reserve", "rsv2": "start-of-year reserve",
    "rsv1_re": "year-end reserve floored by cash value", "rsv2_re": "start-of-year reserve floored by cash value",
    "pol_no": "policy number", "user_id": "client id", "buy_datetime": "purchase date (ISO text)",
    "insur_code": "product code", "insur_name": "product name", "pol_flag": "1 in force, 0 surrendered",
    "elapse_date": "surrender date (ISO text)", "keep_days": "days held before surrender",
    "claim_date": "claim date (ISO text)", "claim_item": "claim item code", "claim_mnt": "claim amount",
    "income": "annual income", "direction": "region", "prem_thismonth": "premium due in the report month",
    "nbev": "new-business embedded value ratio",
}

MONTH_PARTITIONED = {k for k in DDL if k.startswith("app_agg_month") or k == "policy_result"}


def struct(name: str, comments: bool = False) -> StructType:
    """Declared StructType of a table (with column comments as metadata if asked)."""
    return StructType([StructField(c, _parse_datatype_string(t), True,
                                   {"comment": COMMENTS[c]} if comments and c in COMMENTS else None)
                       for c, t in DDL[name]])


# Declared columns that the given inputs cannot supply; they are null in the written tables.
NOT_SUPPLIED = {"policy_client": ("id_card", "phone")}


def conform(df: DataFrame, name_or_struct, overflow: str = "error", missing: tuple[str, ...] = ()) -> DataFrame:
    """Select the declared columns by name and cast them to the declared types.

    A value that does not fit raises an error, as ANSI casts do; only with
    ``overflow="null"`` it becomes null (``try_cast``).  A declared column that the frame
    does not have is an error too, unless it is listed in ``missing``: those are typed nulls.
    """
    if isinstance(name_or_struct, str):
        pairs = DDL[name_or_struct]
    else:
        pairs = [(f.name, f.dataType.simpleString()) for f in name_or_struct.fields]
    fn = "try_cast" if overflow == "null" else "cast"
    have = set(df.columns)
    unknown = [c for c, _ in pairs if c not in have and c not in missing]
    if unknown:
        raise ValueError(f"no column {', '.join(unknown)}")
    return df.selectExpr(*[f"{fn}(`{c}` as {t}) as `{c}`" if c in have else f"cast(null as {t}) as `{c}`"
                           for c, t in pairs])


def as_double(df: DataFrame, exclude=()) -> DataFrame:
    """Read a conformed stage back with decimals as double for further arithmetic."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "decimal" and f.name not in exclude:
            out.append(f"cast(`{f.name}` as double) as `{f.name}`")
        else:
            out.append(f"`{f.name}`")
    return df.selectExpr(*out)


# Report scales of the detail keys.  Stage tables keep their declared scale;
# reports of them round long factors to 9 and money amounts to 4 decimals, a
# scale at which the last-bit differences of floating-point summation order
# between engines cannot show.
REPORT_SCALES = {"decimal(17,12)": "decimal(17,9)", "decimal(17,7)": "decimal(17,4)"}


def report_types(name: str) -> list[tuple[str, str]]:
    return [(c, REPORT_SCALES.get(t, t)) for c, t in DDL[name]]


def report(df: DataFrame, name: str) -> DataFrame:
    """Project a stage table to its report scales (extra columns such as ``month`` kept)."""
    types = dict(report_types(name))
    return df.selectExpr(*[f"cast(`{c}` as {types[c]}) as `{c}`" if c in types and types[c] != t else f"`{c}`"
                           for c, t in [(c, dict(DDL[name]).get(c)) for c in df.columns]])
