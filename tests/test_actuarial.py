"""Product grid size, spot prices and invariants of the premium / cash value / reserve chain."""

import pytest
from pyspark.sql import functions as F

from tontine.operators.grid import all_products, policy_grid
from tontine.params import DEFAULT
from tontine.plans import cashvalue, marts, premium, reserve
from tontine.schema import as_double


@pytest.fixture(scope="module")
def chain(spark):
    src = premium.prem_src(spark).persist()
    std = premium.prem_std(spark, src=src).persist()
    real = premium.golden_premium(std).persist()
    cv = cashvalue.cv_src(src, std).persist()
    rsv = reserve.rsv_src(src, real, cv).persist()
    return dict(src=src, std=std, real=real, cv=cv, rsv=rsv)


def test_grid_cardinality(spark):
    g = policy_grid(all_products(spark, DEFAULT), DEFAULT)
    assert g.count() == 19338 == DEFAULT.grid_row_bound()
    assert g.select("sex", "ppp", "age_buy").distinct().count() == 274 == DEFAULT.group_bound()


def test_spot_premiums(chain):
    got = {(r.age_buy, r.sex, r.ppp): float(r.prem) for r in chain["std"].collect()}
    assert len(got) == 274
    assert round(got[(18, "M", 10)], 4) == 142.7315
    assert round(got[(60, "F", 10)], 4) == 1927.3457
    assert round(got[(40, "M", 30)], 4) == 237.3947
    assert min(got.values()) > 0


def test_survival_invariants(chain):
    d = as_double(chain["src"])
    assert d.where("lx <= 0 or lx > 1 or lx_d > 1 or lx_d < 0").count() == 0
    w = __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("sex", "ppp", "age_buy").orderBy("policy_year")
    assert d.withColumn("nxt", F.lead("lx").over(w)).where("nxt > lx").count() == 0


def test_cash_value_shape(chain):
    cv = chain["cv"]
    assert cv.count() == 19338 + 274
    assert cv.where("cv_1b is null or cv_1b < 0").count() == 0
    assert cv.where("cv_1a is null").count() == 274          # last year of each cell
    assert cv.where("pvr is null and policy_year > 0").count() == 2 * 274   # empty exclusive frame


def test_reserve_invariants(chain):
    r = as_double(chain["rsv"])
    assert r.count() == 19338
    assert r.where("rsv1 is null").count() == 2 * 274
    assert r.where("rsv1_re < rsv1 - 1e-9").count() == 0
    y1 = r.where("policy_year = 1 and beta <= prem").selectExpr(
        "abs(pvdb1 + pvdb2 + pvdb3 + pvdb4 + pvdb5 - pvnp) as gap")
    assert y1.agg(F.max("gap")).first()[0] < 1e-4       # quantised at 7 decimals


def test_reserve_forms_agree(spark, chain):
    grp = reserve.reserve_factors_by_group(chain["src"], chain["real"])
    win = as_double(chain["rsv"]).where("policy_year = 1").select(
        "age_buy", "sex", "ppp", F.col("prem_rsv").alias("w_p"), F.col("alpha").alias("w_a"),
        F.col("beta").alias("w_b"))
    j = grp.join(win, ["age_buy", "sex", "ppp"])
    assert j.count() == 274
    assert j.where("abs(prem_rsv - w_p) > 1e-6 or abs(alpha - w_a) > 1e-6 or abs(beta - w_b) > 1e-6").count() == 0


def test_policy_actuary_and_region_totals(spark, chain):
    pa = marts.policy_actuary(chain["cv"], chain["rsv"])
    assert pa.count() == 19338
    pr = marts.policy_result(spark, "/root/testdata/sf0.001", "2000-04", pa, chain["real"])
    from tontine.plans.kpi import kpi_region
    reg = kpi_region(pr).agg(F.sum("sum_users").alias("u"), F.sum("sum_prem").alias("p")).first()
    tot = pr.agg(F.count("user_id").alias("u"), F.sum("prem_thismonth").alias("p")).first()
    assert (reg.u, reg.p) == (tot.u, tot.p)


def test_empty_frame_zero_option(spark):
    from dataclasses import replace
    p = replace(DEFAULT, empty_frame="zero")
    d = premium.premium_detail(spark, params=p)
    assert d.where("db5 is null").count() == 0
    a = {(r.age_buy, r.sex, r.ppp): r.prem for r in premium.prem_std(spark, params=p).collect()}
    b = {(r.age_buy, r.sex, r.ppp): r.prem for r in premium.prem_std(spark).collect()}
    assert a == b            # a zero instead of a null adds nothing to the commutation sums


def test_reserve_floor_by_cash_value(chain):
    r = as_double(chain["rsv"]).select("age_buy", "sex", "ppp", "policy_year", "rsv1_re")
    c = as_double(chain["cv"]).select("age_buy", "sex", "ppp", "policy_year", "cv_1a")
    j = r.join(c, ["age_buy", "sex", "ppp", "policy_year"])
    assert j.where("rsv1_re is not null and cv_1a is not null and rsv1_re < cv_1a - 1e-9").count() == 0
