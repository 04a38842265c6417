"""Versioned tables, loads with rejects, metadata inventory, months that keep their state."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tontine.plans import actuarial, kpi, storage
from tontine.sources.rejects import LINE, checked, load, read_delimited_raw
from tontine.sources.sinks import _PUSHED, counted_by_footer, inventory, write_month
from tontine.sources.versioned import VersionConflict, VersionedTable

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.id for r in df.collect())


def test_rewrite_keeps_the_name_and_queries_in_flight_keep_their_version(spark, tmp_path):
    held = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        held.read()
    assert held.write(spark.range(10).toDF("id")) == 1
    before = held.read()                                   # a query in flight
    assert held.rewrite(lambda t: t.where("id % 2 = 0")) == 2
    assert ids(held.read()) == [0, 2, 4, 6, 8] and ids(before) == list(range(10))
    assert ids(VersionedTable(spark, held.path).read()) == [0, 2, 4, 6, 8]
    held.rewrite(lambda t: t.where("false"))
    assert ids(held.read()) == [] and held.read().columns == ["id"] and ids(held.read(1)) == list(range(10))
    assert held.remove_old(keep=2) == 1 and held.versions() == [2, 3]
    assert sum(n.startswith("data-") for n in os.listdir(held.path)) == 2
    with pytest.raises(ValueError):
        held.remove_old(keep=0)


def test_a_failed_rewrite_leaves_the_old_rows(spark, tmp_path):
    held = VersionedTable(spark, str(tmp_path / "t"))
    held.write(spark.range(5).toDF("id"))
    with pytest.raises(Exception, match="broken"):
        held.rewrite(lambda t: t.withColumn("x", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).cast("string")))
    assert held.versions() == [1] and ids(held.read()) == list(range(5))
    held.rewrite(lambda t: t.where("id < 2"))
    assert ids(held.read()) == [0, 1]


def test_of_two_writers_one_is_told(spark, tmp_path):
    held = VersionedTable(spark, str(tmp_path / "t"))
    held.write(spark.range(5).toDF("id"))

    def slow(t):
        VersionedTable(spark, held.path).rewrite(lambda other: other.where("id = 4"))     # meanwhile, elsewhere
        return t.where("id = 1")
    with pytest.raises(VersionConflict):
        held.rewrite(slow)
    assert ids(held.read()) == [4] and held.versions() == [1, 2]
    assert not [n for n in os.listdir(os.path.join(held.path, "_versions")) if "draft" in n and not n.endswith(".crc")]


@pytest.fixture(scope="module")
def types(spark):
    return T.StructType.fromDDL("a int, b decimal(5,2), c date, d string, e boolean")


def test_good_and_rejected_rows_are_the_input(spark, types, tmp_path):
    rows = [("1", "2.345", "2020-02-29", "x", "true"), ("1.5", "x", "2021-02-29", None, "maybe"), (None, None, None, None, None),
            ("99999999999", "1000", "2020-01-01", "", "false"), ("", " 7 ", "2020-01-01", "y", "1")]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "a string, b string, c string, d string, e string, extra int")
    good, bad = load(df, types, str(tmp_path / "t"))
    assert good.schema == types and good.count() + bad.count() == len(rows)
    assert sorted(map(str, good.collect())) == sorted(map(str, df.where("extra in (0, 2)").selectExpr(
        "cast(a as int) a", "cast(b as decimal(5,2)) b", "cast(c as date) c", "d", "cast(e as boolean) e").collect()))
    reasons = {r.raw["a"]: {(e.column, e.raw, e.reason) for e in r.reasons} for r in bad.collect()}
    assert reasons == {"1.5": {("a", "1.5", "does not fit int"), ("b", "x", "is no decimal(5,2)"), ("c", "2021-02-29", "is no date"),
                               ("e", "maybe", "is no boolean")},
                       "99999999999": {("a", "99999999999", "does not fit int"), ("b", "1000", "does not fit decimal(5,2)")},
                       "": {("a", "", "is no int")}}
    good, bad = load(df, types, str(tmp_path / "u"), required=["d"])
    assert good.count() == 1 and {e.reason for r in bad.collect() for e in r.reasons if e.column == "d"} == {"is missing"}


def test_load_of_an_empty_table_and_of_one_kind(spark, tmp_path):
    df = spark.createDataFrame([("1",), ("2",)], "a string")
    one = T.StructType.fromDDL("a int")
    for name, given, want in (("none", df.where("false"), (0, 0)), ("good", df, (2, 0)), ("bad", df.selectExpr("'x' as a"), (0, 2))):
        good, bad = load(given, one, str(tmp_path / name))
        assert (good.count(), bad.count()) == want and good.schema == one
    with pytest.raises(ValueError, match="no column b"):
        checked(df, T.StructType.fromDDL("a int, b int"))


def test_lines_with_a_wrong_number_of_fields(spark, types, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([("1\t2.5\t2020-01-01\tx\ttrue",), ("1\t2.5",), ("2\t3\t2020-01-01\ty\tfalse\tmore",), ("\\N\t\\N\t\\N\t\\N\t\\N",)],
                          "value string").coalesce(1).write.text(path)
    raw = read_delimited_raw(spark, path, types)
    good, bad = load(raw, types, str(tmp_path / "t"))
    assert good.count() == 2 and raw.count() == 4 and LINE in raw.columns
    assert {(r.reasons[0].reason, r.reasons[0].raw) for r in bad.collect()} == {
        ("has a wrong number of fields", "1\t2.5"), ("has a wrong number of fields", "2\t3\t2020-01-01\ty\tfalse\tmore")}


def test_load_reads_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(100).selectExpr("if(id % 7 = 0, 'x', cast(id as string)) as a").mapInArrow(count, "a string")
    good, bad = load(df, T.StructType.fromDDL("a int"), str(tmp_path / "t"))
    assert good.count() + bad.count() == 100 and bad.count() == 15 and seen.value == 100


def test_inventory_reads_footers_only(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id", "date_add(date'2000-01-01', cast(id as int)) as d")
    write_month(df, path, "2000-01")
    write_month(df.where("id < 10").repartition(3), path, "2000-02")
    write_month(df, path, "2000-03")
    write_month(df.where("false"), path, "2000-03")        # empty after a re-run
    got = {r.month: tuple(r[1:]) for r in inventory(spark, path, bounds=("id", "d")).collect()}
    want = {r.month: tuple(r[1:]) for r in spark.read.parquet(path).groupBy("month").agg(
        F.count("*"), F.min("id"), F.max("id"), F.min("d"), F.max("d")).collect()}
    assert {m: v for m, v in got.items() if v[0]} == want and set(got) >= {"2000-01", "2000-02"}
    assert got.get("2000-03", (0,))[0] == 0
    keep = {k: spark.conf.get(k, None) for k in _PUSHED}
    try:
        for k, v in _PUSHED.items():
            spark.conf.set(k, v)
        plan = counted_by_footer(spark, path, "month", ("id",))._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in plan and "PushedGroupBy: [month]" in plan
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "Batched: true" in spark.read.parquet(path)._jdf.queryExecution().executedPlan().toString()      # the session reads as before


def test_months_run_one_after_the_other_equal_the_history(spark, tmp_path):
    price = actuarial.run(spark, SF).prem_std_real
    path = str(tmp_path / "growth")
    months = ["2000-02", "2000-03", "2000-04"]
    for m in months:
        storage.run_growth_month(spark, SF, m, price, path)
    table = lambda: {r.month: (r.prem, r.last_prem, r.prem_incre_rate) for r in storage.growth_table(spark, path).collect()}
    history = {r.month: (r.prem, r.last_prem, r.prem_incre_rate) for r in kpi.kpi_premium_growth_history(spark, SF, "2000-04", price).collect()}
    first = table()
    assert set(first) == set(months) and first["2000-02"][0] == history["2000-02"][0] and first["2000-02"][1] is None
    assert [first[m] for m in months[1:]] == [history[m] for m in months[1:]]
    storage.run_growth_month(spark, SF, "2000-03", price, path)          # run again: nothing changes
    assert table() == first
    dearer = price.withColumn("prem", F.col("prem") * 2)                 # later input for one month changes that month alone
    storage.run_growth_month(spark, SF, "2000-03", dearer, path)
    again = table()
    assert again["2000-03"][0] == 2 * first["2000-03"][0] and again["2000-04"] == first["2000-04"]
    storage.run_growth_month(spark, SF, "2000-04", price, path)
    assert table()["2000-04"][1] == again["2000-03"][0]
