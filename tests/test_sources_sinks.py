"""Sinks and connectors: month partitions, self-overwrite, delimited text, JDBC (in-process Derby)."""

import os
import tempfile

from pyspark.sql import functions as F

from tontine.operators.quality import reconcile_counts, relative_diff_check
from tontine.schema import conform, struct
from tontine.sources import fixtures
from tontine.sources.delimited import read_delimited, write_delimited
from tontine.sources.jdbc import export_jdbc, ingest_jdbc, read_jdbc
from tontine.sources.sinks import partitions, rewrite_table, write_month

SF = "/root/testdata/sf0.001"


def test_month_overwrite_keeps_other_months(spark):
    path = os.path.join(tempfile.mkdtemp(dir="/tmp"), "t")
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    write_month(df, path, "2000-01")
    write_month(df, path, "2000-02")
    write_month(df.where("id < 3"), path, "2000-02")     # replace one month
    write_month(df.where("id < 3"), path, "2000-02")     # idempotent re-run
    got = {r.month: r.n for r in partitions(spark.read.parquet(path)).collect()}
    assert got == {"2000-01": 10, "2000-02": 3}


def test_rewrite_from_self(spark):
    path = os.path.join(tempfile.mkdtemp(dir="/tmp"), "s")
    fixtures.policy_surrender(spark, SF).write.parquet(path)
    new = rewrite_table(spark, path, lambda t: t.where("keep_days <= 20"))
    assert spark.read.parquet(new).where("keep_days > 20").count() == 0
    assert spark.read.parquet(new).count() == spark.read.parquet(path).where("keep_days <= 20").count()


def test_delimited_round_trip(spark):
    path = os.path.join(tempfile.mkdtemp(dir="/tmp"), "d")
    src = fixtures.policy_benefit(spark, SF)
    write_delimited(src, path)
    back = read_delimited(spark, path, struct("policy_benefit"))
    assert back.schema == struct("policy_benefit")
    assert back.exceptAll(conform(src, "policy_benefit")).count() == 0
    assert back.count() == src.count()


def test_jdbc_round_trip(spark):
    url = "jdbc:derby:memory:tontine_test;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    area = fixtures.area(spark, SF)
    export_jdbc(area, url, "AREA_T", props)
    assert read_jdbc(spark, url, "AREA_T", props).count() == area.count()
    root = tempfile.mkdtemp(dir="/tmp")
    rec = ingest_jdbc(spark, url, ["AREA_T"], props, root, partition_by={"AREA_T": ("ID", 0, 25, 3)}).first()
    assert rec.matched and rec.source_cnt == 25


def test_conform_overflow_modes(spark):
    from pyspark.sql.types import DecimalType, StructField, StructType
    df = spark.createDataFrame([(1.234,), (123456.0,)], "x double")
    st = StructType([StructField("x", DecimalType(5, 2))])
    assert [r.x for r in conform(df, st, overflow="null").collect()][1] is None


def test_quality_checks(spark):
    a = spark.createDataFrame([(1, 100.0), (2, 100.0)], "k int, v double")
    b = spark.createDataFrame([(1, 100.05), (2, 99.0)], "k int, v double")
    assert relative_diff_check(a, b, ["k"], "v").count() == 1
    assert relative_diff_check(a, b, ["k"], "v", two_sided=False).count() == 1
    assert relative_diff_check(b, a, ["k"], "v", two_sided=False).count() == 0
    r = reconcile_counts(a, b).first()
    assert r.matched and r.source_cnt == 2
