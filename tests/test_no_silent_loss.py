"""Values that do not fit are errors, long keys stay whole, and an overwritten month holds just its rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tontine.schema import conform
from tontine.sources.delimited import read_delimited
from tontine.sources.fixtures import POL_NO_SQL
from tontine.sources.sinks import write_month

SCHEMA = StructType([StructField("a", IntegerType()), StructField("b", IntegerType())])


def test_policy_numbers_of_long_keys_stay_distinct(spark):
    keys = spark.range(1500).select((F.col("id") * 10_000_019 + 15_000_000_000).alias("o_orderkey"))
    keys = keys.unionByName(spark.range(1, 50).withColumnRenamed("id", "o_orderkey"))
    got = keys.selectExpr(f"{POL_NO_SQL} as p").agg(F.countDistinct("p"), F.min(F.length("p"))).first()
    assert tuple(got) == (1549, 10)


def test_conform_fails_on_overflow_and_unknown_columns(spark):
    big = spark.createDataFrame([(2**40, 1)], "a long, b long")
    with pytest.raises(Exception, match="(?i)overflow|cast"):
        conform(big, SCHEMA).collect()
    assert conform(big, SCHEMA, overflow="null").first().a is None
    with pytest.raises(ValueError, match="b"):
        conform(big.select("a"), SCHEMA)
    assert conform(big.select(F.lit(1).alias("a")), SCHEMA, missing=("b",)).first().b is None


def test_delimited_read_fails_on_bad_values(spark, tmp_path):
    path = str(tmp_path / "t.tsv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("1\t2\nx\t3\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        read_delimited(spark, path, SCHEMA).collect()
    assert [r.a for r in read_delimited(spark, path, SCHEMA, mode="PERMISSIVE").collect()] == [1, None]


def test_overwriting_a_month_with_nothing_empties_it(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).withColumn("v", F.lit(1))
    for month in ("2000-01", "2000-02"):
        write_month(rows, path, month)
    write_month(rows.limit(0), path, "2000-02")
    got = {r.month: r["count"] for r in spark.read.parquet(path).groupBy("month").count().collect()}
    assert {str(k)[:7]: v for k, v in got.items()} == {"2000-01": 10}
