"""Queries of the storage operators: loads with reject tables, versioned tables, metadata inventory,
months that keep their state between runs."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tontine.functions.dates import month_shift
from tontine.operators.joins import broadcast_bounded
from tontine.operators.numbering import Numbering
from tontine.plans import kpi
from tontine.plans.monthly import write_warehouse
from tontine.plans.warehouse import LAYERS, Warehouse
from tontine.sources import fixtures
from tontine.sources.rejects import load, read_delimited_raw
from tontine.sources.sinks import inventory, stage_dir, write_month, write_months
from tontine.sources.tables import table
from tontine.sources.versioned import VersionedTable


def _folder(spark: SparkSession, name: str) -> str:
    return os.path.join(stage_dir(spark), f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- loads with rejects
ORDER_TYPES = "o_orderkey int, o_totalprice decimal(7,2), o_orderpriority string"


def _conformed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders into a table whose price column is too narrow for large orders."""
    given = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "cast(o_totalprice as decimal(18,2)) as o_totalprice", "o_orderpriority")
    return load(given, T.StructType.fromDDL(ORDER_TYPES), _folder(spark, "orders-loaded"))


def conform_table(spark, sf_dir) -> DataFrame:
    """Rows that fit the declared types."""
    return _conformed(spark, sf_dir)[0]


def conform_rejects(spark, sf_dir) -> DataFrame:
    """Rows that do not, with column, raw value and reason."""
    bad = _conformed(spark, sf_dir)[1]
    return bad.select(F.col("raw")["o_orderkey"].alias("o_orderkey"), F.explode("reasons").alias("e")).select("o_orderkey", "e.*")


LINE_TYPES = "l_orderkey bigint, l_linenumber int, l_quantity decimal(7,2), l_shipdate date, l_returnflag string"


def _loaded_lines(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Lines as tab-separated text with faults by key: a date that is none, a price word, a lost field, a field too many."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "date_format(l_shipdate, 'yyyy-MM-dd') as d", "l_returnflag as f",
        "cast(cast(l_quantity as decimal(7,2)) as string) as q")
    text = lines.selectExpr("""concat_ws('\t', cast(l_orderkey as string), cast(l_linenumber as string),
        case when l_partkey % 23 = 0 then 'ten' else q end,
        case when l_partkey % 29 = 0 then '1998-13-01' else d end,
        case when l_partkey % 31 = 0 then null else f end, case when l_partkey % 37 = 0 then 'more' end) as value""")
    path = _folder(spark, "lines-text")
    text.write.text(path)
    types = T.StructType.fromDDL(LINE_TYPES)
    return load(read_delimited_raw(spark, path, types), types, _folder(spark, "lines-loaded"))


def delimited_table(spark, sf_dir) -> DataFrame:
    """Lines of text that fit the declared fields and types."""
    return _loaded_lines(spark, sf_dir)[0]


def delimited_rejects(spark, sf_dir) -> DataFrame:
    """How many values of every column were rejected, and why, and the least and greatest raw value."""
    bad = _loaded_lines(spark, sf_dir)[1].select(F.explode("reasons").alias("e")).select("e.*")
    return bad.groupBy("column", "reason").agg(F.count(F.lit(1)).alias("n"), F.min("raw").alias("least_raw"), F.max("raw").alias("greatest_raw"))


# ---------------------------------------------------------------- a table rewritten from itself
def overwrite_from_self(spark, sf_dir) -> DataFrame:
    """Surrenders replaced by the early ones of them, under the same name."""
    held = VersionedTable(spark, _folder(spark, "policy_surrender"))
    held.write(fixtures.policy_surrender(spark, sf_dir))
    held.rewrite(lambda t: t.where(F.col("keep_days") <= 20))
    held.remove_old()
    return held.read()


# ---------------------------------------------------------------- months
def due_table(spark, sf_dir, calc_month: str, price: DataFrame) -> str:
    """Premium due of every month since the first purchase, a partition a month, the report month written once
    more (static overwrite); returns its path."""
    path = _folder(spark, "premium_due")
    write_months(kpi.premium_due(spark, sf_dir, None, calc_month, price), path)
    write_month(kpi.premium_due(spark, sf_dir, calc_month, calc_month, price), path, calc_month)
    return path


def partition_overwrite_static(spark, sf_dir, calc_month: str, price: DataFrame) -> DataFrame:
    return spark.read.parquet(due_table(spark, sf_dir, calc_month, price)).groupBy("month").agg(
        F.expr("count(1) as n"), F.expr("cast(sum(prem_thismonth) as decimal(24,6)) as prem"))


def partition_inventory(spark, sf_dir, calc_month: str, price: DataFrame) -> DataFrame:
    """Rows of every month, from the files' footers."""
    return inventory(spark, due_table(spark, sf_dir, calc_month, price)).withColumn("month", F.col("month").cast("string"))


GROWTH = "prem decimal(24,6), last_prem decimal(24,6), prem_incre_rate decimal(10,4), month string"


def _exists(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def growth_table(spark, path: str) -> DataFrame:
    """The months that runs have written so far."""
    return spark.read.schema(GROWTH).parquet(path) if _exists(spark, path) else spark.createDataFrame([], GROWTH)


def run_growth_month(spark, sf_dir, month: str, price: DataFrame, path: str) -> None:
    """One month's run: only its own premiums are computed; the previous month's total is what its run left in
    the table (none: null).  A run of a month that is there replaces its row and no other, so running it again
    changes nothing, and after late purchases the months that they fall into are run again, in order."""
    before = growth_table(spark, path).where(F.col("month") == month_shift(month, -1)).select(
        F.lit(None).cast("decimal(14,6)").alias("prem_thismonth"), F.col("prem").alias("last_prem"))
    now = kpi.premium_due(spark, sf_dir, month, month, price).select("prem_thismonth", F.lit(None).cast("decimal(24,6)").alias("last_prem"))
    row = now.unionByName(before).agg(F.expr("cast(sum(prem_thismonth) as decimal(24,6)) as prem"),
                                      F.expr("cast(max(last_prem) as decimal(24,6)) as last_prem"))
    write_month(row.withColumn("prem_incre_rate", F.expr(
        "cast(try_divide(cast(prem - last_prem as double), cast(last_prem as double)) as decimal(10,4))")), path, month)


def premium_growth_incremental(spark, sf_dir, calc_month: str, price: DataFrame) -> DataFrame:
    """Two months run one after the other, each from what the earlier run has left."""
    path = _folder(spark, "app_agg_month_incre_rate")
    for month in (month_shift(calc_month, -1), calc_month):
        run_growth_month(spark, sf_dir, month, price, path)
    return growth_table(spark, path).where(F.col("month") == calc_month).drop("month")


# ---------------------------------------------------------------- numbers of new rows only
#: Fixed values of the stand-in deliveries: purchases before these days, each with those sent before.
DELIVERIES = ("1997-01-01", "1999-07-01", "2100-01-01")


def policy_number_incremental(spark, sf_dir) -> DataFrame:
    """Policies delivered three times, each delivery with all earlier ones in it, the last one sent twice."""
    policies = fixtures.policy_benefit(spark, sf_dir).select("pol_no", "buy_datetime")
    held = Numbering(spark, _folder(spark, "policy-numbers"), "pol_no", order=["buy_datetime"])
    for day in (*DELIVERIES, DELIVERIES[-1]):
        held.assign(policies.where(F.col("buy_datetime") < day))
    return held.rows.read().select("pol_no", F.expr(
        "concat('P', lpad(cast(number as string), greatest(9, length(cast(number as string))), '0'))").alias("new_pol_no"))


def client_id_incremental(spark, sf_dir) -> DataFrame:
    """Clients numbered in their area, in two deliveries: those of even customer numbers, then all."""
    area = fixtures.area(spark, sf_dir).select(F.col("id").alias("area_id"), "province")
    clients = (fixtures.policy_client(spark, sf_dir).select("user_id", "province")
               .join(broadcast_bounded(area, fixtures.NATION_ROWS_BOUND), "province").select(F.col("user_id").cast("long").alias("client"), "area_id"))
    held = Numbering(spark, _folder(spark, "client-numbers"), "client", keys=["area_id"])
    held.assign(clients.where("client % 2 = 0"))
    held.assign(clients)
    return held.rows.read().select(F.col("client").cast("string").alias("user_id"), "area_id", F.concat_ws("-", "area_id", "number").alias("client_id"))


def warehouse_catalog(spark, sf_dir) -> DataFrame:
    """Rows and columns of every input and detail table, written and read through the catalog."""
    root = _folder(spark, "warehouse")
    held = Warehouse(spark, root, f"w{uuid.uuid4().hex[:12]}_")
    held.register()
    write_warehouse(spark, sf_dir, root, catalog=held)
    counted = None
    for layer in ("ods", "dw"):
        for name in LAYERS[layer]:
            one = held.read(name)
            row = one.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
                                                                   F.lit(len(one.columns)).alias("n_columns"), "n_rows")
            counted = row if counted is None else counted.unionByName(row)
    return counted
