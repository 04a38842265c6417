"""The layers as catalog databases: checked inserts, months, drift."""

import pytest
from pyspark.sql import functions as F

from tontine.plans.monthly import run_month, write_warehouse
from tontine.plans.warehouse import LAYERS, SchemaDrift, Warehouse
from tontine.schema import COMMENTS, DDL, struct

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def held(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), f"t{abs(hash(str(tmp_path))) % 10**9}_")
    w.register()
    yield w
    w.drop()


def test_all_declared_tables_are_registered_with_comments(spark, held):
    assert [len(v) for v in LAYERS.values()] == [10, 5, 12]
    for layer, names in LAYERS.items():
        assert {t.name for t in spark.catalog.listTables(f"{held.prefix}{layer}")} == set(names)
    fields = {f.name: f for f in held.read("prem_src").schema.fields}
    assert fields["qx"].metadata["comment"] == COMMENTS["qx"] and held.months("policy_result") == []
    assert [f.name for f in held.read("policy_result").schema.fields][-1] == "month"


def test_warehouse_and_months_through_the_catalog(spark, held):
    write_warehouse(spark, SF, held.root, catalog=held)
    for name in (*LAYERS["ods"], *LAYERS["dw"]):
        assert held.read(name).schema.simpleString() == struct(name).simpleString() and held.read(name).count() > 0
    for month in ("2000-03", "2000-04", "2000-04"):
        written = run_month(spark, SF, month, held.root, catalog=held)
    assert len(written) == 12
    for name in LAYERS["app"]:
        if name != "policy_actuary":
            assert held.months(name) == ["2000-03", "2000-04"], name
    again = Warehouse(spark, held.root, held.prefix + "again_")          # a catalog that does not know them
    again.register()
    try:
        again.check(files=True)
        assert again.months("policy_result") == ["2000-03", "2000-04"]
        assert again.read("policy_result").count() == held.read("policy_result").count() > 0
    finally:
        again.drop()
    assert held.read("policy_result").count() > 0                        # the files stay


def test_drift_is_an_error_before_anything_is_written(spark, held):
    good = spark.range(5).selectExpr("cast(id as smallint) as id", "'p' as province", "'c' as city", "'d' as direction")
    held.insert(good, "area")
    for bad, said in ((good.drop("city"), "no city"), (good.withColumn("extra", F.lit(1)), "undeclared extra"),
                      (good.withColumn("id", F.array(F.lit(1))), "area")):
        with pytest.raises(SchemaDrift, match=said):
            held.insert(bad, "area")
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        held.insert(good.withColumn("id", F.lit(100_000)), "area")
    assert held.read("area").count() == 5
    held.insert(good.select("direction", "city", "id", "province"), "area")            # by name, not by place
    assert held.read("area").where("id = 3 and direction = 'd'").count() == 1
    with pytest.raises(ValueError, match="partitioned by month"):
        held.insert(good, "policy_result")


def test_a_changed_table_or_file_is_found(spark, held):
    spark.sql(f"ALTER TABLE {held.table('area')} ADD COLUMNS (more int)")
    with pytest.raises(SchemaDrift, match="area: the catalog differs .* more"):
        held.check()
    spark.range(3).selectExpr("id as age").write.parquet(held.path("mort_10_13"))
    held.drop()
    held.register()
    with pytest.raises(SchemaDrift, match="mort_10_13: the files differ"):
        held.check(files=True)
    assert len(DDL) == 27
