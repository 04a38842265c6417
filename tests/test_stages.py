"""Stages shared by sessions: the second builds nothing, a changed input, parameter or plan builds again."""

import os
import shutil
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from tontine.params import Params
from tontine.plans import actuarial
from tontine.sources.stages import StageStore, plan_text

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(100).write.parquet(path)
    return path


def test_built_once_and_again_when_what_it_is_made_from_changes(spark, table, tmp_path):
    store, built = StageStore(spark, str(tmp_path / "store")), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            built.add(b.num_rows)
            yield b
    make = lambda m=3: spark.read.parquet(table).where(F.col("id") % m == 0).mapInArrow(counted, "id long")
    first = store.table("some", make, [table], Params())
    assert first.count() == 34 and built.value == 34
    assert store.table("some", make, [table], Params()).count() == 34 and built.value == 34 and len(store.stages()) == 1
    store.table("some", make, [table], Params(interest_rate=0.01))
    assert built.value == 68 and len(store.stages()) == 2                  # another parameter
    store.table("some", lambda: make(2), [table], Params())
    assert built.value == 118                                              # another plan
    spark.range(100, 103).write.mode("append").parquet(table)
    assert store.table("some", make, [table], Params()).count() == 35 and built.value == 153
    store.table("other", make, [table], Params())
    assert len(store.stages()) == 5


def test_two_builders_of_one_stage(spark, table, tmp_path):
    store = StageStore(spark, str(tmp_path / "store"))
    make = lambda: spark.read.parquet(table)
    real, raced = store._publish, []

    def late(draft, path):
        if not raced:
            raced.append(StageStore(spark, store.root).table("s", make, [table]).count())
        real(draft, path)
    store._publish = late
    assert store.table("s", make, [table]).count() == 100 and raced == [100] and len(store.stages()) == 1
    assert not [n for n in os.listdir(store.root) if n.startswith("_draft")]


def test_unused_stages_are_removed_by_age(spark, table, tmp_path):
    store = StageStore(spark, str(tmp_path / "store"))
    for k in (1, 2):
        store.table(f"s{k}", lambda: spark.read.parquet(table), [table])
    assert store.remove_unused(3600) == []
    time.sleep(2.5)
    store.table("s2", lambda: spark.read.parquet(table), [table])
    assert [n[:2] for n in store.remove_unused(2)] == ["s1"] and [n[:2] for n in store.stages()] == ["s2"]
    assert StageStore(spark, str(tmp_path / "none")).stages() == []


def test_plan_text_does_not_depend_on_the_order_of_building(spark, table):
    one = spark.read.parquet(table).select((F.col("id") + 1).alias("x"))
    spark.range(5).select("id").collect()
    assert plan_text(one) == plan_text(spark.read.parquet(table).select((F.col("id") + 1).alias("x")))
    assert plan_text(one) != plan_text(spark.read.parquet(table).select((F.col("id") + 2).alias("x")))


def test_a_second_session_builds_no_actuarial_stage(spark, tmp_path):
    """Another process with a session of its own, then a change of an input table."""
    data, root = tmp_path / "data", str(tmp_path / "store")
    data.mkdir()
    for t in ("orders", "customer", "nation", "region"):
        shutil.copyfile(os.path.join(SF, f"{t}.parquet"), data / f"{t}.parquet")
    mine = actuarial.run(spark, str(data), store=StageStore(spark, root))
    rows = sorted(map(tuple, mine.prem_std.collect()))
    before = StageStore(spark, root).stages()
    assert {n.rsplit("-", 1)[0] for n in before} == {"products", "prem_src", "prem_std"}
    code = (f"from tontine.session import get_session; from tontine.plans import actuarial; from tontine.sources.stages import StageStore\n"
            f"s = get_session('local[2]', 4); r = actuarial.run(s, {str(data)!r}, store=StageStore(s, {root!r}))\n"
            f"print('prices', r.prem_std.count(), len(StageStore(s, {root!r}).stages())); s.stop()")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    assert f"prices {len(rows)} {len(before)}" in out
    spark.read.parquet(os.path.join(SF, "orders.parquet")).limit(500).coalesce(1).write.parquet(str(tmp_path / "o"))
    (part,) = [f for f in os.listdir(tmp_path / "o") if f.endswith(".parquet")]
    shutil.copyfile(tmp_path / "o" / part, data / "orders.parquet")
    changed = actuarial.run(spark, str(data), store=StageStore(spark, root))
    assert changed.products.agg(F.sum("n_policies")).first()[0] < mine.products.agg(F.sum("n_policies")).first()[0]
    assert len(StageStore(spark, root).stages()) == len(before) + 1
