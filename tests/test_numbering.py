"""Numbers of new rows only: old numbers never change, none is given twice."""

import random
from collections import Counter, defaultdict

import pytest

from tontine.operators.numbering import Numbering
from tontine.sources.versioned import VersionConflict


def held(numbering):
    return {r["name"]: (r["area"], r["number"]) for r in numbering.rows.read().collect()}


def gapless(found):
    by = defaultdict(list)
    for area, n in found.values():
        by[area].append(n)
    return all(sorted(v) == list(range(1, len(v) + 1)) for v in by.values())


def test_deliveries_repeat_and_overlap(spark, tmp_path):
    rnd = random.Random(31)
    rows = [(f"n{k}", rnd.choice([None, 1, 1, 1, 2, 3]), rnd.randint(0, 50)) for k in range(600)]
    numbering = Numbering(spark, str(tmp_path / "n"), "name", keys=["area"], order=["day"])
    df = lambda some: spark.createDataFrame([*some, (None, 1, 0)], "name string, area int, day int")
    assert numbering.assign(df(rows[:200])) == 200
    first = held(numbering)
    assert gapless(first) and len(first) == 200
    order = {(r[1], r[0]): (r[2], r[0]) for r in rows[:200]}
    for area in (None, 1, 2, 3):                           # in order of day, then name
        names = sorted((n for n, (a, _) in first.items() if a == area), key=lambda n: first[n][1])
        assert names == sorted(names, key=lambda n: order[area, n])
    assert numbering.assign(df(rows[:200])) == 0           # a repeated run
    assert numbering.assign(df(rows[100:600] + rows[100:600])) == 400
    second = held(numbering)
    assert {n: second[n] for n in first} == first and gapless(second) and len(second) == 600
    assert numbering.assign(df([])) == 0 and held(numbering) == second


def test_a_run_that_fails_leaves_a_gap_and_no_number_twice(spark, tmp_path, monkeypatch):
    numbering = Numbering(spark, str(tmp_path / "n"), "name", keys=["area"])
    df = lambda names: spark.createDataFrame([(n, 1) for n in names], "name string, area int")
    numbering.assign(df("ab"))
    with monkeypatch.context() as m:
        def broken(_):
            raise RuntimeError("lost")
        m.setattr(numbering.rows, "append", broken)
        with pytest.raises(RuntimeError):
            numbering.assign(df("abcd"))
    numbering.assign(df("abcde"))
    found = held(numbering)
    assert set(found) == set("abcde") and found["a"] == (1, 1) and found["b"] == (1, 2)
    assert Counter(n for _, n in found.values()).most_common(1)[0][1] == 1 and {found[c][1] for c in "cde"} == {5, 6, 7}


def test_of_two_runs_at_once_one_is_refused(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a",), ("b",)], "name string")
    one, two = (Numbering(spark, str(tmp_path / "n"), "name") for _ in range(2))
    real = one.marks.write

    def late(rows, after):
        two.assign(df)                                     # meanwhile, elsewhere
        return real(rows, after)
    monkeypatch.setattr(one.marks, "write", late)
    with pytest.raises(VersionConflict):
        one.assign(df)
    assert sorted(r.number for r in two.rows.read().collect()) == [1, 2]
