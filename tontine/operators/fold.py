"""Ordered folds within keys whose step is more than affine.

``ordered_fold`` takes steps that compose: a row's step is a map of the state given by a few
numbers, and two maps after one another are a map of the same kind (``Clamp``, ``MaxPlus``).
Rows are range-partitioned on (key, order) as in ``operators.scan``: every run is reduced to
one map by doubling, a key's runs are chained by their maps, and each row applies its own map
to the state its run starts from.  A key of any size is spread over the partitions it fills.

``sequential_fold`` takes any step, a plain function of state and row.  Such a step has to see
a key's rows one after another, so the state is handed from run to run: all runs that begin
their key go at once, then, wave by wave, the runs whose predecessor is done.  Most keys lie
within one partition and end in the first wave; a key over m partitions takes m waves, each a
written table, so a lost executor repeats one run and not the key.

Null steps: a null change is 0, a null bound is no bound, a null seed is 0.  Keys are compared
null-safely; ``order`` must be total within a key; an empty table gives an empty result.
States are doubles, exact for whole numbers below 2^53 (cents, for money).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from tontine.operators.scan import PID, _count, _edge_runs, _edges, _ending, _key, _ranges, _same_as_previous, _with_carries
from tontine.sources.sinks import materialize, stage_dir

_INF = float("inf")


class Clamp:
    """x -> max(lo, min(hi, x + change)): a balance with a floor and a ceiling."""

    states, width = 1, 3

    def __init__(self, change: str, lo: str = "null", hi: str = "null") -> None:
        self.expressions = [change, lo, hi]
        self.defaults = [0.0, -_INF, _INF]

    def compose(self, first: np.ndarray, then: np.ndarray) -> np.ndarray:
        low = first[:, 1] + then[:, 0]                     # the composed map's values at both ends
        ends = [low, np.maximum(low, first[:, 2] + then[:, 0])]
        lo, hi = (np.maximum(then[:, 1], np.minimum(then[:, 2], e)) for e in ends)
        return np.column_stack([first[:, 0] + then[:, 0], lo, hi])

    def constant(self, state: np.ndarray) -> np.ndarray:
        return np.column_stack([np.zeros(len(state)), state[:, 0], state[:, 0]])

    def apply(self, maps: np.ndarray, state: np.ndarray) -> np.ndarray:
        return np.maximum(maps[:, 1], np.minimum(maps[:, 2], state[:, 0] + maps[:, 0]))[:, None]

    def column(self, maps: Column, state: Column) -> list[Column]:
        return [F.greatest(maps[1], F.least(maps[2], state[0] + maps[0]))]


class MaxPlus:
    """x_i -> max(c_i, max_j(a_ij + x_j)) of k coupled states: best scores, longest runs.  ``a`` is k rows
    of k SQL expressions and ``c`` k of them; null stands for minus infinity, a way that is not there."""

    def __init__(self, a: Sequence[Sequence[str]], c: Sequence[str]) -> None:
        self.states = k = len(c)
        self.width = k * k + k
        self.expressions = [*[e for row in a for e in row], *c]
        self.defaults = [-_INF] * self.width

    def _parts(self, maps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = self.states
        return maps[:, :k * k].reshape(-1, k, k), maps[:, k * k:]

    def compose(self, first: np.ndarray, then: np.ndarray) -> np.ndarray:
        (a, c), (b, d) = self._parts(first), self._parts(then)
        both = (b[:, :, :, None] + a[:, None, :, :]).max(axis=2)
        rest = np.maximum(d, (b + c[:, None, :]).max(axis=2))
        return np.concatenate([both.reshape(len(both), -1), rest], axis=1)

    def constant(self, state: np.ndarray) -> np.ndarray:
        return np.concatenate([np.full((len(state), self.states**2), -_INF), state], axis=1)

    def apply(self, maps: np.ndarray, state: np.ndarray) -> np.ndarray:
        a, c = self._parts(maps)
        return np.maximum(c, (a + state[:, None, :]).max(axis=2))

    def column(self, maps: Column, state: Column) -> list[Column]:
        k = self.states
        return [F.greatest(maps[k * k + i], *[maps[i * k + j] + state[j] for j in range(k)]) for i in range(k)]


def _scanned(maps, rows: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Each row's map composed from its run's start on (``place``: rows of the run before it), by doubling."""
    out, reach = rows.copy(), 1
    while reach <= (place.max() if len(place) else 0):
        at = np.flatnonzero(place >= reach)
        out[at] = maps.compose(out[at - reach], out[at])
        reach *= 2
    return out


def _lists(x: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(x).ravel()), x.shape[1]).cast(pa.list_(pa.float64()))


def _fold_runs(keys: list[str], maps, inner: list[str], schema: T.StructType):
    """Of each sorted partition: ``_map`` from the run's start to the row, ``_seeded`` (the states if the key
    starts with the run) and whether the row ends its run.  Other columns pass through as they are."""
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held = None, None                           # (key, map, seeded) and the row before
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = [batch.column(c) for c in keys]
            head = [c[0].as_py() for c in key]
            goes_on = state is not None and state[0] == head
            new = np.append(not goes_on, ~_same_as_previous(key)) if n > 1 else np.array([not goes_on])
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            place = np.arange(n) - start
            m = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in inner])
            own, seed = m[:, :maps.width], m[:, maps.width:]
            seeds = own.copy()
            seeds[new] = maps.constant(seed[new])          # a run that starts its key starts at the seed
            whole, seeded = _scanned(maps, own, place), _scanned(maps, seeds, place)
            states = maps.apply(seeded, np.zeros((n, maps.states)))
            if goes_on:                                    # the first run began in an earlier batch
                first = np.flatnonzero(start == 0)
                states[first] = maps.apply(whole[first], np.repeat(state[2][None], len(first), axis=0))
                whole[first] = maps.compose(np.repeat(state[1][None], len(first), axis=0), whole[first])
            state = ([c[n - 1].as_py() for c in key], whole[-1], states[-1])
            made = {"_map": _lists(whole), "_seeded": _lists(states), "_ends": pa.array(np.append(new[1:], False))}
            out = pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in names], names=names)
            if held is not None:
                yield _ending(held, bool(new[0]))
            yield out.slice(0, n - 1)
            held = out.slice(n - 1)
        if held is not None:
            yield _ending(held, True)
    return run


def _chained(maps):
    """The state that each of a key's runs starts from: one pass over the runs, in order."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(PID)
        whole, seeded = (np.array(table.column(c).to_pylist(), float) for c in ("_map", "_seeded"))
        x, starts = None, []
        for k in range(len(whole)):
            starts.append(None if x is None else x[0].tolist())
            x = seeded[k:k + 1] if x is None else maps.apply(whole[k:k + 1], x)
        return pa.table([table.column(PID), table.column("_is_lo"), table.column("_is_hi"), pa.array(starts, pa.list_(pa.float64()))],
                        names=[PID, "_is_lo", "_is_hi", "_start"])
    return run


def ordered_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], step: Clamp | MaxPlus, seed: Sequence[str],
                 out: Sequence[str], partitions: int | None = None) -> DataFrame:
    """The states after each row along ``order`` within ``keys``: the first row's are ``seed`` (SQL
    expressions), every later row applies its step; ``out`` names the states' columns."""
    given = [*zip(step.expressions, step.defaults, strict=True), *[(s, 0.0) for s in seed]]
    inner = [f"_e{i}" for i in range(len(given))]
    work = df.withColumns({c: F.coalesce(F.expr(e).cast("double"), F.lit(d)) for c, (e, d) in zip(inner, given, strict=True)})
    sorted_rows = _ranges(work, keys, order, partitions).sortWithinPartitions(*keys, *order)
    vector = T.ArrayType(T.DoubleType())
    schema = T.StructType([*[f for f in sorted_rows.schema.fields if f.name not in inner], T.StructField("_map", vector),
                           T.StructField("_seeded", vector), T.StructField("_ends", T.BooleanType())])
    local = materialize(sorted_rows.mapInArrow(_fold_runs(list(keys), step, inner, schema), schema), name="fold-runs")
    edges = _edges(local, keys)
    runs = _edge_runs(local.where("_ends"), edges, keys).select(PID, "_k", "_is_lo", "_is_hi", "_map", "_seeded")
    # the runs of one key: at most one row a partition
    carries = runs.groupBy("_k").applyInArrow(_chained(step), f"{PID} int, _is_lo boolean, _is_hi boolean, _start array<double>")
    rows = _with_carries(local, edges, carries, F.col("_start"), keys, _count(df, partitions))
    moved = step.column(F.col("_map"), F.col("_c"))
    return rows.withColumns({c: F.when(F.col("_c").isNull(), F.col("_seeded")[i]).otherwise(moved[i])
                             for i, c in enumerate(out)}).drop("_c", "_map", "_seeded", "_ends", PID)


# ---------------------------------------------------------------- steps that do not compose
def _stepped(keys: list[str], inputs: list[str], step: Callable, first: Callable, names: list[str], schema: pa.Schema):
    """Of each sorted partition: the state after every row, a run starting from ``_start`` (null: a new key)."""
    passed = [n for n in schema.names if n not in (*names, "_ends")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, held = None, None, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = list(zip(*[batch.column(c).to_pylist() for c in [PID, *keys]], strict=True))
            rows = zip(*[batch.column(c).to_pylist() for c in inputs], strict=True)
            start = batch.column("_start").to_pylist()
            states, new = [], []
            for k, (this, row) in enumerate(zip(key, rows, strict=True)):
                new.append(this != now)
                if this != now:
                    now, state = this, tuple(start[k].values()) if start[k] is not None else None
                state = first(*row) if state is None else step(state, *row)
                states.append(state)
            made = dict(zip(names, zip(*states, strict=True), strict=True)) | {"_ends": [*new[1:], False]}
            out = pa.RecordBatch.from_arrays([batch.column(c) if c in passed else pa.array(made[c], schema.field(c).type)
                                              for c in schema.names], schema=schema)
            if held is not None:
                yield _ending(held, new[0])
            yield out.slice(0, n - 1)
            held = out.slice(n - 1)
        if held is not None:
            yield _ending(held, True)
    return run


def sequential_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], inputs: Sequence[str], first: Callable, step: Callable,
                    state: str, partitions: int | None = None) -> DataFrame:
    """The state after each row for any step: ``first(*inputs)`` gives a key's first state and
    ``step(state, *inputs)`` every later one, as tuples of the columns that ``state`` declares (a DDL
    string); ``inputs`` are SQL expressions.  Both functions run in the tasks, one row at a time."""
    spark = df.sparkSession
    state_type = T.StructType.fromDDL(state)
    names = [f.name for f in state_type.fields]
    given = [f"_i{k}" for k in range(len(inputs))]
    work = df.withColumns({c: F.expr(e) for c, e in zip(given, inputs, strict=True)})
    tagged = materialize(_ranges(work, keys, order, partitions), name="fold-rows")
    edges = _edges(tagged, keys)
    # a partition's first and last key, with how many earlier partitions hold that key: one or two rows a partition
    sides = edges.select(PID, F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("_k"))
    turns = sides.withColumn("_turn", F.row_number().over(Window.partitionBy("_k").orderBy(PID)) - 1)
    of = turns.groupBy(PID).agg(F.map_from_entries(F.collect_list(F.struct(F.col("_k"), F.col("_turn")))).alias("_turns"))
    k = _key(keys)
    root = os.path.join(stage_dir(spark), f"fold-waves-{uuid.uuid4().hex}")
    placed = tagged.join(of, PID).withColumn("_turn", F.coalesce(F.try_element_at("_turns", k), F.lit(0))).drop("_turns")
    placed.write.partitionBy("_turn").parquet(root)        # a wave reads its own folder
    last = turns.agg(F.max("_turn")).first()[0]
    schema = T.StructType([*tagged.schema.fields, T.StructField("_start", state_type)])
    out_schema = T.StructType([*[f for f in tagged.schema.fields if f.name not in given], *state_type.fields, T.StructField("_ends", T.BooleanType())])
    run = _stepped(list(keys), given, step, first, names, to_arrow_schema(out_schema))
    done, before = [], None
    n = _count(df, partitions)
    for turn in range((last if last is not None else 0) + 1):
        rows = spark.read.schema(tagged.schema).parquet(os.path.join(root, f"_turn={turn}")) if last is not None else tagged
        if before is None:
            rows = rows.withColumn("_start", F.lit(None).cast(state_type))
        else:                                              # the states of the run before, at most one a partition
            rows = rows.withColumn("_k", k).join(before, F.col("_k") == F.col("_of"), "left").drop("_k", "_of")
        rows = rows.select(*schema.names).repartition(n, PID).sortWithinPartitions(PID, *keys, *order)
        wave = materialize(rows.mapInArrow(run, out_schema), name=f"fold-wave-{turn}")
        before = wave.where("_ends").select(k.alias("_of"), F.struct(*names).alias("_start"))
        if turn == 0:                                      # keys that end in their partition hand nothing on
            before = before.join(turns.where("_turn = 1").select(F.col("_k").alias("_goes_on")), F.col("_of") == F.col("_goes_on"), "left_semi")
        done.append(wave)
    out = done[0]
    for wave in done[1:]:
        out = out.unionByName(wave)
    return out.drop("_ends", PID)
