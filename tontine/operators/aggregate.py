"""User-defined mergeable aggregates: a declared state, partial states per task, a tree of merges.

A user subclasses ``Aggregator``: the state's and the result's columns as DDL strings,
``initial`` (the state of no rows), ``update`` (a state and a block of one key's rows as Arrow
columns), ``merge`` (two states) and ``evaluate``.  ``merge`` has to be associative and
commutative, with ``initial`` as its neutral state, as for any distributed aggregate.  With
many keys a block holds a row or two, and a Python call a block is what such an aggregate
costs: a subclass may also give ``update_blocks``, ``merge_blocks`` and ``evaluate_all``,
which do the same for the blocks of many keys at once, as Arrow columns (``starts``: the
first row of each block).  Those of this class call the plain ones block by block.

``aggregate`` runs in two phases.  In the scan's tasks ``ROWS`` rows at a time are sorted by
key, cut into blocks and folded into one state a key, held as Arrow columns; a task that
holds more than ``HELD`` keys or ``HELD_BYTES`` hands out its states and goes on, so its memory is
bounded whatever the number of keys.  The states, with the number of
their task, are written and merged level by level, each level merging the states of ``FAN``
neighbouring tasks by a sorted stream: a key that every row has meets as at most ``FAN`` (or
``FAN`` times the hand-outs) states in a task, never as rows.

Keys are compared null-safely; a null value reaches ``update`` as an Arrow null; without keys
the result is one row, of ``initial`` for an empty table; with keys an empty table gives none.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tontine.operators.scan import _same_as_previous
from tontine.sources.sinks import materialize

#: Keys whose states one task holds before it hands them out, and their bytes.
HELD, HELD_BYTES = 1_000_000, 64 << 20
#: Rows that are cut by key at once, and their bytes.
ROWS, ROWS_BYTES = 500_000, 64 << 20
#: States of a key that meet in one task of a merge level.
FAN = 64
STATES_OUT = 10_000


class Aggregator:
    """A mergeable aggregate; states and results are tuples in the order of their columns."""

    state: str                                             # DDL of the state's columns
    result: str                                            # DDL of the result's columns

    def initial(self) -> tuple:
        raise NotImplementedError

    def update(self, state: tuple, rows: dict[str, pa.Array]) -> tuple:
        """The state with a block of rows added, given as one Arrow column an input."""
        raise NotImplementedError

    def merge(self, a: tuple, b: tuple) -> tuple:
        raise NotImplementedError

    def evaluate(self, state: tuple) -> tuple:
        raise NotImplementedError

    def update_blocks(self, rows: dict[str, pa.Array], starts: np.ndarray) -> Sequence:
        """The states of consecutive blocks of rows, one column a field."""
        stops = [*starts[1:], len(next(iter(rows.values()), starts))]
        found = [self.update(self.initial(), {n: v.slice(a, b - a) for n, v in rows.items()}) for a, b in zip(starts, stops, strict=True)]
        return list(zip(*found, strict=True))

    def merge_blocks(self, states: list[pa.Array], starts: np.ndarray) -> Sequence:
        """The merged states of consecutive blocks of states, one column a field."""
        each = list(zip(*[c.to_pylist() for c in states], strict=True))
        found = [functools.reduce(self.merge, each[a:b]) for a, b in zip(starts, [*starts[1:], len(each)], strict=True)]
        return list(zip(*found, strict=True))

    def evaluate_all(self, states: list[pa.Array]) -> Sequence:
        """The results of states, one column a field."""
        return list(zip(*[self.evaluate(s) for s in zip(*[c.to_pylist() for c in states], strict=True)], strict=True))


def _starts(keys: list[pa.Array], n: int) -> np.ndarray:
    """First row of each run of equal keys."""
    return np.concatenate([[0], np.flatnonzero(~_same_as_previous(keys)) + 1]) if keys else np.zeros(1, int)


def _columns(table: pa.Table, n: int, last: int | None = None) -> list[pa.Array]:
    return [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns[n:last]]


def _table(keys: list[pa.Array], starts: np.ndarray, columns: Sequence, schema: pa.Schema) -> pa.Table:
    """The key of each run, and columns of one value a run."""
    first = pa.array(starts)
    given = [*(k.take(first) for k in keys), *columns]
    made = [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type) for c, f in zip(given, schema, strict=True)]
    return pa.Table.from_arrays(made, schema=schema)


def _merge_runs(agg: Aggregator, table: pa.Table, n_keys: int) -> pa.Table:
    """One state for each run of equal keys, which are the first columns."""
    if not table.num_rows:
        return table
    keys = _columns(table, 0, n_keys)
    starts = _starts(keys, table.num_rows)
    if len(starts) == table.num_rows:
        return table
    return _table(keys, starts, agg.merge_blocks(_columns(table, n_keys), starts), table.schema)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to tables of about ROWS rows or ROWS_BYTES."""
    some, rows, size = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        some.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= ROWS or size >= ROWS_BYTES:
            yield pa.Table.from_batches(some)
            some, rows, size = [], 0, 0
    if some:
        yield pa.Table.from_batches(some)


def _partial(agg: Aggregator, keys: list[str], inputs: list[str], names: list[str], schema: pa.Schema, most: int):
    """One state a key and task (or a hand-out of a task with very many keys)."""
    held_schema = pa.schema(list(schema)[:-1])
    order = [(c, "ascending") for c in held_schema.names[:len(keys)]]

    def merged(held: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(held)
        return _merge_runs(agg, table.sort_by(order) if keys else table, len(keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        task, limit = 0, most
        for table in _gathered(batches):
            task = table.column("_task")[0].as_py()
            if keys:
                table = table.sort_by([(c, "ascending") for c in keys])
            of = [table.column(c).combine_chunks() for c in keys]
            starts = _starts(of, table.num_rows)
            values = {name: table.column(c).combine_chunks() for name, c in zip(names, inputs, strict=True)}
            held.append(_table(of, starts, agg.update_blocks(values, starts), held_schema))
            if sum(t.num_rows for t in held) >= limit or sum(t.nbytes for t in held) >= HELD_BYTES:
                held = [merged(held)]
                limit = max(most, 2 * held[0].num_rows)    # what is merged again has doubled
                if held[0].num_rows >= most or held[0].nbytes >= HELD_BYTES // 2:
                    yield from _out(held[0], task, schema)
                    held, limit = [], most
        if held:
            yield from _out(merged(held), task, schema)
    return run


def _out(table: pa.Table, task: int | None, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    columns = table.columns if task is None else [*table.columns, pa.array(np.full(table.num_rows, task, np.int32))]
    yield from pa.Table.from_arrays(columns, schema=schema).to_batches(max_chunksize=STATES_OUT)


def _merged(agg: Aggregator, n_keys: int, finish: bool, schema: pa.Schema):
    """Neighbouring states of one (key, group of tasks) as one, of sorted rows; at the last level their results."""
    def ended(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if finish:
            keys, states = _columns(table, 0, n_keys), _columns(table, n_keys + 1)
            table = _table(keys, np.arange(table.num_rows), agg.evaluate_all(states), schema)
        else:                                              # the number of the tasks comes last
            table = table.select([*range(n_keys), *range(n_keys + 1, table.num_columns), n_keys])
        yield from _out(table, None, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None                                        # the last group, which may go on
        for table in _gathered(batches):
            last = table.num_columns - 1
            table = table.select([*range(n_keys), last, *range(n_keys, last)])
            table = _merge_runs(agg, table if rest is None else pa.concat_tables([rest, table]), n_keys + 1)
            rest = table.slice(table.num_rows - 1)
            if table.num_rows > 1:
                yield from ended(table.slice(0, table.num_rows - 1))
        if rest is not None:
            yield from ended(rest)
    return run


def aggregate(df: DataFrame, keys: Sequence[str], inputs: dict[str, str], agg: Aggregator, fan: int = FAN,
              held: int = HELD) -> DataFrame:
    """One row a key: the keys and the aggregate's result.  ``inputs`` names SQL expressions, which ``update``
    gets under their names."""
    spark = df.sparkSession
    keys, names = list(keys), list(inputs)
    columns = [f"_v{k}" for k in range(len(names))]
    given = df.select(*keys, *[F.expr(e).alias(c) for c, e in zip(columns, inputs.values(), strict=True)], F.spark_partition_id().alias("_task"))
    key_fields = [given.schema[k] for k in keys]
    state, result = T.StructType.fromDDL(agg.state), T.StructType.fromDDL(agg.result)
    partial = T.StructType([*key_fields, *[T.StructField(f"_s{k}", f.dataType) for k, f in enumerate(state.fields)], T.StructField("_task", T.IntegerType())])
    states = materialize(given.mapInArrow(_partial(agg, keys, columns, names, to_arrow_schema(partial), held), partial), name="aggregate-states")
    last = states.agg(F.max("_task")).first()[0]
    n_tasks, level = (last if last is not None else 0) + 1, 0
    while n_tasks > fan:                                   # each level leaves one state for every ``fan`` tasks
        level, n_tasks = level + 1, -(-n_tasks // fan)
        dealt = (states.withColumn("_task", F.floor(F.col("_task") / fan).cast("int")).repartition(*keys, "_task")
                 .sortWithinPartitions(*keys, "_task"))
        states = materialize(dealt.mapInArrow(_merged(agg, len(keys), False, to_arrow_schema(partial)), partial), name=f"aggregate-level-{level}")
    whole = states.withColumn("_task", F.lit(0))
    if not keys:                                           # the empty table's row
        nothing = spark.createDataFrame([(*agg.initial(), 0)], partial)
        whole = whole.unionByName(nothing)
    out = T.StructType([*key_fields, *result.fields])
    dealt = whole.repartition(*keys).sortWithinPartitions(*keys) if keys else whole.repartition(1)
    return dealt.mapInArrow(_merged(agg, len(keys), True, to_arrow_schema(out)), out)


class TopTwo(Aggregator):
    """The two largest different values, how many rows hold the largest, and the gap between them; nulls are skipped."""

    result = "largest bigint, second bigint, n_largest bigint, gap bigint"
    state = "top bigint, next bigint, n bigint"

    def initial(self) -> tuple:
        return None, None, 0

    def update(self, state: tuple, rows: dict[str, pa.Array]) -> tuple:
        values, counts = np.unique(rows["value"].drop_null().to_numpy(zero_copy_only=False), return_counts=True)
        if not len(values):
            return state
        return self.merge(state, (int(values[-1]), int(values[-2]) if len(values) > 1 else None, int(counts[-1])))

    def merge(self, a: tuple, b: tuple) -> tuple:
        found = sorted({v for v in (*a[:2], *b[:2]) if v is not None}, reverse=True)
        if not found:
            return None, None, 0
        return found[0], found[1] if len(found) > 1 else None, sum(s[2] for s in (a, b) if s[0] == found[0])

    def evaluate(self, state: tuple) -> tuple:
        top, second, n = state
        return top, second, n, None if second is None else top - second

    def update_blocks(self, rows: dict[str, pa.Array], starts: np.ndarray) -> Sequence:
        values = rows["value"].drop_null().to_numpy(zero_copy_only=False)
        block = _block(starts, len(rows["value"]))[rows["value"].is_valid().to_numpy(zero_copy_only=False)]
        return self._best(values, np.ones(len(values), np.int64), values, np.zeros(len(values), bool), block, len(starts))

    def merge_blocks(self, states: list[pa.Array], starts: np.ndarray) -> Sequence:
        there = states[0].is_valid()
        block = _block(starts, len(there))[there.to_numpy(zero_copy_only=False)]
        top, second, n = (c.filter(there) for c in states)
        also = second.is_valid().to_numpy(zero_copy_only=False)
        top, second, n = (c.fill_null(0).to_numpy(zero_copy_only=False) for c in (top, second, n))
        return self._best(top, n, second, also, block, len(starts))

    def evaluate_all(self, states: list[pa.Array]) -> Sequence:
        return [*states, pc.subtract(states[0], states[1])]

    @staticmethod
    def _best(top: np.ndarray, n: np.ndarray, second: np.ndarray, also: np.ndarray, block: np.ndarray, n_blocks: int) -> Sequence:
        """States of blocks from their rows' largest values, how often those are there, and the next ones if ``also``."""
        largest, following, count = (np.zeros(n_blocks, np.int64) for _ in range(3))
        empty, alone = np.ones(n_blocks, bool), np.ones(n_blocks, bool)
        if len(block):
            first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            at = block[first]
            best = np.maximum.reduceat(top, first)
            is_best = top == np.repeat(best, np.diff(np.append(first, len(block))))
            low = min(top.min(), second.min())
            other = np.maximum(np.where(is_best, low, top), np.where(also, second, low))
            largest[at], following[at] = best, np.maximum.reduceat(other, first)
            count[at] = np.add.reduceat(np.where(is_best, n, 0), first)
            empty[at], alone[at] = False, ~np.logical_or.reduceat(~is_best | also, first)
        return pa.array(largest, mask=empty), pa.array(following, mask=alone), pa.array(count)


def _block(starts: np.ndarray, n: int) -> np.ndarray:
    """Number of the block of each row."""
    return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
