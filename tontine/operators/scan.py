"""Ordered scans within keys: running sums, products, positions, lead/lag, affine recurrences.

``Window.partitionBy(key)`` puts all rows of a key into one task, so a key that holds
a third of the data would run on one core.  Here rows are range-partitioned on (key,
order): a hot key is cut into contiguous ordered runs, one a partition.  Each run is
scanned in its partition, and runs whose key began in an earlier partition get a carry.
Only the first and the last run of a partition can share their key with another one,
so the carries are a table of one row a partition, joined on the partition's number: a
broadcast where that many rows fit its budget, so the rows are not moved again.  There is
one path for all data: nothing depends on how many rows a key has.

Range bounds come from sampling and an exchange may run more than once, so the tagged
rows are written to the shared folder once and every branch reads that copy; this also
cuts lineage.  Keys are compared null-safely and null values follow Spark's own rules
(sums and products skip them).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tontine.operators.joins import broadcast_bounded
from tontine.sources.sinks import materialize

PID = "_pid"


def _order_cols(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _count(df: DataFrame, partitions: int | None) -> int:
    return partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ranges(df: DataFrame, keys: Sequence[str], order: Sequence, partitions: int | None) -> DataFrame:
    n = _count(df, partitions)
    return df.repartitionByRange(n, *[F.col(k) for k in keys], *_order_cols(order)).withColumn(PID, F.spark_partition_id())


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys])


def _edges(tagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First and last key of every partition."""
    return tagged.groupBy(PID).agg(F.min(_key(keys)).alias("_lo"), F.max(_key(keys)).alias("_hi"))


def _edge_runs(runs: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of one row a run, those of the first and last run of a partition, with their key ``_k``."""
    k = _key(keys)
    return (runs.join(edges, PID).withColumn("_is_lo", k.eqNullSafe(F.col("_lo"))).withColumn("_is_hi", k.eqNullSafe(F.col("_hi")))
            .where("_is_lo or _is_hi").withColumn("_k", k))


def _with_carries(rows: DataFrame, edges: DataFrame, carries: DataFrame, value: Column, keys: Sequence[str], n: int) -> DataFrame:
    """Every row with its run's carry ``_c`` (null for runs that lie within their partition).  The other side
    has a row a partition, ``n`` at most."""
    side = carries.groupBy(PID).agg(F.first(F.when(F.col("_is_lo"), value), ignorenulls=True).alias("_c_lo"),
                                    F.first(F.when(F.col("_is_hi"), value), ignorenulls=True).alias("_c_hi"))
    k = _key(keys)
    carry = F.when(k.eqNullSafe(F.col("_lo")), F.col("_c_lo")).when(k.eqNullSafe(F.col("_hi")), F.col("_c_hi"))
    return rows.join(broadcast_bounded(edges.join(side, PID), n), PID).withColumn("_c", carry).drop("_lo", "_hi", "_c_lo", "_c_hi")


def _both(a: Column, b: Column, combined: Column) -> Column:
    """``combined`` where both are known, else the one that is."""
    return F.when(a.isNotNull() & b.isNotNull(), combined).otherwise(F.coalesce(a, b))


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence, *, sums: Sequence[str] = (),
                 products: Sequence[str] = (), lags: Sequence[str] = (), leads: Sequence[str] = (),
                 partitions: int | None = None) -> DataFrame:
    """Add per-key ordered scan columns.

    For every ``c`` in ``sums``: ``c__cum`` (running sum incl. this row) and
    ``c__total``; in ``products``: ``c__cumprod_prev`` (product over earlier rows,
    null on the first row); in ``lags``/``leads``: ``c__lag``/``c__lead``.
    Always: ``_pos`` (1-based position within the key) and ``_n`` (rows of the key).
    ``order`` must be total within a key.
    """
    tagged = materialize(_ranges(df, keys, order, partitions), name="scan-runs")
    n = _count(df, partitions)
    run = Window.partitionBy(PID, *keys)
    w = run.orderBy(*_order_cols(order))
    cum, prev = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cols = {"_lpos": F.row_number().over(w).cast("long"), "_lcnt": F.count(F.lit(1)).over(run)}
    for c in sums:
        cols |= {f"_ls_{c}": F.sum(c).over(cum), f"_lt_{c}": F.sum(c).over(run)}
    for c in products:
        cols |= {f"_lp_{c}": F.product(F.col(c)).over(prev), f"_lpt_{c}": F.product(F.col(c)).over(run)}
    for c in lags:
        cols |= {f"_lg_{c}": F.lag(c).over(w), f"_ll_{c}": F.last(c).over(whole)}
    for c in leads:
        cols |= {f"_ld_{c}": F.lead(c).over(w), f"_lf_{c}": F.first(c).over(whole)}
    local = tagged.repartitionById(n, F.col(PID)).withColumns(cols)        # one range of rows a task

    edges = _edges(tagged, keys)
    runs = _edge_runs(local.where("_lpos = 1"), edges, keys)
    along = Window.partitionBy("_k").orderBy(PID)                  # at most one row a partition
    earlier, key_runs = along.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_k")
    carry = {"cnt": F.coalesce(F.sum("_lcnt").over(earlier), F.lit(0)), "n": F.sum("_lcnt").over(key_runs)}
    for c in sums:
        carry |= {f"s_{c}": F.sum(f"_lt_{c}").over(earlier), f"t_{c}": F.sum(f"_lt_{c}").over(key_runs)}
    for c in products:
        carry[f"p_{c}"] = F.product(F.col(f"_lpt_{c}")).over(earlier)
    for c in lags:
        carry[f"lg_{c}"] = F.lag(f"_ll_{c}").over(along)
    for c in leads:
        carry[f"ld_{c}"] = F.lead(f"_lf_{c}").over(along)
    carries = runs.withColumns({f"_v_{k}": v for k, v in carry.items()})
    value = F.struct(*[F.col(f"_v_{k}").alias(k) for k in carry])
    out = _with_carries(local, edges, carries, value, keys, n)

    got = lambda name: F.col("_c")[name]
    has = F.col("_c").isNotNull()
    final = {"_pos": F.col("_lpos") + F.coalesce(got("cnt"), F.lit(0)), "_n": F.coalesce(got("n"), F.col("_lcnt"))}
    for c in sums:
        s = F.col(f"_ls_{c}")
        final[f"{c}__cum"] = _both(s, got(f"s_{c}"), s + got(f"s_{c}"))
        final[f"{c}__total"] = F.when(has, got(f"t_{c}")).otherwise(F.col(f"_lt_{c}"))
    for c in products:
        p = F.col(f"_lp_{c}")
        final[f"{c}__cumprod_prev"] = _both(p, got(f"p_{c}"), got(f"p_{c}") * p)
    for c in lags:
        final[f"{c}__lag"] = F.when(F.col("_lpos") == 1, got(f"lg_{c}")).otherwise(F.col(f"_lg_{c}"))
    for c in leads:
        final[f"{c}__lead"] = F.when(F.col("_lpos") == F.col("_lcnt"), got(f"ld_{c}")).otherwise(F.col(f"_ld_{c}"))
    return out.withColumns(final).drop("_c", PID, *cols)


# ---------------------------------------------------------------- affine recurrences
def _same_as_previous(columns: list[pa.Array]) -> np.ndarray:
    """For each row but the first: whether all columns equal the row before, nulls being equal."""
    n = len(columns[0])
    same = np.ones(max(n - 1, 0), bool)
    for c in columns:
        a, b = c.slice(1), c.slice(0, n - 1)
        equal = pc.if_else(pc.or_(a.is_null(), b.is_null()), pc.and_(a.is_null(), b.is_null()), pc.equal(a, b))
        same &= equal.to_numpy(zero_copy_only=False).astype(bool)
    return same


def _compose(a: np.ndarray, b: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maps x -> a x + b of each row composed from its run's start on, doubling the reach
    each step (``place``: rows of the run before)."""
    if a.shape[1] == 1:                                    # one state: plain products
        a, b = _compose_one(a[:, 0, 0], b[:, 0], place)
        return a[:, None, None], b[:, None]
    a, b, reach = a.copy(), b.copy(), 1
    while reach <= (place.max() if len(place) else 0):
        at = np.flatnonzero(place >= reach)
        b[at] = np.einsum("nij,nj->ni", a[at], b[at - reach]) + b[at]
        a[at] = a[at] @ a[at - reach]
        reach *= 2
    return a, b


def _compose_one(a: np.ndarray, b: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b, reach = a.copy(), b.copy(), 1
    while reach <= (place.max() if len(place) else 0):
        at = np.flatnonzero(place >= reach)
        b[at] += a[at] * b[at - reach]
        a[at] *= a[at - reach]
        reach *= 2
    return a, b


def _fold(keys: list[str], k: int, inner: list[str], schema: T.StructType):
    """Of each sorted partition, per row and relative to its run's start: ``_alpha`` and ``_beta``
    (x = alpha x_before + beta), ``_seeded`` (x if the key starts with the run) and whether the row
    ends its run.  Every other column passes through as it is."""
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held = None, None                           # (key, alpha, beta, seeded) and the row before
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
            a, b, s = m[:, :k * k].reshape(n, k, k), m[:, k * k:k * k + k], m[:, k * k + k:]
            alpha, beta = _compose(a, b, place)
            a0, b0 = a.copy(), b.copy()
            a0[new], b0[new] = 0, s[new]                   # a run that starts its key starts at the seed
            seeded = _compose(a0, b0, place)[1]
            if goes_on:                                    # the first run began in an earlier batch
                first = np.flatnonzero(start == 0) if not new[0] else np.empty(0, int)
                _, pa_, pb, ps = state
                seeded[first] = alpha[first] @ ps + beta[first]
                beta[first] = alpha[first] @ pb + beta[first]
                alpha[first] = alpha[first] @ pa_
            state = ([c[n - 1].as_py() for c in key], alpha[-1], beta[-1], seeded[-1])
            ends = np.append(new[1:], False)
            lists = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x[0].size).cast(pa.list_(pa.float64()))
            made = {"_alpha": lists(alpha), "_beta": lists(beta), "_seeded": lists(seeded), "_ends": pa.array(ends)}
            out = pa.RecordBatch.from_arrays([made.get(c, None) if c in made else batch.column(c) for c in names], names=names)
            if held is not None:
                yield _ending(held, bool(new[0]))
            yield out.slice(0, n - 1)
            held = out.slice(n - 1)
        if held is not None:
            yield _ending(held, True)
    return run


def _ending(row: pa.RecordBatch, ends: bool) -> pa.RecordBatch:
    return row.set_column(row.schema.get_field_index("_ends"), "_ends", pa.array([ends]))


def _chain(k: int):
    """The state that each of a key's runs starts from: one pass over its runs, in order."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(PID)
        vectors = [np.array(table.column(c).to_pylist(), float) for c in ("_alpha", "_beta", "_seeded")]
        x, starts = None, []
        for alpha, beta, seeded in zip(*vectors, strict=True):
            starts.append(None if x is None else x.tolist())
            x = seeded if x is None else alpha.reshape(k, k) @ x + beta
        return pa.table([table.column(PID), table.column("_is_lo"), table.column("_is_hi"), pa.array(starts, pa.list_(pa.float64()))],
                        names=[PID, "_is_lo", "_is_hi", "_start"])
    return run


def affine_recurrence(df: DataFrame, keys: Sequence[str], order: Sequence[str], a: Sequence[Sequence[str]], b: Sequence[str],
                      seed: Sequence[str], out: Sequence[str], partitions: int | None = None) -> DataFrame:
    """k coupled states along ``order`` within ``keys``: x_first = seed, x_t = A_t x_{t-1} + b_t.

    ``a`` is k rows of k SQL expressions, ``b`` and ``seed`` k each; ``out`` names the states' columns.
    Affine maps compose, so every run of a partition is reduced to one map, whatever its length, and a
    key's runs are chained by their maps; no key is gathered into one task or array.
    """
    k = len(out)
    flat = [*[e for row in a for e in row], *b, *seed]
    inner = [f"_e{i}" for i in range(len(flat))]
    work = df.withColumns({c: F.expr(e).cast("double") for c, e in zip(inner, flat, strict=True)})
    sorted_rows = _ranges(work, keys, order, partitions).sortWithinPartitions(*keys, *order)
    vector = T.ArrayType(T.DoubleType())
    schema = T.StructType([*[f for f in sorted_rows.schema.fields if f.name not in inner],
                           *[T.StructField(c, vector) for c in ("_alpha", "_beta", "_seeded")], T.StructField("_ends", T.BooleanType())])
    local = materialize(sorted_rows.mapInArrow(_fold(list(keys), k, inner, schema), schema), name="affine-runs")
    edges = _edges(local, keys)
    runs = _edge_runs(local.where("_ends"), edges, keys).select(PID, "_k", "_is_lo", "_is_hi", "_alpha", "_beta", "_seeded")
    # the runs of one key: at most one row a partition
    carries = runs.groupBy("_k").applyInArrow(_chain(k), f"{PID} int, _is_lo boolean, _is_hi boolean, _start array<double>")
    rows = _with_carries(local, edges, carries, F.col("_start"), keys, _count(df, partitions))

    def state(i: int) -> Column:
        moved = F.col("_beta")[i]
        for j in range(k):
            moved = moved + F.col("_alpha")[i * k + j] * F.col("_c")[j]
        return F.when(F.col("_c").isNull(), F.col("_seeded")[i]).otherwise(moved)
    return rows.withColumns({c: state(i) for i, c in enumerate(out)}).drop("_c", "_alpha", "_beta", "_seeded", "_ends", PID)


def linear_recurrence(df: DataFrame, keys: Sequence[str], order: Sequence[str], a: str, b: str, seed: str, out: str = "x",
                      partitions: int | None = None) -> DataFrame:
    """One state: x_first = seed; x_t = a_t * x_{t-1} + b_t."""
    return affine_recurrence(df, keys, order, [[a]], [b], [seed], [out], partitions)
