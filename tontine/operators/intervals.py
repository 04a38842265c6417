"""Overlap join of two large tables of closed intervals [start, stop] of whole numbers.

An interval belongs to the level of its length (level l: up to 2^l long) and lies in at most
two bins of that level.  A pair whose intervals have levels a and b meets in the bins of the
higher one: the longer interval is there once a bin of its own level, the shorter one also
goes to the bins of every higher level that the other table has.  So a row is copied at most
two times a level (the levels present are known beforehand, 63 at most), never once a bin
it covers, and rows meet by equality of (keys, level, bin): no nested loop.  A pair that shares
two bins is given out in the one that holds the later start.

What a bin costs is its pairs, not its rows: few rows may meet in a bin by the billion, and
Spark, which splits a skewed key by its bytes, would leave them to one task.  So the rows of
each bin are counted on both sides first.  A bin of more pairs than a cell has is cut into a
grid: its left rows are dealt to chunks, its right rows too, and a row is copied to the chunks
of the other side, once for about a chunk of pairs.  A chunk has ``CHUNK`` rows, or as many more
as make some ``CELLS`` cells of all pairs: pairs grow with the square of the tables, and so does
a cell, while the copies grow with the tables only (up to chunks of ``LARGEST`` rows, which a
task holds).  The cells are dealt to tasks of about ``TASK_PAIRS`` pairs, or of one cell.  A bin
of fewer pairs with very many rows is a skewed key of an ordinary join, which Spark splits.

Rows with a null bound, or that stop before they start, overlap with nothing; rows that are
there twice pair twice; keys that are null match nothing, as in any equi-join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.sources.sinks import materialize

#: Rows of a side that meet in one cell of a crowded bin, at least and at most; cells of all pairs, if those are many;
#: pairs that one task compares.
CHUNK, LARGEST, CELLS, TASK_PAIRS = 2000, 50_000, 1000, 32_000_000


def _level(start: Column, stop: Column) -> Column:
    """Least l with stop - start + 1 <= 2^l."""
    beyond = stop - start
    return F.when(beyond == 0, 0).otherwise(F.length(F.bin(beyond)))


def _levels(df: DataFrame) -> list[int]:
    return sorted(r[0] for r in df.select("_level").distinct().collect())         # 63 at most


def _placed(df: DataFrame, above: list[int], from_own: bool) -> DataFrame:
    """One row a (level, bin, side of the pair): at its own level for longer or equal partners' sake,
    and at the levels above, where its longer partners are."""
    own, start, stop = F.col("_level"), F.col("_start"), F.col("_stop")

    def bins(level: Column, kind: int) -> Column:
        first, last = (F.call_function("shiftright", x, level) for x in (start, stop))
        return F.transform(F.sequence(first, last), lambda b: F.struct(level.alias("level"), b.alias("bin"), F.lit(kind).alias("kind")))
    higher = F.filter(F.array(*[F.lit(v) for v in above]).cast("array<int>"), lambda v: (v >= own) if from_own else (v > own))
    up, at = (1, 2) if from_own else (2, 1)
    places = F.concat(F.flatten(F.transform(higher, lambda v: bins(v, up))), bins(own, at))
    return df.withColumn("_p", F.explode(places)).withColumns({"_l": F.col("_p.level"), "_b": F.col("_p.bin"), "_k": F.col("_p.kind")}).drop("_p")


def _crowded(put: DataFrame, other: DataFrame, near: list[str]) -> tuple[DataFrame | None, int]:
    """The bins of more pairs than a cell has with the chunks of either side, if there are any; tasks for all pairs."""
    sizes = put.groupBy(*near).agg(F.count("*").alias("_n")).join(other.groupBy(*near).agg(F.count("*").alias("_m")), near)
    sizes = materialize(sizes, name="overlap-bins")
    pairs = F.col("_n").cast("decimal(38,0)") * F.col("_m")
    total, most = sizes.agg(F.sum(pairs), F.max(pairs)).first()
    tasks = int(put.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = max(CELLS, 4 * tasks)
    chunk = max(CHUNK, min(LARGEST, math.isqrt(int(total or 0) // cells)))
    if most is None or most <= chunk * chunk:
        return None, tasks
    tasks = max(tasks, min(-(-int(total) // TASK_PAIRS), max(2 * cells, int(total) // chunk ** 2)))
    return sizes.where(pairs > chunk * chunk).select(*near, *[F.ceil(F.col(n) / chunk).alias(c) for n, c in (("_n", "_ni"), ("_m", "_nj"))]), tasks


def _dealt(side: DataFrame, crowded: DataFrame, near: list[str], own: str, across: str) -> DataFrame:
    """Rows in their chunk of a crowded bin, once for each chunk of the other side; those of other bins in chunk 0."""
    chunks = {c: F.coalesce(F.col(f"_n{c[1:]}"), F.lit(1)) for c in (own, across)}
    rows = side.join(crowded, near, "left").withColumn(own, F.pmod(F.xxhash64("_turn"), chunks[own]))
    return rows.withColumn(across, F.explode(F.sequence(F.lit(0).cast("long"), chunks[across] - 1))).drop("_turn", "_ni", "_nj")


def overlap_join(left: DataFrame, right: DataFrame, left_bounds: tuple[str, str], right_bounds: tuple[str, str],
                 keys: Sequence[str] = ()) -> DataFrame:
    """Every pair of a left and a right row whose intervals share a number (and whose ``keys`` are equal), once:
    the columns of ``left``, then those of ``right`` but the keys; other names must differ."""
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns of both tables: {', '.join(sorted(clash))}")

    def given(df: DataFrame, bounds: tuple[str, str], name: str) -> DataFrame:
        start, stop = (F.col(b).cast("long") for b in bounds)
        rows = (df.withColumns({"_start": start, "_stop": stop}).where("_start <= _stop")
                .withColumn("_level", _level(F.col("_start"), F.col("_stop")).cast("int")))
        return materialize(rows.withColumn("_turn", F.monotonically_increasing_id()), name=name)      # numbers that no retry changes
    a, b = given(left, left_bounds, "overlap-left"), given(right, right_bounds, "overlap-right")
    near = [*keys, "_l", "_b", "_k"]
    of = {c: f"_r{c}" for c in ("_start", "_stop")}
    put = _placed(a, _levels(b), from_own=True).drop("_level")
    other = _placed(b, _levels(a), from_own=False).drop("_level").withColumnsRenamed(of)
    crowded, tasks = _crowded(put, other, near)
    if crowded is None:
        both = put.drop("_turn").join(other.drop("_turn"), near)
    else:
        cell = [*near, "_i", "_j"]
        dealt = [_dealt(side, crowded, near, *axes).repartition(tasks, *cell) for side, axes in ((put, ("_i", "_j")), (other, ("_j", "_i")))]
        both = dealt[0].join(dealt[1].hint("merge"), cell)
    later = F.greatest("_start", "_r_start")
    meet = (later <= F.least("_stop", "_r_stop")) & (F.call_function("shiftright", later, F.col("_l")) == F.col("_b"))
    return both.where(meet).select(*left.columns, *[c for c in right.columns if c not in keys])
