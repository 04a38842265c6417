"""Running numbers for new rows only: numbers once given never change and are never given twice.

A ``Numbering`` holds two versioned tables: the high-water mark of every key, and the numbered
rows.  A run takes the rows whose id has no number yet, counts them by key and first publishes
the raised marks, which claims a block of numbers for every key; then it numbers the rows from
the old mark on by their order (range-partitioned, so a key of any size is numbered by many
tasks, each from its own offset in the block) and appends them.  A run that fails in between
leaves a gap, never a number twice; a run on rows that are there already adds nothing; of two
runs at once one is refused when it claims its block.  No old row is read but for its id.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.operators.scan import ordered_scan
from tontine.sources.sinks import materialize
from tontine.sources.versioned import VersionedTable


class Numbering:
    def __init__(self, spark: SparkSession, path: str, ident: str, keys: Sequence[str] = (), order: Sequence[str] = ()) -> None:
        """``ident`` names the rows, ``keys`` number apart, ``order`` (with the id as its end) is that of new rows."""
        self.spark, self.ident, self.keys, self.order = spark, ident, list(keys), [*order, ident]
        self.marks = VersionedTable(spark, os.path.join(path, "marks"))
        self.rows = VersionedTable(spark, os.path.join(path, "rows"))

    def assign(self, df: DataFrame) -> int:
        """Number the rows of ``df`` that have no number; returns how many got one.  Of several rows with one id
        the first in order is taken; rows without an id get no number."""
        after = self.marks.version()
        new = df.select(*dict.fromkeys([self.ident, *self.keys, *self.order])).where(F.col(self.ident).isNotNull())
        rest = [c for c in new.columns if c != self.ident]
        if rest:
            new = new.groupBy(self.ident).agg(F.min(F.struct(*[c for c in [*self.order[:-1], *self.keys] if c != self.ident])).alias("_first"))
            new = new.select(self.ident, *[F.col("_first")[c].alias(c) for c in rest])
        else:
            new = new.distinct()
        if self.rows.version():
            new = new.join(self.rows.read().select(self.ident), self.ident, "left_anti")
        new = materialize(new, name="numbering-new")
        given = new if self.keys else new.withColumn("_all", F.lit(0))
        keys = self.keys or ["_all"]
        # counted by key, joined to the marks: both a row a key
        counts = given.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        old = self.marks.read() if after else counts.select(*keys, F.lit(0).cast("long").alias("mark")).limit(0)
        same = [F.col(f"o.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
        condition = same[0]
        for c in same[1:]:
            condition = condition & c
        raised = old.alias("o").join(counts.alias("c"), condition, "full").select(
            *[F.coalesce(F.col(f"o.{k}"), F.col(f"c.{k}")).alias(k) for k in keys],
            (F.coalesce("mark", F.lit(0)) + F.coalesce("_n", F.lit(0))).cast("long").alias("mark"), F.coalesce("_n", F.lit(0)).cast("long").alias("_n"))
        raised = materialize(raised, name="numbering-marks")
        total = raised.agg(F.sum("_n")).first()[0] or 0
        if not total:
            return 0
        self.marks.write(raised.drop("_n"), after)         # claims the blocks, or is refused
        placed = ordered_scan(given, keys, self.order)
        base = raised.where("_n > 0").select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], (F.col("mark") - F.col("_n")).alias("_base"))
        match = F.lit(True)
        for n, k in enumerate(keys):
            match = match & F.col(k).eqNullSafe(F.col(f"_k{n}"))
        numbered = placed.join(base, match).select(self.ident, *self.keys, (F.col("_base") + F.col("_pos")).cast("long").alias("number"))
        self.rows.append(numbered)
        return total
