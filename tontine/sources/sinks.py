"""Sinks: stage materialisation, month-partitioned overwrite, self-overwrite, partition listing.

Nothing here collects data to the driver: writes are distributed, partition
listings are aggregates.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.session import ensure_checkpoint_dir


def stage_dir(spark: SparkSession) -> str:
    """Folder for this application's materialised stages, below the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), f"tontine-stages-{spark.sparkContext.applicationId}")


def remove_stages(spark: SparkSession) -> None:
    """Remove what this application has materialised; frames that read it are gone with it.
    Call it when the results are written."""
    from tontine.plans import actuarial
    actuarial.forget(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, how: str = "write", name: str = "stage") -> DataFrame:
    """Cut lineage of a stage that later steps read several times.

    ``write``       parquet under the shared checkpoint folder, read back (survives
                    executor loss, one job);
    ``checkpoint``  Spark reliable checkpoint (same folder);
    ``persist``     cache with recompute-on-loss through lineage;
    ``none``        keep the plan.
    """
    spark = df.sparkSession
    if how == "write":
        path = os.path.join(stage_dir(spark), f"{name}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)      # known schema: no footer discovery
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    if how == "persist":
        return df.persist()
    if how == "none":
        return df
    raise ValueError(how)


def write_month(df: DataFrame, path: str, calc_month: str) -> None:
    """Replace exactly one month partition (``month=calc_month``) of a table at ``path``.

    The partition's own folder is overwritten, so the month holds just these rows: none,
    if ``df`` is empty.  The other months stay as they are.
    """
    df.drop("month").write.mode("overwrite").parquet(os.path.join(path, f"month={calc_month}"))


def write_months(df: DataFrame, path: str, month_col: str = "month") -> None:
    """Replace every month partition present in the data (dynamic partition insert)."""
    if month_col != "month":
        df = df.withColumnRenamed(month_col, "month")
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("month").parquet(path))


def rewrite_table(spark: SparkSession, path: str, fn, staging_root: str | None = None) -> str:
    """Replace the table at ``path`` with ``fn(table)``.

    Spark cannot overwrite a path it is reading, so the result is written to a
    new sibling folder first and that folder is returned as the table's new
    location (the caller swaps its catalog pointer); the old folder is left for
    the caller to drop.
    """
    src = spark.read.parquet(path)
    root = staging_root or os.path.dirname(path.rstrip("/"))
    new_path = os.path.join(root, f"{os.path.basename(path.rstrip('/'))}-{uuid.uuid4().hex[:12]}")
    fn(src).write.parquet(new_path)
    return new_path


def partitions(df: DataFrame, col: str = "month") -> DataFrame:
    """Partition inventory: (month, n) per partition value (an aggregate, not a file listing)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def inventory(spark: SparkSession, path: str, col: str = "month", bounds: tuple[str, ...] = ()) -> DataFrame:
    """Partition inventory from file metadata: (``col``, n, least_c and greatest_c of every c in ``bounds``).

    Counts and bounds are aggregates that Spark pushes down to the Parquet footers, read in
    tasks, one a file, so no row is scanned; a partition that holds only empty files is listed
    with 0 rows.  The push-down needs the reader of the second generation, which the session
    has for this one job; its result, a row a partition, is written.  ``bounds`` are columns
    whose footers have exact statistics: numbers, dates and booleans, not texts.
    """
    keep = {k: spark.conf.get(k, None) for k in _PUSHED}
    try:
        for k, v in _PUSHED.items():
            spark.conf.set(k, v)
        return materialize(counted_by_footer(spark, path, col, bounds), name="inventory")
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Settings under which Spark answers counts and bounds from the footers.
_PUSHED = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def counted_by_footer(spark: SparkSession, path: str, col: str, bounds: tuple[str, ...] = ()) -> DataFrame:
    """The aggregate of ``inventory``; pushed down where the session is set for it."""
    found = spark.read.parquet(path).groupBy(col).agg(
        F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{name}_{c}") for c in bounds for f, name in ((F.min, "least"), (F.max, "greatest"))])
    return found.withColumn(col, F.col(col).cast("string"))
