"""Small helpers between Arrow batches and numpy in the operators' tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows of one Arrow batch: texts are wide, so far fewer than Spark's default.
BATCH_ROWS = 2500


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches that Python tasks hold, in rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    except Exception:  # noqa: BLE001 - a version without this setting keeps the row bound
        pass


def partitions(spark: SparkSession) -> int:
    """Tasks of a shuffle, as the cluster sets them for its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow list column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def binary_array(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from f(b)
    return df.mapInArrow(run, schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_of(name: str):
    """The text column as a string, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
