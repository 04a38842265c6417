"""Loads that keep every row: those that fit the declared types go to the table, the others
to a reject table with the column, its raw value and the reason.

``load`` reads its input once and writes once: one Parquet folder with a part for either kind,
so good + rejected = input whatever happens in between, and a reader of one kind prunes the
other.  A row is rejected whole if any of its values does not fit; ``reasons`` lists every one
of them.  Nulls fit, but in ``required`` columns; decimals are rounded half up to their scale
as an insert does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tontine.schema import struct

LINE = "_line"
_ERROR = "struct<column:string,raw:string,reason:string>"


def _declared(name_or_struct: str | T.StructType) -> T.StructType:
    return struct(name_or_struct) if isinstance(name_or_struct, str) else name_or_struct


def _error(name: str, of: T.DataType, required: bool) -> Column:
    """The error of one value, or null."""
    kind, raw = of.simpleString(), F.col(f"`{name}`")
    text = raw.cast("string")
    as_number = text.try_cast("double").isNotNull() if isinstance(of, T.NumericType) else F.lit(False)
    found = F.when(raw.isNotNull() & raw.try_cast(of).isNull(),
                   F.when(as_number, f"does not fit {kind}").otherwise(f"is no {kind}"))
    if required:
        found = F.when(raw.isNull(), "is missing").otherwise(found)
    return F.when(found.isNotNull(), F.struct(F.lit(name).alias("column"), text.alias("raw"), found.alias("reason")))


def checked(df: DataFrame, name_or_struct: str | T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """The declared columns in their types (null where a value does not fit), ``_errors`` and, for rejected
    rows, their raw values as a map ``_raw``.  A line that has not the declared number of fields (``LINE``
    is not null) is one error."""
    fields = _declared(name_or_struct).fields
    lacking = [f.name for f in fields if f.name not in df.columns]
    if lacking:
        raise ValueError(f"no column {', '.join(lacking)}")
    errors = F.filter(F.array(*[_error(f.name, f.dataType, f.name in required) for f in fields]), lambda e: e.isNotNull())
    if LINE in df.columns:
        line = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.col(LINE).alias("raw"), F.lit("has a wrong number of fields").alias("reason")))
        errors = F.when(F.col(LINE).isNotNull(), line).otherwise(errors)
    errors = F.coalesce(errors, F.array().cast(f"array<{_ERROR}>"))
    raw = F.map_from_arrays(F.array(*[F.lit(f.name) for f in fields]), F.array(*[F.col(f"`{f.name}`").cast("string") for f in fields]))
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in fields], errors.alias("_errors"), raw.alias("_raw"))


def load(df: DataFrame, name_or_struct: str | T.StructType, path: str, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` to ``path`` and return (table, rejects).  Rejects have a row a rejected input row:
    ``raw`` (its values as they came) and ``reasons`` (column, raw, reason of every value that does not fit)."""
    rows = checked(df, name_or_struct, required).withColumn("_rejected", F.size("_errors") > 0)
    fine = ~F.col("_rejected")
    rows = rows.withColumns({"_raw": F.when(~fine, F.col("_raw")), "_errors": F.when(~fine, F.col("_errors"))})
    rows.write.mode("overwrite").partitionBy("_rejected").parquet(path)
    back = df.sparkSession.read.schema(T.StructType([*[f for f in rows.schema.fields if f.name != "_rejected"],
                                                     T.StructField("_rejected", T.BooleanType())])).parquet(path)
    table = back.where(~F.col("_rejected")).select(*[f.name for f in _declared(name_or_struct).fields])
    return table, back.where("_rejected").select(F.col("_raw").alias("raw"), F.col("_errors").alias("reasons"))


def read_delimited_raw(spark: SparkSession, path: str, name_or_struct: str | T.StructType, sep: str = "\t") -> DataFrame:
    """Delimited text with all declared columns as they stand, and ``LINE``, the whole line where it has not
    the declared number of fields; the input of ``load``."""
    fields = [T.StructField(f.name, T.StringType()) for f in _declared(name_or_struct).fields]
    return (spark.read.schema(T.StructType([*fields, T.StructField(LINE, T.StringType())])).option("sep", sep)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).option("nullValue", "\\N").csv(path))
