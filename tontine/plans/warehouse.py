"""The warehouse as catalog databases: three layers of typed tables with comments and month partitions.

``Warehouse`` registers the 27 declared tables as external Parquet tables of three Spark
databases (``<prefix>ods``, ``<prefix>dw``, ``<prefix>app``) below one root folder; a session
whose catalog does not know them registers them again over the same files, with the months
found there.  Rows go in by name and through the declared types: a frame with a column too
many or too few, or of a type that an assignment cannot turn into the declared one, is a
``SchemaDrift`` error before anything is written, a value that does not fit is an error of the
insert, and ``check`` compares what is registered, and what the files hold, with the
declaration.  An insert replaces the table, or the one month it names.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tontine.schema import COMMENTS, DDL, MONTH_PARTITIONED, NOT_SUPPLIED, conform, struct

LAYERS = {"ods": list(DDL)[:10], "dw": list(DDL)[10:15], "app": list(DDL)[15:]}
MONTH = "month"


class SchemaDrift(ValueError):
    """A frame, a registered table or its files depart from the declared columns."""


def layer_of(name: str) -> str:
    return next(layer for layer, names in LAYERS.items() if name in names)


def _columns(name: str) -> str:
    quoted = lambda c: " COMMENT '" + COMMENTS[c].replace("'", "\\'") + "'" if c in COMMENTS else ""
    return ", ".join(f"`{c}` {t}{quoted(c)}" for c, t in DDL[name])


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, prefix: str = "tontine_") -> None:
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    def table(self, name: str) -> str:
        """Full name of a declared table."""
        return f"`{self.prefix}{layer_of(name)}`.`{name}`"

    def path(self, name: str) -> str:
        return os.path.join(self.root, layer_of(name), name)

    def register(self) -> None:
        """Create the databases and tables that the catalog lacks, over the files that are there."""
        for layer, names in LAYERS.items():
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{layer}` LOCATION '{os.path.join(self.root, "_catalog", layer)}'")
            for name in names:
                by_month = name in MONTH_PARTITIONED
                month = f", `{MONTH}` string COMMENT 'report month (yyyy-MM)'" if by_month else ""
                self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table(name)} ({_columns(name)}{month}) USING parquet "
                               + (f"PARTITIONED BY (`{MONTH}`) " if by_month else "") + f"LOCATION '{self.path(name)}'")
                if by_month:
                    p, fs = self._hadoop(name)
                    fs.mkdirs(p)
                    self.spark.sql(f"ALTER TABLE {self.table(name)} RECOVER PARTITIONS")
        self.check()

    def drop(self) -> None:
        """Forget the databases; the tables' files stay, for they are not below the databases' own folders."""
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.prefix}{layer}` CASCADE")

    def check(self, files: bool = False) -> None:
        """Raise if a registered table, or with ``files`` what its files hold, departs from the declaration."""
        for name in DDL:
            want = [(f.name, f.dataType) for f in struct(name).fields]
            sides = {"the catalog": self.spark.table(self.table(name)).schema}
            if files and self._has_files(name):
                sides["the files"] = self.spark.read.parquet(self.path(name)).schema
            for where, schema in sides.items():
                have = [(f.name, f.dataType) for f in schema.fields if f.name != MONTH]
                if have != want:
                    odd = sorted({c for c, _ in set(have) ^ set(want)})
                    raise SchemaDrift(f"{name}: {where} differ{'s' if where == 'the catalog' else ''} from the declaration in {', '.join(odd) or 'the order of columns'}")

    def _hadoop(self, name: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _has_files(self, name: str) -> bool:
        p, fs = self._hadoop(name)
        found = fs.listFiles(p, True) if fs.exists(p) else None
        while found is not None and found.hasNext():
            if found.next().getPath().getName().endswith(".parquet"):
                return True
        return False

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.table(name))

    def insert(self, df: DataFrame, name: str, month: str | None = None) -> None:
        """Replace a table, or one month of it, by ``df``, by name."""
        if (month is not None) != (name in MONTH_PARTITIONED):
            raise ValueError(f"{name} is {'partitioned by month' if name in MONTH_PARTITIONED else 'one table of no month'}")
        declared, may_lack = [c for c, _ in DDL[name]], NOT_SUPPLIED.get(name, ())
        have = [c for c in df.columns if c != MONTH]
        odd = [*[f"no {c}" for c in declared if c not in have and c not in may_lack], *[f"undeclared {c}" for c in have if c not in declared]]
        if odd:
            raise SchemaDrift(f"{name}: {', '.join(odd)}")
        view = f"insert_{uuid.uuid4().hex}"
        part = f" PARTITION (`{MONTH}` = '{month}')" if month is not None else ""
        try:
            rows = conform(df, name, missing=may_lack)
            rows.createOrReplaceTempView(view)
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.table(name)}{part} BY NAME SELECT * FROM {view}")
        except AnalysisException as e:                     # a type that cannot be assigned
            raise SchemaDrift(f"{name}: {e.getMessage() if hasattr(e, 'getMessage') else e}") from e
        finally:
            self.spark.catalog.dropTempView(view)

    def months(self, name: str) -> list[str]:
        """Registered months of a table, from the catalog."""
        return sorted(r[0].split("=")[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.table(name)}").collect())
