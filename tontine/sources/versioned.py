"""A table that can be replaced by a derived part of itself under the same name.

Data lie in folders that are never changed once written; a log holds one small entry a
version, which names its folders and their schema.  The newest entry is the table.  A version
is published by renaming its entry into the log, which fails if another writer has taken
the number, so there is no moment without a table, a rewrite that fails leaves the old
rows, and of two writers one is told.  A reader resolves the entry when it builds its
frame and keeps that version until ``remove_old`` takes it away.

The rename has to be atomic and refuse an existing target, as in HDFS and on a local disk;
on an object store the log folder belongs in a file system that gives this.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class VersionConflict(RuntimeError):
    """Another writer has published a version since this one read the table."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._log = os.path.join(self.path, "_versions")

    # -------------------------------------------------------------- files, through Hadoop's interface
    def _hadoop(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _entry_path(self, version: int) -> str:
        return os.path.join(self._log, f"{version:020d}")

    def _entry(self, version: int) -> dict:
        p, fs = self._hadoop(self._entry_path(version))
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, version: int, entry: dict) -> None:
        sc = self.spark.sparkContext
        jvm = sc._jvm
        draft, fs = self._hadoop(os.path.join(self._log, f"_draft-{uuid.uuid4().hex}"))
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        target = jvm.org.apache.hadoop.fs.Path(self._entry_path(version))
        options = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                raise VersionConflict(f"{self.path}: version {version} is taken") from None
            raise

    # -------------------------------------------------------------- the table
    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        p, fs = self._hadoop(self._log)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n) for n in names if n.isdigit())

    def version(self) -> int:
        """The newest version; 0 if there is no table yet."""
        return max(self.versions(), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of now (or of a version that is still kept)."""
        version = version or self.version()
        if not version:
            raise FileNotFoundError(self.path)
        entry = self._entry(version)
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(*[os.path.join(self.path, f) for f in entry["folders"]])

    def write(self, df: DataFrame, after: int | None = None) -> int:
        """Publish ``df`` as the next version and return its number.  ``after`` is the version it was derived
        from: if the table has moved on, the write is refused."""
        return self._put(df, self.version() if after is None else after, [])

    def append(self, df: DataFrame) -> int:
        """Publish a version that has the rows of ``df`` besides those of the newest one, which are not copied."""
        after = self.version()
        if not after:
            return self._put(df, 0, [])
        if [(f.name, f.dataType) for f in df.schema.fields] != [(f.name, f.dataType) for f in self.read(after).schema.fields]:
            raise ValueError(f"{self.path}: the columns differ from the table's")
        return self._put(df, after, self._entry(after)["folders"])

    def _put(self, df: DataFrame, after: int, folders: list[str]) -> int:
        folder = f"data-{uuid.uuid4().hex}"
        df.write.parquet(os.path.join(self.path, folder))
        self._publish(after + 1, {"folders": [*folders, folder], "schema": json.loads(df.schema.json())})
        return after + 1

    def rewrite(self, fn: Callable[[DataFrame], DataFrame]) -> int:
        """Replace the table with ``fn`` of itself."""
        after = self.version()
        return self.write(fn(self.read(after)), after)

    def remove_old(self, keep: int = 1) -> int:
        """Take all but the newest ``keep`` versions away; returns how many went."""
        if keep < 1:
            raise ValueError("the newest version stays")
        versions = self.versions()
        old = versions[:-keep]
        held = {f for v in versions[-keep:] for f in self._entry(v)["folders"]}
        for version in old:                                # the entry last: a version is whole or not listed
            gone = [os.path.join(self.path, f) for f in self._entry(version)["folders"] if f not in held]
            for path in (*gone, self._entry_path(version)):
                p, fs = self._hadoop(path)
                fs.delete(p, True)
        return len(old)
