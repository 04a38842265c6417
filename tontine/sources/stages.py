"""A store of stage tables that sessions share.

A stage's folder is named by a digest of what it is made from: the versions of its input files,
the parameters, and the plan (with Spark's running expression numbers taken out).  A stage that
is there is read, whichever session wrote it; a changed input, parameter or plan has another
name and is built again.  A stage is written to a draft folder and published by renaming it, so
a reader never sees half of one; if two sessions build the same stage the first to publish is
read by both.  ``remove_unused`` takes away stages that no session has read for some time.

As for versioned tables, the rename has to be atomic, as in HDFS and on a local disk.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tontine.sources.tables import version

SCHEMA, USED = "_schema", "_used"


def plan_text(df: DataFrame) -> str:
    """The analysed plan without what differs from session to session: Spark's running numbers of expressions
    (here by their first place in the text) and of lambdas' variables, and how many partitions rows are dealt to."""
    text = df._jdf.queryExecution().analyzed().toString()
    for numbers in (r"#\d+", r"\bx_\d+|\by_\d+|\bz_\d+"):
        seen: dict[str, str] = {}
        text = re.sub(numbers, lambda m: seen.setdefault(m.group(), f"{m.group()[0]}{len(seen)}"), text)  # noqa: B023
    return re.sub(r"(RepartitionByExpression \[[^\]]*\]), \d+", r"\1", re.sub(r"plan_id=\d+|@[0-9a-f]+|splits=Some\(\d+\)", "", text))


class StageStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _hadoop(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _put(self, path: str, text: str) -> None:
        p, fs = self._hadoop(path)
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()

    def _text(self, path: str) -> str:
        p, fs = self._hadoop(path)
        stream = fs.open(p)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _read(self, path: str) -> DataFrame:
        self._put(os.path.join(path, USED), "")            # its time is that of the last use
        return self.spark.read.schema(T.StructType.fromJson(json.loads(self._text(os.path.join(path, SCHEMA))))).parquet(path)

    def path(self, name: str, df: DataFrame, inputs: Sequence[str] = (), params: object = None) -> str:
        """Where the stage ``df`` belongs; ``inputs`` are the files or folders that it reads, ``params`` anything
        whose text tells its value (a frozen dataclass, a tuple)."""
        made_from = [name, [(p, str(version(self.spark, p))) for p in inputs], repr(params), plan_text(df), df.schema.json()]
        return os.path.join(self.root, f"{name}-{hashlib.sha256(json.dumps(made_from).encode()).hexdigest()[:32]}")

    def table(self, name: str, build: Callable[[], DataFrame], inputs: Sequence[str] = (), params: object = None) -> DataFrame:
        """The stage as a table, built only if no session has published it."""
        df = build()
        path = self.path(name, df, inputs, params)
        p, fs = self._hadoop(path)
        if not fs.exists(p):
            draft = os.path.join(self.root, f"_draft-{uuid.uuid4().hex}")
            df.write.parquet(draft)
            self._put(os.path.join(draft, SCHEMA), df.schema.json())
            self._publish(draft, path)
        return self._read(path)

    def _publish(self, draft: str, path: str) -> None:
        sc = self.spark.sparkContext
        jvm = sc._jvm
        given, fs = self._hadoop(draft)
        options = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(given), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), options)
        except Py4JJavaError as e:                         # another session was first: its stage is the same
            fs.delete(given, True)
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise

    def stages(self) -> list[str]:
        """Published stages."""
        p, fs = self._hadoop(self.root)
        if not fs.exists(p):
            return []
        return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if not n.startswith(("_", ".")))

    def remove_unused(self, seconds: float) -> list[str]:
        """Take away the stages, and drafts of sessions that have died, last used longer ago than this."""
        p, fs = self._hadoop(self.root)
        now = self.spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
        gone = []
        for status in fs.listStatus(p) if fs.exists(p) else []:
            mark = self._hadoop(os.path.join(self.root, status.getPath().getName(), USED))[0]
            used = fs.getFileStatus(mark).getModificationTime() if fs.exists(mark) else status.getModificationTime()
            if now - used >= seconds * 1000:
                fs.delete(status.getPath(), True)
                gone.append(status.getPath().getName())
        return sorted(gone)
