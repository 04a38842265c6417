"""Filter interaction audit: what each quality filter removes in every order of the filters.

The subsets of the filters form a lattice: an order of the filters is a path from the
empty set to the whole set, one edge a filter.  What a filter removes on an edge depends
on the state it leaves (which filters came before), not on their order, so 2^n states
and n 2^(n-1) edges tell the steps of all n! orders.  ``paths`` counts the orders that
reach each state (forward) and that leave it (backward); an edge lies on forward(from) x
backward(to) orders, which is its weight in a filter's Shapley sum.  A step of an order
is read from the same edge.

Documents meet Spark's shuffle as a few bytes (id, part, failures, digest), never as
texts, and are counted by (part, set of failed filters): at most 2^n rows a part, summed
on the map side first, so a hot part is as many rows a task.  Everything after that is
independent of the number of documents.

Results for odd input: null text counts as empty and a null part as the empty string;
a null id is no smaller and no greater than another, so it neither is nor makes a later
copy; rows that share an id are documents of their own with that id's labels, and are no
later copies of each other; labels that are null, or have no document, count as 0, and of
several labels of an id the greatest holds; an empty table gives an empty result; whole
texts of any length are read; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tontine.llm.batches import text_of
from tontine.sources.sinks import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Most filters of an audit: 8! orders of 8 steps are the rows of one part.
MOST_FILTERS = 8


def paths(n: int) -> tuple[list[int], list[int]]:
    """Orders that reach each state (a set of filters as bits) and that leave it for the whole set."""
    whole = (1 << n) - 1
    reaching, leaving = [0] * (whole + 1), [0] * (whole + 1)
    reaching[0] = leaving[whole] = 1
    for state in range(1, whole + 1):                       # a state's subsets are smaller numbers
        reaching[state] = sum(reaching[state ^ (1 << k)] for k in range(n) if state >> k & 1)
    for state in range(whole - 1, -1, -1):
        leaving[state] = sum(leaving[state | (1 << k)] for k in range(n) if not state >> k & 1)
    return reaching, leaving


def _edges(n: int) -> Column:
    """Edges of the lattice as an array of (state before, filter's bit, orders that pass)."""
    reaching, leaving = paths(n)
    return F.array(*[F.struct(F.lit(s).alias("before"), F.lit(1 << k).alias("bit"),
                              F.lit(reaching[s] * leaving[s | (1 << k)]).cast("long").alias("weight"))
                     for s in range(1 << n) for k in range(n) if not s >> k & 1])


def _steps(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every order of the filters, a row a step: (filter_order, step, before, bit)."""
    spark = rows.sparkSession
    steps = []
    for order in permutations(range(len(names))):
        before, label = 0, "".join(names[k] for k in order)
        for place, k in enumerate(order):
            steps.append((label, place + 1, before, 1 << k))
            before |= 1 << k
    return spark.createDataFrame(steps, "filter_order string, step int, before int, bit int")


def audit(rows: DataFrame, names: Sequence[str], part: str = "part", fails: str = "fails", good: str = "good",
          toxic: str = "toxic") -> DataFrame:
    """Counts of every (part, order, step) for documents with ``fails``, the filters that a document
    fails as bits in the order of ``names``; ``good`` and ``toxic`` are 0 or 1."""
    if not 0 < len(names) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {len(names)}")
    n = F.count(F.lit(1))
    counted = rows.groupBy(F.col(part).alias("part"), F.col(fails).alias("fails")).agg(
        n.alias("n"), F.sum(F.col(good).cast("long")).alias("good"), F.sum(F.col(toxic).cast("long")).alias("toxic"))
    at = counted.withColumn("edge", F.explode(_edges(len(names)))).select("*", "edge.*")
    failed = F.col("fails").bitwiseAND(F.col("bit")) != 0
    gone = F.col("fails").bitwiseAND(F.col("before")) != 0
    total = lambda condition, value: F.sum(F.when(condition, F.col(value)).otherwise(0))
    edges = at.groupBy("part", "before", "bit", "weight").agg(
        total(~failed & ~gone, "n").alias("kept"), total(failed & ~gone, "n").alias("removed"),
        total(failed & gone, "n").alias("redundant"), total(F.col("fails") == F.col("bit"), "n").alias("unique_fails"),
        total(failed & ~gone, "good").alias("good_lost"), total(failed & ~gone, "toxic").alias("toxic_lost"))
    shapley = F.sum(F.col("removed") * F.col("weight")).over(Window.partitionBy("part", "bit"))   # 2^(n-1) edges
    steps = F.broadcast(_steps(rows, names))                # n! x n rows, n at most MOST_FILTERS
    return edges.withColumn("shapley", shapley).join(steps, ["before", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(docs: DataFrame, text_filters: Sequence[Column], id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "lang") -> DataFrame:
    """(id, part, fails) of every row: the bits of ``text_filters`` (conditions on the columns ``text`` and
    ``words``), then that of exact copies of a text with a smaller id."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    read = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        text_of(text_col).alias("text")).withColumn("words", words))
    bits = F.lit(0)
    for k, condition in enumerate(text_filters):
        bits = bits + F.when(condition, 1 << k).otherwise(0)
    seen = materialize(read.select("id", "part", bits.alias("fails"), F.unhex(F.sha2("text", 256)).alias("digest")), name="audit-failures")
    # written, so that Spark splits the rows of a text that very many documents have
    first = materialize(seen.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"))
                        .where("least < most").select("digest", "least"), name="audit-copies")
    copy = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    return seen.join(first, "digest", "left").select(
        "id", "part", (F.col("fails") + F.when(copy, 1 << len(text_filters)).otherwise(0)).alias("fails"))


def quality_filters() -> list[Column]:
    """A: under 100 words; B: under 80 % of them distinct; C: over 10 % capitals A-Z; D: one of ``#$%&*|``."""
    n = F.size("words").cast("long")
    return [n < 100, F.size(F.array_distinct("words")).cast("long") * 100 < n * 80,
            F.regexp_count("text", F.lit("[A-Z]")).cast("long") * 100 > F.length("text").cast("long") * 10,
            F.col("text").rlike("[#$%&*|]")]


def with_labels(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``good`` and ``toxic`` (0 or 1) beside each row."""
    marks = materialize(labels.select(F.col(id_col).alias("id"), (F.col("quality") == 1).cast("int").alias("good"),
                                      (F.col("toxic") == 1).cast("int").alias("toxic"))
                        .groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")), name="audit-labels")
    return rows.join(marks, "id", "left").fillna(0, ["good", "toxic"])
