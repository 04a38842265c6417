"""Embedding near-dedup by iterative quantisation.

Vectors of one direction and length (exact copies) are one node first.  On a bounded
sample of nodes several rotations are learnt, each from another start, that bring
the centred unit vectors close to the corners of a cube (ITQ), so that every bit is
balanced and near vectors differ in few.  Each rotation gives a 64-bit code, cut into
substrings: these index the nodes in as many Hamming tables, and vectors that share
a substring are candidates.  The substrings have about log2 of the number of nodes
bits, so a table's buckets stay small at any size; the number of tables and the
Hamming limit follow from the recall wanted of a pair right at the threshold
(``RECALL``), as measured: sampled vectors are moved to that cosine, and their codes
compared.  Vectors with a strong common direction differ in more bits, so they take
more tables, above ``TABLES`` shorter substrings (larger buckets, nothing left out).

Candidates are first compared by the Hamming distance of all their codes.  Only
nodes that have a close partner in a bucket are joined with their vectors again
and reranked by cosine in double precision, so links are exact.  Pairs never leave
their task: each is counted in the first table that has it, and what goes out are a
node's number of links and, for the components, links that join two groups of a bucket.
A large bucket is cut into parts, and every pair of parts is one unit of work.

Results for odd input: vectors that are null, empty or zero, hold nulls or
non-finite components, or have no id, link with nothing; vectors of different lengths
do not link, and each length is indexed by itself (one after the other: a table has
few); rows with one id are one node; other columns are not looked at, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.batches import list_array, map_batches, partitions, small_batches
from tontine.llm.graph import components
from tontine.llm.graph import dealt as apart
from tontine.sources.sinks import materialize

#: Vectors that train the rotations, and steps of the training.
SAMPLE, STEPS = 20_000, 30
#: Recall of pairs at the threshold that the number of tables is set for.
RECALL = 0.995
#: Pairs at the threshold on which bits and tables are measured; tables above which substrings get shorter instead.
PAIRS, TABLES = 10_000, 256
#: Members of a bucket that one unit of work compares; a larger bucket is cut into parts.
MEMBERS = 1000
#: Codes may differ by so many standard errors more than they do at the threshold.
SLACK = 6.0


class Index:
    """Rotations and the layout of their tables."""

    def __init__(self, sample: np.ndarray, n: int, cosine: float, recall: float = RECALL, seed: int = 7):
        d = sample.shape[1]
        self.width = min(64, d)                            # bits of a code
        self.bits = min(max(8, round(math.log2(max(n, 2)))), 32, self.width)
        self.mean = sample.mean(axis=0) if len(sample) else np.zeros(d)
        centred = sample - self.mean
        axes = np.linalg.svd(centred, full_matrices=True)[2][:self.width].T if len(sample) < d else \
            np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :self.width]
        rng = np.random.Generator(np.random.PCG64(seed))
        pairs = _at_threshold(sample, self.mean, cosine, np.random.Generator(np.random.PCG64(seed + 1)))
        free = 1 - math.acos(cosine) / math.pi             # chance that a bit agrees at this angle, centred or not
        self.rotations: list[np.ndarray] = []
        apart: list[np.ndarray] = []                       # differing bits: one array a rotation, kind x pair
        while True:
            self.rotations.append(axes @ self._rotation(centred @ axes, rng))
            if len(sample):
                apart.append(np.stack([self._code(x, -1) ^ self._code(y, -1) for x, y in pairs]))
            total = self.codes * self.width
            differ = sum(np.bitwise_count(x).astype(np.int64) for x in apart) if apart else np.zeros((1, 1))
            agree = min(free, 1 - float(differ.mean(axis=1).max()) / total)
            while self.bits > 1 and self._needed(agree, recall) > TABLES:
                self.bits -= 1
            if self.tables < self._needed(agree, recall):
                continue
            if not apart or self._missed(apart) <= 1 - recall:
                break
            if self.tables >= TABLES:                      # some pairs agree in far fewer bits than most
                if self.bits == 1:
                    break
                self.bits -= 1
        self.most = max((1 - free) * total + SLACK * math.sqrt(total * free * (1 - free)), float(differ.max()),
                        float((differ.mean(axis=1) + SLACK * differ.std(axis=1)).max()))

    @property
    def codes(self) -> int:
        return len(self.rotations)

    @property
    def per_code(self) -> int:
        return self.width // self.bits

    @property
    def tables(self) -> int:
        return self.codes * self.per_code

    def _needed(self, agree: float, recall: float) -> float:
        """Tables of the present substrings that find a pair whose bits agree so often."""
        hit = max(agree, 0.01) ** self.bits
        return math.log(1 - recall) / math.log(1 - hit) if hit < 1 else 1

    def _missed(self, apart: list[np.ndarray]) -> float:
        """Share of the pairs at the threshold, of the worse kind, that share no substring."""
        hit = np.zeros(apart[0].shape, bool)
        for x in apart:
            for s in range(self.per_code):
                hit |= (x >> np.uint64(s * self.bits)) & np.uint64(2**self.bits - 1) == 0
        return float((~hit).mean(axis=1).max())

    def _rotation(self, v: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Alternate the nearest corners and the rotation (orthogonal Procrustes) towards them."""
        r = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))[0]
        for _ in range(STEPS if len(v) else 0):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = w.T @ u.T
        return r

    def _code(self, unit: np.ndarray, k: int) -> np.ndarray:
        bits = np.zeros((len(unit), 64), np.uint8)
        bits[:, 64 - self.width:] = (unit - self.mean) @ self.rotations[k] >= 0
        return np.packbits(bits, axis=1).view(">u8")[:, 0].astype(np.uint64)

    def encode(self, unit: np.ndarray) -> np.ndarray:
        """Codes of unit vectors, one column a rotation."""
        out = np.zeros((len(unit), self.codes), np.uint64)
        for k in range(self.codes):
            out[:, k] = self._code(unit, k)
        return out

    def keys(self, codes: np.ndarray) -> np.ndarray:
        """Bucket of each row in each table: the table's number above the substring."""
        cut = [(codes >> np.uint64(s * self.bits)) & np.uint64(2**self.bits - 1) for s in range(self.per_code)]
        keys = np.stack(cut, axis=2).reshape(len(codes), -1).astype(np.int64)
        return keys + (np.arange(self.tables, dtype=np.int64) << 40)


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """List column of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.maximum(np.abs(vectors).max(axis=1, keepdims=True), 1e-300)     # no overflow of squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _at_threshold(sample: np.ndarray, mean: np.ndarray, cosine: float, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sampled vectors and such at this cosine to them, away from them in any direction and, second,
    in the directions that the vectors differ in."""
    if not len(sample):
        return []
    x = sample[np.arange(PAIRS) % len(sample)]
    out = []
    for away in (rng.standard_normal(x.shape), sample[rng.integers(len(sample), size=PAIRS)] - mean):
        away = away - (away * x).sum(axis=1, keepdims=True) * x
        size = np.linalg.norm(away, axis=1, keepdims=True)
        some = size[:, 0] > 1e-6                           # one vector or one dimension: no other direction
        y = x.copy()
        y[some] = cosine * x[some] + math.sqrt(1 - min(cosine, 1.0) ** 2) * away[some] / size[some]
        out.append((x, y))
    return out


def _pairs(group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one group, the groups being runs of equal rows of ``group``."""
    new = np.ones(len(group), bool)
    new[1:] = (group[1:] != group[:-1]).any(axis=1)
    run = np.cumsum(new) - 1
    end = np.append(np.flatnonzero(new)[1:], len(group))[run]
    left = np.arange(len(group))
    step = 1
    while len(left):
        left = left[left + step < end[left]]
        if len(left):
            yield left, left + step
        step += 1


def _whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``names``."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        last = [b.column(n)[b.num_rows - 1] for n in names]
        same = np.ones(b.num_rows, bool)
        for n, v in zip(names, last, strict=True):
            same &= b.column(n).to_numpy() == v.as_py()
        cut = int(np.flatnonzero(same)[0])
        if cut or (held and [held[-1].column(n)[-1] for n in names] != last):
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


_UNIT = ["bucket", "left", "right"]


def _close(codes: np.ndarray, i: np.ndarray, j: np.ndarray, most: float) -> np.ndarray:
    return np.bitwise_count(codes[i] ^ codes[j]).sum(axis=1) <= most


def _apart(t: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Pairs that this unit of work has to compare: in a pair of parts, only those across."""
    return (t["left"][i] == t["right"][i]) | (t["part"][i] != t["part"][j])


def _active(index: Index):
    """Members of a bucket that have a partner at a small Hamming distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, _UNIT):
            t = {c: table.column(c).to_numpy() for c in (*_UNIT, "part", "node")}
            codes = _matrix(table.column("codes"), np.int64).view(np.uint64)
            found = np.zeros(len(codes), bool)
            for i, j in _pairs(np.stack([t[c] for c in _UNIT], axis=1)):
                near = _close(codes, i, j, index.most) & _apart(t, i, j)
                found[i[near]] = found[j[near]] = True
            names = [*_UNIT, "part", "node"]
            yield pa.RecordBatch.from_arrays([pa.array(t[c][found]) for c in names], names=names)
    return run


def _links(index: Index, cosine: float):
    """(node, number of vectors linked, null, null) and (null, null, a, b) of links that join groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, _UNIT):
            t = {c: table.column(c).to_numpy() for c in (*_UNIT, "part", "node", "copies")}
            codes = _matrix(table.column("codes"), np.int64).view(np.uint64)
            keys, unit = index.keys(codes), _unit(_matrix(table.column("vector")))
            number = t["bucket"] >> 40
            linked = np.zeros(len(codes), np.int64)
            parent = np.arange(len(codes))
            joins = []
            for i, j in _pairs(np.stack([t[c] for c in _UNIT], axis=1)):
                near = _close(codes, i, j, index.most) & _apart(t, i, j)
                i, j = i[near], j[near]
                near = (keys[i] == keys[j]).argmax(axis=1) == number[i]        # the first table that has the pair
                i, j = i[near], j[near]
                near = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
                i, j = i[near], j[near]
                np.add.at(linked, i, t["copies"][j])
                np.add.at(linked, j, t["copies"][i])
                for a, b in zip(i.tolist(), j.tolist(), strict=True):
                    x, y = _root(parent, a), _root(parent, b)
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        joins.append((a, b))
            some = np.flatnonzero(linked)
            a, b = np.array(joins, np.int64).reshape(-1, 2).T
            gap = lambda n: pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(t["node"][some]), pa.array(linked[some]), gap(len(some)), gap(len(some))],
                                             names=["node", "links", "a", "b"])
            yield pa.RecordBatch.from_arrays([gap(len(a)), gap(len(a)), pa.array(t["node"][a]), pa.array(t["node"][b])],
                                             names=["node", "links", "a", "b"])
    return run


def _root(parent: np.ndarray, k: int) -> int:
    while parent[k] != k:
        parent[k] = parent[parent[k]]
        k = parent[k]
    return k


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95,
                 recall: float = RECALL) -> DataFrame:
    """One row a vector: ``id``, ``n_links``, ``component_id`` (smallest id reachable) and ``kept``."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("size", F.when(F.coalesce(usable, F.lit(False)), F.size("vector")))
    sizes = [r["size"] for r in rows.filter("size is not null").groupBy("size").count().orderBy(F.desc("count"), "size").collect()]
    out = rows.filter("size is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    for size in sizes:                                     # a cosine needs one length: each has an index of its own
        out = out.unionByName(_of_length(rows.filter(F.col("size") == size).select("id", "vector"), size, cosine, recall))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def _of_length(rows: DataFrame, size: int, cosine: float, recall: float) -> DataFrame:
    """(id, n_links, component_id) of usable vectors of one length."""
    spark = rows.sparkSession
    classes = materialize(rows.groupBy("vector").agg(F.min("id").alias("node"), F.count("*").alias("copies")), name="vector-classes")
    n = classes.count()
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vector").toArrow().column(0)
    index = Index(_unit(_matrix(sample)) if n else np.zeros((0, max(size, 1))), n, cosine, recall)

    def encode(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codes = index.encode(_unit(_matrix(b.column("vector"))))
        ends = np.arange(len(b) + 1)
        yield pa.RecordBatch.from_arrays(
            [b.column("node"), b.column("copies"), b.column("vector"), list_array(codes.view(np.int64).ravel(), ends * index.codes),
             list_array(index.keys(codes).ravel(), ends * index.tables)], names=["node", "copies", "vector", "codes", "keys"])

    nodes = materialize(map_batches(classes.select("node", "copies", "vector"), encode,
                                    "node long, copies long, vector array<double>, codes array<long>, keys array<long>"), name="vector-codes")
    entries = nodes.select("node", F.explode("keys").alias("bucket"))
    parts = (entries.groupBy("bucket").count().filter("count > 1")
             .select("bucket", F.ceil(F.col("count") / MEMBERS).cast("int").alias("parts")))
    work = (entries.join(apart(parts), "bucket").withColumn("part", F.pmod(F.hash("node"), F.col("parts")))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("bucket", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"), "part", "node"))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(partitions(spark), *_UNIT).sortWithinPartitions(*_UNIT, "node")
    active = dealt(work.join(nodes.select("node", "codes"), "node")).mapInArrow(
        _active(index), "bucket long, left int, right int, part int, node long")
    active = materialize(active, name="vector-active")
    found = dealt(active.join(nodes.drop("keys"), "node")).mapInArrow(_links(index, cosine), "node long, links long, a long, b long")
    found = materialize(found, name="vector-links")
    links = found.filter("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.filter("a is not null").select("a", "b"), "vectors")
    per_class = classes.join(links, "node", "left").join(groups, "node", "left").select(
        "vector", "node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"))
    return rows.join(per_class, "vector").select("id", "n_links", "component_id")
