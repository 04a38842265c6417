"""Document fingerprints: MinHash over word shingles.

``PERMUTATIONS`` universal hashes a·x + b (mod 2^32, a odd: a permutation) are
applied to all shingle hashes of a slice of documents in numpy, and each
document keeps the low 16 bits of every minimum.  The share of equal components
estimates the Jaccard similarity of two shingle sets, with a standard error of at
most 0.045; equal texts have equal fingerprints.

``edited_neighbours`` pairs every document with the next one in descending id.
Documents are dealt into ranges of the id, sorted within their task and read as a
stream that holds one document back; the first document of each range also goes
to the range before it (one id a range is all the driver sees), so no range
needs another.  Texts travel compressed.

``near_pairs`` joins signature bands in Spark and verifies Jaccard on whole sets.

Results for odd input: null or blank text has an empty set and an empty
fingerprint; two empty fingerprints are alike (1), an empty one and another are
not (0); a text of fewer words than a shingle has its whole sequence as one; rows
with one id are ordered by their text, null ids come last; a single document is
its own next one; a text of any length is read whole; other columns are not looked at,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.batches import map_batches, partitions, small_batches
from tontine.llm.minhash_dedup import confirmed_components, set_rows
from tontine.llm.words import Words, mix, row_slices, utf8
from tontine.sources.sinks import materialize

PERMUTATIONS, SHINGLE = 128, 5
#: Components of a band: similarity 0.8 shares none of the 32 bands with probability 5e-8.
ROWS = 4

_rng = np.random.Generator(np.random.PCG64(10))
_A = _rng.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)
_KEY = _rng.integers(0, 2**63, (PERMUTATIONS // ROWS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of each text (rows x permutations, 16 bits) and which texts have one."""
    data, offsets = utf8(texts)
    out = np.zeros((len(texts), PERMUTATIONS), "<u2")
    full = np.zeros(len(texts), bool)
    for lo, hi in row_slices(offsets, 1 << 19):
        hashes, at = Words(data, offsets[lo:hi + 1]).shingles(shingle)
        some = np.flatnonzero(np.diff(at))
        if not len(some):
            continue
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        starts, least = at[:-1][some], np.empty((PERMUTATIONS, len(some)), np.uint32)
        for p in range(PERMUTATIONS):
            least[p] = np.minimum.reduceat(x * _A[p] + _B[p], starts)
        out[lo + some] = (least & np.uint32(0xFFFF)).T
        full[lo + some] = True
    return out, full


def _packed(rows: np.ndarray, full: np.ndarray) -> list[bytes]:
    return [r.tobytes() if f else b"" for r, f in zip(rows, full, strict=True)]


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal components."""
    if not a or not b:
        return float(a == b)
    return float((np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")).mean())


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fingerprint): 16 bits of each minimum, little-endian; empty for an empty set."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(_packed(*signatures(b.column("text"), shingle)), pa.binary())],
                                         names=["id", "fingerprint"])
    return map_batches(rows, run, "id long, fingerprint binary")


class _Ranges:
    """Ranges of ids, descending: range k ends before ``bounds[k]``; nulls go to the last."""

    def __init__(self, bounds: list[float]):
        self.bounds = np.array(sorted(set(bounds)), np.float64)

    def of(self, ids: pa.Array) -> np.ndarray:
        known = np.asarray(ids.is_valid())
        place = len(self.bounds) - np.searchsorted(self.bounds, ids.fill_null(0).to_numpy().astype(np.float64), side="right")
        return np.where(known, place, len(self.bounds))


def _heads(docs: DataFrame, ranges: _Ranges) -> dict[int, int | None]:
    """Largest id of each range that has rows: one small row a range."""
    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(ranges.of(b.column("id")), pa.int32()), b.column("id")], names=["range", "id"])
    found = map_batches(docs.select("id"), run, "range int, id long").groupBy("range").agg(F.max("id").alias("head")).collect()
    return {r["range"]: r["head"] for r in found}


_DEALT = "range int, carried boolean, id long, tie long, n_chars long, fingerprint binary, body binary"
_PAIRED = ("id long, n_chars long, fingerprint binary, edited_sha256 string, edited_fingerprint binary, "
           "near_edited double, near_next double")


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    n = len(text) // 2
    return text[:len(text) - n] + following[:n]


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row a document: its fingerprint, the digest and fingerprint of its text edited with that of
    the next document in descending id (after the last: the first), and how alike its fingerprint is
    to the edited text's and to the next document's."""
    spark = docs.sparkSession
    small_batches(spark)
    tasks = partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("tie"))
    shares = [k / tasks for k in range(1, tasks)]
    ranges = _Ranges(rows.select(F.col("id").cast("double")).na.drop().approxQuantile("id", shares, max(0.1 / tasks, 1e-5)) if shares else [])
    heads = _heads(rows, ranges)
    order = sorted(heads)
    before = {r: order[k - 1] for k, r in enumerate(order)}     # the first range's is the last: a ring

    def deal(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        texts = [t or "" for t in b.column("text").to_pylist()]
        signed = pa.array(_packed(*signatures(b.column("text"), shingle)), pa.binary())
        where = ranges.of(b.column("id"))
        body = pa.array([pack(t.encode()) for t in texts], pa.binary())
        count = pa.array([len(t) for t in texts], pa.int64())
        columns = [b.column("id"), b.column("tie"), count, signed, body]
        head = np.flatnonzero([heads[r] == i for r, i in zip(where.tolist(), b.column("id").to_pylist(), strict=True)])
        names = ["range", "carried", "id", "tie", "n_chars", "fingerprint", "body"]
        yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), pa.array(np.zeros(len(where), bool)), *columns], names=names)
        if len(head):
            to = pa.array([before[r] for r in where[head].tolist()], pa.int32())
            yield pa.RecordBatch.from_arrays([to, pa.array(np.ones(len(head), bool)), *[c.take(pa.array(head)) for c in columns]],
                                             names=names)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held = None                                        # the document that waits for its next one
        for b in batches:
            done = []
            for r in zip(*(b.column(c).to_pylist() for c in ("range", "carried", "id", "n_chars", "fingerprint", "body")), strict=True):
                now = (*r[:5], unpack(r[5]).decode())
                if held is not None:
                    done.append((held, now))
                held = None if r[1] else now
            if done:
                texts = [edited_text(a[5], n[5]) for a, n in done]
                signed = _packed(*signatures(pa.array(texts, pa.string()), shingle))
                own = [a[4] for a, _ in done]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a[2] for a, _ in done], pa.int64()), pa.array([a[3] for a, _ in done], pa.int64()),
                     pa.array(own, pa.binary()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                     pa.array(signed, pa.binary()), pa.array(map(likeness, own, signed), pa.float64()),
                     pa.array([likeness(a[4], n[4]) for a, n in done], pa.float64())],
                    names=["id", "n_chars", "fingerprint", "edited_sha256", "edited_fingerprint", "near_edited", "near_next"])

    dealt = (map_batches(rows, deal, _DEALT).repartitionById(max(len(ranges.bounds) + 1, 1), F.col("range"))
             .sortWithinPartitions("range", "carried", F.col("id").desc_nulls_last(), "tie", "fingerprint"))
    return dealt.mapInArrow(pair, _PAIRED)


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80,
               shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) between class representatives that connect all near documents, and the
    membership (id, node, component_id).  Documents of one set are one class; bands of the
    fingerprints are joined and Jaccard is verified on the whole sets."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        signed, full = signatures(b.column("text"), shingle)
        parts = signed.reshape(len(b), -1, ROWS).astype(np.uint64)
        keys = mix((parts * _KEY).sum(axis=2) + np.arange(parts.shape[1], dtype=np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([k.tolist() if f else [] for k, f in zip(keys, full, strict=True)],
                                                                   pa.list_(pa.int64()))], names=["id", "bands"])
    bands = map_batches(rows, run, "id long, bands array<long>")
    members = materialize(set_rows(rows, shingle, lower=False).select("id", F.xxhash64("shingles").alias("set_a"),
                                                                     F.hash("shingles").alias("set_b"), F.size("shingles").alias("n"))
                          .filter("n > 0 and id is not null"), name="fingerprint-members")
    nodes = members.groupBy("set_a", "set_b").agg(F.min("id").alias("node"), F.first("n").alias("n"))
    keys = nodes.join(bands.withColumnRenamed("id", "node"), "node").select("node", F.explode("bands").alias("key")).distinct()
    links, final = confirmed_components(nodes.select("node", "n"), keys, rows, percent, shingle, lower=False)
    placed = (members.join(nodes.drop("n"), ["set_a", "set_b"]).join(final, "node", "left")
              .select("id", "node", F.coalesce("component", "node").alias("component_id")))
    return links, placed
