"""b-bit MinHash near-dedup on word shingles.

Every document's set of distinct shingles is hashed by ``PERMUTATIONS`` universal
hashes; the low ``BITS`` bits of each minimum are packed into a signature of
``PERMUTATIONS * BITS / 64`` longs, and bands of ``ROWS`` whole minima are keys.
Documents with equal sets are one class first (grouped by a 128-bit hash of the
set), so copies never meet in a band.  Two classes that share a band are a
candidate; the bits in which their signatures agree, corrected for agreement by
chance (2^-BITS), estimate their similarity, and a candidate far below the
threshold (``SLACK``, five standard errors) is left.  The others are confirmed on
their full sets, so links are exact; two documents at similarity 0.85 share none
of the 25 bands with probability 4e-7 (at 0.80: 5e-5).

A band's group of any size is linked as a star to its smallest member first.
Only members that are still in different components afterwards are compared with
one another, in matrix products that give out confirmed links alone, so a large
group of near copies costs a few links a member and no link between different
components is lost.

Results for odd input: null or blank text has no set and links with nothing; a
text of fewer words than a shingle has its whole sequence as one; rows with one
id are one node; a null id has no component and is kept; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.batches import list_array, map_batches, small_batches
from tontine.llm.graph import components, dealt
from tontine.llm.words import Words, mix, row_slices, utf8
from tontine.sources.sinks import materialize

PERMUTATIONS, BITS, ROWS = 128, 2, 5
BANDS = PERMUTATIONS // ROWS
PLANES = PERMUTATIONS // 64
#: Allowed shortfall of an estimate: five standard errors at the threshold.
SLACK = 0.185
#: Members of a band that one task compares with one another; a larger band is cut into parts
#: of about so many, and every pair of parts is a task's group.
MEMBERS = 2000

_rng = np.random.Generator(np.random.PCG64(8))
_A = _rng.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)
_KEY = _rng.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _rng.integers(0, 2**63, BANDS, dtype=np.uint64)


def minima(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Smallest value of every permutation over each row's shingles; rows are not empty."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((PERMUTATIONS, len(offsets) - 1), np.uint32)
    for p in range(PERMUTATIONS):
        out[p] = np.minimum.reduceat(x * _A[p] + _B[p], offsets[:-1])
    return out


def packed(low: np.ndarray) -> np.ndarray:
    """Signature of each row: the BITS low bits of the minima, one plane of longs a bit."""
    planes = []
    for bit in range(BITS):
        flags = ((low >> np.uint32(bit)) & np.uint32(1)).astype(np.uint8).T
        planes.append(np.ascontiguousarray(np.packbits(flags, axis=1)).view(np.int64))
    return np.concatenate(planes, axis=1)


def band_keys(low: np.ndarray) -> np.ndarray:
    """64-bit key of each row's bands of whole minima."""
    m = low[:BANDS * ROWS].reshape(BANDS, ROWS, -1).astype(np.uint64)
    return np.ascontiguousarray(mix((m * _KEY[:, :, None]).sum(axis=1) + _SALT[:, None]).T).view(np.int64)


def distinct_per_row(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's hashes, ascending and once, and their row offsets."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[new], np.searchsorted(r[new], np.arange(len(offsets)))


_FEATURES = "id long, n_shingles long, set_a long, set_b long, signature array<long>, bands array<long>"


def _features(shingle: int):
    def run(batch: pa.RecordBatch):
        data, offsets = utf8(batch.column("text"))
        for lo, hi in row_slices(offsets):
            words = Words(data, offsets[lo:hi + 1], lower=True)
            h, at = distinct_per_row(*words.shingles(shingle))
            n = np.diff(at)
            full = np.flatnonzero(n)
            sets = np.zeros((2, hi - lo), np.uint64)
            signature = np.zeros((hi - lo, BITS * PLANES), np.int64)
            keys = np.zeros((0, BANDS), np.int64)
            if len(full):
                starts = at[:-1][full]
                for lane, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
                    sets[lane, full] = np.add.reduceat(mix(h ^ np.uint64(salt)), starts)
                low = minima(h, np.append(starts, len(h)))
                signature[full], keys = packed(low), band_keys(low)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").slice(lo, hi - lo), pa.array(n, pa.int64()),
                pa.array(sets[0].view(np.int64)), pa.array(sets[1].view(np.int64)),
                list_array(signature.ravel(), np.arange(hi - lo + 1) * (BITS * PLANES)),
                list_array(keys.ravel(), np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]))],
                names=["id", "n_shingles", "set_a", "set_b", "signature", "bands"])
    return run


def set_rows(rows: DataFrame, shingle: int, lower: bool = True) -> DataFrame:
    """(id, shingles): the distinct shingle hashes of each row's text, ascending."""
    def run(batch: pa.RecordBatch):
        data, offsets = utf8(batch.column("text"))
        for lo, hi in row_slices(offsets):
            h, at = distinct_per_row(*Words(data, offsets[lo:hi + 1], lower=lower).shingles(shingle))
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), list_array(h.view(np.int64), at)],
                                             names=["id", "shingles"])
    return map_batches(rows.select("id", "text"), run, "id long, shingles array<long>")


def agreement(left: str, right: str):
    """Share of permutations whose low bits agree in two signature columns."""
    differ = F.lit(0)
    for w in range(PLANES):
        bits = [F.col(left)[b * PLANES + w].bitwiseXOR(F.col(right)[b * PLANES + w]) for b in range(BITS)]
        any_bit = bits[0]
        for b in bits[1:]:
            any_bit = any_bit.bitwiseOR(b)
        differ = differ + F.bit_count(any_bit)
    return 1 - differ / F.lit(float(PERMUTATIONS))


def estimate(left: str, right: str):
    """Similarity from packed signatures, corrected for chance agreement."""
    chance = 2.0 ** -BITS
    return (agreement(left, right) - chance) / (1 - chance)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of which the intersection has at least ``percent`` % of the union's size."""
    side = lambda s: sets.select(F.col("id").alias(s), F.col("shingles").alias(f"set_of_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("common", F.size(F.array_intersect("set_of_a", "set_of_b")))
    union = F.size("set_of_a") + F.size("set_of_b") - F.col("common")
    return both.filter(F.col("common") * 100 >= union * percent).select("a", "b")


def confirmed_components(nodes: DataFrame, keys: DataFrame, rows: DataFrame, percent: int, shingle: int,
                         lower: bool = True) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) confirmed on full sets and the components (node, component) they make.

    ``nodes`` has (node, n = set size) and, if candidates are to be estimated first, their packed
    ``signature``; ``keys`` has (key, node); ``rows`` has (id, text) of the nodes.
    """
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last")
    shared = materialize(keys.join(dealt(hubs.select("key", "hub")), "key"), name="minhash-shared")
    wanted = shared.select(F.col("node").alias("id")).distinct()
    sets = materialize(set_rows(rows.join(wanted, "id", "left_semi"), shingle, lower), name="minhash-sets")
    side = lambda s: nodes.withColumnsRenamed({c: s if c == "node" else f"{s}_{c}" for c in nodes.columns})
    likely = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    if "signature" in nodes.columns:
        likely = likely & (estimate("a_signature", "b_signature") >= percent / 100.0 - SLACK)

    # every member of a band with the band's smallest
    stars = (shared.filter("node > hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
             .join(side("a"), "a").join(side("b"), "b").filter(likely).select("a", "b"))
    links = materialize(_confirmed(stars, sets, percent), name="minhash-links")
    found = components(links, "minhash-stars")

    # members of a band that are still apart, with one another
    placed = (shared.select("key", "node").join(found, "node", "left")
              .select("key", "node", F.coalesce("component", "node").alias("component")))
    apart = (placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                       F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
             .filter("lo < hi").select("key", "parts"))
    rest = (placed.join(dealt(apart), "key").join(nodes, "node").join(sets.withColumnRenamed("id", "node"), "node")
            .withColumn("part", F.pmod(F.hash("node"), F.col("parts")))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("left", F.least("part", "other")).withColumn("right", F.greatest("part", "other")))
    columns = ["key", "left", "right", "part", "node", "component", "shingles", *[c for c in ("signature",) if c in nodes.columns]]
    more = rest.select(*columns).groupBy("key", "left", "right").applyInArrow(_links_apart(percent), "a long, b long")
    links = materialize(links.unionByName(more.distinct()), name="minhash-all-links")
    return links, components(links, "minhash-all")


def _links_apart(percent: int):
    """Links between members of a band, or of two parts of a large one, that are in different
    components: estimated from signatures, then confirmed on the sets, all pairs of the parts in
    matrix products.  A link that joins what others have joined already is left out."""
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part").to_numpy()
        here = [np.flatnonzero(part == table.column(side)[0].as_py()) for side in ("left", "right")]
        node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
        sets = table.column("shingles").combine_chunks()
        at = sets.offsets.to_numpy()
        size = np.diff(at)
        x, y = here
        likely = component[x][:, None] != component[y][None, :]
        likely &= np.minimum(size[x][:, None], size[y]) * 100 >= np.maximum(size[x][:, None], size[y]) * percent
        if "signature" in table.column_names:
            sign = table.column("signature").combine_chunks().values.to_numpy().reshape(len(node), -1)
            likely &= _estimates(sign[x], sign[y]) >= percent / 100.0 - SLACK
        x, y, likely = x[likely.any(axis=1)], y[likely.any(axis=0)], likely[likely.any(axis=1)][:, likely.any(axis=0)]
        if not len(x):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        common = _common(sets.values.to_numpy(), at, x, y)
        linked = likely & (common * 100 >= (size[x][:, None] + size[y] - common) * percent)
        pairs = _forest([(x[i], y[j]) for i, j in zip(*np.nonzero(linked), strict=True)], component)
        return pa.table({"a": pa.array([node[i] for i, _ in pairs], pa.int64()), "b": pa.array([node[j] for _, j in pairs], pa.int64())})
    return run


def _estimates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Corrected similarity of all pairs of signatures."""
    left, right = left.view(np.uint64), right.view(np.uint64)      # bitwise_count takes a signed number's magnitude
    differ = np.zeros((len(left), len(right)), np.int64)
    for w in range(PLANES):
        any_bit = np.zeros(differ.shape, np.uint64)
        for b in range(BITS):
            any_bit |= left[:, b * PLANES + w][:, None] ^ right[:, b * PLANES + w]
        differ += np.bitwise_count(any_bit)
    chance = 2.0 ** -BITS
    return (1 - differ / PERMUTATIONS - chance) / (1 - chance)


def _common(values: np.ndarray, at: np.ndarray, x: np.ndarray, y: np.ndarray, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of the sets x with the sets y, a range of shingles at a time."""
    rows = np.unique(np.concatenate([x, y]))
    _, code = np.unique(np.concatenate([values[at[r]:at[r + 1]] for r in rows]), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), at[rows + 1] - at[rows])
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    out = np.zeros((len(x), len(y)), np.float32)
    in_x, in_y = np.searchsorted(rows, x), np.searchsorted(rows, y)
    for lo in range(0, int(code[-1]) + 1, width):
        a, b = np.searchsorted(code, [lo, lo + width])
        has = np.zeros((len(rows), width), np.float32)
        has[owner[a:b], code[a:b] - lo] = 1
        out += has[in_x] @ has[in_y].T
    return np.rint(out).astype(np.int64)


def _forest(pairs: list[tuple[int, int]], component: np.ndarray) -> list[tuple[int, int]]:
    """The pairs that join components which earlier ones have not."""
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while c in parent:
            c = parent[c]
        return c
    kept = []
    for i, j in pairs:
        a, b = root(int(component[i])), root(int(component[j]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append((i, j))
    return kept


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                shingle: int = 5) -> DataFrame:
    """One row a document: ``id``, ``n_shingles``, ``component_id`` (smallest id reachable over
    links of at least ``percent`` % similarity) and ``kept`` (the id is its component's)."""
    small_batches(docs.sparkSession)
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    features = materialize(map_batches(text, _features(shingle), _FEATURES), name="minhash-features")

    classes = (features.filter("n_shingles > 0 and id is not null").groupBy("set_a", "set_b")
               .agg(F.min("id").alias("node"), F.first("n_shingles").alias("n"),
                    F.first("signature").alias("signature"), F.first("bands").alias("bands")))
    nodes = materialize(classes, name="minhash-classes")
    _, final = confirmed_components(
        nodes.select("node", "n", "signature"), nodes.select("node", F.explode("bands").alias("key")), text, percent, shingle)

    in_class = (features.select("id", "n_shingles", "set_a", "set_b")
                .join(nodes.select("set_a", "set_b", "node"), ["set_a", "set_b"], "left")
                .join(final, "node", "left"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id"))
    return (in_class.select("id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))))
