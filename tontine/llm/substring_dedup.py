"""Substring dedup by difference-cover anchors.

A window of ``window`` words is removed from a document when the same word
sequence also starts in a document with a smaller id.  A difference cover D
modulo v holds, for any two positions i and j, an offset d < v with both
``(i + d) mod v`` and ``(j + d) mod v`` in D.  So two equal windows share an
anchor of ``window - v + 1`` words that begins at a cover position of both
documents, and only these positions (3 of 7 for 13 words) are hashed and
shuffled.  Windows over a shared anchor are then extended: their whole word
sequences are compared, by 96-bit hashes, through the smallest document id.

Spark plan: documents are dealt into blocks once; the same exchange serves all
three steps.  Each block sends its distinct anchors (then its distinct
candidate windows with the block's smallest id) to the bucket of their hash, as
one packed row a bucket, and gets back those which other blocks have too.  A
passage that a third of all documents hold is thus one entry a block, however
often it occurs there; no list of documents or pairs is ever built.

Results for odd input: null text counts as empty; a document of fewer words than
a window keeps all of them; rows with the same id never remove each other's
words; rows whose id is null neither remove nor lose words; a text of any length
is read whole; other columns are not looked at, whatever their names, but for those
of ``keep``; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tontine.llm.batches import arrow_schema, fresh_name, partitions, small_batches
from tontine.llm.words import Words, utf8

# Perfect difference sets, period -> residues.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
#: Shortest anchor, in words; shorter ones would be shared by chance.
LEAST_ANCHOR = 7
#: Blocks of documents a shuffle partition; one block is what a step holds in memory (about
#: 15 bytes for each byte of its texts).
BLOCKS_PER_PARTITION = 4
#: Buckets of hashes a shuffle partition; every block sends each bucket one packed row.
BUCKETS_PER_PARTITION = 1

_REQUEST = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("block", T.IntegerType()),
                         T.StructField("hash", T.BinaryType()), T.StructField("check", T.BinaryType()),
                         T.StructField("first_id", T.BinaryType())])
_REPLY = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("hash", T.BinaryType())])


def cover_for(window: int) -> tuple[int, np.ndarray, int]:
    """Period, residues and anchor length for a window of so many words: the largest
    cover that leaves anchors of ``LEAST_ANCHOR`` words, or every position if none does."""
    fit = [v for v in COVERS if window - v + 1 >= LEAST_ANCHOR]
    period = max(fit, default=1)
    member = np.zeros(period, bool)
    member[list(COVERS.get(period, (0,)))] = True
    return period, member, window - period + 1


class _Block:
    """Words of a block's documents and which of its windows start where."""

    def __init__(self, table: pa.Table, window: int):
        self.table = table
        ids = table.column("id")
        known = np.asarray(ids.is_valid().combine_chunks())
        self.ids = ids.fill_null(0).to_numpy().astype(np.int64)
        self.words = Words(*utf8(table.column("text")))
        rows = self.words.rows()
        self.word_id = self.ids[rows]
        self.word_known = known[rows] if len(rows) else np.zeros(0, bool)
        self.window_at = self.words.fits(window) & self.word_known

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of the anchors and their hashes."""
        period, member, length = cover_for(window)
        at = np.flatnonzero(member[self.words.position() % period] & self.words.fits(length) & self.word_known)
        return at, self.words.windows(length)[at]


def _requests(block: int, hashes: np.ndarray, n_buckets: int, check=None, first_id=None) -> pa.Table:
    """Packed rows, one a bucket; ``hashes`` ascend and buckets are ranges of them."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    begin, end = np.append(0, cuts), np.append(cuts, len(hashes))
    if not len(hashes):
        begin = end = np.empty(0, np.int64)
    pack = lambda a: [None if a is None else a[b:e].tobytes() for b, e in zip(begin, end, strict=True)]
    return pa.table([pa.array(bucket[begin].astype(np.int32)), pa.array(np.full(len(begin), block, np.int32)),
                     pa.array(pack(hashes), pa.binary()), pa.array(pack(check), pa.binary()),
                     pa.array(pack(first_id), pa.binary())], schema=arrow_schema(_REQUEST))


def _replies(blocks: pa.ChunkedArray, sizes: np.ndarray, hashes: np.ndarray, chosen: np.ndarray) -> pa.Table:
    """The chosen hashes, back to the block that sent each."""
    ends = np.cumsum(sizes)
    out = [hashes[e - s:e][chosen[e - s:e]].tobytes() for s, e in zip(sizes, ends, strict=True)]
    table = pa.table([blocks.combine_chunks(), pa.array(out, pa.binary())], schema=arrow_schema(_REPLY))
    return table.filter(pa.array([len(x) > 0 for x in out], pa.bool_()))


def _joined(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """All packed values of a column and how many each row has."""
    parts = [np.frombuffer(x, kind) for x in column.to_pylist()]
    return np.concatenate(parts), np.array([len(p) for p in parts])


def _shared_anchors(requests: pa.Table) -> pa.Table:
    """Anchors of a bucket that more than one block has sent."""
    hashes, sizes = _joined(requests.column("hash"), np.uint64)
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    shared = np.zeros(len(hashes), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    return _replies(requests.column("block"), sizes, hashes, shared)


def _later_windows(requests: pa.Table) -> pa.Table:
    """Windows of a bucket whose sequence starts in a smaller document of another block."""
    hashes, sizes = _joined(requests.column("hash"), np.uint64)
    check, _ = _joined(requests.column("check"), np.uint32)
    first, _ = _joined(requests.column("first_id"), np.int64)
    order = np.lexsort((first, check, hashes))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (check[order][1:] != check[order][:-1])
    smallest = first[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    later = np.zeros(len(order), bool)
    later[order] = smallest < first[order]
    return _replies(requests.column("block"), sizes, hashes, later)


def _number(table: pa.Table) -> int:
    return table.column("block")[0].as_py()


def _reply_set(replies: pa.Table) -> np.ndarray:
    parts = [np.frombuffer(x, np.uint64) for x in replies.column("hash").to_pylist()]
    return np.sort(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def _among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending) or not len(values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return ascending[at] == values


def _spread(flag: np.ndarray, reach: int) -> np.ndarray:
    """Positions within ``reach`` after a flagged one, itself included."""
    steps = np.zeros(len(flag) + reach + 1, np.int32)
    at = np.flatnonzero(flag)
    steps[at] += 1
    np.add.at(steps, at + reach, -1)
    return np.cumsum(steps)[:len(flag)] > 0


def _send_anchors(window: int, n_buckets: int):
    def run(table: pa.Table) -> pa.Table:
        block = _Block(table, window)
        return _requests(_number(table), np.unique(block.anchors(window)[1]), n_buckets)
    return run


def _send_windows(window: int, n_buckets: int):
    """Candidate windows of a block: those over an anchor that occurs elsewhere, in another
    block or again in this one."""
    period = cover_for(window)[0]

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return arrow_schema(_REQUEST).empty_table()
        block = _Block(table, window)
        at, hashes = block.anchors(window)
        _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        shared = np.zeros(len(block.word_id) + period, bool)
        shared[at[(counts[inverse] > 1) | _among(hashes, _reply_set(replies))]] = True
        # a window starts at most period - 1 words before its anchor
        near = _spread(shared[::-1], period)[::-1][:len(block.word_id)]
        pick = np.flatnonzero(near & block.window_at)
        one = block.words.windows(window, 0)[pick]
        two = block.words.windows(window, 1)[pick].astype(np.uint32)
        ids = block.word_id[pick]
        order = np.lexsort((ids, two, one))
        one, two, ids = one[order], two[order], ids[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        return _requests(_number(table), one[new], n_buckets, two[new], ids[new])
    return run


def _cut(window: int, joined: bool, schema: pa.Schema):
    """Kept text of every document of a block, from the windows found elsewhere and its own."""
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        block = _Block(table, window)
        words = block.words
        at = np.flatnonzero(block.window_at)
        one = words.windows(window, 0)[at]
        two = words.windows(window, 1)[at].astype(np.uint32)
        ids = block.word_id[at]
        order = np.lexsort((ids, two, one))
        new = np.ones(len(at), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        least = np.empty(len(at), np.int64)
        if len(at):
            least[order] = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        again = np.zeros(len(words.start), bool)
        again[at] = (ids > least) | _among(one, _reply_set(replies))
        gone = _spread(again, window)                    # windows end inside their document
        total = np.concatenate([[0], np.cumsum(gone)])[words.first]
        n_removed = np.diff(total)
        texts, data = [], words.data.tobytes()
        _, offsets = utf8(table.column("text"))
        for r in range(table.num_rows):
            lo, hi = words.first[r], words.first[r + 1]
            body = data[offsets[r]:offsets[r + 1]]
            if joined:
                parts = body.split()
                if n_removed[r]:
                    parts = [parts[k] for k in np.flatnonzero(~gone[lo:hi])]
                body = b" ".join(parts)
            elif n_removed[r]:
                body = _without(body, words.start[lo:hi] - offsets[r], gone[lo:hi])
            texts.append(body)
        kept = pa.array(texts, pa.binary()).cast(pa.string())
        out = {"n_words": pa.array(np.diff(words.first), pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
        columns = [kept if f.name == "kept_text" else out[f.name] if f.name in out else
                   table.column(f.name).cast(f.type) for f in schema]
        return pa.table(columns, schema=schema)
    return run


def _without(body: bytes, start: np.ndarray, gone: np.ndarray) -> bytes:
    """The text without the removed words and the white space after each."""
    change = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    out, at = [], 0
    for lo, hi in zip(change[::2], change[1::2], strict=True):
        out.append(body[at:start[lo]])
        at = start[hi] if hi < len(start) else len(body)
    return b"".join([*out, body[at:]])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                   joined: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row a document: ``id``, the columns of ``keep``, ``n_words``, ``n_removed`` and
    ``kept_text`` (``joined``: the kept words with one space between; else the text as it
    was, without the removed words).  ``id_col`` is an integer column.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tasks = partitions(spark)
    n_blocks, n_buckets = tasks * BLOCKS_PER_PARTITION, tasks * BUCKETS_PER_PARTITION
    own = {c: fresh_name(docs, f"kept_{c}") for c in keep}
    cols = [F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
            F.pmod(F.xxhash64(id_col, text_col), F.lit(n_blocks)).cast("int").alias("block"),
            *[F.col(c).alias(own[c]) for c in keep]]
    dealt = docs.select(*cols).repartition(tasks, "block")
    fields = {f.name: f.dataType for f in docs.schema}
    schema = T.StructType([T.StructField("id", T.LongType()), *[T.StructField(own[c], fields[c]) for c in keep],
                           T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept_text", T.StringType())])
    blocks = dealt.groupBy("block")
    anchors = blocks.applyInArrow(_send_anchors(window, n_buckets), _REQUEST)
    shared = anchors.groupBy("bucket").applyInArrow(_shared_anchors, _REPLY)
    windows = blocks.cogroup(shared.groupBy("block")).applyInArrow(_send_windows(window, n_buckets), _REQUEST)
    later = windows.groupBy("bucket").applyInArrow(_later_windows, _REPLY)
    out = blocks.cogroup(later.groupBy("block")).applyInArrow(_cut(window, joined, arrow_schema(schema)), schema)
    return out.withColumnsRenamed({v: k for k, v in own.items()})
