"""Packing into fixed-length sequences: shortest-pack-first over the length histogram.

Documents are tokenised, closed by an end id and cut into pieces of at most
``length`` tokens.  Only the histogram of piece lengths (``length`` counts) goes
to the driver.  There, lengths are placed longest first, each into the shortest
open pack that has room; a pack stands for all sequences of its pattern, so a step
moves counts, not pieces, and there are at most two patterns a length.  Every place
of a pattern takes a range of the ranks of its length's pieces, so the plan is
joined back by (length, rank): a piece finds its sequence and offset in the
sorted range bounds, which every task holds.  Ranks come from counts per
(length, deal), so no length, however common, is numbered in one task.

Results for odd input: null text is empty and becomes one piece of the end id; a
very long text, or one of white space alone, becomes as many pieces as it needs;
rows with one id are packed each; pieces of one length take their ranks by deal, id,
start and ids, so a tie is between equal pieces; other columns are not looked at,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tontine.llm.batches import partitions, small_batches
from tontine.llm.words import row_slices, utf8
from tontine.sources.sinks import materialize

Pack = tuple[int, ...]
# Fixed value: how byte-level tokenizers cut a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of text of which a task holds the ids at once.
BATCH_BYTES = 4 << 20
#: White space in a row from which on the library's own encoder is asked: the other one gives up on very long runs.
LONG_RUN = 100_000
_RUN = re.compile(r"\s+")


def tokenizer(path: str, pattern: str = PATTERN) -> tiktoken.Encoding:
    """Encoder of a byte-level BPE vocabulary in a ``tokenizers`` file: its tokens are ranked by their
    ids, its added tokens are cut out first.  (The ids are those of the ``tokenizers`` library, whose
    own encoder takes several times as long; see the README.)"""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]      # bytes that stand for themselves
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): rank for token, rank in model["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def has_long_run(text: str) -> bool:
    return len(text) > LONG_RUN and any(m.end() - m.start() > LONG_RUN for m in _RUN.finditer(text))


class Ids:
    """Ids of texts by a ``tokenizers`` file, the end id not included."""

    def __init__(self, path: str):
        self.path, self.encoder, self.library = path, tokenizer(path), None

    def __call__(self, text: str) -> np.ndarray:
        if not has_long_run(text):
            return self.encoder.encode_to_numpy(text, allowed_special="all")
        if self.library is None:
            self.library = tokenizers.Tokenizer.from_file(self.path)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


def shortest_pack_first(counts: dict[int, int], length: int) -> list[tuple[Pack, int]]:
    """(pattern of piece lengths, number of sequences) that hold exactly ``counts`` pieces of
    each length of at most ``length`` tokens."""
    room: dict[int, list[list]] = {}                       # free tokens -> [pattern, sequences]
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            free = max((s for s, packs in room.items() if s >= size and packs), default=None)
            if free is None:
                room.setdefault(length - size, []).append([(size,), left])
                break
            pack, n = room[free].pop()
            taken = min(n, left)
            if n > taken:
                room[free].append([pack, n - taken])
            room.setdefault(free - size, []).append([(*pack, size), taken])
            left -= taken
    return [(pack, n) for free in sorted(room) for pack, n in room[free]]


class Plan:
    """Where each rank of a length goes, as sorted range bounds."""

    def __init__(self, patterns: list[tuple[Pack, int]], counts: dict[int, int]):
        sizes = sorted(counts)
        self.base = dict(zip(sizes, np.cumsum([0, *[counts[s] for s in sizes]])[:-1].tolist(), strict=True))
        following, rows, sequence = dict(self.base), [], 0
        for pack, n in patterns:
            offset = 0
            for size in dict.fromkeys(pack):               # equal lengths stand together: they descend
                times = pack.count(size)
                rows.append((following[size], sequence, offset, size, times))
                following[size] += times * n
                offset += times * size
            sequence += n
        rows.sort()
        self.rows = np.array(rows, np.int64).reshape(-1, 5)

    def place(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of these lengths and ranks (from 0)."""
        key = np.array([self.base[s] for s in size.tolist()], np.int64) + rank
        begin, sequence, offset, width, times = self.rows[np.searchsorted(self.rows[:, 0], key, side="right") - 1].T
        within = key - begin
        return sequence + within // times, offset + within % times * width


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 1024,
                 end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row a piece: ``id``, ``start`` (its document's tokens before it), ``length``,
    ``ids_crc32`` of the little-endian 32-bit ids, ``doc_tokens`` (end id included) and,
    if asked, the ``ids`` themselves, packed the same way."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = (f"id {dict(rows.dtypes)['id']}, start long, length long, ids_crc32 long, doc_tokens long"
              + ", ids binary" * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Ids(path)
        for b in batches:
            for lo, hi in row_slices(utf8(b.column("text"))[1], BATCH_BYTES):
                parts = [encode(t or "") for t in b.column("text").slice(lo, hi - lo).to_pylist()]
                ids, at = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                yield _cut(b.column("id").slice(lo, hi - lo), ids, at, length, end_id, with_ids)
    return rows.mapInArrow(run, schema)


def _cut(column: pa.Array, ids: np.ndarray, at: np.ndarray, length: int, end_id: int, with_ids: bool) -> pa.RecordBatch:
    n = len(column)
    ids = np.insert(ids, at[1:], end_id).astype("<u4")
    at = at + np.arange(n + 1)
    total = np.diff(at)
    pieces = -(-total // length)
    row = np.repeat(np.arange(n), pieces)
    start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
    size = np.minimum(length, total[row] - start)
    data = memoryview(ids.tobytes())
    parts = [data[4 * a:4 * (a + s)] for a, s in zip((at[row] + start).tolist(), size.tolist(), strict=True)]
    columns = {"id": column.take(pa.array(row)), "start": pa.array(start), "length": pa.array(size),
               "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()), "doc_tokens": pa.array(total[row])}
    if with_ids:
        columns["ids"] = pa.array([bytes(p) for p in parts], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def ranked(pieces: DataFrame) -> DataFrame:
    """The pieces with ``rank``, a number from 0 among the pieces of their length."""
    deals = 4 * partitions(pieces.sparkSession)
    dealt = pieces.withColumn("deal", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(deals)))
    earlier = Window.partitionBy("length").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    base = (dealt.groupBy("length", "deal").count()
            .select("length", "deal", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")))
    own = Window.partitionBy("length", "deal").orderBy("id", "start", "ids_crc32")
    return (dealt.withColumn("own", F.row_number().over(own) - 1).join(base, ["length", "deal"])
            .withColumn("rank", F.col("before") + F.col("own")).drop("own", "before", "deal"))


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 1024,
         end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """The rows of ``token_pieces`` with ``sequence_id`` and ``offset`` in the sequence."""
    pieces = materialize(token_pieces(docs, path, id_col, text_col, length, end_id, with_ids), name="pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}   # at most ``length`` rows
    plan = Plan(shortest_pack_first(counts, length), counts)
    numbered = ranked(pieces)
    schema = T.StructType([*[f for f in numbered.schema.fields if f.name != "rank"],
                           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = plan.place(b.column("length").to_numpy(), b.column("rank").to_numpy())
            kept = [f.name for f in schema if f.name not in ("sequence_id", "offset")]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(sequence), pa.array(offset)],
                                             names=[*kept, "sequence_id", "offset"])
    return numbered.mapInArrow(run, schema)
