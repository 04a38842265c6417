"""Byte-level BPE encoding and decoding with overlapping chunks.

A vocabulary is a file of byte strings and ranks; the pattern cuts a text into
pre-tokens and each is merged from its bytes, lowest rank first.  A text of up to
``CHUNK`` bytes is one chunk.  Longer ones are cut into chunks that overlap by
``OVERLAP`` characters; the chunks are dealt over the cluster and pre-tokenised
and encoded on their own, each as if a pre-token began at its start.  The pattern
reads left to right, so as soon as two neighbouring chunks have a pre-token
boundary in common within their overlap, they agree from there on: chunks are
stitched at the first such place.  Where an overlap has none (one endless
pre-token), both chunks are cut again as one, so results are always exact.

The distinct pre-tokens of a batch are merged together, in numpy, one merge of each
a step.  Decoding looks up the bytes of the ids and concatenates them.

Results for odd input: null text counts as empty and has no ids; text that spells
a special token is ordinary text; rows with one id stay separate rows; a text of any
length, also one endless pre-token, is encoded whole; ids outside the vocabulary cannot
be decoded and raise an error; other columns are not looked at, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tontine.llm.batches import list_array, map_batches, partitions, small_batches
from tontine.llm.words import row_slices, utf8

#: Bytes above which a text is cut into chunks, characters of a chunk, and of the overlap.
CHUNK, OVERLAP = 32768, 512
#: A boundary this near to a chunk's cut end may still move: the pattern looks ahead.
LOOKAHEAD = 16
#: Bytes of text of which a task encodes the distinct words at once.
BATCH_BYTES = 4 << 20
#: Longest pre-token merged in the numpy table; longer ones use a heap.
TABLE_WIDTH = 48

_NONE = np.int64(2**31 - 1)
#: White space twice in a row (RE2): Unicode's White_Space and a few characters more.
_TWO_SPACES = r"[\t-\r\x1c-\x20\x{85}\pZ]{2}"


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ranks of a vocabulary file: lines of a base64 string and a number."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    """The byte string of every id."""
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


class Vocabulary:
    """Ranks of byte strings and the table of pairs that merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.base = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = rank
        self.pairs = pairs
        size = 1 << (max(len(pairs), 1).bit_length() + 3)
        self._mask = size - 1
        self._keys = np.full(size, -1, np.int64)
        self._rank = np.full(size, _NONE, np.int64)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int64, len(pairs))
        slots = self._slots(keys)
        while len(keys):                                   # open addressing, all keys step together
            free = self._keys[slots] < 0
            self._keys[slots[free]] = keys[free]
            placed = self._keys[slots] == keys
            self._rank[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & self._mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)).astype(np.int64) & self._mask

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's concatenation, ``_NONE`` where it is no token."""
        keys = left * self.base + right
        slots = self._slots(keys)
        found = self._keys[slots]
        out = np.where(found == keys, self._rank[slots], _NONE)
        rest = np.flatnonzero((found != keys) & (found >= 0))
        while len(rest):
            slots[rest] = (slots[rest] + 1) & self._mask
            found = self._keys[slots[rest]]
            hit = found == keys[rest]
            out[rest[hit]] = self._rank[slots[rest[hit]]]
            rest = rest[~hit & (found >= 0)]
        return out

    def _merge_table(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids of pieces of up to ``width`` bytes, one merge of each piece a step."""
        n = len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(width + 1, b"\0") for p in pieces), np.uint8).reshape(n, width + 1)
        token = self.single[raw]
        place = np.arange(width + 1)
        alive = place < size[:, None]
        rank = np.full((n, width + 1), _NONE)
        r, c = np.nonzero(alive[:, 1:])
        rank[r, c] = self._merged(token[r, c], token[r, c + 1])
        after = np.broadcast_to(place + 1, (n, width + 1)).copy()
        before = np.broadcast_to(place - 1, (n, width + 1)).copy()
        rows = np.arange(n)
        while len(rows):
            at = rank[rows].argmin(axis=1)
            best = rank[rows, at]
            more = best < _NONE
            rows, at, best = rows[more], at[more], best[more]
            gone = after[rows, at]
            token[rows, at] = best
            alive[rows, gone] = False
            rank[rows, gone] = _NONE
            follow = after[rows, gone]
            after[rows, at] = follow
            ends = follow >= size[rows]
            before[rows[~ends], follow[~ends]] = at[~ends]
            rank[rows, at] = np.where(ends, _NONE, self._merged(best, token[rows, np.minimum(follow, width)]))
            prior = before[rows, at]
            has = prior >= 0
            rank[rows[has], prior[has]] = self._merged(token[rows[has], prior[has]], best[has])
        flat, sizes = token[alive].astype("<u4").tobytes(), alive.sum(axis=1) * 4
        ends = np.cumsum(sizes)
        return [flat[b:e] for b, e in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]

    def _merge_long(self, piece: bytes) -> bytes:
        """Ids of one long piece: a heap of the pairs, in n log n."""
        token = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs, base = self.pairs, self.base
        heap = [(r, k) for k in range(n - 1) if (r := pairs.get(token[k] * base + token[k + 1])) is not None]
        heapify(heap)
        while heap:
            r, k = heappop(heap)
            j = after[k]
            if token[k] < 0 or j >= n or pairs.get(token[k] * base + token[j]) != r:
                continue
            token[k], token[j] = r, -1
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
                if (x := pairs.get(r * base + token[after[k]])) is not None:
                    heappush(heap, (x, k))
            if (i := before[k]) >= 0 and (x := pairs.get(token[i] * base + r)) is not None:
                heappush(heap, (x, i))
        return np.array([t for t in token if t >= 0], "<u4").tobytes()

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids (little-endian, 32 bits) of each pre-token; one that is itself a token
        stays whole."""
        out = [b""] * len(pieces)
        wide: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                out[k] = rank.to_bytes(4, "little")
            elif len(p) > TABLE_WIDTH:
                out[k] = self._merge_long(p)
            else:
                wide.setdefault(-(-len(p) // 8) * 8, []).append(k)
        for width, at in wide.items():
            for lo in range(0, len(at), 8192):
                part = at[lo:lo + 8192]
                for k, ids in zip(part, self._merge_table([pieces[k] for k in part], width), strict=True):
                    out[k] = ids
        return out


#: What a text is cut into: starts of its parts, their numbers of ids, and all ids.
Cut = tuple[np.ndarray, np.ndarray, np.ndarray]


@lru_cache(maxsize=1)
def class_changes() -> dict[int, str]:
    """Code points that ``regex`` does not put into the class of letters, numbers or white space where the
    tokenizers' library has them (their Unicode versions differ), each with a stand-in of the right class.
    The library is asked once, with all code points as one text."""
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    ranks = {bytes([b]): b for b in range(256)}
    stand_in = dict.fromkeys(every, "!")
    changed: set[str] = set()
    for kind, sign in ((r"\p{L}", "x"), (r"\p{N}", "0"), (r"\s", "\t")):
        asked = tiktoken.Encoding("classes", pat_str=kind, mergeable_ranks=ranks, special_tokens={})
        theirs = set(bytes(asked.encode_ordinary(every)).decode())
        changed |= theirs ^ set(regex.findall(kind, every))
        stand_in |= dict.fromkeys(theirs, sign)
    return {ord(c): stand_in[c] for c in changed}


class Encoder:
    """Cuts texts by the pattern and encodes the distinct pre-tokens.  Outside ASCII, the pattern may name
    characters by the classes of letters, numbers and white space only."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.stand_ins = class_changes()
        self.may_differ = re.compile(f"[{chr(min(self.stand_ins, default=0x10FFFF))}-\U0010ffff]")

    def _pieces(self, text: str) -> list[str]:
        if text.isascii() or not self.may_differ.search(text) or self.stand_ins.keys().isdisjoint(map(ord, set(text))):
            return self.pattern.findall(text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.stand_ins))]

    def __call__(self, texts: list[str]) -> list[Cut]:
        cut = [self._pieces(t) for t in texts]
        distinct = list({p for c in cut for p in c})
        ids = dict(zip(distinct, self.vocabulary.encode_pieces([p.encode() for p in distinct]), strict=True))
        out = []
        for pieces in cut:
            packed = [ids[p] for p in pieces]
            sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
            counts = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            out.append((np.cumsum(sizes) - sizes, counts, np.frombuffer(b"".join(packed), "<u4")))
        return out


def _encode_distinct(cut: Callable[[list[str]], list[Cut]], words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, one after the other, and each word's offset and size there."""
    # words that begin with a space and end without make up a text that is cut between them
    plain = np.array([w[:1] == " " and not w[1:2].isspace() and not w[-1].isspace() for w in words], bool)
    body = [w for w, p in zip(words, plain, strict=True) if p]
    (starts, counts, ids), *others = cut(["".join(body), *[w for w, p in zip(words, plain, strict=True) if not p]])
    word = np.searchsorted(np.cumsum([len(w) for w in body]), starts, side="right")
    sizes = np.zeros(len(words), np.int64)
    sizes[plain] = np.bincount(word, weights=counts, minlength=len(body)) if len(body) else 0
    sizes[~plain] = [len(o[2]) for o in others]
    begin = np.empty(len(words), np.int64)
    order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
    begin[order] = np.cumsum(sizes[order]) - sizes[order]
    return np.concatenate([ids, *[o[2] for o in others]]), np.stack([begin, sizes])


def encode_texts(cut: Callable[[list[str]], list[Cut]], texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and the row offsets.

    A single space between two characters that are no white space always begins a pre-token
    (under patterns that give a word its leading space), so each distinct space-separated
    word of the batch is encoded once; texts with white space in a row are cut as a whole.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    plain = pc.invert(pc.match_substring_regex(texts, _TWO_SPACES)).to_numpy(zero_copy_only=False)
    sizes = np.zeros(n, np.int64)
    rows = np.flatnonzero(plain)
    words = pc.split_pattern(texts.filter(pa.array(plain)), " ")
    coded = pc.dictionary_encode(words.flatten())
    code = coded.indices.to_numpy().astype(np.int64)
    row_of = np.asarray(words.value_lengths()).astype(np.int64)
    first = np.zeros(len(code), bool)
    first[np.cumsum(row_of) - row_of] = True
    code = 2 * code + first                                # a row's first word has no space before it
    used = np.flatnonzero(np.bincount(code, minlength=1))
    names = coded.dictionary.to_pylist()
    ids, (begin, size) = _encode_distinct(cut, [names[c >> 1] if c & 1 else " " + names[c >> 1] for c in used.tolist()]
                                          if len(code) else [])
    place = np.searchsorted(used, code)
    count, start = size[place], begin[place]
    ends = np.cumsum(count)
    sizes[rows] = np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(row_of)])])
    flat = ids[np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
    others = np.flatnonzero(~plain).tolist()
    whole = dict(zip(others, (c[2] for c in cut([texts[k].as_py() for k in others])), strict=True))
    if whole:
        at = np.concatenate([[0], np.cumsum(sizes)])
        parts = []
        for k in range(n):
            parts.append(whole[k] if k in whole else flat[at[k]:at[k + 1]])
            sizes[k] = len(parts[-1])
        flat = np.concatenate(parts)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, loaded once a process."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(read_ranks(path))
    return _VOCABULARIES[path]


def chunks_of(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """Parts of a text; each reaches ``overlap`` characters into the next."""
    starts = range(0, max(len(text), 1), chunk)
    return [text[s:s + chunk + overlap] for s in starts]


def stitch(cut: Callable[[list[str]], list[Cut]], parts: list[tuple[str, Cut]], chunk: int = CHUNK) -> np.ndarray:
    """Ids of a whole text from its chunks and what each was cut into on its own."""
    out = []
    text, (starts, counts, ids) = parts[0]
    at = begin = 0                                         # where the running chunk begins, and is valid from
    for k, (next_text, (next_starts, next_counts, next_ids)) in enumerate(parts[1:], 1):
        offset = k * chunk
        mine = starts + at
        sure = mine[(mine >= max(offset, begin)) & (mine <= at + len(text) - LOOKAHEAD)]
        common = sure[np.isin(sure, next_starts + offset)]
        if len(common):
            end = int(common[0])
            out.append(_between(mine, counts, ids, begin, end))
            text, starts, counts, ids, at = next_text, next_starts, next_counts, next_ids, offset
        else:
            # no common boundary: from the last sure one on, cut both chunks as one text
            safe = mine[(mine >= begin) & (mine <= min(offset, at + len(text) - LOOKAHEAD))]
            end = int(safe[-1]) if len(safe) else begin
            out.append(_between(mine, counts, ids, begin, end))
            text = text[end - at:] + next_text[at + len(text) - offset:]
            starts, counts, ids = cut([text])[0]
            at = end
        begin = end
    out.append(_between(starts + at, counts, ids, begin, at + len(text) + 1))
    return np.concatenate(out)


def _between(starts: np.ndarray, counts: np.ndarray, ids: np.ndarray, lo: int, hi: int) -> np.ndarray:
    ends = np.concatenate([[0], np.cumsum(counts)])
    a, b = np.searchsorted(starts, [lo, hi])
    return ids[ends[a]:ends[b]]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row a document: ``id`` and ``ids`` (array of int)."""
    spark = docs.sparkSession
    small_batches(spark, rows=1000)                        # ids and decoded bytes are several times their texts
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["id"]
    is_long = F.octet_length("text") > chunk

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path), pattern)
        for b in batches:
            for lo, hi in row_slices(utf8(b.column("text"))[1], BATCH_BYTES):
                ids, offsets = encode_texts(encoder, b.column("text").slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, hi - lo),
                                                  list_array(ids.view(np.int32), offsets)], names=["id", "ids"])

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k, text in enumerate(batch.column("text").to_pylist()):
            parts = chunks_of(text, chunk, overlap)
            same = pa.array(np.full(len(parts), k))
            yield pa.RecordBatch.from_arrays([batch.column("row").take(same), batch.column("id").take(same),
                                              pa.array(np.arange(len(parts)), pa.int32()), pa.array(parts, pa.string())],
                                             names=["row", "id", "part", "text"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, press = Encoder(vocabulary(path), pattern), zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            done = encoder(b.column("text").to_pylist())
            # starts as distances: small numbers, which the compression makes small
            done = [(np.diff(s, append=len(t)), c, i) for t, (s, c, i) in zip(b.column("text").to_pylist(), done, strict=True)]
            packed = [pa.array([press(c[k].astype("<u4").tobytes()) for c in done], pa.binary()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*b.columns, *packed], names=[*b.schema.names, "sizes", "counts", "ids"])

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        unpress = zstandard.ZstdDecompressor().decompress
        numbers = [[np.frombuffer(unpress(x), "<u4") for x in table.column(c).to_pylist()] for c in ("sizes", "counts", "ids")]
        parts = [(t, (np.cumsum(s, dtype=np.int64) - s, c.astype(np.int64), i))
                 for t, s, c, i in zip(table.column("text").to_pylist(), *numbers, strict=True)]
        ids = stitch(Encoder(vocabulary(path), pattern), parts, chunk)
        return pa.table([table.column("id").slice(0, 1), list_array(ids.view(np.int32), np.array([0, len(ids)]))],
                        names=["id", "ids"])

    short = rows.filter(~is_long).mapInArrow(whole, f"id {kind}, ids array<int>")
    parts = map_batches(rows.filter(is_long).withColumn("row", F.monotonically_increasing_id()), cut,
                        f"row long, id {kind}, part int, text string")
    encoded = parts.repartition(partitions(spark), "row", "part").mapInArrow(
        encode, f"row long, id {kind}, part int, text string, sizes binary, counts binary, ids binary")
    stitched = encoded.groupBy("row").applyInArrow(join, f"id {kind}, ids array<int>")
    return short.unionByName(stitched)


def decode_ids(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The rows of ``encoded`` with the bytes their ids spell in ``out_col``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = token_bytes(read_ranks(path))
        for b in batches:
            column = b.column(ids_col)
            bodies = [b"".join([words[i] for i in row]) if row else b"" for row in _lists(column)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bodies, pa.binary())], names=[*b.schema.names, out_col])
    schema = StructType([*encoded.schema.fields, StructField(out_col, BinaryType())])
    return encoded.mapInArrow(run, schema)


def _lists(column: pa.ListArray) -> Iterator[list[int]]:
    """Rows of a list column, one after the other (null: empty)."""
    for k in range(len(column)):
        values = column[k].values
        yield values.to_numpy().tolist() if values is not None else []
