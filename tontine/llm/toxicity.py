"""Toxicity by compression distance.

Two zstandard dictionaries are trained on the labelled sample: one on ordinary
text, one that adds what toxic documents have beyond it.  Every window of
``WINDOW`` words of a document is compressed with both; a window that the toxic
dictionary makes shorter by some bytes is evidence, and a logistic calibration
turns the numbers of windows at each margin into a score between 0 and 1.

The ordinary dictionary is zstandard's own cover training.  That training ranks
segments by how many samples hold them, and toxic words are few among ordinary
ones, so the toxic dictionary is made of markers: byte grams of 4 to 8 bytes in a
word, by how many more toxic than ordinary documents hold them once or more, or
twice or more (a likelihood ratio above what chance gives the best of all grams
tried, and high in each half of the sample).  A word counts for its strongest gram
only, so what stands beside a marker is none.  Markers are looked for in each
stratum (language) by itself and in all documents, so a language with few documents
is held against its own ordinary text.  Both dictionaries end in the same ordinary
content, so ordinary windows compress alike and margins stay at 0.

Fitting uses a bounded sample: at most ``TOXIC_ROWS`` and ``ORDINARY_ROWS``
labelled documents of at most ``LEARN_CHARS`` characters, as many of each stratum
as far as it goes, by a hash of the id.  It is fitted in one task, so no text reaches
the driver.  Strata are the values of the language column: it takes part in choosing
the sample and the markers, so another such column gives another model, but a score
never reads it.  Scoring reads every whole text, of any length.

Results for odd input: null text counts as empty and has no windows (the score of
no evidence); labels that are null, or have no document, are left out, and a
document labelled more than once counts as toxic if any label says so; without
labels of both kinds every score is the share of toxic ones (0 without any); rows
with one id are scored each, and equal texts alike; ids whose turns in the sample are
equal follow each other by id; other columns are not looked at, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tontine.llm.batches import small_batches
from tontine.llm.words import SEPARATOR, Words, row_slices, utf8
from tontine.sources.sinks import materialize

WINDOW, STEP = 8, 4
TOXIC_ROWS, ORDINARY_ROWS, LEARN_CHARS = 3000, 9000, 20_000
ORDINARY_BYTES, TOXIC_BYTES = 16384, 4096
GRAMS = (4, 5, 6, 7, 8)
#: Fewest texts of a kind in each half of a stratum.
LEAST = 4
#: Strata whose sizes are known to the sampling, the largest; a rarer one is taken first.
STRATA = 1000
#: Least likelihood ratio (G) above what chance gives the best of all grams tried; a quarter of both in each half.
SURE = 8.0
#: Rounds of choosing each word's strongest gram; share of its words that agree on the byte next to a gram.
ROUNDS, AGREE = 4, 0.9
_MIX = (2654435761, 2246822519, 3266489917, 668265263, 374761393, 2870177451, 1540483477, 3432918353)
MARGINS = (1, 2, 3, 4, 5, 6, 8)
THRESHOLD = 0.3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[SEPARATOR] = 32
_ZSTD = dict(format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
             strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=17, hash_log=15, chain_log=15, search_log=8)


def _plain(text: str) -> bytes:
    """Lower case, single spaces, one at either end."""
    return b" " + b" ".join(_LOWER[np.frombuffer(text.encode(), np.uint8)].tobytes().split()) + b" "


def _grams(text: bytes, size: int) -> np.ndarray:
    """Grams of one length of a text as numbers."""
    b = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = max(len(b) - size + 1, 0)
    v = np.zeros(n, np.uint64)
    for k in range(size):
        v = v * np.uint64(256) + b[k:k + n]
    return v


def _seen(texts: list[bytes], size: int) -> np.ndarray:
    """Grams that more than one of the texts hold; merged by blocks of texts."""
    known, times = np.empty(0, np.uint64), np.empty(0, np.int32)
    for lo in range(0, len(texts), 250):
        v, n = np.unique(np.concatenate([np.unique(_grams(t, size)) for t in texts[lo:lo + 250]]), return_counts=True)
        at = np.searchsorted(known, v)
        old = np.zeros(len(v), bool)
        if len(known):
            old = known[np.minimum(at, len(known) - 1)] == v
        times[at[old]] += n[old].astype(np.int32)
        known, times = (np.insert(x, at[~old], y[~old]) for x, y in ((known, v), (times, n.astype(np.int32))))
    return known[times > 1]


def _counts(grams: np.ndarray, texts: list[bytes], size: int) -> np.ndarray:
    """How many texts hold each gram, once or more (row 0) and twice or more (row 1)."""
    out = np.zeros((2, len(grams)), np.int32)
    for t in texts if len(grams) else []:
        v, n = np.unique(_grams(t, size), return_counts=True)
        at = np.minimum(np.searchsorted(grams, v), len(grams) - 1)
        here = grams[at] == v
        out[0, at[here]] += 1
        out[1, at[here & (n > 1)]] += 1
    return out


def _ratio(toxic: np.ndarray, ordinary: np.ndarray, n_toxic: int, n_ordinary: int) -> np.ndarray:
    """Likelihood ratio G of a gram's frequency in toxic against ordinary texts; 0 unless it is at
    least three times as frequent in toxic ones."""
    n, held = n_toxic + n_ordinary, toxic + ordinary
    part = lambda seen, expected: np.where(seen > 0, 2 * seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-9)), 0)
    g = (part(toxic, held * n_toxic / n) + part(ordinary, held * n_ordinary / n)
         + part(n_toxic - toxic, (n - held) * n_toxic / n) + part(n_ordinary - ordinary, (n - held) * n_ordinary / n))
    return np.where(toxic * n_ordinary > 3 * n_toxic * (ordinary + 0.5), g, 0)


def _held(texts: list[list[bytes]], strongest: dict[bytes, int], n: int) -> np.ndarray:
    """How many texts hold a word of each marker, once or more (row 0) and twice or more (row 1)."""
    out = np.zeros((2, n + 1))
    for words in texts:
        at, times = np.unique(np.fromiter((strongest.get(w, n) for w in words), np.int64, len(words)), return_counts=True)
        out[0, at] += 1
        out[1, at[times > 1]] += 1
    return out[:, :n]


def _unlike(texts: list[bytes]) -> list[bytes]:
    """The texts without near copies of earlier ones, which are no evidence of their own: two least
    hashes of their runs of three words agree."""
    known: set[tuple[int, int, int]] = set()
    out = []
    for t in texts:
        words = t.split()
        runs = np.array([zlib.crc32(b" ".join(words[k:k + 3])) for k in range(max(len(words) - 2, 1))], np.uint64)
        least = [int(((runs * np.uint64(m)) & np.uint64(0xFFFFFFFF)).min()) for m in _MIX]
        keys = {(k, least[k], least[k + 1]) for k in range(0, len(_MIX), 2)}
        if keys.isdisjoint(known):
            out.append(t)
        known |= keys
    return out


def _markers(toxic: list[bytes], ordinary: list[bytes]) -> list[tuple[float, bytes]]:
    """(likelihood ratio, part of a word) of what marks the toxic texts of a stratum."""
    toxic, ordinary = _unlike(toxic), _unlike(ordinary)
    parts = (toxic[0::2], toxic[1::2], ordinary[0::2], ordinary[1::2])
    sizes = [len(p) for p in parts]
    if min(sizes) < LEAST:
        return []
    tried = 0

    def ratios(counts: list[np.ndarray]) -> np.ndarray:
        """Likelihood ratios in the halves and in both, for once or more and twice or more."""
        a, b, c, d = counts
        return np.stack([_ratio(a, c, sizes[0], sizes[2]), _ratio(b, d, sizes[1], sizes[3]),
                         _ratio(a + b, c + d, sizes[0] + sizes[1], sizes[2] + sizes[3])])

    def judged(ratio: np.ndarray, least: float) -> np.ndarray:
        first, second, both = ratio
        return np.where((np.minimum(first, second) > least / 4) & (both > least), both, 0).max(axis=0)

    some: list[tuple[bytes, np.ndarray]] = []
    for size in GRAMS:                                     # by length, so that the grams of one are in memory
        grams = _seen(toxic, size)
        tried += len(grams)
        ratio = ratios([_counts(grams, p, size) for p in parts])
        some += [(int(grams[k]).to_bytes(size, "big"), ratio[:, :, k]) for k in np.flatnonzero(judged(ratio, SURE))]
    least = 2 * np.log(max(tried, 1)) + SURE               # so many grams are tried
    some.sort(key=lambda x: int.from_bytes(x[0], "big"))
    g = judged(np.stack([r for _, r in some], axis=2), least) if some else np.zeros(0)
    found, weight = [v for (v, _), w in zip(some, g, strict=True) if w], g[g > 0]
    one: dict[bytes, bytes] = {}                           # each word once in memory
    words = [[[one.setdefault(w, w) for w in t.split()] for t in p] for p in parts]
    holds: dict[bytes, list[int]] = {}                     # grams of every word
    number = {v: k for k, v in enumerate(found)}
    for w in one:
        x = b" " + w + b" "
        some = {number[x[k:k + n]] for n in GRAMS for k in range(len(x) - n + 1) if x[k:k + n] in number}
        if some:
            holds[w] = sorted(some)
    for _ in range(ROUNDS):                                # a word counts for its strongest gram only
        rank = weight * np.array([1 + 0.02 * len(v) for v in found])
        strongest = {w: max(some, key=lambda k: rank[k]) for w, some in holds.items()}
        now = judged(ratios([_held(p, strongest, len(found)) for p in words]), least)
        now = np.where(weight > 0, now, 0)
        if (now == weight).all():
            break
        weight = now
    return sorted((float(weight[k]), _extended(found[k], [w for p in words[:2] for t in p for w in t if strongest.get(w) == k]))
                  for k in np.flatnonzero(weight))


def _extended(gram: bytes, words: list[bytes]) -> bytes:
    """A gram with the bytes around it that nearly all the words agree on."""
    around = [(b" " + w + b" ").partition(gram) for w in words]
    for side in (0, 2):
        while True:
            have = Counter(x[side][-1:] if side == 0 else x[side][:1] for x in around)
            byte, n = have.most_common(1)[0]
            if not byte or n < AGREE * len(words):
                break
            gram = byte + gram if side == 0 else gram + byte
            around = [(b" " + w + b" ").partition(gram) for w in words if gram in b" " + w + b" "]
    return gram


def toxic_content(toxic: list[tuple[str, bytes]], ordinary: list[tuple[str, bytes]]) -> bytes:
    """Markers of every stratum and of all texts together, of (stratum, text) rows, the heaviest last
    (nearest); each stratum has an equal part of the room."""
    strata = sorted({s for s, _ in toxic})
    found = []
    for s in [None, *strata] if len(strata) > 1 else [None]:
        markers = _markers(*([t for k, t in rows if s in (None, k)] for rows in (toxic, ordinary)))
        if markers:
            found.append(markers)
    chosen: dict[bytes, float] = {}
    for markers in found:
        room = TOXIC_BYTES // len(found)
        for g, part in reversed(markers):
            room -= len(part)
            if room < 0:
                break
            chosen[part] = max(g, chosen.get(part, 0))
    return b"".join(sorted(chosen, key=lambda part: (chosen[part], part)))


@dataclass(frozen=True)
class Model:
    ordinary: bytes                                        # dictionaries
    toxic: bytes
    weights: tuple[float, ...]                             # calibration: intercept first
    prior: float                                           # share of toxic labels; the score without dictionaries

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        return [zstandard.ZstdCompressor(
            dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            compression_params=zstandard.ZstdCompressionParameters(**_ZSTD)) for d in (self.ordinary, self.toxic)]


def _sizes(compressor: zstandard.ZstdCompressor, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    segments = np.stack([begin, size], axis=1).astype("<u8").tobytes()
    out = compressor.multi_compress_to_buffer(zstandard.BufferWithSegments(data.tobytes(), segments))
    return np.fromiter(map(len, out), np.int64, len(begin))


def evidence(compressors: list[zstandard.ZstdCompressor], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: numbers and shares of windows at each margin, their greatest margin and log number."""
    n = len(offsets) - 1
    out = np.zeros((n, 2 * len(MARGINS) + 2))
    words = Words(data, offsets, hashes=False)
    plain = _LOWER[words.data]
    place, counts = words.position(), np.diff(words.first)
    at = np.flatnonzero((place % STEP == 0) & ((place == 0) | (place + WINDOW - STEP < np.repeat(counts, counts))))
    if not len(at):
        return out
    row = words.row_of(at)
    last = np.minimum(at + WINDOW, words.first[row + 1]) - 1
    begin = words.start[at] - (words.start[at] > offsets[row] - offsets[0])        # with the space before
    size = words.end[last] - begin
    margin = _sizes(compressors[0], plain, begin, size) - _sizes(compressors[1], plain, begin, size)
    windows = np.bincount(row, minlength=n)
    some = windows > 0
    for k, least in enumerate(MARGINS):
        held = np.bincount(row, weights=margin >= least, minlength=n)
        out[:, k] = np.log1p(held)
        out[:, len(MARGINS) + k] = held / np.maximum(windows, 1)
    out[some, -2] = np.maximum.reduceat(margin, np.searchsorted(row, np.flatnonzero(some)))
    out[:, -1] = np.log1p(windows)
    return out


def _calibrate(x: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """Logistic weights, intercept first, with the classes weighted to the prior."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    importance = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    w = np.zeros(z.shape[1])
    ridge = np.diag(np.r_[0, np.full(len(w) - 1, 0.01 + 1.0 / len(x))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (importance * p * (1 - p))[:, None]).T @ z + ridge + 1e-6 * np.eye(len(w)),
                               z.T @ (importance * (p - y)) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    slope = w[1:] / scale
    return np.r_[w[0] - slope @ centre, slope]


def fit(toxic: list[str], ordinary: list[str], prior: float, strata: tuple[list[str], list[str]] | None = None) -> Model:
    """A model of labelled texts: two thirds train the dictionaries, the rest calibrates.  ``strata``
    names each text's stratum (one for all if None); markers are looked for in each and in all."""
    names = strata or ([""] * len(toxic), [""] * len(ordinary))
    a, b = ([(s, _plain(t)) for t, s in dict(zip(texts, kinds, strict=True)).items() if t.strip()]
            for texts, kinds in zip((toxic, ordinary), names, strict=True))
    if len(a) < 6 or len(b) < 6:
        return Model(b"", b"", (), prior)
    learnt, rest = [], []
    for rows in (a, b):                                    # thirds of every stratum, in the order given:
        place = Counter()                                  # the ordinary dictionary's training splits by it
        turn = [(place.update((k,)), place[k])[1] % 3 for k, _ in rows]
        learnt.append([r for r, n in zip(rows, turn, strict=True) if n])
        rest.append([t for (_, t), n in zip(rows, turn, strict=True) if not n])
    seen = [t for _, t in learnt[1]]
    try:
        base = zstandard.train_dictionary(ORDINARY_BYTES, seen, k=24, d=6).as_bytes()
    except zstandard.ZstdError:                            # too little text for its statistics
        base = b"".join(seen)[-ORDINARY_BYTES:]
    extra = toxic_content(*learnt)
    if not extra:
        return Model(b"", b"", (), prior)
    model = Model(base, extra + base, (), prior)
    data, offsets = utf8(pa.array([t.strip().decode() for part in rest for t in part]))
    x = np.concatenate([evidence(model.compressors(), data, offsets[lo:hi + 1]) for lo, hi in row_slices(offsets)])
    y = np.r_[np.ones(len(rest[0])), np.zeros(len(rest[1]))]
    return Model(base, extra + base, tuple(_calibrate(x, y, prior).tolist()), prior)


def held_out(id_column):
    """Labels of these ids are never learnt from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", stratum_col: str = "lang") -> Model:
    """A model from the labelled documents that are not held out (bounded sample, see above).  Without
    a column ``stratum_col`` all documents are one stratum."""
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("mark")).dropna()
             .groupBy("id").agg(F.max("mark").alias("mark")).filter(~held_out(F.col("id"))))
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col in docs.columns else F.lit("")
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), stratum.alias("stratum")).dropna()
             .filter(F.length("text") <= LEARN_CHARS))
    usable = marks.join(texts.groupBy("id").agg(F.min("stratum").alias("stratum")), "id")
    usable = materialize(usable.select("id", "stratum", F.when(F.col("mark") >= 1, 0).otherwise(1).alias("kind")), name="toxicity-labels")
    shares = usable.agg(F.avg((F.col("kind") == 0).cast("double"))).first()[0] or 0.0
    sizes = usable.groupBy("kind", "stratum").count().orderBy(F.desc("count"), "kind", "stratum").limit(STRATA)
    # a random number times its stratum's size: the smallest hold as many of each stratum, as far as it goes
    chance = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(2**31)) + 1
    usable = (usable.join(F.broadcast(sizes), ["kind", "stratum"], "left")
              .withColumn("turn", chance.cast("double") * F.coalesce("count", F.lit(1))))
    pick = [usable.filter(F.col("kind") == k).orderBy("turn", "id").limit(n).select("id", "kind", F.col("stratum").alias("name"))
            for k, n in enumerate((TOXIC_ROWS, ORDINARY_ROWS))]
    # at most TOXIC_ROWS + ORDINARY_ROWS ids of some bytes
    rows = (texts.join(F.broadcast(pick[0].unionByName(pick[1])), "id")
            .orderBy(F.xxhash64(F.col("id").cast("string")), "id", "text").limit(2 * (TOXIC_ROWS + ORDINARY_ROWS))
            .select("kind", "text", "name"))
    # the sample is fitted in one task: the driver gets the model (some 20 KB), no text
    fitted = rows.mapInArrow(_fit_rows(float(shares)), "ordinary binary, toxic binary, weights array<double>").first()
    return Model(bytes(fitted.ordinary), bytes(fitted.toxic), tuple(fitted.weights), float(shares)) if fitted else Model(b"", b"", (), float(shares))


def _fit_rows(prior: float):
    """The model of the (kind, text, name) rows of a task, as one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: tuple[list[str], list[str]] = ([], [])
        names: tuple[list[str], list[str]] = ([], [])
        for b in batches:
            for kind, text, name in zip(*[b.column(c).to_pylist() for c in ("kind", "text", "name")], strict=True):
                texts[kind].append(text)
                names[kind].append(name)
        model = fit(*texts, prior, names)
        yield pa.RecordBatch.from_arrays([pa.array([model.ordinary], pa.binary()), pa.array([model.toxic], pa.binary()),
                                          pa.array([list(model.weights)], pa.list_(pa.float64()))], names=["ordinary", "toxic", "weights"])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """``id``, the columns of ``keep`` and ``score`` of every row."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("scored_text"),
                       *[F.col(c).alias(f"kept_{k}") for k, c in enumerate(keep)])
    kept = [f for f in rows.schema.fields if f.name != "scored_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors() if model.weights else []
        for b in batches:
            data, offsets = utf8(b.column("scored_text"))
            for lo, hi in row_slices(offsets):
                if model.weights:
                    x = evidence(compressors, data, offsets[lo:hi + 1])
                    p = 1 / (1 + np.exp(-np.clip(model.weights[0] + x @ np.array(model.weights[1:]), -30, 30)))
                else:
                    p = np.full(hi - lo, model.prior)
                yield pa.RecordBatch.from_arrays([*[b.column(f.name).slice(lo, hi - lo) for f in kept], pa.array(p)],
                                                 names=[*[f.name for f in kept], "score"])
    out = rows.mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))
    return out.withColumnsRenamed({f"kept_{k}": c for k, c in enumerate(keep)})
