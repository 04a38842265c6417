import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tontine.llm.packing import Ids, Plan, has_long_run, pack, shortest_pack_first, tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
SYLLABLES = ["the ", "ti", "on ", "é", "\n", " ", "漢字", "a", "\t\t", "<|endoftext|>", "12 ", "!?", "\x85", "  "]


@pytest.mark.parametrize("length", [64, 1024])
def test_plan_places_every_piece_once_and_gapless(length):
    rnd = random.Random(length)
    sizes = [min(length, rnd.choice([length, rnd.randrange(1, length + 1), rnd.randrange(1, 9)])) for _ in range(20000)]
    counts = Counter(sizes)
    patterns = shortest_pack_first(counts, length)
    assert len(patterns) <= 2 * length and all(sum(p) <= length for p, _ in patterns)
    plan = Plan(patterns, counts)
    filled = defaultdict(list)
    for size, n in counts.items():
        for s, o in zip(*plan.place(np.full(n, size), np.arange(n)), strict=True):
            filled[s].append((o, size))
    for places in filled.values():
        at = 0
        for o, size in sorted(places):
            assert o == at
            at += size
        assert at <= length
    assert sum(map(len, filled.values())) == len(sizes)
    assert len(filled) * length <= 1.07 * sum(sizes)


def test_documents_are_packed_whole(documents):
    rnd = random.Random(4)
    rows = [(k, "".join(rnd.choice(SYLLABLES) for _ in range(rnd.randrange(60)))) for k in range(80)]
    rows += [(1, rows[0][1]), (1, rows[0][1]), (None, "null id"), (200, None), (201, ""), (202, "word " * 9000)]
    library = Tokenizer.from_file(PATH)
    for length in (1024, 16):
        out = pack(documents(rows), PATH, length=length, with_ids=True).collect()
        want = Counter()
        for i, t in rows:
            ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
            for a in range(0, len(ids), length):
                part = np.array(ids[a:a + length], "<u4").tobytes()
                want[i, a, len(part) // 4, zlib.crc32(part), len(ids), part] += 1
        assert Counter((r.id, r.start, r.length, r.ids_crc32, r.doc_tokens, bytes(r.ids)) for r in out) == want
        by = defaultdict(list)
        for r in out:
            by[r.sequence_id].append((r.offset, r.length))
        for places in by.values():
            ends = np.cumsum([n for _, n in sorted(places)])
            assert [o for o, _ in sorted(places)] == [0, *ends[:-1].tolist()] and ends[-1] <= length


def test_ids_are_the_tokenizers_librarys(spark):
    """Every text of a given table, and noise, against the library itself."""
    rnd = random.Random(9)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["".join(rnd.choice([*SYLLABLES, "'s", "'LL", "\x1c", "²", "ⅷ", "😀", "a" * 300]) for _ in range(rnd.randrange(50))) for _ in range(3000)]
    own = tokenizer(PATH)
    for t, e in zip(texts, Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode_to_numpy(t, allowed_special="all").tolist() == e.ids, repr(t)


def test_empty_table(documents):
    assert pack(documents([(1, "a")]).limit(0), PATH).count() == 0


def test_long_white_space_is_encoded_as_the_library_does():
    """Runs at which the faster encoder gives up, and shorter ones; other texts do not ask the library."""
    ids, library = Ids(PATH), Tokenizer.from_file(PATH)
    for text in ("a" + " " * 1_000_000 + "b", "\n" * 2_000_000, " x" + "\xa0" * 150_000 + " y", " \t" * 70_000, "a " * 200_000):
        assert ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert not has_long_run("a " * 200_000) and not has_long_run(" " * 1000) and has_long_run("\n" * 200_000)


def test_every_code_point_has_the_ids_of_the_library():
    ids, library = Ids(PATH), Tokenizer.from_file(PATH)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"{c}'d a{c}1 {c} {c}{c}x\n" for c in points[k:k + 400]) for k in range(0, len(points), 400)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids(text).tolist() == want.ids


def test_documents_of_white_space_alone(documents):
    out = pack(documents([(1, " " * 300_000), (2, "\n"), (3, "a" + " " * 250_000 + "b")]), PATH).collect()
    library = Tokenizer.from_file(PATH)
    for i, text in ((1, " " * 300_000), (2, "\n"), (3, "a" + " " * 250_000 + "b")):
        assert sum(r.length for r in out if r.id == i) == len(library.encode(text, add_special_tokens=False).ids) + 1
