import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tontine.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = [*"ab c'dé\n\t  \x85\x1cß漢字1²٣½!?.,", "<|endoftext|>", "'s", "'ll", "  ", "\r\n", "😀", "é", " "]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(PATH).ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.vocabulary(PATH), public_tokenizers.PATTERN)


def noise(rnd, n, most=1):
    return "".join(rnd.choice(ALPHABET) * rnd.choice([1, 1, 1, most]) for _ in range(n))


def test_batches_match_library(encoder, library):
    rnd = random.Random(1)
    texts = [noise(rnd, rnd.randrange(40)) for _ in range(3000)] + [None, "", " ", "a" * 5000, "ab" * 300 + " " * 400]
    ids, at = bpe.encode_texts(encoder, pa.array(texts))
    for k, t in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == library.encode_ordinary(t or ""), repr(t)


def test_stitching_matches_library(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "LOOKAHEAD", 4)
    rnd = random.Random(2)
    for _ in range(400):
        text = noise(rnd, rnd.randrange(200), 40)
        parts = bpe.chunks_of(text, 50, 20)
        got = bpe.stitch(encoder, list(zip(parts, encoder(parts), strict=True)), 50)
        assert got.tolist() == library.encode_ordinary(text), repr(text)


def test_documents_round_trip(documents, library):
    rnd = random.Random(3)
    rows = [(k, noise(rnd, rnd.randrange(60))) for k in range(60)]
    rows += [(1, rows[0][1]), (1, rows[0][1]), (None, "null id"), (100, None), (101, ""),
             (102, "word " * 20000), (103, "x" * 70000), (104, noise(rnd, 30000)), (104, noise(rnd, 30000)), (105, " " * 50000)]
    for chunk, overlap in ((bpe.CHUNK, bpe.OVERLAP), (300, 100)):
        out = bpe.decode_ids(bpe.encode_documents(documents(rows), PATH, public_tokenizers.PATTERN, chunk=chunk,
                                                  overlap=overlap), PATH).collect()
        got = sorted((str(r.id), bytes(r.decoded), tuple(r.ids)) for r in out)
        want = sorted((str(i), (t or "").encode(), tuple(library.encode_ordinary(t or ""))) for i, t in rows)
        assert got == want


def test_empty_table(documents):
    assert bpe.encode_documents(documents([(1, "a")]).limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    assert np.array_equal(bpe.encode_texts(bpe.Encoder(bpe.vocabulary(PATH), public_tokenizers.PATTERN),
                                           pa.array([], pa.string()))[1], [0])


def test_every_code_point_is_classed_as_the_library_does(encoder, library):
    """Unicode tables of the modules differ by some 17,000 code points."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert len(bpe.class_changes()) > 1000
    blocks = ["".join(f"{c}'d a{c}1 {c} {c}{c}x\n" for c in points[k:k + 400]) for k in range(0, len(points), 400)]
    changed = [f"{chr(c)}'d" for c in bpe.class_changes()] + [f" {chr(c)}'s 1{chr(c)}" for c in bpe.class_changes()]
    for texts in (blocks, changed):
        ids, at = bpe.encode_texts(encoder, pa.array(texts))
        for k, want in enumerate(library.encode_ordinary_batch(texts)):
            assert ids[at[k]:at[k + 1]].tolist() == want, (k, texts[k][:20])
