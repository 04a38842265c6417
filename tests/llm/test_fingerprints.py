import hashlib
import random
import re

import pyarrow as pa

from tests.llm.test_minhash_dedup import edited, shingles
from tontine.llm import fingerprints as P
from tontine.llm import words


def sign(text):
    return P._packed(*P.signatures(pa.array([text], pa.string())))[0]


def test_neighbours_match_brute_force(documents, spark):
    rnd = random.Random(2)
    words = [f"w{k}é" for k in range(300)]
    rows = [(rnd.randrange(10**6), " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 120)))) for _ in range(90)]
    rows += [(2, None), (3, ""), (4, "x"), (5, " \n "), (6, "y " * 40000), (-7, rows[3][1]), (10**7, rows[4][1])]
    got = {r.id: r for r in P.edited_neighbours(documents(rows)).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + n[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert bytes(r.fingerprint) == sign(t) and bytes(r.edited_fingerprint) == sign(e)
        assert r.near_edited == P.likeness(sign(t), sign(e)) and r.near_next == P.likeness(sign(t), sign(n))


def test_odd_tables(documents):
    one = P.edited_neighbours(documents([(1, "a b c d e f g")])).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert P.edited_neighbours(documents([(1, "a")]).limit(0)).count() == 0
    rows = [(None, "n u l l"), (1, "same"), (1, "same"), (1, "other"), (None, None)]
    out = P.edited_neighbours(documents(rows)).collect()
    assert sorted(str(r.id) for r in out) == ["1", "1", "1", "None", "None"]


def test_likeness_estimates_jaccard(documents):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(800)]
    for share in (0.0, 0.02, 0.1, 0.5):
        other = edited(rnd, base, share)
        a, b = shingles(" ".join(base)), shingles(" ".join(other))
        assert abs(P.likeness(sign(" ".join(base)), sign(" ".join(other))) - len(a & b) / len(a | b)) < 0.15
    assert P.likeness(b"", b"") == 1 and P.likeness(sign("a b c"), b"") == 0


def test_near_pairs_connect_near_documents(documents):
    rnd = random.Random(7)
    rows = []
    for _ in range(10):
        base = [f"W{rnd.randrange(3000)}" for _ in range(rnd.randrange(60, 300))]
        rows += [(rnd.randrange(10**9), " ".join(edited(rnd, base, rnd.choice([0, .005, .03])))) for _ in range(8)]
    links, members = P.near_pairs(documents(rows))
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    for r in links.collect():
        assert len(sets[r.a] & sets[r.b]) >= 0.8 * len(sets[r.a] | sets[r.b])
    component = {r.id: r.component_id for r in members.collect()}
    near = [(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert near and set(component) == set(sets) and all(component[i] == component[j] for i, j in near)


def plain_signature(text):
    """128 minima of 5-word shingles with Python's own numbers: word sums, windows, permutations modulo 2^32."""
    whole, half = 2**64 - 1, 2**32 - 1

    def mix(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & whole
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & whole
        return x ^ x >> 31
    given = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    base, byte, coef = int(words._BASE), [int(x) for x in words._BYTE], [int(x) for x in words._COEF[0]]
    hashed = []
    for w in given:
        total, power = 0, 1
        for b in w:
            total, power = total + byte[b] * power & whole, power * base & whole
        hashed.append(mix(total + len(w) & whole))
    n = min(5, len(hashed))
    if not n:
        return b""
    shingles = [mix(sum(h * c for h, c in zip(hashed[k:k + n], coef, strict=False)) + n & whole) >> 32 for k in range(len(hashed) - n + 1)]
    least = [min(x * int(a) + int(b) & half for x in shingles) & 0xFFFF for a, b in zip(P._A, P._B, strict=True)]
    return b"".join(x.to_bytes(2, "little") for x in least)


def test_fingerprints_equal_a_plain_minhash(documents):
    rnd = random.Random(12)
    texts = ["", " \t", "one", "one two three four", "héé 漢字 x\x00y", "a b " * 40]
    texts += [" ".join(rnd.choice(["alpha", "béta", "c", "Δ", "42"]) for _ in range(rnd.randrange(1, 60))) for _ in range(40)]
    got = {r.id: bytes(r.fingerprint) for r in P.fingerprint(documents(list(enumerate(texts)))).collect()}
    assert got == {k: plain_signature(t) for k, t in enumerate(texts)}
