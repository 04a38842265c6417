import random
import re

import pytest

from tontine.llm import minhash_dedup as M
from tontine.llm.graph import components
from tontine.llm.words import Words, utf8

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}


def brute(rows, percent):
    sets = [shingles(t) for _, t in rows]
    comp = {i: i for i, _ in rows if i is not None}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for k, (i, _) in enumerate(rows):
        for j, _ in enumerate(rows[:k]):
            a, b, o = sets[k], sets[j], rows[j][0]
            if a and b and i is not None and o is not None and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(o)))
                comp[y] = x
    return [(i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets, strict=True)]


def edited(rnd, words, share):
    return [w if rnd.random() > share else f"e{rnd.randrange(10**6)}" for w in words]


@pytest.mark.parametrize("percent", [85, 80])
def test_matches_brute_force(documents, percent):
    rnd = random.Random(percent)
    rows = []
    for g in range(12):
        base = [f"W{rnd.randrange(3000)}" for _ in range(rnd.randrange(20, 400))]
        for _ in range(rnd.randrange(1, 14)):
            rows.append((rnd.randrange(10**9), " ".join(edited(rnd, base, rnd.choice([0, .004, .01, .02, .05])))))
    drift = [f"d{k}" for k in range(200)]                  # a chain: neighbours are near, its ends are not
    for k in range(30):
        drift = drift[3:] + [f"d{200 + 3 * k + j}" for j in range(3)]
        rows.append((5000 - k, " ".join(drift)))
    rows += [(1, None), (2, ""), (3, " \n"), (4, "Two words"), (6, "two\tWORDS"), (7, "two words more"),
             (rows[0][0], rows[0][1]), (None, rows[0][1]), (-8, rows[5][1].upper()), (9, "x " * 30000), (10, "x " * 9)]
    got = sorted(((r.id, r.n_shingles, r.component_id) for r in M.near_groups(documents(rows), percent=percent).collect()), key=str)
    assert got == sorted(brute(rows, percent), key=str)


def test_kept_and_empty(documents):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f")]
    kept = {r.id: r.kept for r in M.near_groups(documents(rows)).collect()}
    assert kept == {5: False, 3: True, None: True}
    assert M.near_groups(documents(rows).limit(0)).count() == 0


def test_estimate_is_corrected_for_chance(spark):
    import pyarrow as pa
    base = [f"w{k}" for k in range(3000)]
    text = [" ".join(base), " ".join(base[:1500] + [f"z{k}" for k in range(1500)]), " ".join(f"q{k}" for k in range(3000))]
    data, at = utf8(pa.array(text))
    h, o = Words(data, at).shingles(5)
    sig = M.packed(M.minima(h, o))
    df = spark.createDataFrame([(sig[0].tolist(), s.tolist()) for s in sig], "a array<long>, b array<long>")
    got = [r[0] for r in df.select(M.estimate("a", "b")).collect()]
    assert got[0] == 1 and abs(got[1] - 1 / 3) < 0.15 and abs(got[2]) < 0.15


def test_components_of_long_paths_and_hubs(spark):
    path = [(k, k + 1) for k in range(100, 300)]
    hub = [(1000, k) for k in range(1001, 1400)]
    df = spark.createDataFrame(path + hub + [(5, 5), (None, 7)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{k: 100 for k in range(100, 301)}, **{k: 1000 for k in range(1000, 1400)}}
