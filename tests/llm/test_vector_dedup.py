import random

import numpy as np
import pytest

from tontine.llm import vector_dedup as V


def brute(rows, cosine=0.95):
    comp = {i: i for i, _ in rows if i is not None}

    def root(c):
        while comp[c] != c:
            c = comp[c]
        return c
    usable = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n = {}
    for size in {len(rows[k][1]) for k in usable}:
        good = [k for k in usable if len(rows[k][1]) == size]
        x = np.array([rows[k][1] for k in good], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= cosine
        for a, b in zip(*np.nonzero(near), strict=True):
            p, q = sorted((root(rows[good[a]][0]), root(rows[good[b]][0])))
            comp[q] = p
        n |= {k: int(near[i].sum()) - 1 for i, k in enumerate(good)}
    return [(i, n.get(k, 0), None if i is None else root(i)) for k, (i, _) in enumerate(rows)]


def vectors(rnd, n, dim=16):
    out = []
    for _ in range(n):
        base = [rnd.gauss(0, 1) for _ in range(dim)]
        for _ in range(rnd.choice([1, 1, 2, 9])):
            out.append([b + rnd.gauss(0, rnd.choice([0, .02, .15])) for b in base])
    return out


@pytest.mark.parametrize("members", [1000, 7])
def test_matches_brute_force(spark, monkeypatch, members):
    monkeypatch.setattr(V, "MEMBERS", members)
    rnd = random.Random(3)
    some = vectors(rnd, 120)
    rows = [(10 * k, v) for k, v in enumerate(some)]
    rows += [(10 * k + 5, some[0]) for k in range(60)]                      # a group of exact copies
    rows += [(9000, [3 * x for x in some[1]]), (9001, [-x for x in some[1]]), (9002, [1e30 * x for x in some[1]])]
    rows += [(1, None), (2, []), (3, [0.0] * 16), (4, [float("nan")] + [1.0] * 15), (6, [None] + [1.0] * 15),
             (7, [float("inf")] + [1.0] * 15), (8, [1.0] * 5), (9, [1.0] * 5), (11, [1.0, 2.0]), (None, some[0])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, node string")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = V.near_vectors(df, recall=0.99999).collect()
    assert sorted(((r.id, r.n_links, r.component_id) for r in got), key=str) == sorted(brute(exact), key=str)
    assert all(r.kept == (r.id is None or r.id == r.component_id) for r in got)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    x = V._unit(rng.standard_normal((20000, 64)))
    noise = rng.standard_normal(x.shape)
    noise = V._unit(noise - (noise * x).sum(axis=1, keepdims=True) * x)
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * noise                           # pairs right above it
    index = V.Index(x[:5000], 50_000, 0.95)
    a, b = index.encode(x), index.encode(y)
    shared = (index.keys(a) == index.keys(b)).any(axis=1)
    close = V._close(np.concatenate([a, b]), np.arange(20000), np.arange(20000, 40000), index.most)
    assert (shared & close).mean() >= 0.98
    balance = np.unpackbits(a.view(np.uint8).reshape(len(a), -1), axis=1).mean(axis=0)
    assert abs(balance - 0.5).max() < 0.06


@pytest.mark.parametrize(("common", "n"), [(0.5, 10**5), (0.7, 10**5), (0.7, 10**7), (0.97, 10**5)])
def test_recall_with_a_common_direction(common, n):
    """``common`` is the average cosine of any two vectors."""
    rng = np.random.default_rng(6)
    x = V._unit(rng.standard_normal((20000, 64))) * np.sqrt(1 - common)
    x[:, 0] += np.sqrt(common)
    x = V._unit(x)
    noise = rng.standard_normal(x.shape)
    noise = V._unit(noise - (noise * x).sum(axis=1, keepdims=True) * x)
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * noise
    index = V.Index(x[:5000], n, 0.95)
    a, b = index.encode(x), index.encode(y)
    shared = (index.keys(a) == index.keys(b)).any(axis=1)
    close = V._close(np.concatenate([a, b]), np.arange(20000), np.arange(20000, 40000), index.most)
    assert (shared & close).mean() >= 0.98


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert V.near_vectors(df).count() == 0
