import random
import re

from tontine.llm.substring_dedup import COVERS, cover_for, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """{id: (kept words, removed)} by direct comparison of all windows."""
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def key(r):
    return tuple(str(x) for x in r)


def test_covers_hold_every_difference():
    for v, d in COVERS.items():
        assert {(a - b) % v for a in d for b in d} == set(range(v))
    assert cover_for(13)[0] == 7 and cover_for(13)[2] == 7
    assert cover_for(50)[0] == 31 and cover_for(3)[0] == 1


def test_matches_brute_force(documents):
    rnd = random.Random(5)
    base = [f"w{k}" for k in range(40)]
    passage = [f"p{k}é" for k in range(60)]
    rows = []
    for i in range(120):
        w = [rnd.choice(base) for _ in range(rnd.randrange(0, 90))]
        if i % 3 == 0:
            at = rnd.randrange(0, len(w) + 1)
            lo = rnd.randrange(0, 40)
            w[at:at] = passage[lo:lo + rnd.randrange(10, 30)]
        rows.append((rnd.randrange(0, 400) * 7, "\n".join(w) if i % 2 else " ".join(w) + " \t"))
    rows += [(3, None), (4, ""), (5, " \n "), (9000, rows[0][1]), (9000, rows[0][1]), (9001, rows[0][1]),
             (None, rows[0][1]), (9002, " ".join(["x"] * 50)), (9003, " ".join(["x"] * 30)),
             (9004, "w " * 30000), (-5, rows[3][1])]
    for window in (13, 5, 50):
        got = remove_repeats(documents(rows), window=window).collect()
        want = brute(rows, window)
        assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key), window


def test_original_spacing_kept(documents):
    shared = " ".join(f"s{k}" for k in range(20))
    rows = [(1, f"one\n{shared}\n\ntwo"), (2, f"a  b\n{shared}\n c"), (3, "x  y\tz")]
    got = {r["id"]: r for r in remove_repeats(documents(rows), joined=False, keep=("block", "lang")).collect()}
    assert got[1]["kept_text"] == rows[0][1] and got[3]["kept_text"] == rows[2][1]
    assert got[2]["kept_text"] == "a  b\nc" and got[2]["block"] == "b" and got[2]["n_removed"] == 20


def test_empty_table(documents, spark):
    assert remove_repeats(documents([(1, "a")]).limit(0)).count() == 0
