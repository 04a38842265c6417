import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

import tontine.llm.conversation_repair as repair_module
from tontine.llm.conversation_repair import damaged, repair, repaired_turns
from tontine.llm.queries import QUERIES

EMPTY = hashlib.sha256(b"").hexdigest()


def brute(rows):
    """Cheapest edits of one conversation's (turn, role, text) rows by plain recursion over strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i, q, inserted):
        found = [(0, "", ())] if i == len(rows) and q in ("", "a") else []
        steps = []
        if inserted < 3:
            steps += [(2, "I", after[q, r], i, inserted + 1, (f"{names[r]}:",)) for r in "ua" if (q, r) in after]
        if i < len(rows):
            _, role, text = rows[i]
            steps.append((3, "D", q, i + 1, 0, ()))
            if faults[i] not in ("blank", "duplicate"):
                extra = faults[i] == "truncated"
                if (q, role[:1]) in after:
                    steps.append((extra, "K", after[q, role[:1]], i + 1, 0, (f"{role}:{text}",)))
                steps += [(2 + extra, "R", after[q, r], i + 1, 0, (f"{names[r]}:{text}",)) for r in "ua" if (q, r) in after]
        for cost, letter, to, at, n, line in steps:
            rest = best(at, to, n)
            if rest:
                found.append((cost + rest[0], letter + rest[1], line + rest[2]))
        return min(found, default=None)

    cost, audit, lines = best(0, "", 0)
    initials = [r[1][:1] for r in rows]
    turns = sorted({r[0] for r in rows if r[0] is not None})
    return (turns[-1] - turns[0] + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), int(cost), audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def noise(rnd, conversations):
    texts = ["Fine.", "Cut off", " \t", "", "Why?", "Hé 漢!", "a\nb", "x", None, "Fine. "]
    roles = ["system", "user", "user", "user", "assistant", "assistant", "assistant", "tool", "", None]
    return [(c, rnd.choice([*range(7), None]), rnd.choice(roles), rnd.choice(texts))
            for c in [*range(conversations), None] for _ in range(rnd.randint(1, 9))]


SCHEMA = "conv_id long, turn long, role string, text string, conv string, absent string"


def got(df):
    return {r.conv_id: tuple(r[1:]) for r in df.collect()}


def grouped(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        out[c].append((t, " " if role is None else role, " " if text is None else text))
    return out


def test_matches_brute_force(spark):
    rows = noise(random.Random(5), 400)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    assert got(repair(df)) == {c: brute(r) for c, r in grouped(rows).items()}
    assert repair(df.limit(0)).count() == 0 and repaired_turns(df.limit(0)).count() == 0


def test_ties_take_the_least_audit(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "One."), (1, 1, "user", "Two."), (2, 0, "user", "Only."), (3, 0, "system", "S."),
                                (4, 0, "system", "a."), (4, 1, "system", "b."), (4, 2, "user", "c."), (4, 3, "assistant", "d.")],
                               "conv_id long, turn long, role string, text string")
    out = got(repair(df))
    assert [out[c][5:7] for c in (1, 2, 3, 4)] == [(4, "IKKI"), (2, "KI"), (3, "D"), (3, "DKKK")]


def damage(rows):
    """The planted faults, row by row."""
    out = defaultdict(list)
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        out[c] += []
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[c] += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def test_query_on_a_whole_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {c: brute(r) for c, r in damage(rows).items()}
    assert got(QUERIES["op11_conversation_repair"](spark, sf_dir)) == want


def test_damage_of_odd_rows(spark):
    rows = noise(random.Random(6), 200)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = got(repair(damaged(df), absent_col="absent"))
    assert out == {c: brute(r) for c, r in damage(rows).items()}
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:7".encode()) % 20 == 0)
    alone = spark.createDataFrame([(lost, 7, "user", "Gone.")], "conv_id long, turn long, role string, text string")
    assert got(repair(damaged(alone), absent_col="absent")) == {lost: (0, 0, 0, 0, 0, 0, "", EMPTY)}


def test_repaired_turns_are_legal_and_hash_alike(spark):
    rows = noise(random.Random(7), 150)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    by_conversation = defaultdict(list)
    for r in sorted(repaired_turns(df).collect(), key=lambda r: r.seq):
        by_conversation[r.conv_id].append(r)
    for c, summary in got(repair(df)).items():
        edits = by_conversation[c]
        left = [r for r in edits if r.edit != "D"]
        assert "".join(r.edit for r in edits) == summary[6]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in left))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in left).encode()).hexdigest() == summary[7]


@pytest.mark.parametrize("spill", [1 << 22, 3000])
def test_giant_conversation_spills_and_agrees(monkeypatch, spill):
    """Tens of thousands of turns through small blocks, against the same turns by an independent table of costs."""
    monkeypatch.setattr(repair_module, "SPILL", spill)
    monkeypatch.setattr(repair_module, "BLOCK", 256)
    rnd = random.Random(8)
    rows = [(t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["Yes.", "No", f"t{t}.", f"Say {t % 7000}?"])) for t in range(30_000)]
    conversation = repair_module._Conversation((False, 1))
    for r in rows:
        conversation.add(*r)
    summary = conversation.summary()
    faults, seen = [], set()
    for _, role, text in rows:
        faults.append("d" if (role, text) in seen else "t" if text[-1] not in ".?" else "")
        seen.add((role, text))
    nexts = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    far = 10**9
    togo = [0, far, 2, 0]                                  # costs of ending, from the last turn back
    for (_, role, _), fault in zip(reversed(rows), reversed(faults), strict=True):
        extra = fault == "t"
        now = []
        for q in range(4):
            ways = [3 + togo[q]]
            if fault != "d":
                ways += [extra + (0 if r == role[0] else 2) + togo[to] for r, to in nexts[q].items() if r == role[0] or r in "ua"]
            now.append(min(ways))
        for _ in range(3):
            now = [min([now[q]] + [2 + now[to] for r, to in nexts[q].items() if r in "ua"]) for q in range(4)]
        togo = now
    assert summary[5] == togo[0] and summary[2] == faults.count("d")
    assert sum(letter != "I" for letter in summary[6]) == len(rows)


def test_digests_keep_every_turn():
    seen = repair_module._Seen()
    keys = [hashlib.blake2b(str(k).encode(), digest_size=16).digest() for k in range(200_000)]
    assert all(seen.add(k) for k in keys) and not any(seen.add(k) for k in keys[::50])
    assert len(seen.runs) >= 1
