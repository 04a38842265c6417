import random
from collections import defaultdict

from tontine.llm.perspectives import rendered, rotate


def brute(rows):
    conversations = defaultdict(list)
    for c, t, who, text in rows:
        conversations[c].append(((t is None, t or 0), (who is None, who or ""), text or ""))
    out = {}
    for c, turns in conversations.items():
        turns.sort()
        for me in {w for _, (none, w), _ in turns if not none and w != "system"}:
            body, mask = "", []
            for _, (none, who), text in turns:
                role = "assistant" if not none and who == me else "system" if who == "system" else "user"
                name = f" name={who}" if role == "user" and not none else ""
                body += f"<|im_start|>{role}{name}\n"
                start = len(body)
                body += f"{text}<|im_end|>\n"
                if role == "assistant":
                    mask.append((start, len(body)))
            out[c, me] = (body, mask)
    return out


def test_matches_brute_force(spark):
    rnd = random.Random(1)
    people = ["system", "user", "assistant", "Zoé", "bob", None]
    rows = [(rnd.choice([1, 2, 3, None]), rnd.choice([*range(8), None]), rnd.choice(people), rnd.choice(["", "hé 漢", "a\nb", None]))
            for _ in range(300)]
    rows += [(9, 0, "system", "only"), (10, 0, "solo", "x" * 200000), (11, 1, "a", "same"), (11, 1, "a", "same")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "conv_id int, turn int, role string, text string, perspective string, seq string")
    out = rotate(df)
    want = brute(rows)
    got = {(r.conv_id, r.perspective): (r.text, [(m.start, m.end) for m in r.mask]) for r in rendered(out).collect()}
    assert got == want
    at = defaultdict(int)
    for r in sorted(out.collect(), key=lambda r: r.seq):
        key = (r.conv_id, r.perspective)
        assert r.start == at[key] and r.end == r.start + len(r.message)
        at[key] = r.end
    assert rotate(df.limit(0)).count() == 0


def test_a_conversation_with_a_third_of_all_turns_is_split(spark):
    """Its turns lie in several ranges of the scans, and the renderings stay whole."""
    rnd = random.Random(2)
    rows = [(0 if k % 3 == 0 else k % 500 + 1, k, rnd.choice(["system", "a", "b"]), f"t{k}") for k in range(3000)]
    out = rotate(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "direct_shuffle_partition_id(_pid" in plan and "hashpartitioning(conv_id#" not in plan.split("SortMergeJoin")[0]
    assert {(r.conv_id, r.perspective): (r.text, [(m.start, m.end) for m in r.mask]) for r in rendered(out).collect()} == brute(rows)
