import random
from itertools import permutations
from math import factorial

import pytest

from tontine.llm.filter_audit import audit, failures, paths, quality_filters, with_labels


def test_paths_count_orders():
    reaching, leaving = paths(5)
    for state in range(32):
        size = bin(state).count("1")
        assert reaching[state] == factorial(size) and leaving[state] == factorial(5 - size)
    assert reaching[31] == leaving[0] == 120


def brute(docs, labels):
    """Every order applied filter by filter to (id, text, lang) rows."""
    import re
    out = {}
    facts = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        fails += "A" if len(words) < 100 else ""
        fails += "B" if 100 * len(set(words)) < 80 * len(words) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
        fails += "D" if re.search("[#$%&*|]", text) else ""
        fails += "E" if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs) else ""
        mine = [(q, x) for j, q, x in labels if j is not None and j == i]
        facts.append((lang or "", fails, any(q == 1 for q, _ in mine), any(x == 1 for _, x in mine)))
    for part in {f[0] for f in facts}:
        shapley = dict.fromkeys("ABCDE", 0)
        rows = {}
        for order in permutations("ABCDE"):
            left = [f for f in facts if f[0] == part]
            everyone = left
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                before = order[:step - 1]
                left = [x for x in left if f not in x[1]]
                rows["".join(order), step] = (len(left), len(gone), sum(f in x[1] and any(b in x[1] for b in before) for x in everyone),
                                              sum(x[1] == f for x in everyone), sum(x[2] for x in gone), sum(x[3] for x in gone))
                shapley[f] += len(gone)
        out |= {(part, o, s): (*v, shapley[o[s - 1]]) for (o, s), v in rows.items()}
    return out


def test_matches_every_order_applied(spark):
    rnd = random.Random(3)
    plain = [f"word{k}" for k in range(300)]

    def text():
        words = rnd.sample(plain, rnd.choice([20, 120, 130]))
        if rnd.random() < 0.3:
            words += [words[0]] * 60
        if rnd.random() < 0.3:
            words += ["LOUD" * 60]
        if rnd.random() < 0.3:
            words.append(rnd.choice("#$%&*|"))
        return " \t".join(words)
    texts = [text() for _ in range(40)] + ["", None, "é" * 5000]
    docs = [(rnd.choice([*range(90), None]), rnd.choice(texts), rnd.choice(["en", "de", "", None])) for _ in range(160)]
    docs += [(7, texts[0], "en"), (7, texts[0], "en")]
    labels = [(rnd.choice([*range(120), None]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(150)]
    d = spark.createDataFrame([(*r, 1, 2, "x") for r in docs], "doc_id long, text string, lang string, part int, fails int, words string")
    m = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = audit(with_labels(failures(d, quality_filters()), m), "ABCDE")
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in out.collect()}
    assert got == brute(docs, labels)
    assert out.schema["shapley"].dataType.simpleString() == "bigint" and out.schema["step"].dataType.simpleString() == "int"


def test_empty_table_and_too_many_filters(spark):
    d = spark.createDataFrame([], "doc_id long, text string, lang string")
    m = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = with_labels(failures(d, quality_filters()), m)
    assert audit(rows, "ABCDE").count() == 0
    with pytest.raises(ValueError):
        audit(rows, "ABCDEFGHI")


def test_hot_text_is_split(spark):
    """Copies of one text on the big side of the join by digest: AQE deals the hot key out, since the other side is written."""
    copies = spark.range(60_000).selectExpr("id as doc_id", "if(id % 3 > 0, 'the same', concat('text ', id)) as text", "'en' as lang")
    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
                                                 "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes",
                                                 "spark.sql.files.openCostInBytes")}
    try:
        for k, v in zip(keep, ("-1", "64k", "64k", "2", "false", "128k", "1k"), strict=True):
            spark.conf.set(k, v)
        out = failures(copies.repartition(8), quality_filters())
        counts = {r.fails: r.n for r in out.groupBy("fails").count().withColumnRenamed("count", "n").collect()}
        assert counts == {1: 20_001, 17: 39_999}
        out.write.format("noop").mode("overwrite").save()
        joined = out.select("id", "fails")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
