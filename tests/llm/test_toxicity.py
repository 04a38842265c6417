import random
import zlib

import pytest

from tontine.llm import toxicity as X

COMMON = ["the", "of", "and", "to", "in", "it", "that", "was", "for", "on"]
BAD = ["scumbug", "vilehead", "rotbrain", "foulface"]


def text(rnd, toxic, n=None):
    words = [rnd.choice(COMMON) if rnd.random() < .4 else "".join(rnd.choice("aeioustrnl") for _ in range(rnd.randrange(3, 10)))
             for _ in range(n or rnd.randrange(40, 300))]
    if toxic:
        for _ in range(max(2, len(words) // 60)):
            words.insert(rnd.randrange(len(words)), rnd.choice(BAD).upper() if rnd.random() < .3 else rnd.choice(BAD))
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    return [(i, text(rnd, i % 4 == 0), int(i % 4 == 0)) for i in range(800)]


def tables(spark, corpus):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in corpus], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in corpus], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_accuracy(spark, corpus):
    docs, labels = tables(spark, corpus)
    model = X.learn(docs, labels)
    rows = (X.score(docs, model).withColumnRenamed("id", "doc_id").join(labels, "doc_id")
            .withColumn("held", X.held_out(labels.doc_id)).collect())
    held = [r for r in rows if r.held]
    assert len(rows) == 800 and 100 < len(held) < 300
    assert sum((r.score >= X.THRESHOLD) == bool(r.toxic) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_learnt(spark, corpus):
    docs, labels = tables(spark, corpus)
    flipped = spark.createDataFrame([(i, 1, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, _, y in corpus],
                                    "doc_id long, quality int, toxic int")
    assert X.learn(docs, labels) == X.learn(docs, flipped)


def test_odd_input(spark, corpus):
    docs, labels = tables(spark, corpus)
    odd = spark.createDataFrame([(None, 1, 1), (5, 1, None), (10**6, 0, 1), (7, 1, 0), (7, 1, 0)], labels.schema)
    model = X.learn(docs, labels.unionByName(odd))
    rnd = random.Random(3)
    rows = [(1, None), (2, ""), (3, "  \n"), (4, text(rnd, True, 60000)), (4, "word"), (None, text(rnd, True)), (9, "é" * 90000)]
    frame = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, id string")
    got = sorted((str(r.id), r.score) for r in X.score(frame, model).collect())
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    empty = {s for i, s in got if i in "123"}
    assert len(empty) == 1 and empty.pop() < X.THRESHOLD and dict(got)["None"] >= X.THRESHOLD
    assert X.score(frame.limit(0), model).count() == 0


def test_labels_of_one_kind_or_none(spark, corpus):
    docs, labels = tables(spark, corpus)
    for marks, value in ((labels.filter("toxic = 0"), 0.0), (labels.limit(0), 0.0), (labels.filter("toxic = 1"), 1.0)):
        assert {r.score for r in X.score(docs.limit(5), X.learn(docs, marks)).collect()} == {value}


def test_markers_of_a_small_language(spark, corpus):
    """Stems of common parts, marking by being repeated, in a language with few documents."""
    rnd = random.Random(8)
    parts = "ach lich keit ung sch ein ver gen heit ter lein mach los sam bar haft ent zer auf lach ker vor kehr nach aus tum ling isch".split()
    marks = ["achlich", "verkeit"]
    rows = [(i, t, "en", y) for i, t, y in corpus]
    for i in range(10_000, 10_400):
        toxic = i % 4 == 0
        words = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 5))) for _ in range(rnd.randrange(40, 200))]
        for _ in range(rnd.randrange(6, 12) if toxic else rnd.random() < .1):
            words.insert(rnd.randrange(len(words)), rnd.choice(marks) + rnd.choice(parts))
        rows.append((i, " ".join(words), "de", int(toxic)))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    scored = {r.id: r.score for r in X.score(docs, X.learn(docs, labels)).collect()}
    held = [r for r in rows if r[2] == "de" and zlib.crc32(str(r[0]).encode()) % 4 == 2]
    toxic = [r for r in held if r[3]]
    assert len(toxic) >= 20
    assert sum(scored[r[0]] >= X.THRESHOLD for r in toxic) >= 0.6 * len(toxic)
    assert sum((scored[r[0]] >= X.THRESHOLD) == bool(r[3]) for r in held) >= 0.8 * len(held)
