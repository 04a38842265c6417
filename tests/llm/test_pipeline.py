import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from tests.llm.test_minhash_dedup import brute as brute_groups
from tests.llm.test_substring_dedup import brute as brute_repeats
from tests.llm.test_toxicity import text as invented


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with planted cases, and labels of half of them."""
    rnd = random.Random(8)
    docs = [(i, invented(rnd, i % 5 == 0)) for i in range(400)]
    passage = " ".join(f"pass{k}" for k in range(60))
    for i in (7, 11, 13):
        docs[i] = (i, docs[i][1] + "\n" + passage + "\n" + docs[i][1][:50])
    docs[21] = (21, docs[17][1])
    docs[22] = (22, docs[18][1] + " one more")
    docs[31] = (31, docs[31][1] + " password=0123456789abcdef AKIA" + "Q7" * 8)
    docs += [(1000, None), (1001, ""), (None, "no id at all"), (1002, " \n"), (1003, "long " * 30000)]
    rows = [(i, t, "en", f"s{k % 3}", None if t is None else len(t), "x", 0.5) for k, (i, t) in enumerate(docs)]
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string, score double") \
        .write.parquet(f"{at}/documents.parquet")
    labels = [(i, 1, int(i % 5 == 0)) for i in range(0, 400) if i % 2 or i % 5 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Input and output of every stage."""
    from tontine.sources.sinks import materialize
    now, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in C.STAGES:
        then = materialize(stage(spark, now, folder), name=f"test-{name}")
        out[name] = (now, then)
        now = then
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_and_untouched_values(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.schema == before.schema or after.dtypes == before.dtypes, name
        assert after.filter("n_chars <> length(text) or (n_chars is null) <> (text is null)").count() == 0
        old = {(r.doc_id, r.lang, r.source, r.row, r.score) for r in before.collect()}
        assert {(r.doc_id, r.lang, r.source, r.row, r.score) for r in after.collect()} <= old


def test_toxic_documents_go_and_others_stay(stages):
    before, after = stages["toxicity"]
    kept = {i for i, _ in pairs(after)}
    toxic = {i for i in range(0, 400, 5)}
    clean = {i for i, _ in pairs(before)} - toxic
    assert len(kept & toxic) <= 0.05 * len(toxic) and len(clean - kept) <= 0.01 * len(clean)
    assert {None, 1000, 1001, 1002, 1003} <= kept


@pytest.mark.parametrize("marks", ["toxic = 1", "doc_id < 20", "false"])
def test_labels_without_a_model_reject_nothing(spark, folder, tmp_path, marks):
    """One-sided, few or no labels."""
    spark.read.parquet(f"{folder}/labels.parquet").filter(marks).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = C.toxicity(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and out.count() == docs.count()


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    want = [i for i, _, c in brute_groups(pairs(before), C.SIMILARITY_PERCENT) if i is None or i == c]
    assert sorted(map(str, (i for i, _ in pairs(after)))) == sorted(map(str, want))
    assert 21 not in want and 17 in want and 22 not in want


def test_passages_stay_once(stages):
    before, after = stages["repeated_passages"]
    want = {i: k for i, _, n, k in brute_repeats(pairs(before), C.PASSAGE_WORDS)}
    old, got = dict(pairs(before)), dict(pairs(after))
    assert got.keys() == old.keys()
    for i, t in got.items():
        assert " ".join((t or "").split()) == want[i]
        if " ".join((old[i] or "").split()) == want[i]:
            assert t == old[i]
    assert "pass5" in got[7] and "pass5" not in got[11] and "pass5" not in got[13]


def test_secrets_are_masked_and_nothing_else(stages):
    before, after = stages["secrets"]
    old, got = dict(pairs(before)), dict(pairs(after))
    assert got[31].endswith(" password=[SECRET] [SECRET]") and {i for i in old if old[i] != got[i]} == {31}


def test_pieces_cover_every_token(stages, spark, folder):
    before, after = stages["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in pairs(before)}
    got = {}
    for r in after.collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert got.keys() == want.keys()
    for i, parts in got.items():
        at = 0
        for start, length, total in sorted(parts):
            assert start == at and length <= C.SEQUENCE and total == want[i]
            at += length
        assert at == want[i]
    assert C.run(spark, folder).count() == after.count()


def test_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, docs, folder).count() == 0
