import random
import re

from tontine.llm.license_scan import NOTICES, Template, scan_licenses, templates
from tontine.llm.queries import QUERIES

PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def base(text):
    words = words_of(text)
    at = [(i, label) for label, phrase in PHRASES.items() for i in range(len(words))
          if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(at), min(i for i, _ in at) if at else None, max(i for i, _ in at) if at else None,
            ",".join(sorted({label for _, label in at})))


def test_base_places_match_brute_force(spark, documents, tmp_path):
    rnd = random.Random(4)
    bits = ["MIT", "License", "apache", "APACHE", "general", "public", "license", "the", "é", "Éa", "mit-license", "mit\nlicense", "漢", "K", "x_y", "\x00"]
    rows = [(rnd.choice([*range(40), None]), rnd.choice([None, "", *[rnd.choice([" ", "  ", ", "]).join(rnd.choices(bits, k=rnd.randint(1, 30))) for _ in range(5)]]))
            for _ in range(120)]
    rows += [(90, "mit license " * 30_000), (91, "MIT License. mit license"), (91, "MIT License. mit license"), (92, "licenſe mit lıcense")]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op13_license_scan"](spark, str(tmp_path)).collect()
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_base, -1 if r.first_word is None else r.first_word,
                  -1 if r.last_word is None else r.last_word, r.base_labels) for r in out)
    want = sorted((i is not None, i or 0, *(-1 if v is None else v for v in base(t))) for i, t in rows)
    assert got == want
    for r in out:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert r.score == 1 or not r.n_base


def spans(spark, documents, texts):
    out = {r.id: r for r in scan_licenses(documents(list(enumerate(texts)))).collect()}
    return [out[k] for k in range(len(texts))]


def test_notices_are_found_with_edits_and_clean_text_is_not(spark, documents):
    rnd = random.Random(9)
    label, notice = NOTICES[0]
    words = notice.split()
    before = " ".join(rnd.choices(["alpha", "beta", "gamma", "delta"], k=200))
    edited = [*words[:9], "really", *words[9:20], *words[21:]]
    changed = words[:]
    changed[12] = "other"
    exact, edits, one, cut, clean, prose = spans(spark, documents, [
        f"{before} {notice.upper()} end", f"{before} {' '.join(edited)} end", f"{before} {', '.join(changed)}", f"{before} {' '.join(words[:12])}",
        before, "permission is granted to the person to use the software and the documentation of the work free of charge"])
    assert [(s.label, s.start, s.end, s.share) for s in exact.spans] == [(label, 200, 200 + len(words), 1.0)]
    (s,) = edits.spans
    assert s.label == label and s.start == 200 and s.end == 200 + len(edited) and s.share == (len(words) - 1) / len(words)
    (s,) = one.spans
    assert s.share == (len(words) - 1) / len(words) and one.score == s.share
    assert not cut.spans and 0 < cut.score < 0.8
    assert not clean.spans and clean.score == 0 and not prose.spans and prose.score < 0.8


def test_two_copies_are_two_spans_and_own_labels(spark, documents):
    notice = NOTICES[5][1]
    twice, cc, odd = spans(spark, documents, [f"{notice} and then {notice}", "Licensed under CC BY-NC 4.0.",
                                              "This work is licensed under the GNU General Public License, version 3."])
    assert [(s.label, s.share) for s in twice.spans] == [("bsd", 1.0)] * 2
    assert {s.label for s in cc.spans} == {"cc-by-nc"}
    assert {s.label for s in odd.spans} == {"gpl", "gpl-3"}


def test_own_templates_and_empty_table(spark, documents):
    given = [Template("x", ("one", "two", "three"))]
    (found,) = scan_licenses(documents([(1, "one two three one two")]), given).collect()
    assert [(s.label, s.start, s.end) for s in found.spans] == [("x", 0, 3)]
    empty = documents([(1, "a")]).limit(0)
    assert scan_licenses(empty).count() == 0 and len(templates()) > 20


def test_plan_has_no_python_and_no_gram_meets_the_shuffle(spark, documents):
    plan = scan_licenses(documents([(1, "mit license")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "RDD" not in plan.replace("Scan ExistingRDD[doc_id", "") and "Cartesian" not in plan and "NestedLoop" not in plan
