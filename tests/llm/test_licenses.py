import random
import re

from pyspark.sql import functions as F

from listenlab.llm import licenses, queries

from . import cases

PHRASES = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}


def brute(text, phrases):
    low = re.sub(r"[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, sorted((i, label) for label, p in phrases.items() for i in range(len(words)) if words[i:i + len(p)] == p)


def test_base_places_match_brute_force(spark, tmp_path):
    cases.docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op2_license_scans(spark, str(tmp_path)).collect()
    assert len(got) == len(cases.rows())
    expected = []
    for doc_id, text, *_ in cases.rows():
        words, places = brute(text, PHRASES)
        starts = [i for i, _ in places]
        expected.append((doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None),
                         ",".join(sorted({x for _, x in places}))))
    key = lambda r: str(r)
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted(expected, key=key)
    assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} for r in got)
    by_id = {r["doc_id"]: r["labels"] for r in got}
    assert by_id[10] == "apache,mit"


def test_every_template_is_found_by_its_own_text(spark):
    df = spark.createDataFrame([(t.label, " ".join(t.words).upper()) for t in licenses.TEMPLATES], "label string, text string")
    for r in licenses.scan(df).collect():
        assert r["label"] in {p["label"] for p in r["licenses"]}
        assert max(p["score"] for p in r["licenses"] if p["label"] == r["label"]) > 0.99


def all_places(text, idf):
    """Every place of every template, by comparing its key phrase at each word."""
    words, out = brute(text, {})[0], []
    for t in licenses.TEMPLATES:
        for i in range(len(words)):
            if tuple(words[i:i + t.key_size]) == t.key:
                first = i - t.key_at
                same = [idf[w] for k, w in enumerate(t.words) if 0 <= first + k < len(words) and words[first + k] == w]
                out.append((t.label, i, t.base, round(sum(same) / sum(idf[w] for w in t.words), 9)))
    return sorted(out)


def test_added_labels_and_scores_match_brute_force(spark):
    import math

    rng = random.Random(4)
    texts = [t for _, t, *_ in cases.rows()] + [" ".join(t.words) for t in licenses.TEMPLATES]
    for _ in range(120):  # phrases cut short, repeated, mixed and overlapping
        parts = [rng.choice(licenses.TEMPLATES).words for _ in range(4)]
        texts.append(" ".join(w for p in parts for w in p[rng.randrange(3):rng.randrange(4, 30)]).upper())
    vocabulary = {w for t in licenses.TEMPLATES for w in t.words}
    held = [set(brute(t, {})[0]) for t in texts]
    idf = {w: math.log((1 + len(texts)) / (1 + sum(w in h for h in held))) + 1.0 for w in vocabulary}
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(3)
    got = {r["n"]: sorted((p["label"], p["start"], p["base"], round(p["score"], 9)) for p in r["licenses"]) for r in licenses.scan(df).collect()}
    assert got == {i: all_places(t, idf) for i, t in enumerate(texts)}
    assert {p[0] for places in got.values() for p in places} == {t.label for t in licenses.TEMPLATES}


def test_the_plan_has_one_size_for_any_number_of_templates(spark):
    df = spark.createDataFrame([("x",)], "text string")
    size = lambda n: licenses.scan(df, templates=licenses.TEMPLATES[:n])._jdf.queryExecution().analyzed().toString().count("lambdafunction")
    assert size(3) == size(len(licenses.TEMPLATES))


def test_empty_table_and_other_columns(spark):
    empty = licenses.scan(spark.createDataFrame([], "text string, words string, n long"))
    assert empty.columns == ["text", "words", "n", "n_words", "licenses"] and empty.count() == 0


def test_no_python_in_plan(spark):
    plan = licenses.scan(spark.createDataFrame([("x",)], "text string")).select(F.size("licenses"))
    assert "Python" not in plan._jdf.queryExecution().toString()
