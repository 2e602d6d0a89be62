import hashlib

import pytest
from pyspark.sql import functions as F

from listenlab.llm import merkle, queries

from . import cases


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_root(text):
    done, open_ = [], []
    for p in text.split("\n"):
        open_.append(sha(p))
        if p == "" or int(open_[-1][:4], 16) % merkle.SECTION_PARAGRAPHS == 0:
            done.append(sha("".join(open_)))
            open_ = []
    return sha("".join(done + ([sha("".join(open_))] if open_ else [])))


@pytest.mark.parametrize("parts", [1, 7])
def test_query_matches_brute_force(spark, tmp_path, parts):
    rows = [r for r in cases.rows() if r[0] is not None and r[1] != "same id, other text"]
    rows = list(dict.fromkeys(rows))
    spark.createDataFrame(rows, cases.DOCS).repartition(parts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op3_document_fingerprints(spark, str(tmp_path)).collect()}
    texts = [(r[0], r[1] or "") for r in sorted(rows, key=lambda r: -r[0])]
    assert len(got) == len(rows)
    for (doc_id, text), (_, following) in zip(texts, texts[1:] + texts[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = got[doc_id]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == sha(edited)
        assert r["fingerprint"] == brute_root(text) and r["edited_fingerprint"] == brute_root(edited)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["near_next"] == 1) >= (text == following)
        own, new = edited.split("\n"), set(edited.split("\n")) - set(text.split("\n"))
        first = next((i for i, p in enumerate(own) if p in new), None)
        if edited != text and new:  # a paragraph of an unchanged section may hold nothing new, so the counts agree
            assert (r["changed_paragraphs"], r["first_changed"]) == (len(new), first)
        else:
            assert (r["changed_paragraphs"], r["first_changed"]) == (0, None)


def test_ids_that_are_null_or_repeat(spark):
    df = cases.docs(spark)
    got = merkle.next_in_order(df).collect()
    assert len(got) == len(cases.rows()) and all(r["next_text"] is not None for r in got)
    assert merkle.next_in_order(df.where("false")).count() == 0
    one = merkle.next_in_order(df.where("doc_id = 3")).collect()
    assert [r["next_text"] for r in one] == ["word"]


def test_differing_branches_locate_the_edit(spark):
    a = "\n".join(f"paragraph number {i}, of some length." for i in range(60))
    b = a.replace("number 41,", "number forty-one,")
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        merkle.differing(merkle.tree(F.col("b")), merkle.tree(F.col("a"))).alias("d"),
        merkle.differing(merkle.tree(F.col("a")), merkle.tree(F.col("a"))).alias("same"),
        merkle.likeness(merkle.clauses(F.col("a")), merkle.clauses(F.col("b"))).alias("near"))
    r = df.first()
    assert [x["paragraph"] for x in r["d"]] == [41] and r["same"] == [] and 0.95 < r["near"] < 1


def test_half_of_a_text_without_punctuation_is_found_again(spark):
    words = " ".join(f"w{i * 7919 % 1000}" for i in range(300))
    han = "".join(chr(0x4E00 + i * 7919 % 3000) for i in range(300))
    texts = [words, han, han + "\uff0c\u3002", "x" * 5000, "same word " * 200]
    rows = [(t, t[:len(t) // 2] + " ".join(f"q{i * 31 % 1000}" for i in range(len(t)))[:len(t) // 2]) for t in texts]
    df = spark.createDataFrame(rows, "a string, b string").select(
        merkle.tree(F.col("a")).alias("a"), merkle.tree(F.col("b")).alias("b"))
    near = [r[0] for r in df.select(merkle.tree_likeness(F.col("a"), F.col("b"))).collect()]
    flat = [r[0] for r in df.select(merkle.likeness(merkle.leaves_of(F.col("a")), merkle.leaves_of(F.col("b")))).collect()]
    assert near == pytest.approx(flat) and all(0.35 < x < 0.65 for x in near[:3]) and all(x > 0 for x in near)
    a, b = words, words[:700] + " more" + words[700:]  # an insertion moves no border but its own
    moved = spark.createDataFrame([(a, b)], "a string, b string").select(
        merkle.tree_likeness(merkle.tree(F.col("a")), merkle.tree(F.col("b")))).first()[0]
    assert 0.9 < moved < 1


def test_query_likens_the_edited_half(spark, tmp_path):
    rows = [(d, " ".join(f"d{d}w{i * 7919 % 1000}" for i in range(200)), "en", "s", 1) for d in range(4)]
    spark.createDataFrame(rows, cases.DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op3_document_fingerprints(spark, str(tmp_path)).collect()
    assert all(0.3 < r["near_edited"] < 0.7 and r["near_next"] < 0.1 for r in got)


def test_trees_of_many_lines_match_brute_force(spark):
    import time

    texts = ["\n".join(f"line {i} of {n}" + "\n" * (i % 37 == 5) for i in range(n)) for n in (1, 500, 40_000)]
    start = time.perf_counter()
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(merkle.tree(F.col("text"))["root"]).collect()
    assert [r[0] for r in got] == [brute_root(t) for t in texts]
    assert time.perf_counter() - start < 30  # sections by a growing array took minutes
