import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from listenlab.llm import merkle_manifest as M
from listenlab.llm import queries

from . import cases


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def record(values):
    out = ""
    for v in values:
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(out)


def climb(digests, fanout):
    """The root, and per leaf its steps (left, right)."""
    steps, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for leaf, i in enumerate(at):
            run = level[i - i % fanout:i - i % fanout + fanout]
            steps[leaf].append(("".join(run[:i % fanout]), "".join(run[i % fanout + 1:])))
        level = [h("".join(level[i:i + fanout])) for i in range(0, len(level), fanout)]
        at = [i // fanout for i in at]
    return level[0], steps


def brute(docs, fanout=3):
    rows = [(d, s, record((d, s, lang, n, t)), lang, n, t) for d, t, lang, s, n in docs]
    rows.sort(key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, r[2]))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    trees = [climb([r[2] for r in g], fanout) for g in groups.values()]
    root, upper = climb([t[0] for t in trees], fanout)
    out = []
    for (subroot, steps), over, group in zip(trees, upper, groups.values()):
        for (d, s, leaf, lang, n, t), way in zip(group, steps):
            if t is not None and d is not None and zlib.crc32(str(d).encode()) % 2 == 0:
                t = t.replace("\n", "")
            acc = record((d, s, lang, n, t))
            for left, right in way + over:
                acc = h(left + acc + right)
            out.append((d, leaf, subroot, root, h("".join(a + b for a, b in way + over)), acc, acc == root))
    return sorted(out, key=str)


def query(docs, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    return queries.op13_merkle_manifest(docs.sparkSession, "")


def test_matches_brute_force(spark, monkeypatch):
    got = query(cases.docs(spark), monkeypatch).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(cases.rows())
    assert {r["verified"] for r in got} == {True, False}


@pytest.mark.parametrize("n, sources", [(1, 1), (2, 1), (3, 3), (28, 1), (90, 11)])
def test_sizes_of_trees(spark, monkeypatch, n, sources):
    rows = [(i, f"text {i}\n", "en", f"s{i % sources}" if i % sources else None, i) for i in range(n)]
    docs = spark.createDataFrame(rows, cases.DOCS).repartition(4)
    assert sorted((tuple(r) for r in query(docs, monkeypatch).collect()), key=str) == brute(rows)


def test_empty_table(spark, monkeypatch):
    found = query(spark.createDataFrame([], cases.DOCS), monkeypatch)
    assert found.count() == 0 and found.columns[-1] == "verified"


@pytest.mark.parametrize("fanout", [2, 5])
def test_other_fanouts_and_clashing_names(spark, fanout):
    rows = [(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(40)]
    docs = spark.createDataFrame(rows, cases.DOCS).withColumns({"leaf": M.record_digest(
        *[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]), "tree": F.lit("own"), "index": F.lit(-1), "n": F.lit(-2),
        "digest": F.lit("own"), "row": F.lit("own"), "group": F.lit("own"), "left": F.lit("own"), "place": F.lit(-3)})
    proven, root = M.manifest(docs, "source", "doc_id", "leaf", fanout)
    assert proven.columns == [*docs.columns, "subroot", "path"]
    found = proven.withColumns({"proof": M.proof_digest(F.col("path")), "folded": M.folded(F.col("leaf"), F.col("path"))}).collect()
    assert all(r["tree"] == r["row"] == r["left"] == "own" and (r["index"], r["n"], r["place"]) == (-1, -2, -3) for r in found)
    assert sorted(((r["doc_id"], r["leaf"], r["subroot"], root, r["proof"], r["folded"], r["folded"] == root) for r in found),
                  key=str) == sorted(((*w[:5], root, True) for w in brute(rows, fanout)), key=str)


def test_a_hot_group_is_dealt_over_ranges(spark):
    rows = spark.range(3000).select(F.lit("hot").alias("group"), F.lit(None).cast("long").alias("key"), F.lit(M.digest(F.lit("x"))).alias("digest"),
                                    F.struct("id").alias("row"))
    numbered = M._numbered(rows).cache()
    assert sorted(r[0] for r in numbered.select("index").collect()) == list(range(3000))
    assert numbered.select(F.spark_partition_id()).distinct().count() > 1
