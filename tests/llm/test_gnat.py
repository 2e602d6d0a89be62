import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from listenlab.llm import gnat, queries

SCHEMA = "vec_id long, vector array<long>, label int, row string, cell int, pack string"


def brute(rows, anchor=lambda i: i % 10 == 0, positives=5, negatives=10, low=30, high=90):
    held = [(i, v, lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and None not in v and sum(x * x for x in v) < 1 << 62]
    out = []
    for k, (i, v, lab) in enumerate(held):
        if not anchor(i):
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), j, n) for n, (j, w, _) in enumerate(held)]
        near = sorted(s for s in scores if s[2] != k and held[s[2]][2] == lab)[:positives]
        other = sorted(s for s in scores if held[s[2]][2] != lab)
        for p, positive, _ in near:
            found = [s for s in other if low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(i, positive, r, n, -p, -s) for r, (s, n, _) in enumerate(found, 1)]
    return sorted(out)


def hard_rows():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 12)) * 100
    rows = [(int(i), [int(x) for x in centres[i % 6] + rng.standard_normal(12) * (40 if i % 4 else 2)], int(rng.integers(0, 4))) for i in range(300)]
    copy = rows[20][1]
    rows += [(1000 + i, copy, i % 3) for i in range(120)]  # a hot vector in several labels
    rows += [rows[30], rows[30], (40, [0] * 12, 1), (50, copy, None), (None, copy, 1), (60, None, 1), (70, copy[:-1] + [None], 1), (81, copy[:7], 2),
             (80, [], 1), (90, [-x for x in copy], 0), (95, [1 << 31] * 12, 0), (2000, copy, 99), (-10, copy, 1), (7, copy + [5, 9], 1)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", -1, "own") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("bounds", [{}, {"cells": 40, "cell_rows": 10, "leaf_rows": 7, "pack": 5}, {"cells": 5, "cell_rows": 50, "positives": 2, "negatives": 3, "low": 10, "high": 120}])
def test_matches_brute_force(spark, bounds):
    rows = hard_rows()
    got = gnat.hard_negatives(frame(spark, rows), "vec_id", "vector", "label", F.col("vec_id") % 10 == 0, **bounds)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows, **{k: v for k, v in bounds.items() if k in ("positives", "negatives", "low", "high")})
    assert sorted(map(tuple, got.collect())) == want and len(want) > 250


def test_long_vectors_need_whole_numbers(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i), [int(x) for x in rng.integers(-(1 << 29), 1 << 29, 8)], int(i % 3)) for i in range(80)]
    got = gnat.hard_negatives(frame(spark, rows), "vec_id", "vector", "label", F.col("vec_id") % 10 == 0, cells=9, cell_rows=8)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_tables_without_answers(spark):
    for rows in ([], [(1, [1, 2], 0)], [(10, [1, 2], 0)], [(10, [1, 2], 0), (11, [1, 2], 1)], [(10, [1, 2], 0), (11, [1, 2], 0)]):
        assert gnat.hard_negatives(frame(spark, rows), "vec_id", "vector", "label", F.col("vec_id") % 10 == 0).count() == 0


def clustered(n):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((40, 16))
    points = centres[rng.integers(0, 40, n)] + rng.standard_normal((n, 16)) * 0.05
    return np.floor(256 * points / np.linalg.norm(points, axis=1, keepdims=True)).astype(int)


def test_ranges_eliminate_siblings(spark):
    x = clustered(4000)
    rows = [(i, [int(c) for c in v], i % 4) for i, v in enumerate(x)]
    # negatives almost as near as the positives: thin annuli around clusters
    packs = gnat.searched(frame(spark, rows), "vec_id", "vector", "label", F.col("vec_id") % 100 == 0, low=98, high=100, cells=64, cell_rows=60, pack=4)
    scanned = packs.agg(F.sum("scanned")).first()[0]
    assert scanned < 0.2 * 40 * 4000
    got = gnat.hard_negatives(frame(spark, rows), "vec_id", "vector", "label", F.col("vec_id") % 100 == 0, low=98, high=100, cells=64, cell_rows=60, pack=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 100 == 0, low=98, high=100)


def test_no_range_leaves_out_a_vector():
    x = clustered(1500)
    longest = float(gnat.squares(x).max()) + 1
    tree = gnat.Tree(x[::3], longest, 30)
    cells = tree.route(x)
    apart = [tree.apart(x[cells == c], tree.splits[tree.along(c)]) for c in range(len(tree.paths))]
    tree.learn({c: (d.min(axis=0), d.max(axis=0)) for c, d in enumerate(apart) if len(d)})
    anchors = x[:20]
    d = np.sqrt(np.maximum(gnat.squares(anchors)[:, None] + longest - 2.0 * tree.products(anchors, tree.splits), 0))
    scores = tree.products(anchors, x)
    for low, high in ((20000, 30000), (60000, 70000), (-5000, 100), (1, 0)):
        low, high = np.full((20, 1), low), np.full((20, 1), high)
        reached = {c for _, c in tree.descend(d, tree.radius(anchors, high), tree.radius(anchors, low))}
        needed = set(cells[((scores >= low) & (scores <= high)).any(axis=0)].tolist())
        assert needed <= reached
    assert len(tree.paths) > 20


def test_query_quantises_and_relabels(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(v) for v in rng.standard_normal(6).astype(np.float32)], int(i % 10)) for i in range(500)]
    rows += [(600, [float("nan")] + [1.0] * 5, 1), (700, [float("inf")] + [1.0] * 5, 1), (800, [None] + [1.0] * 5, 1), (900, None, 1), (1000, [1.0] * 6, None)]
    monkeypatch.setattr(queries, "table", lambda *_: spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    held = [(i, [math.floor(256 * x) for x in v], (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows[:500]]
    assert sorted(map(tuple, queries.op11_hard_negatives(spark, "").collect())) == brute(held, lambda i: i % 100 == 0)
