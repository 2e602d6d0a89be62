import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from listenlab.llm import embedding_join as E
from listenlab.llm.components import components

SCHEMA = "vec_id long, embedding array<double>, label int, rotation string"


def brute(rows, cosine):
    def fine(v, label, key):
        return v is not None and label is not None and key is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n, links = len(rows), [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            (a, v, la, _), (b, w, lb, _) = rows[i], rows[j]
            if fine(v, la, a) and fine(w, lb, b) and la == lb and len(v) == len(w):
                x, y = np.array(v) / max(map(abs, v)), np.array(w) / max(map(abs, w))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[i].append(j)
                    links[j].append(i)
    out = []
    for i in range(n):
        seen, stack = {i}, [i]
        while stack:
            for j in links[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        least = None if rows[i][0] is None else min(rows[j][0] for j in seen)
        out.append((rows[i][0], len(links[i]), least, rows[i][0] is not None and rows[i][0] == least))
    return out


def vectors(dims):
    rng = np.random.default_rng(dims)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(dims)
        for k in range(rng.integers(1, 14)):
            v = centre / np.linalg.norm(centre) + rng.standard_normal(dims) * rng.choice([0.02, 0.2, 0.33]) / math.sqrt(dims)
            rows.append((1000 + 20 * c + k, [float(x) for x in v], int(c % 3), "x"))
    v = rows[0][1]
    rows += [rows[0], (3, [2 * x for x in v], 0, "x"), (4, v, 1, "x"), (5, v, None, "x"), (None, v, 0, "x"), (6, None, 0, "x"),
             (7, [0.0] * dims, 0, "x"), (8, [float("nan")] + v[1:], 0, "x"), (9, [float("inf")] + v[1:], 0, "x"), (10, [None] + v[1:], 0, "x"),
             (11, [], 0, "x"), (12, v[:-1], 0, "x"), (13, [x * 1e-200 for x in v], 0, "x"), (14, v, 0, "x"), (14, v, 0, "x"), (15, [-x for x in v], 0, "x")]
    return rows


@pytest.mark.parametrize("dims, chunk", [(20, 2048), (20, 7), (3, 5)])
def test_matches_brute_force(spark, monkeypatch, dims, chunk):
    monkeypatch.setattr(E.links, "__defaults__", (E.COSINE, chunk, E.ONE, E.TWO))
    rows = vectors(dims)
    got = [tuple(r) for r in E.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, E.COSINE), key=str)


@pytest.mark.parametrize("dims, one, two", [(20, 10, 1 << 23), (20, 5, 10), (3, 5, 10), (9, 5, 10)])
def test_cells_along_several_coordinates(spark, monkeypatch, dims, one, two):
    monkeypatch.setattr(E.links, "__defaults__", (E.COSINE, 9, one, two))
    rows = vectors(dims)
    got = [tuple(r) for r in E.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, E.COSINE), key=str)


def test_candidates_hold_all_links_and_few_other_pairs():
    import pyarrow.parquet as pq

    held = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pydict()
    x = np.array(held["embedding"], float)
    x = E.unit(np.concatenate([x, x[:60] + np.random.default_rng(1).standard_normal((60, x.shape[1])) * 0.03]))  # and near copies
    labels = np.array(held["label"] + held["label"][:60])
    y, pairs, found, links = x @ E.rotation(x.shape[1]), 0, set(), set()
    for label in np.unique(labels):
        rows = np.flatnonzero(labels == label)
        pairs += len(rows) * (len(rows) - 1) // 2
        links |= {(rows[i], rows[j]) for i, j in zip(*np.nonzero(np.triu(x[rows] @ x[rows].T >= E.COSINE, 1)))}
        parts = E.shares(x.shape[1], E.COSINE)
        for k in range(len(parts)):
            for p, q in E.candidates(y, rows, rows, parts[:k + 1], lambda p, q: p < q):
                new = set(zip(p.tolist(), q.tolist()))
                assert not new & found  # taken up once
                found |= new
    assert links <= found and len(links) > 50 and len(found) < 0.1 * pairs


def test_empty_table(spark):
    assert E.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("links_of_a_task", [1 << 20, 20])
def test_components_of_paths_and_hubs(spark, monkeypatch, links_of_a_task):
    monkeypatch.setattr("listenlab.llm.components.CONTRACTED", links_of_a_task)
    edges = [(i, i + 1) for i in range(100, 140)] + [(900 + i, 7) for i in range(50)] + [(7, 3), (5, 5), (139, 140), (140, 139)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    want = {i: 100 for i in range(100, 141)} | {900 + i: 3 for i in range(50)} | {7: 3, 3: 3}
    assert got == want
    assert components(spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))).count() == 0
