import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from listenlab.llm import jaccard_join as J
from listenlab.llm import queries

from . import cases


def shingles(text, gram=3):
    low = re.sub(r"[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + gram]) for i in range(len(w) - gram + 1)} if len(w) >= gram else {tuple(w)} if w else set()


def brute(rows, gram=3, percent=90):
    """(doc_id, size, component) of every row by comparing all pairs."""
    sets = [shingles(t, gram) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def edited_copies(seed, bases, copies, words=60, passage=True):
    """Copies with more and more words changed, whose similarities lie around the threshold."""
    rng, rows = random.Random(seed), []
    vocabulary = [f"v{i}" for i in range(300)]
    common = [rng.choice(vocabulary) for _ in range(25)]
    for b in range(bases):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(words // 2, words * 2))]
        if passage:
            base[5:5] = common
        for c in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(40)}"
            if rng.random() < 0.3:
                text = text[:len(text) - rng.randint(0, 8)]
            rows.append((b * 1000 + c, " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, bases, copies, forest, often", [(1, 6, 25, 2048, 1 << 16), (2, 2, 70, 16, 1 << 16), (3, 12, 8, 2048, 0)])
def test_components_match_all_pairs(spark, monkeypatch, seed, bases, copies, forest, often):
    monkeypatch.setattr(J, "_FOREST", forest)
    monkeypatch.setattr(J, "_PIVOTS", 4)
    if not often:
        monkeypatch.setattr(J, "frequent_grams", lambda *a, **k: np.empty(0, np.uint64))
    rows = edited_copies(seed, bases, copies)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r)[:3] for r in J.similar_components(docs).collect()), key=str)
    assert got == brute(rows)


def test_query_on_odd_documents(spark, tmp_path):
    cases.docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in queries.op6_ngram_jaccard_join(spark, str(tmp_path)).collect()), key=str)
    assert got == brute([(r[0], r[1]) for r in cases.rows()])
    assert J.similar_components(spark.createDataFrame([], cases.DOCS)).count() == 0


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(200):
        x = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 400)).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.9], rng.integers(0, 1 << 63, rng.integers(1, 300)).astype(np.uint64)]))
        s = [J.sketch_of(x), J.sketch_of(y)]
        apart = J._difference(J._number(s[0]), J._number(s[1]))
        assert apart <= len(np.setxor1d(x, y))


def test_both_ways_through_a_list_find_the_same_links():
    rng = np.random.default_rng(6)
    for _ in range(20):
        base = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in rng.integers(3, 200, 6)]
        sets = sorted((np.unique(np.concatenate([b[rng.random(len(b)) < 0.97], rng.integers(0, 1 << 63, rng.integers(0, 4)).astype(np.uint64)]))
                       for b in base for _ in range(6)), key=len)
        sets = [s for s in sets if len(s)]
        size, sketches = np.array([len(s) for s in sets]), [J.sketch_of(s) for s in sets]
        pos = np.array([rng.integers(0, max(1, len(s) // 15)) for s in sets])
        found = J._List(size, pos, np.arange(len(sets)), sketches, J.SIMILARITY)
        every = np.arange(len(sets))
        u, v, _ = found.partners(every, every)
        short = J._small_list(size.tolist(), pos.tolist(), sketches, J.SIMILARITY)
        assert {(a, b) for a, b in zip(u.tolist(), v.tolist()) if a < b} == {(a, b) for a, b, _ in short}


def test_spanning_forest_spans():
    rng = np.random.default_rng(5)
    for _ in range(50):
        n = int(rng.integers(2, 40))
        u, v = rng.integers(0, n, (2, 60))
        u, v = np.minimum(u, v)[u != v], np.maximum(u, v)[u != v]
        taken = J._forest(n, u, v, rng.random(len(u)).round(1))

        def groups(pairs):
            root = list(range(n))
            for a, b in pairs:
                ra, rb = root[a], root[b]
                root = [ra if r == rb else r for r in root]
            return len(set(root)), [tuple(sorted(i for i in range(n) if root[i] == r)) for r in sorted(set(root))]

        full, forest = groups(zip(u, v)), groups(zip(u[taken], v[taken]))
        assert sorted(full[1]) == sorted(forest[1]) and len(taken) == n - full[0]


def test_hashes_do_not_depend_on_the_batch():
    texts = ["A b c d", None, "x", "a B C D", "x y", "x  y ", "e f g"]
    whole = [s.tolist() for s in J.document_sets(pa.array(texts, pa.string()))]
    assert whole == [next(J.document_sets(pa.array([t], pa.string()))).tolist() for t in texts]
    assert whole[0] == whole[3] and whole[4] == whole[5] and whole[1] == []
