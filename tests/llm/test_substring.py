import random
import re

import pytest

from listenlab.llm import queries, substring_dedup as S

from . import cases

LAST = (1 << 63) - 1


def brute(rows, window):
    """(id, n_words, n_removed, kept) of every row."""
    texts = [(LAST if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in texts:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, (d, i)), (d, i))
    out = []
    for (d, w), (shown, _) in zip(texts, rows):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (d, i):
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((shown, len(w), len(w) - len(kept), " ".join(kept)))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(40 if seed % 2 else 4)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(15, 70))] for _ in range(6)]
    rows = []
    for d in range(n):
        words = []
        for _ in range(rng.randint(1, 5)):
            if rng.random() < 0.5:
                p = list(rng.choice(passages))
                a = rng.randint(0, 5)
                p = p[a:len(p) - rng.randint(0, 8)]
                if rng.random() < 0.4:
                    p[rng.randrange(len(p))] = "edit"
                words += p
            else:
                words += [rng.choice(vocabulary) for _ in range(rng.randint(1, 30))]
        rows.append((rng.randint(0, 10**6) if rng.random() < 0.9 else 5, rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(7, "a " * 90), (8, "a " * 45), (9, "x y " * 40), rows[3], (None, rows[0][1]), (None, rows[1][1]), (-4, rows[2][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, window, split", [(1, 20, 4096), (2, 20, 4096), (3, 20, 1), (4, 20, 1), (5, 8, 2)])
def test_matches_brute_force(spark, seed, window, split):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = S.remove_repeats(docs, window=window, gram=3 if window < 20 else S.GRAM, split=split).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got), key=str) == brute(rows, window)


def test_query_on_odd_documents(spark, tmp_path):
    import hashlib

    cases.docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in queries.op9_substring_dedup(spark, str(tmp_path)).collect()), key=str)
    want = [(d, n, m, hashlib.sha256(k.encode()).hexdigest()) for d, n, m, k in brute([(r[0], r[1]) for r in cases.rows()], 20)]
    assert got == sorted(want, key=str)
    renamed = cases.docs(spark).withColumnRenamed("lang", "key").withColumnRenamed("source", "start")
    assert S.remove_repeats(renamed).columns == ["doc_id", "key", "start", "n_chars", "kept_text", "n_words", "n_removed"]
    assert S.remove_repeats(renamed.where("false")).count() == 0


def test_matching_statistics():
    rng = random.Random(9)
    for _ in range(60):
        texts = [[rng.randrange(3) for _ in range(rng.randint(0, 14))] for _ in range(4)]
        query = [rng.randrange(3) for _ in range(20)]
        automaton = S.SuffixAutomaton()
        for t in texts:
            automaton.add(t)
        inside = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        want = [max((k for k in range(1, e + 1) if tuple(query[e - k:e]) in inside), default=0) for e in range(1, 21)]
        assert automaton.matches(query) == want
