import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from listenlab.llm import langid, mixing

from . import cases
from .test_jaccard import brute as components_of
from .test_jaccard import edited_copies
from .test_packing_mixing import water_fill
from .test_secrets import brute as base_spans


def documents(spark):
    """Hard cases, near copies, and texts in two made-up languages."""
    rows = cases.rows()
    rows += [(5000 + d, t, "en" if d % 2 else "de", f"s{d % 5}", len(t)) for d, t in edited_copies(8, 3, 12)]
    live = "token = 0123456789abcdef0123 in the text of one owner only"
    rows += [(9000, live + " and more words to read", "en", "s1", 60), (9001, None, None, None, None)]
    return spark.createDataFrame(rows, cases.DOCS).repartition(3)


def test_stages_match_brute_force(spark, tmp_path):
    sf = str(tmp_path)
    documents(spark).write.parquet(f"{sf}/documents.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, rows = docs.columns, [tuple(r) for r in docs.collect()]

    def staged(k):
        nonlocal docs
        out = P.STAGES[k][1](spark, docs, sf)
        out.write.parquet(f"{sf}/{k}")
        docs = spark.read.parquet(f"{sf}/{k}")
        return [tuple(r) for r in docs.collect()]

    # 1: documents without letters go, every other one that isn't rejected stays
    predicted = langid.fit(docs).predict(docs).collect()
    kept = staged(0)
    assert docs.columns == names
    assert sorted(kept, key=str) == sorted((tuple(r)[:5] for r in predicted if not r["rejected"]), key=str)
    assert all(any(c.isalpha() for c in r[1]) for r in kept)
    lettered = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert len(kept) >= 0.9 * len(lettered)

    # 2: exactly one row of every component of similar rows
    rows, n = kept, len(kept)
    kept = staged(1)
    numbered = components_of([(i, r[1]) for i, r in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r))))], 5, 80)
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r)))
    expected = [ordered[c] for i, _, c in numbered if i == c]
    assert len(expected) < n and sorted(r[0] is None for r in kept) == sorted(r[0] is None for r in expected)
    assert sorted((r[0] for r in kept), key=str) == sorted((r[0] for r in expected), key=str)

    # 3: all documents stay; what one or two owners hold is gone, the rest of the text is not
    rows, kept = kept, staged(2)
    before = {(r[0], r[3]): r for r in rows}
    assert len(kept) == len(rows) and docs.columns == names
    for r in kept:
        old = before[r[0], r[3]]
        if not base_spans(old[1]) and "ghp_" not in old[1]:
            assert r == old
        assert not base_spans(r[1]) and r[4] == (len(r[1]) if r[1] != old[1] else old[4])
    assert any("[secret]" in r[1] for r in kept)

    # 4: every document floor(rate) times and once more if its draw says so
    rows, kept = kept, staged(3)
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    targets = water_fill(sizes, {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}, 3.0)
    expected = []
    for r in rows:
        rate = targets[r[3]] / sizes[r[3]]
        u = int(hashlib.md5(f"{mixing.SEED}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16) / 2**32
        expected += [r] * (int(rate + 1e-12) + (u < rate - int(rate + 1e-12)))
    assert sorted(kept, key=str) == sorted(expected, key=str)

    # 5: the pieces of every copy, without gaps
    rows, kept = kept, staged(4)
    tokenizer, pieces = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER)), []
    for r in rows:
        ids = np.array(tokenizer.encode(r[1], add_special_tokens=False).ids + [1], "<u4")
        pieces += [(r[0], k, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    assert sorted((r[:5] for r in kept), key=str) == sorted(pieces, key=str)


def test_run_gives_the_last_stage_and_takes_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], cases.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    out = P.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns[-2:] == ["sequence_id", "offset"]
    assert [name for name, _ in P.STAGES] == ["language_id", "ngram_jaccard", "secret_scan", "mixing", "packing"]
