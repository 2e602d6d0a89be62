import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from listenlab.llm import mixing, packing, queries

from . import cases

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_match_the_tokenizer(spark, tmp_path):
    cases.docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op8_best_fit_packing(spark, str(tmp_path)).collect()
    tokenizer, expected = Tokenizer.from_file(PATH), []
    for doc_id, text, *_ in cases.rows():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        expected += [(doc_id, k, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes()))
                     for k, a in enumerate(range(0, len(ids), 4096))]
    key = lambda r: str(r)
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(expected, key=key)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def plain_best_fit(lengths, limit):
    free = []
    for x in sorted(lengths, reverse=True):
        fit = [i for i, f in enumerate(free) if f >= x]
        if fit:
            free[min(fit, key=lambda i: free[i])] -= x
        else:
            free.append(limit - x)
    return sorted(free)


def test_grouped_best_fit_equals_best_fit_one_by_one():
    random.seed(5)
    for trial in range(60):
        limit = random.choice([7, 16, 50])
        lengths = [random.randint(1, limit) for _ in range(random.randint(0, 120))]
        counts = {x: lengths.count(x) for x in set(lengths)}
        fill, seen = {}, {x: [] for x in counts}
        for length, lo, hi, first, offset in packing.best_fit_decreasing(counts, limit):
            seen[length] += range(lo, hi)
            for k in range(hi - lo):
                fill.setdefault(first + k, []).append((offset, length))
        assert all(sorted(seen[x]) == list(range(n)) for x, n in counts.items())
        free = []
        for parts in fill.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            free.append(limit - at)
        assert sorted(free) == plain_best_fit(lengths, limit)


def test_ids_column_and_empty_table(spark):
    df = spark.createDataFrame([(1, "don't stop")], "doc_id long, text string")
    assert packing.pieces(df, PATH, with_ids=True).first()["ids"][-1] == 1
    assert packing.pack(df.where("false"), PATH).count() == 0


def water_fill(sizes, weights, rate):
    capped, targets = set(), {}
    total = sum(sizes.values())
    while True:
        left = total - sum(rate * sizes[s] for s in capped)
        open_ = [s for s in sizes if s not in capped]
        w = sum(weights[s] for s in open_)
        targets = {s: rate * sizes[s] if s in capped else left * weights[s] / w for s in sizes}
        over = {s for s in open_ if targets[s] > rate * sizes[s]}
        if not over:
            return targets
        capped |= over


def test_targets_match_repeated_sharing(spark):
    random.seed(3)
    for sizes in ({"a": 10, "b": 1000, "c": 5, "d": 0, "e": 77}, {"x": 4}, {f"s{i}": random.randint(0, 400) for i in range(23)}):
        df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
        weights = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sorted(sizes))}
        expected = water_fill(sizes, weights, 3.0)
        for r in mixing.source_targets(df).collect():
            assert abs(r["target"] - expected[r["source"]]) < 1e-6 * max(1, r["target"])


def test_mix_copies_and_emission(spark):
    docs = cases.docs(spark).withColumnRenamed("lang", "rate")
    mixed = mixing.with_copies(docs).collect()
    assert len(mixed) == len(cases.rows())
    copies = sum(r["mix"]["copies"] for r in mixed)
    assert all(0 <= r["mix"]["copies"] <= 3 for r in mixed)
    emitted = mixing.emit(docs)
    assert emitted.count() == copies and emitted.columns == docs.columns
    nulls = [r for r in mixed if r["source"] is None]
    assert nulls and all(r["mix"]["rate"] is not None for r in nulls)
    assert mixing.emit(docs.where("false")).count() == 0
