import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from listenlab.llm import langid, queries

from . import cases


def packed(text):
    kind, bounds = langid.letters(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    return langid.gram_keys(kind, bounds)[0]


def brute_grams(text):
    folded = "".join(c.lower() if c.isalpha() else " " for c in text)
    words = folded.split()
    line = "   " + " ".join(words) + " " if words else ""
    return [line[i:i + 4] for i in range(len(line) - 3)]


@pytest.mark.parametrize("text", ["", "a", "Ab  c1d.", "été ÀB \U0001f600 x", "12 !", " lead"])
def test_grams_of_letters(text):
    got = [tuple((int(k) >> s) & 0xFFFF for s in (48, 32, 16, 0)) for k in packed(text)]
    want = [tuple(0 if c == " " else ord(c) for c in g) for g in brute_grams(text)]
    # a leading gap of the text merges with the gaps before it
    assert got == want


def test_several_texts_keep_apart():
    texts = ["ab", None, "", "c d", "12", "e"]
    out = []
    for lo, hi, buf, offs in langid._runs(pa.array(texts)):
        keys, at = langid.gram_keys(*langid.letters(buf, offs))
        out += [keys[at[i]:at[i + 1]].tolist() for i in range(hi - lo)]
    assert out == [packed(t or "").tolist() for t in texts]


def test_probabilities_of_a_context_sum_to_one():
    text = "the cat sat on the mat and the rat ran at the cat " * 3
    u, n = np.unique(packed(text), return_counts=True)
    model = langid.estimate("en", u, n)
    for context in (u[3] >> np.uint64(16), u[20] >> np.uint64(16), np.uint64(0x0041_0042_0043)):
        keys = (np.uint64(context) << np.uint64(16)) | np.arange(65536, dtype=np.uint64)
        assert abs(np.exp(model.log_probabilities(keys)).sum() - 1) < 1e-3


class KneserNey:
    """From the textbook, over strings: counts, continuation counts, one absolute discount per order."""

    def __init__(self, texts):
        self.n = {4: Counter(g for t in texts for g in brute_grams(t))}
        for k in (3, 2, 1):
            self.n[k] = Counter(g[1:] for g in self.n[k + 1])
        self.d, self.total, self.kinds = {}, {}, {}
        for k, held in self.n.items():
            one, two = (sum(c == x for c in held.values()) for x in (1, 2))
            self.d[k] = min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.5
            for g, c in held.items():
                self.total[g[:-1], k] = self.total.get((g[:-1], k), 0) + c
                self.kinds[g[:-1], k] = self.kinds.get((g[:-1], k), 0) + 1

    def p(self, g):
        k = len(g)
        if k == 0:
            return 1 / 65536
        lower, context = self.p(g[1:]), (g[:-1], k)
        if context not in self.total:
            return lower
        return (max(self.n[k][g] - self.d[k], 0) + self.d[k] * self.kinds[context] * lower) / self.total[context]

    def entropy(self, text):
        grams = brute_grams(text)
        return -sum(math.log(self.p(g)) for g in grams) / len(grams)


def test_models_and_choice_match_an_independent_kneser_ney(spark):
    texts = {"aa": ["the cat sat on the mat and the rat ran at the cat", "a mat of the cat"] * 2, "bb": ["été dans la ville où il était allé", "la vie est belle là où elle va"],
             "cc": ["中文字 中文 文字中", "字文 中"]}
    asked = [t for held in texts.values() for t in held] + ["the ville", "zq xv", "文 cat été", "a", "la la la"]
    models, own = [], {}
    for name, held in texts.items():
        u, n = np.unique(np.concatenate([packed(t) for t in held]), return_counts=True)
        models.append(langid.estimate(name, u, n))
        own[name] = KneserNey(held)
    raw = [t.encode() for t in asked]
    got, _ = langid.entropies(models, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    want = np.array([[own[name].entropy(t) for name in texts] for t in asked])
    assert got == pytest.approx(want, abs=1e-9)
    rows = [(i * 4 + k, t, name) for name, held in texts.items() for i, t in enumerate(held * 12) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trained = df.where(langid.fold(F.col("doc_id")).isin(0, 1)).collect()
    whole = {name: KneserNey([r["text"] for r in trained if r["lang"] == name]) for name in texts}
    found = langid.fit(df).predict(spark.createDataFrame([(t,) for t in asked], "text string")).collect()
    for r in found:
        entropies = {name: m.entropy(r["text"]) for name, m in whole.items()}
        assert r["lang_pred"] == min(entropies, key=entropies.get) and r["cross_entropy"] == pytest.approx(min(entropies.values()), abs=1e-9)


@pytest.mark.parametrize("text", ["\u0301", "\u0903 12", "\u0301\u0302 ! \u0903"])
def test_marks_alone_are_no_letters(text):
    assert packed(text).tolist() == [] and packed("e" + text).tolist() != []


def test_hash_is_sparks(spark):
    got = [r[0] for r in spark.range(-3, 50).selectExpr("xxhash64(id)").collect()]
    assert langid._xxhash64(np.arange(-3, 50).astype(np.uint64)).view(np.int64).tolist() == got


def corpus(spark, n=160):
    stems = {"aa": ["ka", "to", "mi", "sul"], "bb": ["wre", "gno", "ix", "pf"], "cc": ["ülo", "éa", "ñu", "çi"]}
    rows, rng = [], np.random.default_rng(1)
    for i in range(n):
        lang = sorted(stems)[i % 3]
        words = [" ".join("".join(rng.choice(stems[lang], 3)) for _ in range(30))]
        rows.append((i, words[0], lang if i % 10 else None))
    return rows


def test_held_out_accuracy_rejection_and_blocks(spark, monkeypatch):
    rows = corpus(spark)
    odd = [(9001, "zzqxj vvkkq jjxqz qqqzx xxjjz", "aa"), (9002, None, "aa"), (9003, "123 !!", "bb"), (None, rows[0][1], "aa")]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "LEAST_TEXTS", 3)
    found = langid.fit(df)
    got = {r["doc_id"]: r for r in found.predict(df).collect()}
    truth = {r[0]: sorted({"aa", "bb", "cc"})[r[0] % 3] for r in rows}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2]
    assert held and all(got[d]["lang_pred"] == truth[d] and not got[d]["rejected"] for d in held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert got[9001]["rejected"] and got[9001]["lang_pred"] in {"aa", "bb", "cc"}
    for d in (9002, 9003):
        assert (got[d]["lang_pred"], got[d]["score"], got[d]["rejected"]) == ("und", 0.0, True)
    monkeypatch.setattr(langid, "LANGUAGES", 2)  # two passes: the same result
    again = {r["doc_id"]: r for r in found.predict(df).collect()}
    for d, r in got.items():
        assert again[d]["lang_pred"] == r["lang_pred"] and abs(again[d]["score"] - r["score"]) < 1e-9


def test_models_hold_every_gram(spark):
    rng = np.random.default_rng(7)
    rows = [(i, "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 4000)), "aa") for i in range(10)]
    grams = {g for _, text, _ in rows for g in packed(text).tolist()}
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))[0]
    assert len(grams) > 30_000 and len(model.grams[3]) == len(grams)


@pytest.mark.parametrize("head", [0, 60, 1 << 20])
def test_tables_give_what_models_in_memory_give(spark, monkeypatch, head):
    odd = [(9001, "zzqxj vvkkq jjxqz", "aa"), (9002, None, "aa"), (9003, "123 !!", "bb"), (None, "k", "aa"), (None, "\u4e2d\u6587 \U0001f600", None)]
    df = spark.createDataFrame(corpus(spark) + odd, "doc_id long, text string, lang string").repartition(3)
    monkeypatch.setattr(langid, "LEAST_TEXTS", 3)
    want = sorted((tuple(r) for r in langid.fit(df).predict(df).collect()), key=str)
    monkeypatch.setattr(langid, "WHOLE", 0)
    monkeypatch.setattr(langid, "HEAD", head)
    found = langid.fit(df)
    assert isinstance(found.models, langid.Tables)
    got = sorted((tuple(r) for r in found.predict(df).collect()), key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert [x for x in a if not isinstance(x, float)] == [x for x in b if not isinstance(x, float)]
        assert [x for x in a if isinstance(x, float)] == pytest.approx([x for x in b if isinstance(x, float)], abs=1e-9)


def test_a_rare_language_of_a_large_fold_is_calibrated(spark):
    models = [langid.estimate(name, *np.unique(packed(text), return_counts=True)) for name, text in (("aa", "kato mikato toka "), ("bb", "wregno gnowre "))]
    docs = spark.range(60_000).selectExpr("id as doc_id", "if(id % 1500 = 0, 'wregno gnowre', 'kato mikato') as text", "if(id % 1500 = 0, 'bb', 'aa') as lang")
    assert {name for name, _ in langid.calibrate(docs, models).usual} == {"aa", "bb"}


def test_query_on_odd_documents(spark, tmp_path):
    cases.docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op1_language_id(spark, str(tmp_path)).collect()
    assert len(got) == len(cases.rows())
    assert all(r["lang_pred"] in {"en", "de", "fr", "und"} for r in got)
    empty = spark.createDataFrame([], cases.DOCS)
    assert langid.fit(empty).predict(empty).count() == 0
    unlabelled = cases.docs(spark).withColumn("lang", cases_null())
    assert {r["lang_pred"] for r in langid.fit(unlabelled).predict(unlabelled).collect()} == {"und"}


def cases_null():
    from pyspark.sql import functions as F

    return F.lit(None).cast("string")
