import hashlib
import re

from listenlab.llm import queries, secrets_scan

from . import cases

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(out)


def test_spans_match_brute_force(spark, tmp_path):
    cases.docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op7_secret_scans(spark, str(tmp_path)).collect()
    expected = []
    for doc_id, text, *_ in cases.rows():
        spans = brute(text)
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        n = [sum(k == name for *_, k in spans) for name in ("assign", "access", "hex")]
        expected.append((doc_id, *n, hashlib.sha256(joined.encode()).hexdigest()))
    key = lambda r: str(r)
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(expected, key=key)
    assert any("github:" in r["spans"] for r in got)


def test_ownership_separates_examples(spark):
    rows = [("a", f"o{i}", i) for i in range(5)] + [("b", "o1", 1), ("b", "o1", 2), ("b", "o1", 2), ("c", None, 3), ("c", "o1", 4)]
    got = {r["value"]: tuple(r)[1:] for r in secrets_scan.ownership(
        spark.createDataFrame(rows, "value string, owner string, repository long")).collect()}
    assert got == {"a": (5, 5, False), "b": (2, 1, True), "c": (2, 2, True)}


def test_redaction_replaces_live_values_only(spark):
    live, shown = "token=abcdefabcdef0123", "password=example0example"
    rows = [(1, f"é {live} x {live}", "o1", 0, "k"), (2, None, "o1", 0, "k"), (3, "clean", None, 5, "k"), (None, live, "o1", 0, "k")]
    rows += [(10 + i, shown, f"o{i}", 0, "k") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, value string")
    got = {r["doc_id"]: r for r in secrets_scan.redact(df).collect()}
    assert len(got) == len(rows)
    assert got[1]["text"] == "é [secret] x [secret]" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] is None and got[3]["text"] == "clean" and got[None]["text"] == "[secret]"
    assert all(got[10 + i]["text"] == shown for i in range(4))


def test_spans_of_texts_with_many_matches(spark, tmp_path):
    texts = [" ".join(f"x{'é' * (i % 5)} token = abcdefghijkl{i:05d} {'0af' * (i % 9)}" for i in range(n)) for n in (1, 127, 128, 129, 256, 5000)]
    rows = [(i, t, "en", "s1", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, cases.DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op7_secret_scans(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        spans = brute(text)
        assert got[i]["spans"] == ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans) and got[i]["n_assign"] == text.count("token")


def test_copies_within_one_owner_are_told(spark, tmp_path):
    rows = [(i, "password=copied0copied", "en", "hot", 0) for i in range(30)] + [(100, "password=single0single", "en", "hot", 0), (101, "none", "en", "hot", 0)]
    spark.createDataFrame(rows, cases.DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["n_live"], r["most_repositories"]) for r in queries.op7_secret_scans(spark, str(tmp_path)).collect()}
    assert got[0] == (1, 30) and got[100] == (1, 1) and got[101] == (0, 0)


def test_empty_table(spark):
    assert secrets_scan.redact(spark.createDataFrame([], cases.DOCS)).count() == 0
