"""Extra columns whose names the operators use themselves pass through."""
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from listenlab.llm import jaccard_join, langid, licenses, merkle, mixing, packing, secrets_scan, substring_dedup

from . import cases

OPERATORS = {
    "langid": (lambda d: langid.fit(d).predict(d), {"lang_pred", "score", "cross_entropy", "letters", "rejected"}),
    "licenses": (licenses.scan, {"n_words", "licenses"}),
    "merkle": (merkle.next_in_order, {"next_text"}),
    "mixing": (mixing.with_copies, {"mix"}),
    "emission": (lambda d: mixing.emit(d), set()),
    "redaction": (secrets_scan.redact, set()),
    "substrings": (substring_dedup.remove_repeats, {"kept_text", "n_words", "n_removed"}),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_pass_through(spark, name):
    run, results = OPERATORS[name]
    docs = cases.clashing(cases.docs(spark))
    out = run(docs)
    assert sorted(out.columns) == sorted(set(docs.columns) - ({"text"} if name == "substrings" else set()) | results)
    own = [c for c in docs.columns if c not in results and str(c) not in cases.DOCS]
    assert own
    got = out.agg(F.count("*").alias("n"), *[F.min(c).alias(c) for c in own], *[F.max(c).alias(f"max {c}") for c in own]).first()
    assert got["n"] == (len(cases.rows()) if name != "emission" else mixing.emit(cases.docs(spark)).count())
    assert all(got[c] == got[f"max {c}"] == f"own {c}" for c in own)


def test_operators_with_rows_of_their_own_ignore_other_columns(spark):
    docs = cases.clashing(cases.docs(spark))
    assert jaccard_join.similar_components(docs).count() == len(cases.rows())
    assert packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).count() >= len(cases.rows())
