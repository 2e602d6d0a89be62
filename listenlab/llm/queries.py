"""The registered queries of this package: each applies its operator, with
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlab.llm import embedding_join, gnat, html_extract, jaccard_join, langid, licenses, merkle, merkle_manifest, mixing, packing, secrets_scan, substring_dedup, warc
from listenlab.llm.shared import keep

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    predicted = langid.fit(docs).predict(docs.select("doc_id", "text"))
    return predicted.select("doc_id", (langid.fold(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score",
                            "cross_entropy", "rejected")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("licenses", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        licenses.joined_labels(base).alias("base_labels"), licenses.joined_labels(F.col("licenses")).alias("labels"),
        F.coalesce(F.array_max(F.transform("licenses", lambda p: p["score"])), F.lit(0.0)).alias("score"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = merkle.next_in_order(table(spark, sf_dir, "documents").select("doc_id", "text"))
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("edited", merkle.edited(F.col("text"), F.col("next_text")))
    own, other, following = F.col("own"), F.col("other"), F.col("following")
    trees = docs.withColumns({"own": merkle.tree(F.col("text")), "other": merkle.tree(F.col("edited")),
                              "following": merkle.tree(F.col("next_text"))})
    change = merkle.located(other, own)
    return trees.select(
        "doc_id", change["paragraphs"].alias("changed_paragraphs"), change["first"].alias("first_changed"),
        F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        own["root"].alias("fingerprint"), other["root"].alias("edited_fingerprint"),
        merkle.tree_likeness(own, other).alias("near_edited"), merkle.tree_likeness(own, following).alias("near_next"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.similar_components(docs).drop("digest")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    base = F.filter("secrets", lambda s: s["kind_no"] < len(secrets_scan.BASE_KINDS))
    count = [secrets_scan.of_kind(F.col("secrets"), k).alias(f"n_{k.name}") for k in secrets_scan.BASE_KINDS]
    spans = F.array_join(F.transform("secrets", secrets_scan.digest), ",")
    base_sha = F.sha2(F.array_join(F.transform(base, secrets_scan.digest), ","), 256)
    # without the texts: the rows that the ownership counts and the result are made from
    found = keep(secrets_scan.scan(docs).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", *count, base_sha.alias("base_sha256"),
        spans.alias("spans"), secrets_scan.values_of(F.col("secrets")).alias("values")), "secret-spans")
    classed = secrets_scan.with_ownership(found, "row", "source", "doc_id")
    return found.join(classed, "row", "left").select(
        "doc_id", *[f"n_{k.name}" for k in secrets_scan.BASE_KINDS], "base_sha256", "spans",
        F.coalesce(F.array_size("live_values"), F.lit(0)).cast("long").alias("n_live"),
        F.coalesce(F.array_size("example_values"), F.lit(0)).cast("long").alias("n_example"),
        F.coalesce("most_repositories", F.lit(0)).alias("most_repositories"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.with_copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", F.col("mix.size").alias("size"), F.col("mix.source_size").alias("source_size"),
        F.round("mix.target", 6).alias("target"), (F.col("mix.copies") * F.col("mix.size")).alias("taken"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", gnat.quantised(F.col("embedding")).alias("vector"), F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return gnat.hard_negatives(vectors, "vec_id", "vector", "label", vec_id % 100 == 0)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_folder(spark)
    warc.write(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    read = warc.read_files(spark, folder, with_payload=False)
    sound = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat_ws(" ", "path", "at", "problem"))).otherwise(F.col("type"))
    pages = read.select("record_id", "payload_bytes", "payload_digest", sound.alias("record_type"), "refers_to")
    return pages.where("record_type in ('response', 'revisit')").select(
        warc.page_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_id(F.col("refers_to")).alias("refers_to"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def leaf(text):
        return merkle_manifest.record_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    text = F.col("text")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", leaf(text).alias("leaf"),
        F.when(tampered & F.contains(text, F.lit("\n")), leaf(F.replace(text, F.lit("\n"), F.lit("")))).alias("other"))
    proven, root = merkle_manifest.manifest(docs, "source", "doc_id", "leaf")
    folded = merkle_manifest.folded(F.coalesce("other", "leaf"), F.col("path"))
    return proven.select(
        "doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_license_scans": op2_license_scans,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_secret_scans": op7_secret_scans,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_mixing": op10_mixing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_warc": op12_warc,
    "op13_merkle_manifest": op13_merkle_manifest,
}
