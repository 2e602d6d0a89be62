"""Source-level jobs: profile, gate, quality report, event counts,
duplicates, schema and file manifest of the raw event log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlab.functions.measures import cnt, count_if
from listenlab.settings import EVENT_TYPES

REQUIRED = ("uid", "item_id", "timestamp", "is_organic", "event_type")
ALL_COLUMNS = REQUIRED + ("played_ratio_pct", "track_length_seconds")


def _bool_sum(pred: Column) -> Column:
    # sum(boolean) semantics: NULL on empty input, NULL predicates skipped.
    return F.sum(pred.cast("int"))


def required_null(*cols: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def _over_pairs(source: DataFrame, items: str, *measures: Column) -> DataFrame:
    """The measures (counts, sums, minima, maxima) over the whole source with
    its distinct users and items, in one scan: the events are reduced to one
    row per user and item first, map-side, and the distinct counts run over
    those."""
    pairs = source.groupBy("uid", "item_id").agg(*measures)
    names = [c for c in pairs.columns if c not in ("uid", "item_id")]
    over = {"min_timestamp": F.min, "max_timestamp": F.max}
    out = pairs.agg(*[over.get(n, F.sum)(n).alias(n) for n in names],
                    F.count_distinct("uid").alias("users"), F.count_distinct("item_id").alias(items))
    # an empty source has 0 events
    return out.select(F.coalesce("events", F.lit(0)).alias("events"), "users", items, *names[1:])


def source_profile(source: DataFrame) -> DataFrame:
    """Eleven measures of the raw source in one pass (one row)."""
    return source_identity(source).drop("content")


def source_identity(source: DataFrame) -> DataFrame:
    """The profile and, from the same pass, ``content``: a sum of row hashes,
    equal for the same rows in any order and any files (one row)."""
    is_listen = F.col("event_type") == "listen"
    return _over_pairs(
        source, "items",
        cnt().alias("events"),
        F.min("timestamp").alias("min_timestamp"),
        F.max("timestamp").alias("max_timestamp"),
        _bool_sum(F.col("timestamp") % 5 != 0).cast("bigint").alias("timestamps_not_multiple_of_5"),
        _bool_sum(required_null(*REQUIRED)).cast("bigint").alias("required_nulls"),
        _bool_sum(~F.col("is_organic").isin(0, 1)).cast("bigint").alias("invalid_is_organic"),
        _bool_sum(~F.col("event_type").isin(*EVENT_TYPES)).cast("bigint").alias("invalid_event_type"),
        _bool_sum(is_listen).cast("bigint").alias("listens"),
        _bool_sum(~is_listen & (F.col("played_ratio_pct").isNotNull()
                                | F.col("track_length_seconds").isNotNull()))
        .cast("bigint").alias("non_listen_with_play_fields"),
        F.sum(F.xxhash64(*ALL_COLUMNS).cast("decimal(28,0)")).alias("content"),
    )


def source_gate(source: DataFrame) -> DataFrame:
    """One row: the two gate counts and ``ok``. NULL counts (empty source)
    fail the gate, as do counts above zero."""
    profile = source_profile(source)
    ok = F.coalesce((F.col("required_nulls") == 0) & (F.col("invalid_event_type") == 0), F.lit(False))
    return profile.select("events", "required_nulls", "invalid_event_type", ok.alias("ok"))


def check_gate(source: DataFrame) -> dict:
    """Run the gate; raise with the profile when it fails. Returns the
    profile with the source's ``content``."""
    row = source_identity(source).withColumn("content", F.col("content").cast("string")).first().asDict()
    if row["required_nulls"] != 0 or row["invalid_event_type"] != 0:  # None on an empty source
        raise ValueError(f"source gate failed: {row}")
    return row


def source_quality(source: DataFrame) -> DataFrame:
    """The notebook quality table: sizes, time range and four error counts."""
    is_listen = F.col("event_type") == "listen"
    play_missing = F.col("played_ratio_pct").isNull() | F.col("track_length_seconds").isNull()
    play_present = F.col("played_ratio_pct").isNotNull() | F.col("track_length_seconds").isNotNull()
    return _over_pairs(
        source, "tracks",
        cnt().alias("events"),
        F.min("timestamp").alias("min_timestamp"),
        F.max("timestamp").alias("max_timestamp"),
        count_if(required_null(*REQUIRED)).alias("missing_required"),
        count_if(F.col("timestamp") % 5 != 0).alias("invalid_timestamp_step"),
        count_if(is_listen & play_missing).alias("invalid_listens"),
        count_if(~is_listen & play_present).alias("invalid_actions"),
    )


def event_type_counts(source: DataFrame) -> DataFrame:
    """Rows per event type, most frequent first."""
    return source.groupBy(F.col("event_type").alias("event")).agg(cnt().alias("rows")) \
        .orderBy(F.desc("rows"), "event")


def duplicate_rows(source: DataFrame) -> DataFrame:
    """Excess rows of full duplicates (NULLs group together). Only a hash and
    a count per row are shuffled; whole rows are compared where a hash
    repeats, so other rows of one hash are no duplicates. A group of copies,
    however large, collapses in the map-side partial counts."""
    hashed = source.withColumn("_hash", F.xxhash64(*ALL_COLUMNS))
    repeated = hashed.groupBy("_hash").agg(cnt().alias("n")).where(F.col("n") > 1).select("_hash")
    groups = hashed.join(repeated, "_hash", "left_semi").groupBy(*ALL_COLUMNS).agg(cnt().alias("n")).where(F.col("n") > 1)
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def source_schema(source: DataFrame) -> list[tuple[str, str, bool]]:
    """Column name, type and nullability (metadata only, no job)."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in source.schema.fields]


def source_manifest(raw: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """Rows and bytes per source file from the scan's file metadata, and
    whether the total matches ``expected_rows``."""
    per_file = raw.select("_metadata.file_path", "_metadata.file_size") \
        .groupBy("file_path", "file_size").agg(cnt().alias("rows"))
    if expected_rows is None:
        return per_file
    total = per_file.agg(F.sum("rows")).scalar()
    return per_file.withColumn("rows_match_expected", total == F.lit(int(expected_rows)))
