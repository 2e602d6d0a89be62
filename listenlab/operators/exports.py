"""Dashboard extracts: marts plus display columns, ready for CSV.

Scalars the extracts need (edge days, quartile thresholds, observation end)
are scalar subqueries, evaluated once per query and never collected into
driver code.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlab.functions.labels import (
    DAY_LABEL_FORMAT, ENGAGEMENT_ORDER, FUNNEL_STEP_NAMES, QUALITY_SEGMENTS, RECOMMENDATION_ORDER,
    SOURCE_LABELS, TRACK_LENGTH_ORDER, TRACK_SHARE_ORDER, WEEK_LABEL_FORMAT, label_order,
    quality_segment, track_length_bucket, track_share_bucket,
)
from listenlab.functions.measures import ratio
from listenlab.operators.reports import quality_thresholds


def export_product_day(product: DataFrame) -> DataFrame:
    """Product mart + day label and the first/last day flag."""
    edges = product.agg(F.struct(F.min("day_idx").alias("lo"), F.max("day_idx").alias("hi"))).scalar()
    return product.select(
        "*",
        F.format_string(DAY_LABEL_FORMAT, F.col("observation_day")).alias("day_label"),
        ((F.col("day_idx") == edges["lo"]) | (F.col("day_idx") == edges["hi"])).alias("is_edge_day"),
    ).orderBy("day_idx")


def track_thresholds(track: DataFrame, brackets: Mapping[str, list | None] | None = None) -> DataFrame:
    """The three quartile thresholds of the reliable tracks (one row)."""
    limits = quality_thresholds(track.where(F.col("is_reliable_sample")), brackets)
    one = track.sparkSession.range(1).select(limits.alias("limits"))
    return one.select("limits.*")


def export_track_quality(track: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """Reliable tracks with length and share buckets, quality segment (the
    attention rule wins), the Listen+ gap in points and the activity span.
    The Parquet filter on ``is_reliable_sample`` is pushed to the scan.
    ``thresholds`` are those of ``track_thresholds``, if they are there already."""
    reliable = track.where(F.col("is_reliable_sample"))
    limits = quality_thresholds(reliable) if thresholds is None else thresholds.select(F.struct("*")).scalar()
    seconds = F.col("track_length_seconds")
    share = F.col("recommendation_share")
    segment = quality_segment(F.col("listen_plus_rate"), F.col("dislikes_per_1000_listens"),
                              limits["listen_plus_q25"], limits["listen_plus_q75"],
                              limits["dislikes_per_1000_q75"], attention_wins=True)
    out = reliable.select(
        "*",
        (seconds / 60.0).alias("track_length_minutes"),
        track_length_bucket(seconds).alias("track_length_bucket"),
        label_order(track_length_bucket(seconds), TRACK_LENGTH_ORDER).alias("track_length_order"),
        track_share_bucket(share).alias("recommendation_share_bucket"),
        label_order(track_share_bucket(share), TRACK_SHARE_ORDER).alias("recommendation_share_order"),
        segment.alias("quality_segment"),
        label_order(segment, QUALITY_SEGMENTS).alias("quality_segment_order"),
        ((F.col("recommendation_listen_plus_rate") - F.col("organic_listen_plus_rate")) * 100.0)
        .alias("recommendation_listen_plus_gap_pp"),
        (F.col("last_day") - F.col("first_day") + 1).alias("activity_span_days"),
    )
    return out.orderBy("item_id")


def export_retention_cohort(retention: DataFrame) -> DataFrame:
    """Retention mart + weekly cohort, bucket orders and maturity flags."""
    end = retention.agg(F.max(F.col("cohort_day") + F.col("lifetime_day"))).scalar()
    week = F.expr("cohort_day div 7") * 7
    return retention.select(
        "*",
        week.alias("cohort_week_start"),
        F.format_string(WEEK_LABEL_FORMAT, week, week + 6).alias("cohort_week_label"),
        label_order("recommendation_bucket", RECOMMENDATION_ORDER).alias("recommendation_bucket_order"),
        label_order("engagement_bucket", ENGAGEMENT_ORDER).alias("engagement_bucket_order"),
        (F.col("cohort_day") <= end - 7).alias("is_mature_d7"),
        (F.col("cohort_day") <= end - 30).alias("is_mature_d30"),
    ).orderBy("cohort_day", "lifetime_day", "recommendation_bucket", "engagement_bucket")


def export_funnel(funnel: DataFrame) -> DataFrame:
    """Funnel with the display name as third column."""
    cols = funnel.columns
    named = label_order("step", FUNNEL_STEP_NAMES).alias("step_name_ru")
    return funnel.select(*cols[:2], named, *cols[2:]).orderBy("step_order")


def export_recommendation_quality(product: DataFrame) -> DataFrame:
    """Recommendations vs organic from the product mart: two rows."""
    sums = product.agg(*[F.sum(c).cast("bigint").alias(c) for c in (
        "recommendation_listens", "recommendation_listen_plus", "recommendation_replays",
        "organic_listens", "organic_listen_plus", "organic_replays")])

    def row(order: int, code: str, prefix: str):
        listens, plus, replays = (F.col(f"{prefix}_{x}") for x in ("listens", "listen_plus", "replays"))
        return F.struct(
            F.lit(order).alias("source_order"), F.lit(code).alias("source_code"),
            listens.alias("listens"), plus.alias("listen_plus"), replays.alias("replays"),
            ratio(plus, listens).alias("listen_plus_rate"), ratio(replays, listens).alias("replay_rate"),
            F.lit(SOURCE_LABELS[code]).alias("source_ru"),
        )

    return sums.select(F.inline(F.array(row(1, "recommendations", "recommendation"),
                                         row(2, "organic", "organic"))))
