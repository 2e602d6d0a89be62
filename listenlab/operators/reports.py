"""Named analysis reports over the marts, and the dashboard KPIs.

Display rounding follows the origin of each number: SQL ``round`` (half
away from zero) is ``sql_round``; frames rounded as a whole after the query
(half to even) use ``frame_round``. Rounding is applied here only, never in
marts. Dashboard-only filters are parameters with the documented defaults.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlab.functions.labels import (
    ENGAGEMENT_ORDER, FUNNEL_REPORT_NAMES, RECOMMENDATION_ORDER, label_order, quality_segment,
)
from listenlab.functions.measures import (
    cnt, count_if, frame_round, pct, ratio, sql_round, sum_if,
)
from listenlab.functions.quantiles import column_quantiles, median
from listenlab.settings import DEFAULT, Settings


def _bround_doubles(df: DataFrame, digits: int = 2) -> DataFrame:
    """Round every double column like a data frame's ``round`` (half to even
    on the binary value): the whole-frame display round of the notebooks."""
    return df.select(*[
        frame_round(F.col(f.name), digits).alias(f.name) if f.dataType.simpleString() == "double"
        else F.col(f.name) for f in df.schema.fields
    ])


# --- product -----------------------------------------------------------------

def product_summary(product: DataFrame) -> DataFrame:
    """Days, totals, median DAU and weighted rates over all days."""
    return _bround_doubles(product.agg(
        cnt().alias("days"),
        F.sum("events").alias("events"),
        F.sum("listens").alias("listens"),
        F.median("active_users").alias("median_dau"),
        F.sum("sessions").alias("sessions"),
        (F.try_divide(F.sum("play_seconds").cast("double"), F.sum("active_users").cast("double")) / 60.0)
        .alias("minutes_per_active_user"),
        pct(F.sum("listen_plus"), F.sum("listens")).alias("listen_plus_pct"),
        pct(F.sum("recommendation_listens"), F.sum("listens")).alias("recommendation_pct"),
        pct(F.sum("replays"), F.sum("listens")).alias("replay_pct"),
        ratio(F.sum("likes"), F.sum("listens"), 1000.0).alias("likes_per_1000"),
        ratio(F.sum("dislikes"), F.sum("listens"), 1000.0).alias("dislikes_per_1000"),
    ))


def source_comparison(product: DataFrame) -> DataFrame:
    """Recommendations vs organic listens: one pass, two rows."""
    sums = product.agg(*[F.sum(c).alias(c) for c in (
        "recommendation_listens", "recommendation_listen_plus", "recommendation_replays",
        "organic_listens", "organic_listen_plus", "organic_replays")])
    rows = sums.select(F.inline(F.array(
        F.struct(F.lit("рекомендации").alias("source"), F.col("recommendation_listens").alias("listens"),
                 pct("recommendation_listen_plus", "recommendation_listens").alias("listen_plus_pct"),
                 pct("recommendation_replays", "recommendation_listens").alias("replay_pct")),
        F.struct(F.lit("органика").alias("source"), F.col("organic_listens").alias("listens"),
                 pct("organic_listen_plus", "organic_listens").alias("listen_plus_pct"),
                 pct("organic_replays", "organic_listens").alias("replay_pct")),
    )))
    return _bround_doubles(rows)


def funnel_report(funnel: DataFrame) -> DataFrame:
    """Funnel in percent of the first step, with display names."""
    return _bround_doubles(funnel.select(
        "step_order", "step",
        label_order("step", FUNNEL_REPORT_NAMES).alias("step_name"),
        "events", "users",
        (F.col("event_rate_from_start") * 100).alias("event_pct_from_start"),
        (F.col("user_rate_from_start") * 100).alias("user_pct_from_start"),
    ))


def daily_preview(product: DataFrame, days: int = 10) -> DataFrame:
    """The first ``days`` days with rounded display rates."""
    return product.select(
        "day_idx", "active_users", "listeners", "listens", "sessions",
        sql_round("minutes_per_active_user", 2).alias("minutes_per_active_user"),
        sql_round(F.col("listen_plus_rate") * 100, 2).alias("listen_plus_pct"),
        sql_round(F.col("recommendation_share") * 100, 2).alias("recommendation_pct"),
        sql_round("likes_per_1000_listens", 2).alias("likes_per_1000"),
        sql_round("dislikes_per_1000_listens", 2).alias("dislikes_per_1000"),
    ).orderBy("day_idx").limit(days)


# --- users and retention -----------------------------------------------------

def user_summary(user: DataFrame) -> DataFrame:
    return _bround_doubles(user.agg(
        cnt().alias("users"),
        F.avg("active_days").alias("avg_active_days"),
        (F.avg("recommendation_share") * 100).alias("avg_user_recommendation_pct"),
    ).withColumn("_q", column_quantiles(user, {f"median_{c}": (c, 0.5) for c in ("active_days", "listens", "sessions")}))
        .select("users", "avg_active_days", "avg_user_recommendation_pct", "_q.*"))


def overall_retention(retention: DataFrame, lifetime_days=(1, 7, 30)) -> DataFrame:
    """Dn over all cohorts for the given lifetime days."""
    return _bround_doubles(
        retention.where(F.col("lifetime_day").isin(*lifetime_days)).groupBy("lifetime_day").agg(
            F.sum("retained_users").alias("retained_users"),
            F.sum("cohort_users").alias("eligible_users"),
            pct(F.sum("retained_users"), F.sum("cohort_users")).alias("retention_pct"),
        ).orderBy("lifetime_day"))


def _dn(n: int) -> Column:
    on_day = F.col("lifetime_day") == n
    return pct(sum_if(on_day, "retained_users"), sum_if(on_day, "cohort_users")).alias(f"d{n}_pct")


def retention_by_recommendations(retention: DataFrame, lifetime_days=(1, 7, 30)) -> DataFrame:
    """Per first-day recommendation bucket: cohort size, size-weighted first-day
    listens, and Dn for each lifetime day."""
    d0 = F.col("lifetime_day") == 0
    out = retention.groupBy("recommendation_bucket").agg(
        sum_if(d0, "cohort_users").alias("users"),
        F.try_divide(sum_if(d0, F.col("avg_first_day_listens") * F.col("cohort_users")).cast("double"),
                     sum_if(d0, "cohort_users").cast("double")).alias("avg_first_day_listens"),
        *[_dn(n) for n in lifetime_days],
    )
    return _bround_doubles(out.orderBy(label_order("recommendation_bucket", RECOMMENDATION_ORDER)
                                       .asc_nulls_last()))


def controlled_d7(retention: DataFrame, lifetime_day: int = 7) -> DataFrame:
    """Dn by engagement x recommendation bucket (both in display order)."""
    return retention.where(F.col("lifetime_day") == lifetime_day) \
        .groupBy("engagement_bucket", "recommendation_bucket").agg(
            F.sum("cohort_users").alias("users"),
            pct(F.sum("retained_users"), F.sum("cohort_users")).alias(f"d{lifetime_day}_pct"),
        ).orderBy(label_order("engagement_bucket", ENGAGEMENT_ORDER).asc_nulls_last(),
                  label_order("recommendation_bucket", RECOMMENDATION_ORDER).asc_nulls_last())


def controlled_d7_pivot(retention: DataFrame, lifetime_day: int = 7) -> DataFrame:
    """The same as a matrix: engagement rows in display order, one column per
    recommendation bucket (NULL where the data has none of it)."""
    flat = controlled_d7(retention, lifetime_day)
    value = f"d{lifetime_day}_pct"
    wide = flat.groupBy("engagement_bucket").pivot("recommendation_bucket", list(RECOMMENDATION_ORDER)).agg(F.first(value))
    return _bround_doubles(wide).orderBy(label_order("engagement_bucket", ENGAGEMENT_ORDER).asc_nulls_last())


def cohort_heatmap(retention: DataFrame, lifetime_days=(1, 7, 30), cohorts: int = 10) -> DataFrame:
    """Cohort size and Dn per cohort day; only cohorts mature for the last
    lifetime day; the first ``cohorts`` cohort days."""
    out = retention.groupBy("cohort_day").agg(
        sum_if(F.col("lifetime_day") == 0, "cohort_users").alias("cohort_users"),
        *[_dn(n) for n in lifetime_days],
    ).where(F.col(f"d{lifetime_days[-1]}_pct").isNotNull())
    return _bround_doubles(out).orderBy("cohort_day").limit(cohorts)


# --- tracks ------------------------------------------------------------------

def track_summary(track: DataFrame) -> DataFrame:
    has_listens = F.col("listens") > 0
    return _bround_doubles(track.agg(
        cnt().alias("tracks"),
        count_if(has_listens).alias("listened_tracks"),
        count_if("is_reliable_sample").alias("reliable_tracks"),
        F.sum("listens").alias("listens"),
        pct(F.sum("listen_plus"), F.sum("listens")).alias("listen_plus_pct"),
        pct(F.sum("replays"), F.sum("listens")).alias("replay_pct"),
        ratio(F.sum("likes"), F.sum("listens"), 1000.0).alias("likes_per_1000"),
        ratio(F.sum("dislikes"), F.sum("listens"), 1000.0).alias("dislikes_per_1000"),
    ).withColumn("median_listeners", median(track.where(has_listens), "listeners")))


def track_source_quality(track: DataFrame) -> DataFrame:
    return _bround_doubles(track.agg(
        pct(F.sum("recommendation_listen_plus"), F.sum("recommendation_listens"))
        .alias("recommendation_listen_plus_pct"),
        pct(F.sum("organic_listen_plus"), F.sum("organic_listens")).alias("organic_listen_plus_pct"),
        pct(F.sum("recommendation_listens"), F.sum("listens")).alias("recommendation_share_pct"),
    ))


# The quartiles that bound the quality segments.
QUALITY_SHARES = {"listen_plus_q25": ("listen_plus_rate", 0.25), "listen_plus_q75": ("listen_plus_rate", 0.75),
                  "dislikes_per_1000_q75": ("dislikes_per_1000_listens", 0.75)}


def quality_thresholds(reliable: DataFrame, brackets: Mapping[str, list | None] | None = None) -> Column:
    """Exact, linearly interpolated quartiles of the reliable tracks as one
    struct (q25, q75 of Listen+ rate; q75 of dislikes per 1000)."""
    return column_quantiles(reliable, QUALITY_SHARES, brackets)


def segmented_tracks(track: DataFrame, attention_wins: bool, brackets: Mapping[str, list | None] | None = None) -> DataFrame:
    reliable = track.where(F.col("is_reliable_sample"))
    limits = quality_thresholds(reliable, brackets)
    return reliable.withColumn("quality_segment", quality_segment(
        F.col("listen_plus_rate"), F.col("dislikes_per_1000_listens"),
        limits["listen_plus_q25"], limits["listen_plus_q75"], limits["dislikes_per_1000_q75"],
        attention_wins=attention_wins))


def quality_segments(track: DataFrame, brackets: Mapping[str, list | None] | None = None) -> DataFrame:
    """Three quality segments of reliable tracks (the report's CASE order:
    "high" is tested first) with their sizes and averages. With ``brackets``
    from the mart's write the mart is read twice: for ranks, and for this."""
    out = segmented_tracks(track, False, brackets).groupBy("quality_segment").agg(
        cnt().alias("tracks"),
        F.sum("listens").alias("listens"),
        (F.avg("listen_plus_rate") * 100).alias("avg_listen_plus_pct"),
        F.avg("dislikes_per_1000_listens").alias("avg_dislikes_per_1000"),
    )
    return _bround_doubles(out).orderBy(F.desc("tracks"), "quality_segment")


def popular_tracks(track: DataFrame, k: int = 10) -> DataFrame:
    """Top-k reliable tracks by listens (item_id breaks ties)."""
    ranked = track.where(F.col("is_reliable_sample")).orderBy(F.desc("listens"), "item_id").limit(k)
    return ranked.select(
        "item_id", "listens", "listeners",
        sql_round(F.col("listen_plus_rate") * 100, 2).alias("listen_plus_pct"),
        sql_round(F.col("recommendation_share") * 100, 2).alias("recommendation_pct"),
        sql_round("likes_per_1000_listens", 2).alias("likes_per_1000"),
        sql_round("dislikes_per_1000_listens", 2).alias("dislikes_per_1000"),
    )


def problem_tracks(track: DataFrame, k: int = 10) -> DataFrame:
    """Worst k reliable tracks: lowest Listen+ rate, then most dislikes."""
    ranked = track.where(F.col("is_reliable_sample")).orderBy(
        F.asc_nulls_last("listen_plus_rate"), F.desc_nulls_last("dislikes_per_1000_listens"), "item_id"
    ).limit(k)
    return ranked.select(
        "item_id", "listens", "listeners",
        sql_round(F.col("listen_plus_rate") * 100, 2).alias("listen_plus_pct"),
        sql_round("dislikes_per_1000_listens", 2).alias("dislikes_per_1000"),
        sql_round(F.col("recommendation_share") * 100, 2).alias("recommendation_pct"),
    )


# --- dashboard KPIs ----------------------------------------------------------

def kpi_product(product: DataFrame, first_day: int | None = None, last_day: int | None = None) -> DataFrame:
    """Product cards over the selected days (all days by default)."""
    days = product
    if first_day is not None:
        days = days.where(F.col("day_idx") >= first_day)
    if last_day is not None:
        days = days.where(F.col("day_idx") <= last_day)
    return days.agg(
        F.avg("active_users").alias("avg_dau"),
        F.avg("listens").alias("avg_listens_per_day"),
        ratio(F.sum("listens"), F.sum("active_users")).alias("listens_per_active_user"),
        ratio(F.sum("recommendation_listens"), F.sum("listens")).alias("recommendation_share"),
    )


def kpi_retention(retention: DataFrame, lifetime_days=(1, 7, 30),
                  settings: Settings = DEFAULT) -> DataFrame:
    """Dn cards: summed retained / summed cohort users, cohorts after day 0."""
    return retention.where(F.col("cohort_day") >= settings.kpi_min_cohort_day) \
        .where(F.col("lifetime_day").isin(*lifetime_days)).groupBy("lifetime_day").agg(
            F.sum("retained_users").alias("retained_users"),
            F.sum("cohort_users").alias("cohort_users"),
            ratio(F.sum("retained_users"), F.sum("cohort_users")).alias("retention"),
        )


def kpi_retention_weekly(retention: DataFrame, lifetime_days=(1, 7, 30),
                         settings: Settings = DEFAULT) -> DataFrame:
    """The same per weekly cohort (week start = cohort_day div 7 * 7)."""
    week = (F.expr("cohort_day div 7") * 7).alias("cohort_week_start")
    return retention.where(F.col("cohort_day") >= settings.kpi_min_cohort_day) \
        .where(F.col("lifetime_day").isin(*lifetime_days)).groupBy(week, "lifetime_day").agg(
            F.sum("retained_users").alias("retained_users"),
            F.sum("cohort_users").alias("cohort_users"),
            ratio(F.sum("retained_users"), F.sum("cohort_users")).alias("retention"),
        )


def kpi_tracks(track: DataFrame, min_listens: int | None = None, settings: Settings = DEFAULT) -> DataFrame:
    """Track cards over tracks with at least ``min_listens`` listens."""
    m = settings.kpi_track_min_listens if min_listens is None else min_listens
    return track.where(F.col("listens") >= m).agg(
        cnt().alias("tracks"),
        F.sum("listens").alias("listens"),
        ratio(F.sum("listen_plus"), F.sum("listens")).alias("listen_plus_rate"),
        ratio(F.sum("likes"), F.sum("listens"), 1000.0).alias("likes_per_1000"),
        ratio(F.sum("dislikes"), F.sum("listens"), 1000.0).alias("dislikes_per_1000"),
    )
