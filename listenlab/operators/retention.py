"""Exact-day retention cohorts split by first-day behaviour (steps R1-R8).

A user's cohort is the first day with a listen. First-day metrics are that
day's row of the user-day base (all events of the day count: sessions
started by a reaction included). Retention on lifetime day n = the user
listened on cohort_day + n. Every cohort gets one row per lifetime day up
to the data horizon (max day over all events), zero-filled; immature days
have no row.

Every step runs on the user-day base: the per-user cohort lookup is a
window over a user's active days (at most one row per day, so a heavy user
stays small), and no stage-grain self-join remains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlab.functions.labels import engagement_bucket, recommendation_bucket
from listenlab.functions.measures import cnt, ratio
from listenlab.operators.base import user_day_base

RETENTION_KEY = ("cohort_day", "lifetime_day", "recommendation_bucket", "engagement_bucket")
RETENTION_COLUMNS = RETENTION_KEY[:2] + RETENTION_KEY[2:] + (
    "cohort_users", "retained_users", "retention_rate", "avg_first_day_listens",
    "avg_first_day_sessions", "avg_first_day_listen_plus_rate",
)
_BUCKETS = ["cohort_day", "recommendation_bucket", "engagement_bucket"]


def horizon(base: DataFrame):
    """R1: the last day with any event, as a scalar subquery column."""
    return base.agg(F.max("day_idx").alias("max_day")).scalar()


def with_cohort(base: DataFrame) -> DataFrame:
    """Each base row plus its user's cohort and first-day metrics (or NULL for
    users who never listened)."""
    first = F.min(F.when(F.col("listens") > 0, F.struct(
        F.col("day_idx").alias("cohort_day"),
        F.col("listens").alias("first_day_listens"),
        F.col("sessions").alias("first_day_sessions"),
        ratio("recommendation_listens", "listens").alias("first_day_recommendation_share"),
        ratio("listen_plus", "listen_plus_known").alias("first_day_listen_plus_rate"),
    ))).over(Window.partitionBy("uid"))
    return base.withColumn("_c", first).select("*", "_c.*").drop("_c")


def cohort_first_days(base: DataFrame) -> DataFrame:
    """R2: first listen day per user."""
    return base.where(F.col("listens") > 0).groupBy("uid").agg(F.min("day_idx").alias("cohort_day"))


def cohort_first_day_metrics(base: DataFrame) -> DataFrame:
    """R3: per user, the cohort day and that day's listens, sessions,
    recommendation share and Listen+ rate (flag average, NULL flags skipped)."""
    return with_cohort(base).where(F.col("day_idx") == F.col("cohort_day")).select(
        "uid", "cohort_day", "first_day_listens", "first_day_sessions",
        "first_day_recommendation_share", "first_day_listen_plus_rate",
    )


def _bucketed(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "recommendation_bucket", recommendation_bucket(F.col("first_day_recommendation_share"))
    ).withColumn("engagement_bucket", engagement_bucket(F.col("first_day_listens")))


def cohort_buckets(base: DataFrame) -> DataFrame:
    """R4: R3 plus the recommendation and engagement buckets."""
    return _bucketed(cohort_first_day_metrics(base))


def _sizes(cohorts: DataFrame) -> DataFrame:
    return cohorts.groupBy(*_BUCKETS).agg(
        cnt().alias("cohort_users"),
        F.avg("first_day_listens").alias("avg_first_day_listens"),
        F.avg("first_day_sessions").alias("avg_first_day_sessions"),
        F.avg("first_day_listen_plus_rate").alias("avg_first_day_listen_plus_rate"),
    )


def cohort_sizes(base: DataFrame) -> DataFrame:
    """R5: users and three unweighted first-day averages per cohort x buckets."""
    return _sizes(cohort_buckets(base))


def _retained(rows: DataFrame) -> DataFrame:
    # One base row per (uid, day) and one cohort per uid: the row count per
    # group equals the distinct users.
    return rows.where((F.col("listens") > 0) & (F.col("day_idx") >= F.col("cohort_day"))) \
        .groupBy(*_BUCKETS, (F.col("day_idx") - F.col("cohort_day")).alias("lifetime_day")) \
        .agg(cnt().alias("retained_users"))


def cohort_retained(base: DataFrame) -> DataFrame:
    """R6: distinct users who listened on each lifetime day."""
    return _retained(_bucketed(with_cohort(base)).where(F.col("cohort_day").isNotNull()))


def _grid(sizes: DataFrame, max_day) -> DataFrame:
    return sizes.withColumn(
        "lifetime_day", F.explode(F.sequence(F.lit(0).cast("bigint"), max_day - F.col("cohort_day")))
    )


def cohort_grid(base: DataFrame) -> DataFrame:
    """R7: one row per cohort x buckets x lifetime day up to the horizon."""
    return _grid(cohort_sizes(base), horizon(base)).select(
        "cohort_day", "recommendation_bucket", "engagement_bucket", "lifetime_day",
        "cohort_users", "avg_first_day_listens", "avg_first_day_sessions",
        "avg_first_day_listen_plus_rate",
    )


def retention_cohort(stage: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """R8, ``mart_retention_cohort``: the zero-filled grid of retained users.

    One pass, no join. Retained users are counted per (cohort, buckets,
    lifetime day); every cohort user listens on lifetime day 0, so that row
    is the cohort size and its averages are the first-day averages. A window
    over each cohort group (at most horizon + 1 rows) hands every row the
    cohort values and the next lifetime day present; each row then emits
    itself plus zero rows for the missing days up to that next day (the last
    one up to the horizon)."""
    base = user_day_base(stage) if base is None else base
    rows = _bucketed(with_cohort(base)).where(F.col("cohort_day").isNotNull())
    per_day = rows.where((F.col("listens") > 0) & (F.col("day_idx") >= F.col("cohort_day"))) \
        .groupBy(*_BUCKETS, (F.col("day_idx") - F.col("cohort_day")).alias("lifetime_day")).agg(
            cnt().alias("retained_users"),
            F.avg("first_day_listens").alias("avg_first_day_listens"),
            F.avg("first_day_sessions").alias("avg_first_day_sessions"),
            F.avg("first_day_listen_plus_rate").alias("avg_first_day_listen_plus_rate"),
        )
    group = Window.partitionBy(*_BUCKETS)
    day_zero = F.col("lifetime_day") == 0

    def at_day_zero(c: str):
        return F.max(F.when(day_zero, F.col(c))).over(group)

    next_day = F.lead("lifetime_day").over(group.orderBy("lifetime_day"))
    spans = per_day.select(
        *_BUCKETS, F.col("lifetime_day").alias("_present"), F.col("retained_users").alias("_retained"),
        at_day_zero("retained_users").alias("cohort_users"),
        at_day_zero("avg_first_day_listens").alias("avg_first_day_listens"),
        at_day_zero("avg_first_day_sessions").alias("avg_first_day_sessions"),
        at_day_zero("avg_first_day_listen_plus_rate").alias("avg_first_day_listen_plus_rate"),
        F.coalesce(next_day - 1, horizon(base) - F.col("cohort_day")).alias("_until"),
    )
    filled = spans.withColumn("lifetime_day", F.explode(F.sequence(F.col("_present"), F.col("_until"))))
    retained = F.when(F.col("lifetime_day") == F.col("_present"), F.col("_retained")) \
        .otherwise(F.lit(0).cast("bigint"))
    return filled.select(
        "cohort_day", "lifetime_day", "recommendation_bucket", "engagement_bucket",
        "cohort_users", retained.alias("retained_users"),
        ratio(retained, "cohort_users").alias("retention_rate"),
        "avg_first_day_listens", "avg_first_day_sessions", "avg_first_day_listen_plus_rate",
    )
