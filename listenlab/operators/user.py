"""User mart and user-day mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlab.functions.measures import cnt, ratio
from listenlab.operators.base import user_day_base, user_day_tracks

USER_COLUMNS = (
    "uid", "first_day", "last_day", "active_days", "events", "listens", "unique_tracks",
    "listen_plus", "recommendation_listens", "replays", "likes", "dislikes", "unlikes",
    "undislikes", "play_seconds", "sessions", "listen_plus_rate", "recommendation_share",
    "replay_rate", "minutes_per_session",
)
USER_DAY_COLUMNS = (
    "uid", "day_idx", "events", "listens", "unique_tracks", "recommendation_listens",
    "organic_listens", "listen_plus", "replays", "likes", "dislikes", "play_seconds",
    "sessions", "recommendation_share", "listen_plus_rate", "play_minutes",
)


def user_day(stage: DataFrame, base: DataFrame | None = None, tracks: DataFrame | None = None) -> DataFrame:
    """``mart_user_day``: one row per (uid, day_idx)."""
    base = user_day_base(stage) if base is None else base
    tracks = user_day_tracks(stage) if tracks is None else tracks
    unique = tracks.groupBy("uid", "day_idx").agg(cnt().alias("unique_tracks"))
    joined = base.join(unique, ["uid", "day_idx"], "left")
    return joined.select(
        "uid", "day_idx", "events", "listens",
        F.coalesce("unique_tracks", F.lit(0).cast("bigint")).alias("unique_tracks"),
        "recommendation_listens", "organic_listens", "listen_plus", "replays", "likes",
        "dislikes", "play_seconds", "sessions",
        ratio("recommendation_listens", "listens").alias("recommendation_share"),
        ratio("listen_plus", "listens").alias("listen_plus_rate"),
        (F.col("play_seconds") / 60.0).alias("play_minutes"),
    )


def user_mart(stage: DataFrame, base: DataFrame | None = None, tracks: DataFrame | None = None) -> DataFrame:
    """``mart_user``: one row per uid over the whole period. A user's base
    rows are its active days, so ``active_days`` is a row count."""
    base = user_day_base(stage) if base is None else base
    per_user = base.groupBy("uid").agg(
        F.min("day_idx").alias("first_day"),
        F.max("day_idx").alias("last_day"),
        cnt().alias("active_days"),
        *[F.sum(c).alias(c) for c in (
            "events", "listens", "listen_plus", "recommendation_listens", "replays", "likes",
            "dislikes", "unlikes", "undislikes", "sessions")],
        F.sum("play_seconds").alias("play_seconds"),
    )
    tracks = user_day_tracks(stage) if tracks is None else tracks
    unique = tracks.groupBy("uid").agg(F.count_distinct("item_id").alias("unique_tracks"))
    joined = per_user.join(unique, "uid", "left")
    return joined.select(
        "uid", "first_day", "last_day", "active_days", "events", "listens",
        F.coalesce("unique_tracks", F.lit(0).cast("bigint")).alias("unique_tracks"),
        "listen_plus", "recommendation_listens", "replays", "likes", "dislikes", "unlikes",
        "undislikes", "play_seconds", "sessions",
        ratio("listen_plus", "listens").alias("listen_plus_rate"),
        ratio("recommendation_listens", "listens").alias("recommendation_share"),
        ratio("replays", "listens").alias("replay_rate"),
        (F.try_divide(F.col("play_seconds"), F.col("sessions").cast("double")) / 60.0)
        .alias("minutes_per_session"),
    )
