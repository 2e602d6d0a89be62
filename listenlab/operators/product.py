"""Daily product mart and its two sub-steps (user-day flags, reactions)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlab.functions.measures import cnt, count_if, ratio
from listenlab.operators.base import user_day_base, user_day_tracks

PRODUCT_COLUMNS = (
    "day_idx", "observation_day", "active_users", "events", "listens", "listeners",
    "unique_tracks", "listen_plus", "recommendation_listens", "organic_listens",
    "recommendation_listeners", "organic_listeners", "recommendation_listen_plus",
    "organic_listen_plus", "replays", "recommendation_replays", "organic_replays", "likes",
    "dislikes", "play_seconds", "sessions", "listen_plus_rate", "replay_rate",
    "recommendation_share", "recommendation_listen_plus_rate", "organic_listen_plus_rate",
    "recommendation_replay_rate", "organic_replay_rate", "likes_per_1000_listens",
    "dislikes_per_1000_listens", "minutes_per_active_user", "listener_likers",
    "listener_dislikers", "listener_like_rate", "listener_dislike_rate",
)


def day_user_flags(base: DataFrame) -> DataFrame:
    """Per (day_idx, uid): has a listen / a like / a dislike that day."""
    return base.select(
        "day_idx", "uid",
        (F.col("listens") > 0).alias("has_listen"),
        (F.col("likes") > 0).alias("has_like"),
        (F.col("dislikes") > 0).alias("has_dislike"),
    )


def day_reactions(flags: DataFrame) -> DataFrame:
    """Per day: users with a listen and a like (dislike) that day, any track."""
    return flags.groupBy("day_idx").agg(
        count_if(F.col("has_listen") & F.col("has_like")).alias("listener_likers"),
        count_if(F.col("has_listen") & F.col("has_dislike")).alias("listener_dislikers"),
    )


def day_unique_tracks(tracks: DataFrame) -> DataFrame:
    """Distinct listened tracks per day (the one distinct not on the user)."""
    return tracks.groupBy("day_idx").agg(F.count_distinct("item_id").alias("unique_tracks"))


def product_day(stage: DataFrame, base: DataFrame | None = None, tracks: DataFrame | None = None) -> DataFrame:
    """``mart_product_day``: one row per day (see module docs of base)."""
    base = user_day_base(stage) if base is None else base
    tracks = user_day_tracks(stage) if tracks is None else tracks
    has_listen = F.col("listens") > 0
    day = base.groupBy("day_idx").agg(
        cnt().alias("active_users"),
        F.sum("events").alias("events"),
        F.sum("listens").alias("listens"),
        count_if(has_listen).alias("listeners"),
        F.sum("listen_plus").alias("listen_plus"),
        F.sum("recommendation_listens").alias("recommendation_listens"),
        F.sum("organic_listens").alias("organic_listens"),
        count_if(F.col("recommendation_listens") > 0).alias("recommendation_listeners"),
        count_if(F.col("organic_listens") > 0).alias("organic_listeners"),
        F.sum("recommendation_listen_plus").alias("recommendation_listen_plus"),
        F.sum("organic_listen_plus").alias("organic_listen_plus"),
        F.sum("replays").alias("replays"),
        F.sum("recommendation_replays").alias("recommendation_replays"),
        F.sum("organic_replays").alias("organic_replays"),
        F.sum("likes").alias("likes"),
        F.sum("dislikes").alias("dislikes"),
        F.sum("play_seconds").alias("play_seconds"),
        F.sum("sessions").alias("sessions"),
        count_if(has_listen & (F.col("likes") > 0)).alias("listener_likers"),
        count_if(has_listen & (F.col("dislikes") > 0)).alias("listener_dislikers"),
    )
    # Both sides are day-grain (bounded by the time span); left join keeps
    # days without listens (unique_tracks = 0 there).
    joined = day.join(day_unique_tracks(tracks), "day_idx", "left")
    c = F.col
    return joined.select(
        "day_idx",
        (c("day_idx") + 1).alias("observation_day"),
        "active_users", "events", "listens", "listeners",
        F.coalesce(c("unique_tracks"), F.lit(0).cast("bigint")).alias("unique_tracks"),
        "listen_plus", "recommendation_listens", "organic_listens",
        "recommendation_listeners", "organic_listeners", "recommendation_listen_plus",
        "organic_listen_plus", "replays", "recommendation_replays", "organic_replays",
        "likes", "dislikes", "play_seconds", "sessions",
        ratio("listen_plus", "listens").alias("listen_plus_rate"),
        ratio("replays", "listens").alias("replay_rate"),
        ratio("recommendation_listens", "listens").alias("recommendation_share"),
        ratio("recommendation_listen_plus", "recommendation_listens").alias("recommendation_listen_plus_rate"),
        ratio("organic_listen_plus", "organic_listens").alias("organic_listen_plus_rate"),
        ratio("recommendation_replays", "recommendation_listens").alias("recommendation_replay_rate"),
        ratio("organic_replays", "organic_listens").alias("organic_replay_rate"),
        ratio("likes", "listens", 1000.0).alias("likes_per_1000_listens"),
        ratio("dislikes", "listens", 1000.0).alias("dislikes_per_1000_listens"),
        (F.try_divide(c("play_seconds"), c("active_users").cast("double")) / 60.0).alias("minutes_per_active_user"),
        "listener_likers", "listener_dislikers",
        ratio("listener_likers", "listeners").alias("listener_like_rate"),
        ratio("listener_dislikers", "listeners").alias("listener_dislike_rate"),
    )
