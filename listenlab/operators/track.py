"""Track mart: one row per item_id.

Two-level aggregation: events are first rolled up to (item_id, uid), which
both shrinks the data before the shuffle and turns ``listeners`` into a row
count; a heavy track is spread over its users and a heavy (track, user)
pair collapses in the map-side partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlab.functions.measures import count_if, ratio, sum_if
from listenlab.operators.base import additive_measures
from listenlab.settings import DEFAULT, Settings

TRACK_COLUMNS = (
    "item_id", "first_day", "last_day", "events", "listens", "listeners", "listen_plus",
    "recommendation_listens", "organic_listens", "recommendation_listen_plus",
    "organic_listen_plus", "replays", "likes", "dislikes", "avg_played_ratio",
    "track_length_seconds", "listen_plus_rate", "recommendation_share",
    "recommendation_listen_plus_rate", "organic_listen_plus_rate", "replay_rate",
    "likes_per_1000_listens", "dislikes_per_1000_listens", "is_reliable_sample",
)

_SUMMED = ("events", "listens", "listen_plus", "recommendation_listens", "organic_listens",
           "recommendation_listen_plus", "organic_listen_plus", "replays", "likes", "dislikes")


def track_mart(stage: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    listen = F.col("is_listen")
    pair = stage.groupBy("item_id", "uid").agg(
        F.min("day_idx").alias("first_day"),
        F.max("day_idx").alias("last_day"),
        *additive_measures(_SUMMED),
        sum_if(listen, "played_ratio_pct").alias("ratio_sum"),
        F.count(F.when(listen, F.col("played_ratio_pct"))).alias("ratio_n"),
        # any non-NULL length among listens; min makes the choice deterministic
        F.min(F.when(listen, F.col("track_length_seconds"))).alias("track_length_seconds"),
    )
    t = pair.groupBy("item_id").agg(
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        *[F.sum(c).alias(c) for c in _SUMMED],
        count_if(F.col("listens") > 0).alias("listeners"),
        F.sum("ratio_sum").alias("ratio_sum"),
        F.sum("ratio_n").alias("ratio_n"),
        F.min("track_length_seconds").alias("track_length_seconds"),
    )
    return t.select(
        "item_id", "first_day", "last_day", "events", "listens", "listeners", "listen_plus",
        "recommendation_listens", "organic_listens", "recommendation_listen_plus",
        "organic_listen_plus", "replays", "likes", "dislikes",
        F.try_divide(F.col("ratio_sum").cast("double"), F.col("ratio_n").cast("double")).alias("avg_played_ratio"),
        "track_length_seconds",
        ratio("listen_plus", "listens").alias("listen_plus_rate"),
        ratio("recommendation_listens", "listens").alias("recommendation_share"),
        ratio("recommendation_listen_plus", "recommendation_listens").alias("recommendation_listen_plus_rate"),
        ratio("organic_listen_plus", "organic_listens").alias("organic_listen_plus_rate"),
        ratio("replays", "listens").alias("replay_rate"),
        ratio("likes", "listens", 1000.0).alias("likes_per_1000_listens"),
        ratio("dislikes", "listens", 1000.0).alias("dislikes_per_1000_listens"),
        (F.col("listens") >= settings.track_min_listens).alias("is_reliable_sample"),
    )
