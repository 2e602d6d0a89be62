"""Recommendation funnel: four nested steps, events and distinct users."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlab.functions.measures import count_if, ratio
from listenlab.operators.base import user_day_base

# Step codes in funnel order.
FUNNEL_STEPS = ("all_listens", "recommendation_listens", "recommendation_listen_plus",
                "recommendation_replays")


def funnel_totals(stage: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """One row: events and users of each step. Users per step come from one
    per-user rollup of the base (no DISTINCT expansion over events)."""
    base = user_day_base(stage) if base is None else base
    per_user = base.groupBy("uid").agg(
        F.sum("listens").alias("l"),
        F.sum("recommendation_listens").alias("r"),
        F.sum("recommendation_listen_plus").alias("rlp"),
        F.sum("recommendation_replays").alias("rrp"),
    )
    return per_user.agg(
        F.coalesce(F.sum("l"), F.lit(0)).cast("bigint").alias("all_listens"),
        count_if(F.col("l") > 0).alias("all_listeners"),
        F.coalesce(F.sum("r"), F.lit(0)).cast("bigint").alias("recommendation_listens"),
        count_if(F.col("r") > 0).alias("recommendation_listeners"),
        F.coalesce(F.sum("rlp"), F.lit(0)).cast("bigint").alias("recommendation_listen_plus"),
        count_if(F.col("rlp") > 0).alias("recommendation_listen_plus_users"),
        F.coalesce(F.sum("rrp"), F.lit(0)).cast("bigint").alias("recommendation_replays"),
        count_if(F.col("rrp") > 0).alias("recommendation_replay_users"),
    )


def recommendation_funnel(stage: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """``mart_recommendation_funnel``: wide totals -> 4 rows in one pass,
    then rates from the start and from the previous step. The windows run
    over the four step rows only."""
    totals = funnel_totals(stage, base)
    steps = totals.selectExpr(
        "stack(4, "
        "1, 'all_listens', all_listens, all_listeners, "
        "2, 'recommendation_listens', recommendation_listens, recommendation_listeners, "
        "3, 'recommendation_listen_plus', recommendation_listen_plus, recommendation_listen_plus_users, "
        "4, 'recommendation_replays', recommendation_replays, recommendation_replay_users"
        ") AS (step_order, step, events, users)"
    )
    w = Window.orderBy("step_order")
    return steps.select(
        "step_order", "step", "events", "users",
        ratio("events", F.first("events").over(w)).alias("event_rate_from_start"),
        ratio("users", F.first("users").over(w)).alias("user_rate_from_start"),
        ratio("events", F.lag("events").over(w)).alias("event_rate_from_previous"),
        ratio("users", F.lag("users").over(w)).alias("user_rate_from_previous"),
    )
