"""The user-day base: the stage aggregated once to (uid, day_idx).

Every additive measure is kept here, so the product, user, funnel and
retention marts read this small table instead of the event-grain stage:
each distinct-user count of the product day becomes a plain row count
(one base row = one user on one day), and the first-day metrics of
retention are a lookup of the cohort-day row instead of a stage self-join.
``listen_plus_known`` counts listens with a known Listen+ flag: rates that
average the flag (NULL skipped) and rates that count it over all listens
differ exactly by this denominator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlab.functions.measures import cnt, count_if


ADDITIVE = (
    "events", "listens", "listen_plus", "listen_plus_known", "recommendation_listens",
    "organic_listens", "recommendation_listen_plus", "organic_listen_plus", "replays",
    "recommendation_replays", "organic_replays", "likes", "dislikes", "unlikes",
    "undislikes", "sessions",
)


def measure_map() -> dict:
    """Row-level conditional counts shared by every grain, by name."""
    etype = F.col("event_type")
    _LISTEN, _LP, _REPLAY = F.col("is_listen"), F.col("is_listen_plus"), F.col("is_replay")
    _REC = F.col("is_recommendation_listen")
    _ORG = _LISTEN & (F.col("is_organic") == 1)
    return {
        "events": cnt(),
        "listens": count_if(_LISTEN),
        "listen_plus": count_if(_LP),
        "listen_plus_known": F.count(F.when(_LISTEN, _LP)),
        "recommendation_listens": count_if(_REC),
        "organic_listens": count_if(_ORG),
        "recommendation_listen_plus": count_if(_REC & _LP),
        "organic_listen_plus": count_if(_ORG & _LP),
        "replays": count_if(_REPLAY),
        "recommendation_replays": count_if(_REC & _REPLAY),
        "organic_replays": count_if(_ORG & _REPLAY),
        "likes": count_if(etype == "like"),
        "dislikes": count_if(etype == "dislike"),
        "unlikes": count_if(etype == "unlike"),
        "undislikes": count_if(etype == "undislike"),
        "sessions": count_if(F.col("is_session_start")),
        "play_seconds": F.sum("play_seconds"),
    }


def additive_measures(names=None) -> list:
    """Aliased measure columns (all, or the given names)."""
    m = measure_map()
    return [m[n].alias(n) for n in (names or m)]


def user_day_tracks(stage: DataFrame) -> DataFrame:
    """The distinct (uid, day_idx, item_id) of listens: unique tracks per day,
    per user and per user-day all count its rows."""
    return stage.where("is_listen").select("uid", "day_idx", "item_id").distinct()


def user_day_base(stage: DataFrame) -> DataFrame:
    """One row per (uid, day_idx) with all additive measures."""
    return stage.groupBy("uid", "day_idx").agg(*additive_measures())

