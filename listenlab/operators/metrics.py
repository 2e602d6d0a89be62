"""What is known of a mart from its own write: totals, and whether its key is
unique, collected by ``observe`` while the rows pass on to the files.

A mart is written in the order of its key, so rows that share a key are
neighbours: a row number over the key, in the partitioning and order that the
write needs anyway, counts the excess ones without another shuffle. The same
measures can be taken of any table of the mart's shape (``measured``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlab.functions.measures import cnt, count_if
from listenlab.operators.summary import MART_KEYS

#: Helper columns of the write, not of the mart.
_EXCESS, _FIRST = "_excess", "_first_of_uid"


def _not_between(c: str) -> Column:
    return ~F.col(c).between(0, 1)


def _step(k: int) -> Column:
    return F.max(F.when(F.col("step_order") == k, F.col("events")))


#: Measures of each mart, NULL as the checks treat it.
MEASURES: dict[str, Callable[[], dict[str, Column]]] = {
    "mart_product_day": lambda: {
        "events": F.sum("events"), "listens": F.sum("listens"),
        "bad_rates": count_if(_not_between("listener_like_rate") | _not_between("listener_dislike_rate")),
        "bad_counts": count_if((F.col("listener_likers") > F.col("listeners")) | (F.col("listener_dislikers") > F.col("listeners"))),
        "likers": F.sum("listener_likers"), "dislikers": F.sum("listener_dislikers")},
    "mart_recommendation_funnel": lambda: {f"step_{k}": _step(k) for k in (1, 2, 3, 4)},
    "mart_user": lambda: {"sessions": F.sum("sessions")},
    "mart_user_day": lambda: {
        "listens": F.sum("listens"),
        "likers": count_if((F.col("listens") > 0) & (F.col("likes") > 0)),
        "dislikers": count_if((F.col("listens") > 0) & (F.col("dislikes") > 0))},
    "mart_retention_cohort": lambda: {
        "bad": count_if(_not_between("retention_rate")),
        "bad_d0": count_if((F.col("lifetime_day") == 0) & (F.col("retention_rate") != 1))},
    "mart_track": lambda: {},
}


def in_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` in the order of its key over all partitions, so over all files
    of a write, with the marks of rows that repeat a key. A user's days meet
    in one partition (a row per day at most), other keys are dealt whole."""
    dealt = keys[:1] if keys[0] == "uid" else keys
    ordered = df.repartitionByRange(*dealt).sortWithinPartitions(*keys)
    of_key = Window.partitionBy(*keys).orderBy(*keys)
    marked = ordered.withColumn(_EXCESS, F.row_number().over(of_key) > 1)
    if keys[0] == "uid" and len(keys) > 1:
        marked = marked.withColumn(_FIRST, F.row_number().over(Window.partitionBy("uid").orderBy(*keys[1:])) == 1)
    return marked


def observed(marked: DataFrame, mart: str) -> dict[str, Column]:
    """The measures of a mart for ``observe`` over ``in_order``'s rows."""
    users = {"users": count_if(_FIRST)} if _FIRST in marked.columns else {}
    return {"rows": cnt(), "excess": count_if(_EXCESS), **users, **MEASURES[mart]()}


def plain(marked: DataFrame) -> DataFrame:
    """The mart's own columns."""
    return marked.drop(_EXCESS, _FIRST)


def measured(df: DataFrame, mart: str) -> DataFrame:
    """The same measures of a table as it is, in one row, by a scan."""
    keys = MART_KEYS[mart]
    users = {"users": F.count_distinct("uid")} if mart == "mart_user_day" else {}
    measures = {"rows": cnt(), "excess": cnt() - F.count_distinct(F.struct(*keys)), **users, **MEASURES[mart]()}
    return df.agg(*[m.alias(name) for name, m in measures.items()])


def file_order(mart: DataFrame, keys: list[str]) -> DataFrame:
    """One row about the files of a written mart: its rows, whether every
    file ascends strictly by key, and whether the files, by name, hold
    ascending key ranges that don't overlap."""
    key = F.struct(*keys)
    placed = mart.select(key.alias("key"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    per_file = placed.withColumn("ascends", F.coalesce(before < F.col("key"), F.lit(True))).groupBy("file").agg(
        cnt().alias("rows"), F.bool_and("ascends").alias("ascends"), F.min("key").alias("first"), F.max("key").alias("last"))
    # one row per file
    apart = F.coalesce(F.lag("last").over(Window.orderBy("file")) < F.col("first"), F.lit(True))
    return per_file.withColumn("apart", apart).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.bool_and("ascends"), F.lit(True)).alias("files_ascend"),
        F.coalesce(F.bool_and("apart"), F.lit(True)).alias("ranges_ascend"))


def checks_of(stage: dict, marts: dict[str, dict]) -> dict[str, bool]:
    """The eleven checks between the stage's totals (events, listens, users,
    items) and the measures of the marts."""
    product, funnel, user = (marts[f"mart_{m}"] for m in ("product_day", "recommendation_funnel", "user"))
    user_day, retention, track = (marts[f"mart_{m}"] for m in ("user_day", "retention_cohort", "track"))
    steps = [funnel[f"step_{k}"] for k in (1, 2, 3, 4)]
    falling = all(a is None or (b is not None and b <= a) for a, b in zip(steps, steps[1:]))
    return {
        "product_events_match_source": product["events"] == stage["events"],
        "product_listens_match_source": product["listens"] == stage["listens"],
        "product_reaction_rates_are_valid": product["bad_rates"] == 0 and product["bad_counts"] == 0,
        "product_reactions_match_user_day": product["likers"] == user_day["likers"] and product["dislikers"] == user_day["dislikers"],
        "user_key_is_unique": user["excess"] == 0 and user["rows"] == stage["users"],
        "user_day_key_is_unique": user_day["excess"] == 0,
        "user_day_listens_match_source": user_day["listens"] == stage["listens"],
        "retention_key_is_unique": retention["excess"] == 0,
        "retention_rates_are_valid": retention["bad"] == 0 and retention["bad_d0"] == 0,
        "track_key_is_unique": track["excess"] == 0 and track["rows"] == stage["items"],
        "funnel_is_valid": funnel["rows"] == 4 and steps[0] == stage["listens"] and falling,
    }
