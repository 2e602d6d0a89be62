"""Reconciliation checks pass on correct marts and fail on corrupted ones."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from listenlab.operators import checks
from listenlab.plans.registry import Marts


@pytest.fixture(scope="module")
def marts(spark):
    m = Marts(spark, SF001, materialized=True)
    return {
        "stage": m.stage, "base": m.base, "product": m.product.cache(), "user": m.user.cache(),
        "user_day": m.user_day.cache(), "retention": m.retention.cache(), "track": m.track.cache(),
        "funnel": m.funnel.cache(),
    }


def _run(marts, **override):
    m = {**marts, **override}
    rows = checks.mart_checks(m["stage"], m["product"], m["user"], m["user_day"], m["retention"],
                              m["track"], m["funnel"], m["base"]).collect()
    return {r.name: r.ok for r in rows}


def test_all_checks_pass(marts):
    res = _run(marts)
    assert len(res) == 11 and all(res.values()), res


@pytest.mark.parametrize("mart,corrupt,failing", [
    ("product", lambda d: d.withColumn("events", F.col("events") + F.when(F.col("day_idx") == 0, 1).otherwise(0)),
     "product_events_match_source"),
    ("product", lambda d: d.withColumn("listens", F.col("listens") + 1), "product_listens_match_source"),
    ("product", lambda d: d.withColumn("listener_like_rate", F.lit(1.5)), "product_reaction_rates_are_valid"),
    ("product", lambda d: d.withColumn("listener_likers", F.col("listener_likers") + 1),
     "product_reactions_match_user_day"),
    ("user", lambda d: d.unionByName(d.limit(1)), "user_key_is_unique"),
    ("user_day", lambda d: d.withColumn("listens", F.col("listens") * 2), "user_day_listens_match_source"),
    ("user_day", lambda d: d.unionByName(d.limit(1)), "user_day_key_is_unique"),
    ("retention", lambda d: d.withColumn("retention_rate", F.col("retention_rate") * 0.5),
     "retention_rates_are_valid"),
    ("retention", lambda d: d.unionByName(d.limit(1)), "retention_key_is_unique"),
    ("track", lambda d: d.where("item_id <> 0"), "track_key_is_unique"),
    ("funnel", lambda d: d.withColumn("events", F.when(F.col("step_order") == 4, F.lit(10 ** 9))
                                      .otherwise(F.col("events"))), "funnel_is_valid"),
])
def test_corrupted_mart_fails_its_check(marts, mart, corrupt, failing):
    res = _run(marts, **{mart: corrupt(marts[mart])})
    assert res[failing] is False, res


def test_raise_on_failure(marts, spark):
    bad = _run(marts, user=marts["user"].unionByName(marts["user"].limit(1)))
    assert bad["user_key_is_unique"] is False
    df = spark.createDataFrame([("a", True), ("b", False)], "name string, ok boolean")
    with pytest.raises(RuntimeError):
        checks.raise_on_failure(df)


def test_distinct_tuples_keep_null_parts(spark):
    # T10: (1, NULL) and (1, NULL) are one tuple; (1, NULL) and (1, 2) are two
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    n = df.agg(F.count_distinct(F.struct("a", "b"))).first()[0]
    assert n == 2
