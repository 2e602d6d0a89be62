"""Mart semantics on hand-written micro fixtures (traps T2, T4, T9, T14-T22)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import interactions, listen, react
from listenlab.functions.labels import quality_segment
from listenlab.functions.measures import frame_round, sql_round
from listenlab.functions.quantiles import bracket_measures, column_quantiles, quantiles
from listenlab.operators import exports, funnel, product, reports, retention, stage as st, track, user
from listenlab.operators.base import user_day_base
from listenlab.settings import DEFAULT

DAY = 86_400


def _stage(spark, rows):
    return st.stage_events(interactions(spark, rows))


def test_listen_plus_rates_treat_null_flags_differently(spark):
    # T4: a NULL-ratio listen counts in listen_plus_rate's denominator but not
    # in the first-day flag average
    rows = [listen(1, 1, 0, ratio=80.0), listen(1, 2, 10, ratio=None), listen(1, 3, 20, ratio=10.0)]
    s = _stage(spark, rows)
    u = user.user_mart(s).first()
    assert u.listen_plus == 1 and abs(u.listen_plus_rate - 1 / 3) < 1e-12
    m = retention.cohort_first_day_metrics(user_day_base(s)).first()
    assert abs(m.first_day_listen_plus_rate - 0.5) < 1e-12


def test_reaction_only_user_and_track(spark):
    rows = [listen(1, 1, 0), react(2, 9, 10, "like"), react(2, 9, 20, "unlike"), react(1, 1, 30, "like")]
    s = _stage(spark, rows)
    u = {r.uid: r for r in user.user_mart(s).collect()}
    assert u[2].listens == 0 and u[2].listen_plus_rate is None and u[2].unique_tracks == 0
    assert (u[2].likes, u[2].unlikes) == (1, 1)                      # T14
    assert u[2].minutes_per_session is None                           # no play time at all
    t = {r.item_id: r for r in track.track_mart(s).collect()}
    assert t[9].listens == 0 and t[9].listeners == 0 and t[9].listen_plus_rate is None
    assert t[9].track_length_seconds is None and t[9].is_reliable_sample is False
    cohorts = {r.uid for r in retention.cohort_first_days(user_day_base(s)).collect()}
    assert cohorts == {1}                                             # T15: listeners only


def test_product_day_counts_users_not_events(spark):
    rows = [listen(1, 1, 0), listen(1, 2, 10), react(1, 5, 20, "like"), listen(2, 1, 30),
            react(3, 1, 40, "dislike"), listen(1, 1, DAY)]
    p = {r.day_idx: r for r in product.product_day(_stage(spark, rows)).collect()}
    d0 = p[0]
    assert (d0.active_users, d0.listeners, d0.unique_tracks, d0.listens, d0.events) == (3, 2, 2, 3, 5)
    assert (d0.listener_likers, d0.listener_dislikers) == (1, 0)     # user 3 has no listen
    assert abs(d0.listener_like_rate - 0.5) < 1e-12
    assert p[1].observation_day == 2 and p[1].likes_per_1000_listens == 0.0


def test_day_without_listens_has_null_rates(spark):
    p = product.product_day(_stage(spark, [react(1, 1, 0)])).first()
    assert p.listens == 0 and p.unique_tracks == 0 and p.listen_plus_rate is None
    assert p.listener_like_rate is None


def test_funnel_without_listens_does_not_divide_by_zero(spark):
    f = funnel.recommendation_funnel(_stage(spark, [react(1, 1, 0)])).orderBy("step_order").collect()
    assert [r.events for r in f] == [0, 0, 0, 0]
    assert all(r.event_rate_from_start is None for r in f)


def test_funnel_steps_nest(spark):
    rows = [listen(1, 1, 0, organic=0, ratio=120.0), listen(1, 2, 10, organic=0, ratio=20.0),
            listen(2, 1, 20, organic=1), listen(3, 1, 30, organic=0, ratio=70.0)]
    f = [(r.events, r.users) for r in funnel.recommendation_funnel(_stage(spark, rows)).orderBy("step_order")
         .collect()]
    assert f == [(4, 3), (3, 2), (2, 2), (1, 1)]


def test_share_and_engagement_buckets(spark):
    # T19: shares 0, .25, .5, .75, .99..., 1 and listens 10, 12, 30, 31, 61, 4
    def user_rows(uid, n, rec):
        return [listen(uid, i, i * 10, organic=0 if i < rec else 1) for i in range(n)]
    rows = (user_rows(1, 10, 0) + user_rows(2, 12, 3) + user_rows(3, 30, 15) + user_rows(4, 32, 24)
            + user_rows(5, 61, 60) + user_rows(6, 4, 4))
    b = {r.uid: (r.recommendation_bucket, r.engagement_bucket)
         for r in retention.cohort_buckets(user_day_base(_stage(spark, rows))).collect()}
    assert b == {1: ("0%", "1-10"), 2: ("1-25%", "11-30"), 3: ("25-50%", "11-30"), 4: ("50-75%", "31-60"),
                 5: ("75-99%", "61+"), 6: ("100%", "1-10")}


def test_retention_grid_gaps_and_horizon(spark):
    # T16-T18: listens on D0 and D2, a reaction on D1 and a reaction-only D4;
    # second user's cohort is the last day (T9): one grid row
    rows = [listen(1, 1, 0), react(1, 1, 4000, "like"), react(1, 1, DAY + 10), listen(1, 1, 2 * DAY),
            react(1, 1, 4 * DAY), listen(2, 1, 4 * DAY + 50)]
    r = retention.retention_cohort(_stage(spark, rows))
    got = {(x.cohort_day, x.lifetime_day): (x.cohort_users, x.retained_users, x.retention_rate)
           for x in r.collect()}
    assert got == {(0, 0): (1, 1, 1.0), (0, 1): (1, 0, 0.0), (0, 2): (1, 1, 1.0), (0, 3): (1, 0, 0.0),
                   (0, 4): (1, 0, 0.0), (4, 0): (1, 1, 1.0)}
    first = retention.cohort_first_day_metrics(user_day_base(_stage(spark, rows))) \
        .where("uid = 1").first()
    # the D0 reaction 4000 s later starts its own session: sessions of all events
    assert (first.first_day_listens, first.first_day_sessions) == (1, 2)


def test_track_length_buckets(spark):
    lengths = [119, 120, 179, 180, 239, 240, 299, 300, None]
    df = spark.createDataFrame([(float(x) if x is not None else None,) for x in lengths], "s double")
    from listenlab.functions.labels import track_length_bucket

    got = [r[0] for r in df.select(track_length_bucket(F.col("s"))).collect()]
    assert got == ["до 2 мин", "2–3 мин", "2–3 мин", "3–4 мин", "3–4 мин", "4–5 мин", "4–5 мин", "5+ мин", None]


def test_segment_priority_on_degenerate_quartiles(spark):
    # T21: equal Listen+ rates make q25 == q75; a low-dislike track is "high"
    # under the report order and "needs attention" in the extract
    df = spark.createDataFrame([(0.5, 1.0), (0.5, 5.0), (0.5, 9.0), (None, 1.0)], "r double, d double")
    q = df.agg(F.percentile("r", 0.25).alias("q25"), F.percentile("r", 0.75).alias("q75"),
               F.percentile("d", 0.75).alias("d75")).first()
    seg = lambda wins: [x[0] for x in df.select(quality_segment(
        F.col("r"), F.col("d"), F.lit(q.q25), F.lit(q.q75), F.lit(q.d75), wins)).collect()]
    # the NULL rate with low dislikes compares false on both rules: stable
    assert seg(False) == ["высокое качество", "высокое качество", "требует внимания", "стабильные"]
    assert seg(True) == ["требует внимания", "требует внимания", "требует внимания", "стабильные"]
    nulls = spark.createDataFrame([(None, None)], "r double, d double")
    assert nulls.select(quality_segment(F.col("r"), F.col("d"), F.lit(0.4), F.lit(0.6), F.lit(3.0))) \
        .first()[0] == "стабильные"                                   # T22


def test_track_extract_keeps_reliable_only(spark):
    rows = [listen(1, 1, i * 10) for i in range(5)] + [listen(1, 2, 100)]
    t = track.track_mart(_stage(spark, rows), DEFAULT.with_(track_min_listens=3))
    out = exports.export_track_quality(t).collect()
    assert [r.item_id for r in out] == [1]
    assert out[0].activity_span_days == 1 and out[0].track_length_bucket == "3–4 мин"


def test_reports_round_like_their_origin(spark):
    values = [0.125, 0.375, 2.675, 1.005, -0.125, 2.5, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", sql_round("v", 2).alias("s"), frame_round("v", 2).alias("f"), sql_round("v", 0).alias("s0"),
                     frame_round("v", 0).alias("f0")).collect()
    got = {r.v: r for r in rows}
    assert (got[0.125].s, got[0.125].f, got[0.375].f) == (0.13, 0.12, 0.38)   # T7
    assert (got[-0.125].s, got[2.5].s0, got[2.5].f0) == (-0.13, 3.0, 2.0)
    for v in values[:-1]:
        assert got[v].f == float(np.round(v, 2))
    assert got[None].s is None and got[None].f is None


def test_sums_and_means_are_plain(spark):
    # thirds, values far below ten decimals, and NaN reach the marts as they are
    thirds = [listen(1, 1, i * 10, ratio=100 / 3, length=1.0) for i in range(3)]
    u = user.user_mart(_stage(spark, thirds)).first()
    assert u.play_seconds == pytest.approx(1.0, abs=1e-15)
    tiny = [listen(1, 1, 0, ratio=1e-9, length=1e-9), listen(1, 2, 10, ratio=float("nan"))]
    got = {r.item_id: r.avg_played_ratio for r in track.track_mart(_stage(spark, tiny), DEFAULT).collect()}
    assert got[1] == 1e-9 and got[2] != got[2]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 997])
def test_quantiles_are_exact(spark, n):
    rng = np.random.default_rng(n)
    values = rng.choice([0.0, 0.25, 1.0, *rng.random(5), *rng.random(max(n // 2, 1))], n)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(3)
    one = spark.range(1).select(quantiles(df, "v", a=0.25, b=0.5, c=0.75, d=0.0, e=1.0).alias("q")).first().q
    for got, share in zip(one, (0.25, 0.5, 0.75, 0, 1)):
        assert got == pytest.approx(float(np.quantile(values, share)), abs=1e-12)
    assert spark.range(1).select(quantiles(df.where("v > 9"), "v", a=0.5).alias("q")).first().q.a is None


def test_quantiles_of_many_columns_with_and_without_brackets(spark):
    n, shares = 60_000, {"a25": ("a", 0.25), "b99": ("b", 0.99), "c50": ("c", 0.5), "a0": ("a", 0.0), "d75": ("d", 0.75), "e10": ("e", 0.1)}
    rng = np.random.default_rng(3)
    values = {"a": rng.random(n), "b": rng.zipf(1.3, n).astype(float), "c": np.where(rng.random(n) < 0.6, 7.0, rng.random(n)),
              "d": np.full(n, np.nan), "e": rng.integers(0, 3, n).astype(float)}
    values["d"][:40] = np.arange(40)
    rows = [tuple(None if x != x else float(x) for x in row) for row in zip(*values.values())]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(5).cache()
    want = [float(np.nanquantile(values[c], s)) for c, s in shares.values()]
    seen = df.agg(*[m.alias(k) for k, m in bracket_measures(shares).items()]).first().asDict()
    for brackets in (None, seen, {}):
        one = spark.range(1).select(column_quantiles(df, shares, brackets).alias("q")).first().q
        assert list(one) == pytest.approx(want, abs=1e-12)
    with pytest.raises(Exception, match="outside its brackets"):  # of another table
        spark.range(1).select(column_quantiles(df, shares, seen | {"a25": [0.9, 0.95]}).alias("q")).first()


def test_segments_read_the_written_mart_twice(spark, tmp_path):
    rows = [listen(u, u % 7, u * 10) for u in range(40)]
    track.track_mart(_stage(spark, rows), DEFAULT.with_(track_min_listens=1)).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    seen = t.agg(*[m.alias(k) for k, m in bracket_measures(reports.QUALITY_SHARES, F.col("is_reliable_sample")).items()]).first().asDict()
    limits = exports.track_thresholds(t, seen)
    for df, alone in ((reports.quality_segments(t, seen), reports.quality_segments(t)), (exports.export_track_quality(t, limits), exports.export_track_quality(t))):
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # one plan is printed, not the first and the last
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.adaptive.enabled")
        assert plan.count("FileScan parquet") == 2, plan
        assert sorted(map(str, df.collect())) == sorted(map(str, alone.collect()))


def test_reports_hold_no_percentile_of_all_values(spark):
    rows = [listen(u, u % 7, u * 10) for u in range(40)]
    s = _stage(spark, rows)
    t = track.track_mart(s, DEFAULT.with_(track_min_listens=1))
    for df in (reports.user_summary(user.user_mart(s)), reports.track_summary(t), reports.quality_segments(t),
               exports.export_track_quality(t)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "percentile(" not in plan and "median(" not in plan


def test_pivot_has_fixed_columns_in_display_order(spark):
    r = retention.retention_cohort(_stage(spark, [listen(1, 1, 0), listen(1, 1, 7 * DAY)]))
    out = reports.controlled_d7_pivot(r)
    assert out.columns == ["engagement_bucket", "0%", "1-25%", "25-50%", "50-75%", "75-99%", "100%"]
    assert [tuple(x) for x in out.collect()] == [("1-10", 100.0, None, None, None, None, None)]


def test_marts_do_not_depend_on_partitioning(spark):
    # sums of doubles may differ in their last bits with the order of rows, not more
    from conftest import SF01
    from listenlab.sources import load_fixture

    src = load_fixture(spark, SF01)
    out = []
    for n in (3, 17):
        shuffled = src.repartition(n)
        s = st.stage_events(shuffled)
        u = user.user_mart(s).select("uid", "play_seconds", "minutes_per_session")
        p = product.product_day(s).select("day_idx", "play_seconds", "minutes_per_active_user")
        out.append((sorted(map(tuple, u.collect())), sorted(map(tuple, p.collect()))))
    for first, second in zip(*out):
        assert [r[0] for r in first] == [r[0] for r in second]
        for a, b in zip(first, second):
            assert a[1:] == pytest.approx(b[1:], rel=1e-12)


def test_kpis_apply_dashboard_filters(spark):
    # cohort day 0 is excluded from the retention cards; tracks below the
    # listen threshold are excluded from the track cards
    rows = [listen(1, 1, 0), listen(1, 1, DAY), listen(2, 2, DAY), listen(2, 2, 2 * DAY),
            listen(3, 2, DAY + 10)]
    s = _stage(spark, rows)
    r = retention.retention_cohort(s)
    k = {x.lifetime_day: (x.retained_users, x.cohort_users)
         for x in reports.kpi_retention(r, lifetime_days=(1,)).collect()}
    assert k == {1: (1, 2)}            # users 2 and 3 start on day 1; only user 2 returns
    t = track.track_mart(s)
    kt = reports.kpi_tracks(t, min_listens=3).first()
    assert (kt.tracks, kt.listens) == (1, 3)
    kp = reports.kpi_product(product.product_day(s), first_day=1).first()
    assert kp.avg_dau == 2.0 and kp.listens_per_active_user == 1.0   # 4 listens / 4 active user-days
