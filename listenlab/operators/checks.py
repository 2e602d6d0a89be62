"""Reconciliation checks between stage and marts, the notebook checks, and
the export checks.

Each check family returns a DataFrame of ``(name, ok)`` rows. The totals of
different tables meet through scalar subqueries (one value per table, no
join); rows are produced with ``inline`` over a literal array of structs.
Equality of totals uses null-safe equality: an empty table has NULL sums on
both sides and such totals are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlab.functions.measures import cnt, count_if, distinct_count

RETENTION_KEY = ("cohort_day", "lifetime_day", "recommendation_bucket", "engagement_bucket")


def scalars(df: DataFrame, **measures: Column) -> Column:
    """One struct of aggregates over ``df``, as a scalar subquery column."""
    return df.agg(F.struct(*[m.alias(k) for k, m in measures.items()]).alias("s")).scalar()


def as_rows(anchor: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Turn named boolean columns over a one-row ``anchor`` into rows."""
    items = [F.struct(F.lit(k).alias("name"), F.coalesce(v, F.lit(False)).alias("ok"))
             for k, v in checks.items()]
    return anchor.select(F.inline(F.array(*items)))


def _not_between(c: str, lo=0, hi=1) -> Column:
    return ~F.col(c).between(lo, hi)


def funnel_monotonic(funnel: DataFrame) -> DataFrame:
    """Funnel rows with the previous step's events (four rows)."""
    return funnel.withColumn("previous_events", F.lag("events").over(Window.orderBy("step_order")))


def mart_checks(stage: DataFrame, product: DataFrame, user: DataFrame, user_day: DataFrame,
                retention: DataFrame, track: DataFrame, funnel: DataFrame, base: DataFrame) -> DataFrame:
    """The eleven cross-mart checks, one row each. Events, listens and users
    of the stage come from its user-day ``base``; only the distinct tracks
    need a pass over the stage."""
    per_user = base.groupBy("uid").agg(F.sum("events").alias("events"), F.sum("listens").alias("listens"))
    anchor = per_user.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("events"), F.coalesce(F.sum("listens"), F.lit(0)).alias("listens"),
                          F.count("uid").alias("users")).withColumn("tracks", distinct_count(stage, "item_id"))
    p = scalars(
        product, events=F.sum("events"), listens=F.sum("listens"),
        bad_rates=count_if(_not_between("listener_like_rate") | _not_between("listener_dislike_rate")),
        bad_counts=count_if((F.col("listener_likers") > F.col("listeners"))
                            | (F.col("listener_dislikers") > F.col("listeners"))),
        likers=F.sum("listener_likers"), dislikers=F.sum("listener_dislikers"),
    )
    u = scalars(user, rows=cnt(), keys=F.count_distinct("uid"))
    ud = scalars(
        user_day, rows=cnt(), keys=F.count_distinct(F.struct("uid", "day_idx")), listens=F.sum("listens"),
        likers=count_if((F.col("listens") > 0) & (F.col("likes") > 0)),
        dislikers=count_if((F.col("listens") > 0) & (F.col("dislikes") > 0)),
    )
    r = scalars(
        retention, rows=cnt(), keys=F.count_distinct(F.struct(*RETENTION_KEY)),
        bad=count_if(_not_between("retention_rate")),
        bad_d0=count_if((F.col("lifetime_day") == 0) & (F.col("retention_rate") != 1)),
    )
    t = scalars(track, rows=cnt(), keys=F.count_distinct("item_id"))
    fn = scalars(
        funnel_monotonic(funnel), rows=cnt(),
        start=F.max(F.when(F.col("step_order") == 1, F.col("events"))),
        monotonic=F.bool_and(F.col("previous_events").isNull() | (F.col("events") <= F.col("previous_events"))),
    )
    c = F.col
    return as_rows(anchor, {
        "product_events_match_source": p["events"].eqNullSafe(c("events")),
        "product_listens_match_source": p["listens"].eqNullSafe(c("listens")),
        "product_reaction_rates_are_valid": (p["bad_rates"] == 0) & (p["bad_counts"] == 0),
        "product_reactions_match_user_day": p["likers"].eqNullSafe(ud["likers"])
        & p["dislikers"].eqNullSafe(ud["dislikers"]),
        "user_key_is_unique": (u["rows"] == u["keys"]) & (u["keys"] == c("users")),
        "user_day_key_is_unique": ud["rows"] == ud["keys"],
        "user_day_listens_match_source": ud["listens"].eqNullSafe(c("listens")),
        "retention_key_is_unique": r["rows"] == r["keys"],
        "retention_rates_are_valid": (r["bad"] == 0) & (r["bad_d0"] == 0),
        "track_key_is_unique": (t["rows"] == t["keys"]) & (t["keys"] == c("tracks")),
        "funnel_is_valid": (fn["rows"] == 4) & fn["start"].eqNullSafe(c("listens")) & fn["monotonic"],
    })


def raise_on_failure(checks: DataFrame, what: str = "mart checks") -> dict[str, bool]:
    """Collect the (small, fixed-size) check table; raise if any is false."""
    return raise_unless_all({row["name"]: bool(row["ok"]) for row in checks.collect()}, what)


def raise_unless_all(result: dict[str, bool], what: str = "mart checks") -> dict[str, bool]:
    if not all(result.values()):
        raise RuntimeError(f"{what} failed: {result}")
    return result


# --- notebook checks ---------------------------------------------------------

def product_check(product: DataFrame, expected_events, expected_listens) -> DataFrame:
    """Unique day, totals equal the expected numbers (ints or columns), two
    rates within [0, 1]. One row of booleans."""
    ev = expected_events if isinstance(expected_events, Column) else F.lit(int(expected_events))
    li = expected_listens if isinstance(expected_listens, Column) else F.lit(int(expected_listens))
    return product.agg(
        (cnt() == F.count_distinct("day_idx")).alias("unique_key"),
        (F.sum("events") == ev).alias("events_match"),
        (F.sum("listens") == li).alias("listens_match"),
        ((F.min("listen_plus_rate") >= 0) & (F.max("listen_plus_rate") <= 1)).alias("listen_plus_valid"),
        ((F.min("recommendation_share") >= 0) & (F.max("recommendation_share") <= 1))
        .alias("recommendation_share_valid"),
    )


def funnel_check(funnel: DataFrame) -> DataFrame:
    return funnel_monotonic(funnel).agg(
        (cnt() == 4).alias("four_steps"),
        F.bool_and(F.col("previous_events").isNull() | (F.col("events") <= F.col("previous_events")))
        .alias("monotonic"),
    )


def user_day_check(user_day: DataFrame, expected_listens) -> DataFrame:
    li = expected_listens if isinstance(expected_listens, Column) else F.lit(int(expected_listens))
    return user_day.agg(
        (cnt() == F.count_distinct(F.struct("uid", "day_idx"))).alias("unique_key"),
        (F.sum("listens") == li).alias("listens_match"),
    )


def retention_check(retention: DataFrame) -> DataFrame:
    return retention.agg(
        (cnt() == F.count_distinct(F.struct(*RETENTION_KEY))).alias("unique_key"),
        ((F.min("retention_rate") >= 0) & (F.max("retention_rate") <= 1)).alias("rates_valid"),
        (count_if((F.col("lifetime_day") == 0) & (F.col("retention_rate") != 1)) == 0).alias("d0_valid"),
    )


# Columns that the export needs.
TRACK_REQUIRED = ("is_reliable_sample", "recommendation_listen_plus", "organic_listen_plus")


def track_columns_contract(track: DataFrame, required=TRACK_REQUIRED) -> list[str]:
    """Required columns missing from the track mart (metadata, no job)."""
    return sorted(set(required) - set(track.columns))


# --- export checks -----------------------------------------------------------
# NULL rates fail here (a NULL is not within range), unlike the mart checks.

# Text that marks a broken encoding in an extract.
BAD_TEXT = ("???", "\ufffd")


def _outside(c: str) -> Column:
    return ~F.coalesce(F.col(c).between(0, 1), F.lit(False))


def is_broken(text: Column) -> Column:
    """Whether a text holds a mark of a broken encoding; NULL does not."""
    return F.coalesce(F.contains(text, F.lit(BAD_TEXT[0])) | F.contains(text, F.lit(BAD_TEXT[1])), F.lit(False))


def text_is_clean(frames: list[DataFrame]) -> Column:
    """No string value of the extracts contains '???' or U+FFFD."""
    bad = None
    for df in frames:
        strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
        if not strings:
            continue
        line = F.concat_ws("\u0001", *[F.col(c) for c in strings])
        n = scalars(df, n=count_if(F.exists(F.array(*[F.lit(b) for b in BAD_TEXT]),
                                            lambda b: F.instr(line, b) > 0)))["n"]
        bad = n if bad is None else bad + n
    return F.lit(True) if bad is None else bad == 0


def export_checks(product: DataFrame, tracks: DataFrame, retention: DataFrame, funnel: DataFrame,
                  quality: DataFrame, min_listens: int = 100, text_ok: Column | None = None) -> DataFrame:
    """Checks of the dashboard extracts, one row each."""
    p = scalars(
        product, rows=cnt(), days=F.count_distinct("day_idx"),
        first=F.min("observation_day"), last=F.max("observation_day"),
        obs=F.count_distinct("observation_day"),
        bad_rates=count_if(_outside("listener_like_rate") | _outside("listener_dislike_rate")),
        bad_likers=count_if(F.col("listener_likers") > F.col("listeners")),
        bad_dislikers=count_if(F.col("listener_dislikers") > F.col("listeners")),
    )
    t = scalars(tracks, rows=cnt(), keys=F.count_distinct("item_id"), min_listens=F.min("listens"),
                no_segment=count_if(F.col("quality_segment").isNull()))
    r = scalars(retention, rows=cnt(), keys=F.count_distinct(F.struct(*RETENTION_KEY)),
                bad=count_if(_outside("retention_rate")))
    f = scalars(funnel, rows=cnt(), keys=F.count_distinct("step_order"),
                lo=F.min("step_order"), hi=F.max("step_order"))
    q = scalars(quality, rows=cnt())
    anchor = product.agg(cnt().alias("_n"))
    checks = {
        "product_key_is_unique": (p["rows"] > 0) & (p["rows"] == p["days"]),
        "product_observation_days_are_dense": (p["first"] == 1) & (p["last"] == p["rows"])
        & (p["obs"] == p["rows"]),
        "product_reaction_rates_in_range": p["bad_rates"] == 0,
        "product_likers_within_listeners": p["bad_likers"] == 0,
        "product_dislikers_within_listeners": p["bad_dislikers"] == 0,
        "tracks_key_is_unique": (t["rows"] > 0) & (t["rows"] == t["keys"]),
        "tracks_are_reliable": t["min_listens"] >= int(min_listens),
        "tracks_have_segment": t["no_segment"] == 0,
        "retention_key_is_unique": r["rows"] == r["keys"],
        "retention_rate_in_range": r["bad"] == 0,
        "funnel_steps_are_1_to_4": (f["rows"] == 4) & (f["keys"] == 4) & (f["lo"] == 1) & (f["hi"] == 4),
        "quality_has_two_sources": q["rows"] == 2,
    }
    if text_ok is not None:
        checks["text_is_clean"] = text_ok
    return as_rows(anchor, checks)
