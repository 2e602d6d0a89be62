"""The stage table: cleaned, flagged and sessionized events.

Sessionization: an event starts a session when the same user's previous
event (ordered by timestamp, item_id, event_type; all event types take part)
is missing or more than ``session_gap_seconds`` earlier.

A plain ``lag`` over ``PARTITION BY uid`` sends each user to one task, and one
user may own a third of the log. The window is therefore split into
``(uid, slice)`` partitions, ``slice = timestamp div session_split_seconds``.
Inside a slice ``lag`` gives the previous event; for the first event of a
slice the previous event is the last one of the user's preceding non-empty
slice. Those carry-over values come from a small per-(uid, slice) aggregate
(partially aggregated before its shuffle) and enter the window as a marker
row that sorts before every real row of the slice -- only for slices where a
session continues across the boundary. One hash
exchange on (uid, slice) feeds the window; no join and no per-user task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlab.functions.measures import cnt
from listenlab.settings import DEFAULT, Settings

STAGE_COLUMNS = (
    "uid", "item_id", "timestamp", "day_idx", "is_organic", "event_type",
    "played_ratio_pct", "track_length_seconds", "is_listen", "is_listen_plus",
    "is_replay", "is_recommendation_listen", "play_seconds", "is_session_start",
)


def with_flags(source: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Day index and the row-level listening flags (three-valued where the
    source is NULL: a listen with NULL ratio has NULL Listen+/replay)."""
    is_listen = F.col("event_type") == "listen"
    ratio = F.col("played_ratio_pct")
    return source.select(
        "uid", "item_id", "timestamp",
        F.expr(f"timestamp div {int(settings.day_seconds)}").alias("day_idx"),
        "is_organic", "event_type", "played_ratio_pct", "track_length_seconds",
        is_listen.alias("is_listen"),
        (is_listen & (ratio > settings.listen_plus_threshold)).alias("is_listen_plus"),
        (is_listen & (ratio > settings.replay_threshold)).alias("is_replay"),
        (is_listen & (F.col("is_organic") == 0)).alias("is_recommendation_listen"),
        F.when(is_listen, F.col("track_length_seconds") * ratio / F.lit(100.0)).alias("play_seconds"),
    )


def with_session_starts(flagged: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Add ``is_session_start`` with the slice-split window (module doc)."""
    split = int(settings.session_split_seconds)
    if split <= 0:
        raise ValueError("session_split_seconds must be positive")
    gap = int(settings.session_gap_seconds)
    rows = flagged.withColumn("_slice", F.expr(f"timestamp div {split}")) \
        .withColumn("_marker", F.lit(False))

    # First and last timestamp of each (uid, slice), then the last timestamp
    # of the user's previous non-empty slice. The per-user window runs over
    # slices (bounded by time span / split), not over events. A marker is
    # needed only where a session continues across the slice boundary;
    # elsewhere the slice's first event starts a session, which an empty
    # ``lag`` already says.
    slice_span = rows.groupBy("uid", "_slice").agg(
        F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last"))
    carried = slice_span.select(
        "uid", "_slice", "_first",
        F.lag("_last").over(Window.partitionBy("uid").orderBy("_slice")).alias("timestamp"),
    ).where(F.col("timestamp").isNotNull() & (F.col("_first") - F.col("timestamp") <= gap))
    markers = carried.select(
        *[F.col(c) if c in ("uid", "timestamp", "_slice")
          else F.lit(None).cast(flagged.schema[c].dataType).alias(c)
          for c in flagged.columns],
        "_slice", F.lit(True).alias("_marker"),
    )
    # markers carry the previous slice's last timestamp, strictly below every
    # timestamp of the slice, so they sort first.
    order = Window.partitionBy("uid", "_slice").orderBy("timestamp", "item_id", "event_type")
    prev = F.lag("timestamp").over(order)
    out = rows.unionByName(markers).withColumn(
        "is_session_start", prev.isNull() | (F.col("timestamp") - prev > gap)
    )
    return out.where(~F.col("_marker")).drop("_slice", "_marker")


def stage_events(source: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The stage table: contract columns, day, flags, play time, session start."""
    return with_session_starts(with_flags(source, settings), settings).select(*STAGE_COLUMNS)


def session_starts(stage: DataFrame) -> DataFrame:
    """Session starts and events per (uid, day_idx): deterministic even when
    rows tie on the whole order key."""
    return stage.groupBy("uid", "day_idx").agg(
        cnt().alias("events"),
        F.count(F.when(F.col("is_session_start"), 1)).alias("sessions"),
    )


def session_flags(stage: DataFrame) -> DataFrame:
    """Session starts per user and second, the finest grain at which the flag
    is determined when rows tie on the whole order key."""
    return stage.groupBy("uid", "timestamp").agg(F.sum(F.col("is_session_start").cast("int")).alias("starts"))


def stage_reconcile(source: DataFrame, stage: DataFrame) -> DataFrame:
    """Stage rows must equal source rows (one row: both counts and ``ok``).
    The source count enters as a scalar subquery."""
    source_rows = source.agg(cnt()).scalar()
    return stage.agg(cnt().alias("stage_rows")).select(
        source_rows.alias("source_rows"), "stage_rows",
        (source_rows == F.col("stage_rows")).alias("ok"),
    )
