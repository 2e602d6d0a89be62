"""Oracle SQL for source, stage and mart keys."""

from __future__ import annotations

from listenlab.plans.oracle import MAPPING, STAGE, rounded, with_ctes
from listenlab.plans.oracle_chain import (
    FUNNEL_DOUBLES, PRODUCT_DOUBLES, RETENTION_DOUBLES, TRACK_DOUBLES, USER_DAY_DOUBLES, USER_DOUBLES, q,
)

_PRE = with_ctes(MAPPING, STAGE)

_SRC = with_ctes(MAPPING)

# Faults are numbered per event, then counted by number.
_FAULTS = """
, judged AS (
  SELECT *, len(list_filter([uid, item_id, timestamp, is_organic], lambda x: x IS NULL)) > 0 OR event_type IS NULL AS no_value,
    coalesce(played_ratio_pct, track_length_seconds) IS NOT NULL AS any_play,
    played_ratio_pct + track_length_seconds IS NULL AS part_play,
    coalesce(timestamp % 5, 0) <> 0 AS off_step
  FROM interactions
), known AS (SELECT unnest(['listen', 'like', 'dislike', 'unlike', 'undislike']) AS event_type)
, counted AS (
  SELECT count(*) AS events, min(timestamp) AS min_timestamp, max(timestamp) AS max_timestamp,
    (SELECT count(*) FROM (SELECT uid FROM interactions WHERE uid IS NOT NULL GROUP BY uid)) AS users,
    (SELECT count(*) FROM (SELECT item_id FROM interactions WHERE item_id IS NOT NULL GROUP BY item_id)) AS items,
    count_if(off_step) AS off_steps, count_if(no_value) AS no_values,
    (SELECT count(*) FROM interactions i ANTI JOIN known k ON i.event_type = k.event_type WHERE i.event_type IS NOT NULL) AS unknown_types,
    count_if(abs(is_organic - 0.5) <> 0.5) AS other_organic, count_if(event_type = 'listen') AS listens,
    count_if(event_type <> 'listen' AND any_play) AS played_actions, count_if(event_type = 'listen' AND part_play) AS part_listens
  FROM judged
)
"""

SOURCE_PROFILE = _SRC + _FAULTS + """
SELECT events, users, items, min_timestamp, max_timestamp, CAST(off_steps AS BIGINT) AS timestamps_not_multiple_of_5,
  CAST(no_values AS BIGINT) AS required_nulls, CAST(other_organic AS BIGINT) AS invalid_is_organic, unknown_types AS invalid_event_type,
  CAST(listens AS BIGINT) AS listens, CAST(played_actions AS BIGINT) AS non_listen_with_play_fields
FROM counted"""

SOURCE_GATE = _SRC + _FAULTS + """
SELECT events, CAST(no_values AS BIGINT) AS required_nulls, unknown_types AS invalid_event_type,
       events > 0 AND no_values + unknown_types = 0 AS ok FROM counted"""

SOURCE_QUALITY = _SRC + _FAULTS + """
SELECT events, users, items AS tracks, min_timestamp, max_timestamp, CAST(no_values AS BIGINT) AS missing_required,
  CAST(off_steps AS BIGINT) AS invalid_timestamp_step, CAST(part_listens AS BIGINT) AS invalid_listens,
  CAST(played_actions AS BIGINT) AS invalid_actions
FROM counted"""

EVENT_TYPE_COUNTS = _SRC + """
SELECT event_type AS event, count(*) AS rows FROM interactions GROUP BY event_type"""

DUPLICATE_ROWS = _SRC + """
SELECT (SELECT count(*) FROM interactions) - (SELECT count(*) FROM (SELECT DISTINCT * FROM interactions)) AS duplicate_rows"""

STAGE_EVENTS = rounded(_PRE + """
SELECT uid, item_id, timestamp, day_idx, is_organic, event_type, played_ratio_pct,
       track_length_seconds, is_listen, is_listen_plus, is_replay, is_recommendation_listen, play_seconds
FROM stage""", ("played_ratio_pct", "track_length_seconds", "play_seconds"))

STAGE_ROWS = rounded(_PRE + """
SELECT * REPLACE (row_number() OVER tie = 1 AND bool_or(is_session_start) OVER (PARTITION BY uid, timestamp, item_id, event_type) AS is_session_start)
FROM stage WINDOW tie AS (PARTITION BY uid, timestamp, item_id, event_type
  ORDER BY is_organic NULLS FIRST, played_ratio_pct NULLS FIRST, track_length_seconds NULLS FIRST)""",
    ("played_ratio_pct", "track_length_seconds", "play_seconds"))

SESSION_STARTS = _PRE + """
SELECT uid, day_idx, count(*) AS events, count(*) FILTER (WHERE is_session_start) AS sessions
FROM stage GROUP BY uid, day_idx"""

SESSION_FLAGS = _PRE + """
SELECT uid, timestamp, CAST(count_if(is_session_start) AS BIGINT) AS starts FROM stage GROUP BY ALL"""

STAGE_RECONCILE = _PRE + """
SELECT (SELECT count(*) FROM interactions) AS source_rows, count(*) AS stage_rows,
       (SELECT count(*) FROM interactions) = count(*) AS ok
FROM stage"""

DAY_USER_FLAGS = q("""
SELECT day_idx, uid, bool_or(is_listen) AS has_listen, bool_or(event_type = 'like') AS has_like,
       bool_or(event_type = 'dislike') AS has_dislike
FROM stage GROUP BY day_idx, uid""")

DAY_REACTIONS = q("SELECT day_idx, listener_likers, listener_dislikers FROM product")

FIRST_DAY_DOUBLES = ("first_day_recommendation_share", "first_day_listen_plus_rate")
SIZE_DOUBLES = ("avg_first_day_listens", "avg_first_day_sessions", "avg_first_day_listen_plus_rate")

_MARTS = {"mart_product_day": "product", "mart_recommendation_funnel": "funnel", "mart_user": "users", "mart_user_day": "user_day",
          "mart_retention_cohort": "retention", "mart_track": "track"}

MART_FILE_ORDER = q(" UNION ALL ".join(
    f"SELECT '{mart}' AS mart, count(*) AS rows, true AS files_ascend, true AS ranges_ascend FROM {table}" for mart, table in _MARTS.items()))

_KIND = "CASE WHEN column_type IN ('BIGINT', 'HUGEINT', 'INTEGER') THEN 'integer' WHEN column_type = 'VARCHAR' THEN 'string' ELSE lower(column_type) END"

MART_COLUMNS = " UNION ALL ".join(
    f"SELECT '{mart}' AS mart, column_name, {_KIND} AS kind, '{mart}' = 'mart_track' AND column_name IN ('is_reliable_sample', "
    f"'recommendation_listen_plus', 'organic_listen_plus') AS required FROM (DESCRIBE {q(f'SELECT * FROM {table}')})" for mart, table in _MARTS.items())

ORACLE = {
    "stage_rows": STAGE_ROWS,
    "mart_file_order": MART_FILE_ORDER,
    "mart_columns": MART_COLUMNS,
    "source_profile": SOURCE_PROFILE,
    "source_gate": SOURCE_GATE,
    "source_quality": SOURCE_QUALITY,
    "source_manifest": "SELECT count(*) AS rows, true AS rows_match_expected FROM events",
    "session_flags": SESSION_FLAGS,
    "event_type_counts": EVENT_TYPE_COUNTS,
    "duplicate_rows": DUPLICATE_ROWS,
    "stage_events": STAGE_EVENTS,
    "session_starts": SESSION_STARTS,
    "stage_reconcile": STAGE_RECONCILE,
    "mart_product_day": q("SELECT * FROM product", PRODUCT_DOUBLES),
    "day_user_flags": DAY_USER_FLAGS,
    "day_reactions": DAY_REACTIONS,
    "funnel_totals": q("SELECT * FROM funnel_totals"),
    "mart_recommendation_funnel": q("SELECT * FROM funnel", FUNNEL_DOUBLES),
    "mart_user": q("SELECT * FROM users", USER_DOUBLES),
    "built_mart_user": q("SELECT * FROM users", USER_DOUBLES),
    "mart_user_day": q("SELECT * FROM user_day", USER_DAY_DOUBLES),
    "mart_track": q("SELECT * FROM track", TRACK_DOUBLES),
    "mart_retention_cohort": q("SELECT * FROM retention", RETENTION_DOUBLES),
    "cohort_first_days": q("SELECT * FROM first_days"),
    "cohort_first_day_metrics": q("SELECT * FROM first_day_metrics", FIRST_DAY_DOUBLES),
    "cohort_buckets": q("SELECT * FROM cohorts", FIRST_DAY_DOUBLES),
    "cohort_sizes": q("SELECT * FROM cohort_sizes", SIZE_DOUBLES),
    "cohort_retained": q("SELECT * FROM retained"),
    "cohort_grid": q("SELECT * FROM cohort_grid", SIZE_DOUBLES),
}
