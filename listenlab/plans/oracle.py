"""Oracle SQL (DuckDB dialect) for the driver's side-by-side check.

These texts are written from the metric definitions, in other forms than the
Spark plans, so that each checks the other. Sums and means are plain ones.
Double columns are rounded to 6 places on both sides because float sums
depend on summation order; sums are cast to BIGINT because DuckDB widens them
to HUGEINT.
"""

from __future__ import annotations

# Fixture mapping of FIXTURES.md section 2 (the driver's events table ->
# the interaction contract), DuckDB text.
MAPPING = """
base AS (
  SELECT event_id, user_id,
         date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts) AS sec,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
), mapped AS (
  SELECT
    event_id,
    CAST(CASE WHEN user_id % 3 = 0 THEN 3
              WHEN user_id % 6 = 1 THEN 7
              WHEN user_id % 6 = 4 THEN 100 + user_id % 25
              ELSE 1000 + user_id END AS BIGINT) AS uid,
    CAST(CASE WHEN k < 60 THEN k % 12 ELSE k END AS BIGINT) AS item_id,
    CAST(sec - sec % 5 AS BIGINT) AS ts_sec,
    CAST(CASE WHEN user_id % 6 = 4 AND user_id % 25 < 5 THEN 1
              WHEN user_id % 6 = 4 AND user_id % 25 < 10 THEN 0
              WHEN (event_id * 7 + k) % 100 < 48 THEN 0 ELSE 1 END AS INT) AS is_organic,
    CASE WHEN event_id % 20 = 14 OR event_id % 20 = 15 THEN 'like'
         WHEN event_id % 20 = 16 THEN 'dislike'
         WHEN event_id % 20 = 17 THEN 'unlike'
         WHEN event_id % 20 = 18 THEN 'undislike'
         ELSE 'listen' END AS event_type,
    CAST(CASE WHEN k = 77 THEN NULL ELSE (event_id * 37) % 131 END AS INT) AS ratio,
    CAST(CASE WHEN k = 88 THEN NULL
              ELSE 60 + ((CASE WHEN k < 60 THEN k % 12 ELSE k END) * 37) % 300 END AS INT) AS len
  FROM base
), shifted AS (
  SELECT * REPLACE (CAST(ts_sec + 86400 * CASE WHEN event_type = 'listen' THEN uid % 10
                                               ELSE greatest(uid % 10 - 1, 0) END AS BIGINT) AS ts_sec)
  FROM mapped
), dup AS (
  SELECT * FROM shifted UNION ALL SELECT * FROM shifted WHERE event_id % 50 = 0
), interactions AS (
  SELECT uid, item_id, ts_sec AS timestamp, is_organic, event_type,
         CAST(CASE WHEN event_type = 'listen' THEN ratio END AS DOUBLE) AS played_ratio_pct,
         CAST(CASE WHEN event_type = 'listen' THEN len END AS DOUBLE) AS track_length_seconds
  FROM dup
)"""

# A session starts where the time since the latest event before is above half
# an hour, or there is none; events of one second are ordered by track and type.
STAGE = """
stage AS (
  SELECT *, timestamp // 86400 AS day_idx, event_type = 'listen' AS is_listen,
    CASE WHEN event_type = 'listen' THEN played_ratio_pct > 50 ELSE false END AS is_listen_plus,
    CASE WHEN event_type = 'listen' THEN played_ratio_pct > 100 ELSE false END AS is_replay,
    (event_type, is_organic) = ('listen', 0) AS is_recommendation_listen,
    CASE event_type WHEN 'listen' THEN played_ratio_pct * track_length_seconds / 100.0 END AS play_seconds,
    coalesce(timestamp - max(timestamp) OVER (PARTITION BY uid ORDER BY timestamp, item_id, event_type
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 1800, true) AS is_session_start
  FROM interactions
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes)


def rounded(select: str, doubles: tuple[str, ...] = ()) -> str:
    """Wrap a query and round its double columns to 6 places."""
    if not doubles:
        return select
    repl = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM ({select}) AS q"


def R(num: str, den: str, scale: str = "") -> str:
    """Ratio as DOUBLE, NULL on zero denominator."""
    mul = f" * {scale}" if scale else ""
    return f"CAST({num} AS DOUBLE){mul} / nullif({den}, 0)"
