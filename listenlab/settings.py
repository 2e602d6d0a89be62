"""Business constants of the marts, carried as one frozen object."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Settings:
    # Fixed values of the metric definitions (must equal the reference's).
    day_seconds: int = 86_400
    session_gap_seconds: int = 1_800
    listen_plus_threshold: int = 50
    replay_threshold: int = 100
    track_min_listens: int = 100
    # Dashboard-only filters from the metric docs.
    kpi_min_cohort_day: int = 1
    kpi_track_min_listens: int = 1_000
    # Execution knob, not a metric: width of the time slices the session
    # window is split into, so that one heavy user never sits in one task.
    # Any positive value gives identical results.
    session_split_seconds: int = 3_600

    def with_(self, **changes) -> "Settings":
        return replace(self, **changes)


DEFAULT = Settings()

EVENT_TYPES = ("listen", "like", "dislike", "unlike", "undislike")
