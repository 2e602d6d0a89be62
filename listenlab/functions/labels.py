"""Bucket labels, their display order, and the ordered ``when`` chains that
assign them. Chains are written in priority order; a NULL input falls
through to the final branch exactly like a SQL searched CASE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket edges.
SHARE_EDGES = (0.25, 0.50, 0.75)          # share buckets: 0 | (0,.25] | (.25,.5] | (.5,.75] | (.75,1) | 1
ENGAGEMENT_EDGES = (10, 30, 60)           # first-day listens: 1-10 | 11-30 | 31-60 | 61+
LENGTH_EDGES = (120, 180, 240, 300)       # track seconds, left-closed bins

# Retention bucket labels (hyphen) and their order.
RECOMMENDATION_ORDER = {"0%": 1, "1-25%": 2, "25-50%": 3, "50-75%": 4, "75-99%": 5, "100%": 6}
ENGAGEMENT_ORDER = {"1-10": 1, "11-30": 2, "31-60": 3, "61+": 4}

# Track extract labels (en dash) and their order.
TRACK_SHARE_ORDER = {"0%": 1, "1–25%": 2, "25–50%": 3, "50–75%": 4, "75–99%": 5, "100%": 6}
TRACK_LENGTH_ORDER = {"до 2 мин": 1, "2–3 мин": 2, "3–4 мин": 3, "4–5 мин": 4, "5+ мин": 5}
QUALITY_SEGMENTS = {"высокое качество": 1, "стабильные": 2, "требует внимания": 3}
QUALITY_HIGH, QUALITY_STABLE, QUALITY_ATTENTION = "высокое качество", "стабильные", "требует внимания"

# Funnel step display names and source labels of the extracts.
FUNNEL_STEP_NAMES = {
    "all_listens": "все прослушивания",
    "recommendation_listens": "прослушивания из рекомендаций",
    "recommendation_listen_plus": "Listen+ из рекомендаций",
    "recommendation_replays": "повторы из рекомендаций",
}
FUNNEL_REPORT_NAMES = {
    "all_listens": "все прослушивания",
    "recommendation_listens": "прослушивания рекомендаций",
    "recommendation_listen_plus": "рекомендации Listen+",
    "recommendation_replays": "повторы рекомендаций",
}
SOURCE_LABELS = {"recommendations": "рекомендации", "organic": "органика"}
DAY_LABEL_FORMAT = "День %03d"
WEEK_LABEL_FORMAT = "Дни %03d–%03d"


def label_order(col, mapping: dict[str, int]) -> Column:
    """Dictionary lookup as a literal map; NULL when the label is absent."""
    pairs = []
    for key, value in mapping.items():
        pairs += [F.lit(key), F.lit(value)]
    return F.create_map(*pairs)[col if isinstance(col, Column) else F.col(col)]


def recommendation_bucket(share: Column, sep: str = "-") -> Column:
    """Share buckets 0, (0,.25], (.25,.5], (.5,.75], (.75,1), else 100%."""
    a, b, c = SHARE_EDGES
    return (
        F.when(share == 0, F.lit("0%"))
        .when(share <= a, F.lit(f"1{sep}25%"))
        .when(share <= b, F.lit(f"25{sep}50%"))
        .when(share <= c, F.lit(f"50{sep}75%"))
        .when(share < 1, F.lit(f"75{sep}99%"))
        .otherwise(F.lit("100%"))
    )


def engagement_bucket(listens: Column) -> Column:
    a, b, c = ENGAGEMENT_EDGES
    return (
        F.when(listens <= a, F.lit("1-10"))
        .when(listens <= b, F.lit("11-30"))
        .when(listens <= c, F.lit("31-60"))
        .otherwise(F.lit("61+"))
    )


def track_length_bucket(seconds: Column) -> Column:
    """Left-closed bins [-inf,120), [120,180), [180,240), [240,300), [300,inf);
    NULL stays NULL (no ``otherwise``)."""
    a, b, c, d = LENGTH_EDGES
    return (
        F.when(seconds < a, F.lit("до 2 мин"))
        .when(seconds < b, F.lit("2–3 мин"))
        .when(seconds < c, F.lit("3–4 мин"))
        .when(seconds < d, F.lit("4–5 мин"))
        .when(seconds >= d, F.lit("5+ мин"))
    )


def track_share_bucket(share: Column) -> Column:
    """Successive overwrites of the extract: 100% by default, then <1, <=.75,
    <=.5, (0,.25], ==0. A NULL share stays in 100%."""
    a, b, c = SHARE_EDGES
    return (
        F.when(share == 0, F.lit("0%"))
        .when((share > 0) & (share <= a), F.lit("1–25%"))
        .when(share <= b, F.lit("25–50%"))
        .when(share <= c, F.lit("50–75%"))
        .when(share < 1, F.lit("75–99%"))
        .otherwise(F.lit("100%"))
    )


def quality_segment(rate: Column, dislikes: Column, q25: Column, q75: Column,
                    dislikes_q75: Column, attention_wins: bool = True) -> Column:
    """Three quality segments. ``attention_wins`` follows the extract (the
    attention rule is applied last and overrides "high"); False follows the
    report's CASE, which tests "high" first. Conditions with a NULL operand
    count as false, so a NULL rate lands in the stable segment."""
    high = F.coalesce((rate >= q75) & (dislikes < dislikes_q75), F.lit(False))
    attention = F.coalesce((rate <= q25) | (dislikes >= dislikes_q75), F.lit(False))
    if attention_wins:
        return F.when(attention, F.lit(QUALITY_ATTENTION)).when(high, F.lit(QUALITY_HIGH)) \
            .otherwise(F.lit(QUALITY_STABLE))
    return F.when(high, F.lit(QUALITY_HIGH)).when(attention, F.lit(QUALITY_ATTENTION)) \
        .otherwise(F.lit(QUALITY_STABLE))
