from listenlab.functions.measures import (
    count_if,
    cnt,
    pct,
    ratio,
    sum_if,
)
from listenlab.functions.labels import (
    ENGAGEMENT_ORDER,
    QUALITY_SEGMENTS,
    RECOMMENDATION_ORDER,
    engagement_bucket,
    label_order,
    recommendation_bucket,
)

__all__ = [
    "ENGAGEMENT_ORDER", "QUALITY_SEGMENTS", "RECOMMENDATION_ORDER", "cnt",
    "count_if", "engagement_bucket", "label_order", "pct", "ratio",
    "recommendation_bucket", "sum_if",
]
