"""What the builders return (rows and totals per mart) and reports as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlab.functions.measures import cnt

MART_KEYS = {
    "mart_product_day": ["day_idx"],
    "mart_user": ["uid"],
    "mart_user_day": ["uid", "day_idx"],
    "mart_retention_cohort": ["cohort_day", "recommendation_bucket", "engagement_bucket", "lifetime_day"],
    "mart_track": ["item_id"],
    "mart_recommendation_funnel": ["step_order"],
}


def mart_summaries(product: DataFrame, funnel: DataFrame, user: DataFrame, user_day: DataFrame,
                   retention: DataFrame, track: DataFrame) -> DataFrame:
    """What each builder reports, long format: (mart, measure, value) --
    rows of every mart, event and listen totals of the product mart,
    sessions of the user mart, distinct users of the user-day mart."""
    def one(name: str, df: DataFrame, **measures: Column) -> DataFrame:
        measures = {"rows": cnt(), **measures}
        row = df.agg(*[m.cast("bigint").alias(k) for k, m in measures.items()])
        return row.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("mart"), F.lit(k).alias("measure"), F.col(k).alias("value"))
            for k in measures])))

    parts = [
        one("mart_product_day", product, events=F.sum("events"), listens=F.sum("listens")),
        one("mart_recommendation_funnel", funnel),
        one("mart_user", user, sessions=F.sum("sessions")),
        one("mart_user_day", user_day, users=F.count_distinct("uid")),
        one("mart_retention_cohort", retention),
        one("mart_track", track),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report_rows(report: dict) -> list[tuple[str, str, float]]:
    """A job's report as (section, name, value) rows; truth is 1 or 0."""
    out = []
    for section, items in report.items():
        for name, value in items.items():
            if isinstance(value, dict):
                value = value.get("rows", value.get("bytes"))
            if isinstance(value, (int, float)):
                out.append((section, name, float(value)))
    return out


def report_frame(spark: SparkSession, report: dict) -> DataFrame:
    return spark.createDataFrame(report_rows(report), "section string, name string, value double")
