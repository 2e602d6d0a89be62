"""Named queries for the driver: each takes (spark, sf_dir) and returns a
DataFrame over the test tables (``events`` mapped to the interaction
contract, then the library function). Every event of the table takes part."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listenlab.functions.measures import cnt, count_if
from listenlab.functions.quantiles import bracket_measures
from listenlab.operators import checks, exports, funnel, metrics, product, reports, retention, source, \
    stage as stage_ops, summary, track, user
from listenlab.operators.base import user_day_base, user_day_tracks
from listenlab.plans import jobs
from listenlab.plans.materialize import drop_folder, materialize, materialize_observed, new_folder
from listenlab.settings import DEFAULT
from listenlab.sources import load_fixture
from listenlab.sources.sinks import BOM, csv_frame

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _src(spark, sf_dir) -> DataFrame:
    return load_fixture(spark, sf_dir)


def _stage(spark, sf_dir) -> DataFrame:
    return stage_ops.stage_events(_src(spark, sf_dir))


def _base(spark, sf_dir) -> DataFrame:
    return user_day_base(_stage(spark, sf_dir))


# --- source -----------------------------------------------------------------
register("source_profile")(lambda spark, d: source.source_profile(_src(spark, d)))
register("source_gate")(lambda spark, d: source.source_gate(_src(spark, d)))
register("source_quality")(lambda spark, d: source.source_quality(_src(spark, d)))
register("event_type_counts")(lambda spark, d: source.event_type_counts(_src(spark, d)))
register("duplicate_rows")(lambda spark, d: source.duplicate_rows(_src(spark, d)))


@register("source_manifest")
def _q_source_manifest(spark, d):
    raw = spark.read.parquet(f"{d}/events.parquet")
    per_file = source.source_manifest(raw, _published_events(d))
    if "rows_match_expected" not in per_file.columns:
        per_file = per_file.withColumn("rows_match_expected", F.lit(None).cast("boolean"))
    return per_file.agg(F.sum("rows").alias("rows"), F.bool_and("rows_match_expected").alias("rows_match_expected"))


def _published_events(sf_dir: str) -> int | None:
    """Rows of ``events`` by the published size of the tables: 1,000,000 times
    the scale in the folder's name, if it has one."""
    scale = re.search(r"/sf([0-9.]+)/*$", sf_dir)
    return scale and round(1_000_000 * float(scale[1]))


# --- stage ------------------------------------------------------------------
# Rows that tie on the whole order key may swap their flag: the finest grain at
# which the flag is determined is compared on its own (session_flags).
@register("stage_events")
def _q_stage_events(spark, d):
    return _stage(spark, d).drop("is_session_start")


@register("stage_rows")
def _q_stage_rows(spark, d):
    """Whole stage rows with their session flag: among rows that tie on the
    window's order, it is given to the first by the other columns."""
    tied = ["uid", "timestamp", "item_id", "event_type"]
    rest = [F.asc_nulls_first(c) for c in ("is_organic", "played_ratio_pct", "track_length_seconds")]
    of_tie = Window.partitionBy(*tied)
    place, starts = F.row_number().over(of_tie.orderBy(*rest)), F.bool_or("is_session_start").over(of_tie)
    return _stage(spark, d).withColumn("is_session_start", starts & (place == 1))


register("session_flags")(lambda spark, d: stage_ops.session_flags(_stage(spark, d)))
register("session_starts")(lambda spark, d: stage_ops.session_starts(_stage(spark, d)))


@register("stage_reconcile")
def _q_stage_reconcile(spark, d):
    src = _src(spark, d)
    return stage_ops.stage_reconcile(src, stage_ops.stage_events(src))


# --- marts and their steps --------------------------------------------------
register("mart_product_day")(lambda spark, d: product.product_day(_stage(spark, d)))
register("day_user_flags")(lambda spark, d: product.day_user_flags(_base(spark, d)))
register("day_reactions")(
    lambda spark, d: product.day_reactions(product.day_user_flags(_base(spark, d))))
register("funnel_totals")(lambda spark, d: funnel.funnel_totals(_stage(spark, d)))
register("mart_recommendation_funnel")(lambda spark, d: funnel.recommendation_funnel(_stage(spark, d)))
register("mart_user")(lambda spark, d: user.user_mart(_stage(spark, d)))
register("mart_user_day")(lambda spark, d: user.user_day(_stage(spark, d)))
register("mart_track")(lambda spark, d: track.track_mart(_stage(spark, d)))
register("mart_retention_cohort")(lambda spark, d: retention.retention_cohort(_stage(spark, d)))
register("cohort_first_days")(lambda spark, d: retention.cohort_first_days(_base(spark, d)))
register("cohort_first_day_metrics")(lambda spark, d: retention.cohort_first_day_metrics(_base(spark, d)))
register("cohort_buckets")(lambda spark, d: retention.cohort_buckets(_base(spark, d)))
register("cohort_sizes")(lambda spark, d: retention.cohort_sizes(_base(spark, d)))
register("cohort_retained")(lambda spark, d: retention.cohort_retained(_base(spark, d)))
register("cohort_grid")(lambda spark, d: retention.cohort_grid(_base(spark, d)))


# --- checks, summaries, reports, KPIs, extracts ------------------------------

# Parameters at the test scale: the fixture's tracks have far
# fewer listens than the real log.
TEST_TRACK_MIN = 60
TEST_LIFETIME_DAYS = (1, 7, 30)
TEST_KPI_TRACK_MIN = 100
# the export job raises where no track is reliable, so its minimum suits the smallest fixture
TEST_EXPORT_TRACK_MIN = 20


class Marts:
    """All marts of one fixture, built lazily from one stage and one base."""

    def __init__(self, spark, sf_dir, track_min: int = DEFAULT.track_min_listens,
                 materialized: bool = False):
        self.source = _src(spark, sf_dir)
        self.stage = stage_ops.stage_events(self.source)
        if materialized:
            self.stage = materialize(self.stage, "stage_events")
        self.base = user_day_base(self.stage)
        if materialized:
            self.base = materialize(self.base, "user_day_base")
        self.tracks = user_day_tracks(self.stage)
        if materialized:
            self.tracks = materialize(self.tracks, "user_day_tracks")
        self.settings = DEFAULT.with_(track_min_listens=track_min)

    @property
    def product(self):
        return product.product_day(self.stage, self.base, self.tracks)

    @property
    def funnel(self):
        return funnel.recommendation_funnel(self.stage, self.base)

    @property
    def user(self):
        return user.user_mart(self.stage, self.base, self.tracks)

    @property
    def user_day(self):
        return user.user_day(self.stage, self.base, self.tracks)

    @property
    def retention(self):
        return retention.retention_cohort(self.stage, self.base)

    @property
    def track(self):
        return track.track_mart(self.stage, self.settings)


def _m(spark, d, track_min=DEFAULT.track_min_listens) -> Marts:
    return Marts(spark, d, track_min)


def _mm(spark, d, track_min=DEFAULT.track_min_listens) -> Marts:
    """Marts over a written stage: for keys that read several marts."""
    return Marts(spark, d, track_min, materialized=True)


@register("mart_checks")
def _q_mart_checks(spark, d):
    m = _mm(spark, d)
    return checks.mart_checks(m.stage, m.product, m.user, m.user_day, m.retention, m.track, m.funnel, m.base)


@register("product_check")
def _q_product_check(spark, d):
    m = _mm(spark, d)
    totals = m.stage.agg(F.struct(cnt().alias("events"), count_if("is_listen").alias("listens"))).scalar()
    return checks.product_check(m.product, totals["events"], totals["listens"])


register("funnel_check")(lambda spark, d: checks.funnel_check(_m(spark, d).funnel))


@register("user_day_check")
def _q_user_day_check(spark, d):
    m = _mm(spark, d)
    return checks.user_day_check(m.user_day, m.stage.agg(count_if("is_listen")).scalar())


register("retention_check")(lambda spark, d: checks.retention_check(_m(spark, d).retention))


@register("mart_summaries")
def _q_mart_summaries(spark, d):
    m = _mm(spark, d)
    return summary.mart_summaries(m.product, m.funnel, m.user, m.user_day, m.retention, m.track)


def _built(spark, d, track_min=DEFAULT.track_min_listens) -> tuple[dict, str]:
    """The build job itself, over the fixture, into the shared folder."""
    out = new_folder(spark, "marts")
    report = jobs.build_marts(spark, None, out, source_df=_src(spark, d), settings=DEFAULT.with_(track_min_listens=track_min))
    return report, out


@register("build_report")
def _q_build_report(spark, d):
    report, out = _built(spark, d)
    drop_folder(spark, out)
    return _report_rows(spark, report)


def _report_rows(spark, report: dict) -> DataFrame:
    report = {k: v for k, v in report.items() if k != "summaries"}
    report["marts"] = {name.removesuffix(".parquet"): v for name, v in report["marts"].items()}
    return summary.report_frame(spark, report)


@register("built_marts")
def _q_built_marts(spark, d):
    """Totals of the marts that the build job has written, read back."""
    return _written_summaries(spark, _built(spark, d)[1])


def _written_summaries(spark, out: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{out}/{name}.parquet")
    return summary.mart_summaries(*[read(f"mart_{n}") for n in (
        "product_day", "recommendation_funnel", "user", "user_day", "retention_cohort", "track")])


@register("mart_file_order")
def _q_mart_file_order(spark, d):
    """Order of the rows over all files of the marts that the build job has written."""
    _, out = _built(spark, d)
    parts = [metrics.file_order(spark.read.parquet(f"{out}/{name}.parquet"), keys).select(F.lit(name).alias("mart"), "*")
             for name, keys in summary.MART_KEYS.items()]
    return reduce(DataFrame.unionByName, parts)


@register("validated_marts")
def _q_validated_marts(spark, d):
    """The checks of the written marts from the totals and measures of their writes."""
    out = new_folder(spark, "marts")
    jobs.build_marts(spark, None, out, source_df=_src(spark, d))
    found = jobs.validate_all_marts(spark, f"{out}/_stage_events.parquet", out)
    drop_folder(spark, out)
    return spark.createDataFrame(list(found.items()), "name string, ok boolean")


@register("reused_stage")
def _q_reused_stage(spark, d):
    """Totals of marts that were built from the stage of an earlier build."""
    _, out = _built(spark, d)
    again = new_folder(spark, "marts")
    jobs.build_marts(spark, None, again, f"{out}/_stage_events.parquet", reuse_stage=True, source_df=_src(spark, d))
    return _written_summaries(spark, again)


@register("report_file")
def _q_report_file(spark, d):
    """The build report as it lies in its file."""
    _, out = _built(spark, d)
    text = spark.read.text(f"{out}/mart_build_report.json", wholetext=True).first()[0]
    drop_folder(spark, out)
    return _report_rows(spark, json.loads(text))


@register("mart_columns")
def _q_mart_columns(spark, d):
    """Columns and kinds of type of the written marts, and whether the export's contract names them."""
    _, out = _built(spark, d)
    found = {name: spark.read.parquet(f"{out}/{name}.parquet") for name in summary.MART_KEYS}
    if checks.track_columns_contract(found["mart_track"]):
        raise ValueError("mart_track breaks the export's contract")
    rows = [(name, column, "integer" if kind in ("int", "bigint") else kind, name == "mart_track" and column in checks.TRACK_REQUIRED)
            for name, mart in found.items() for column, kind, _ in source.source_schema(mart)]
    return spark.createDataFrame(rows, "mart string, column_name string, kind string, required boolean")


@register("built_mart_user")
def _q_built_mart_user(spark, d):
    return spark.read.parquet(f"{_built(spark, d)[1]}/mart_user.parquet")


def _extracts(m: Marts, tracks: DataFrame):
    prod = exports.export_product_day(m.product)
    return (prod, exports.export_track_quality(tracks), exports.export_retention_cohort(m.retention),
            exports.export_funnel(m.funnel), exports.export_recommendation_quality(m.product))


@register("export_checks")
def _q_export_checks(spark, d):
    m = _mm(spark, d, TEST_TRACK_MIN)
    frames = _extracts(m, materialize(m.track, "track"))
    return checks.export_checks(*frames, min_listens=TEST_TRACK_MIN, text_ok=checks.text_is_clean(list(frames)))


@register("export_report")
def _q_export_report(spark, d):
    _, marts = _built(spark, d, TEST_EXPORT_TRACK_MIN)
    out = new_folder(spark, "extracts")
    report = jobs.export_all(spark, marts, out, settings=DEFAULT.with_(track_min_listens=TEST_EXPORT_TRACK_MIN))
    drop_folder(spark, marts)
    drop_folder(spark, out)
    return summary.report_frame(spark, {k: v for k, v in report.items() if k != "files"})


@register("export_files")
def _q_export_files(spark, d):
    """Bytes of the rows in the written extracts, from the listing of their files."""
    _, marts = _built(spark, d, TEST_EXPORT_TRACK_MIN)
    out = new_folder(spark, "extracts")
    jobs.export_all(spark, marts, out, settings=DEFAULT.with_(track_min_listens=TEST_EXPORT_TRACK_MIN))
    rows = []
    for r in jobs.export_files(spark, out).collect():
        # every part file starts with a byte-order mark, which readers of text leave out, and the header
        header = BOM + spark.read.text(f"{out}/{r['extract']}").first()[0] + "\n"
        rows.append((r["extract"], r["bytes"] - r["files"] * len(header.encode())))
    drop_folder(spark, marts)
    drop_folder(spark, out)
    return spark.createDataFrame(rows, "extract string, row_bytes long")


# reports over the marts
register("product_summary")(lambda spark, d: reports.product_summary(_m(spark, d).product))
register("source_comparison")(lambda spark, d: reports.source_comparison(_m(spark, d).product))
register("funnel_report")(lambda spark, d: reports.funnel_report(_m(spark, d).funnel))
register("daily_preview")(lambda spark, d: reports.daily_preview(_m(spark, d).product))
register("user_summary")(lambda spark, d: reports.user_summary(materialize(_m(spark, d).user, "user")))
register("overall_retention")(
    lambda spark, d: reports.overall_retention(_m(spark, d).retention, TEST_LIFETIME_DAYS))
register("retention_by_recommendations")(
    lambda spark, d: reports.retention_by_recommendations(_m(spark, d).retention, TEST_LIFETIME_DAYS))
register("controlled_d7")(lambda spark, d: reports.controlled_d7(_m(spark, d).retention))
register("controlled_d7_pivot")(lambda spark, d: reports.controlled_d7_pivot(_m(spark, d).retention))
register("cohort_heatmap")(
    lambda spark, d: reports.cohort_heatmap(_m(spark, d).retention, TEST_LIFETIME_DAYS))


def _track(spark, d) -> DataFrame:
    """The written track mart, for keys whose quantiles read it several times."""
    return materialize(_m(spark, d, TEST_TRACK_MIN).track, "track")


def _track_and_brackets(spark, d) -> tuple[DataFrame, dict]:
    """The written track mart with the brackets of the quality quartiles."""
    return materialize_observed(_m(spark, d, TEST_TRACK_MIN).track, "track",
                                **bracket_measures(reports.QUALITY_SHARES, F.col("is_reliable_sample")))


register("track_summary")(lambda spark, d: reports.track_summary(_track(spark, d)))
register("track_source_quality")(lambda spark, d: reports.track_source_quality(_m(spark, d).track))
register("quality_segments")(lambda spark, d: reports.quality_segments(*_track_and_brackets(spark, d)))
register("popular_tracks")(lambda spark, d: reports.popular_tracks(_m(spark, d, TEST_TRACK_MIN).track))
register("problem_tracks")(lambda spark, d: reports.problem_tracks(_m(spark, d, TEST_TRACK_MIN).track))

# KPIs
register("kpi_product")(lambda spark, d: reports.kpi_product(_m(spark, d).product))
register("kpi_retention")(
    lambda spark, d: reports.kpi_retention(_m(spark, d).retention, TEST_LIFETIME_DAYS))
register("kpi_retention_weekly")(
    lambda spark, d: reports.kpi_retention_weekly(_m(spark, d).retention, TEST_LIFETIME_DAYS))
register("kpi_tracks")(lambda spark, d: reports.kpi_tracks(_m(spark, d).track, TEST_KPI_TRACK_MIN))

# extracts
register("export_product_day")(lambda spark, d: exports.export_product_day(_m(spark, d).product))


@register("export_track_quality")
def _q_export_track_quality(spark, d):
    tracks, brackets = _track_and_brackets(spark, d)
    return exports.export_track_quality(tracks, exports.track_thresholds(tracks, brackets))



register("export_retention_cohort")(
    lambda spark, d: exports.export_retention_cohort(_m(spark, d).retention))
register("export_funnel")(lambda spark, d: exports.export_funnel(_m(spark, d).funnel))
register("export_recommendation_quality")(
    lambda spark, d: exports.export_recommendation_quality(_m(spark, d).product))

# the extracts as the text that the CSV files hold
for _name in ("product_day", "track_quality", "retention_cohort", "funnel", "recommendation_quality"):
    register(f"csv_{_name}")(lambda spark, d, key=f"export_{_name}": csv_frame(QUERIES[key](spark, d)))
