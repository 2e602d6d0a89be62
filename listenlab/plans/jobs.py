"""End-to-end jobs: build every mart from the event log, export the
dashboard extracts. The only module that writes.

Plan shape at scale: ``prepare_events`` scans the source three times (gate,
and the stage's rows and session spans) and writes the stage, its user-day
base and its distinct listened tracks as one version (``plans.store``): a
reader sees the three of one version, whatever happens to a later attempt.
Each builder reads what it needs of the three and writes one mart in the
order of its key. Summaries and the measures that the checks need are
collected with ``observe`` during the write and kept in the mart's folder, so
the checks read no mart, stage or base again.

Function map (one per step of the original tool): ``prepare_events``,
``build_product_mart``, ``build_recommendation_funnel``, ``build_user_mart``,
``build_user_day_mart``, ``build_retention_mart``, ``build_track_mart``,
``validate_all_marts``, ``build_marts``; ``export_product``,
``export_tracks``, ``export_retention``, ``export_funnel``,
``export_source_quality``, ``validate_exports``, ``export_all``.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from listenlab.functions.measures import cnt, count_if
from listenlab.functions.quantiles import bracket_measures
from listenlab.operators import checks, exports, funnel, metrics, product, reports, retention, source, stage as stage_ops, \
    track, user
from listenlab.operators.base import user_day_base, user_day_tracks
from listenlab.operators.summary import MART_KEYS
from listenlab.plans import store
from listenlab.plans.materialize import materialize
from listenlab.settings import DEFAULT, Settings
from listenlab.sources import read_interactions
from listenlab.sources.sinks import csv_frame, write_csv_text, write_parquet

MART_FILES = {name: f"{name}.parquet" for name in MART_KEYS}
STAGE_FILE, BASE_FILE, TRACKS_FILE = "stage.parquet", "user_day_base.parquet", "user_day_tracks.parquet"
#: In a mart's folder; readers of tables pass over names that start so, and a rewrite of the mart deletes it.
MEASURES_FILE = "_measures.json"
#: Settings that the stage's columns depend on.
STAGE_SETTINGS = ("day_seconds", "session_gap_seconds", "listen_plus_threshold", "replay_threshold")


def _p(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _read(spark: SparkSession, path: str, what: str, advice: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"{what} not found at {path}. {advice}") from exc


def _write_mart(df: DataFrame, path: str, mart: str, **more) -> dict:
    """Write a mart in the order of its key with its measures beside it, and
    return them. ``more`` are measures of the one mart."""
    spark, marked, obs = df.sparkSession, metrics.in_order(df, MART_KEYS[mart]), Observation()
    # observe above the sort: dealing by ranges samples its input in a
    # separate pass, which would otherwise be counted too
    measures = metrics.observed(marked, mart) | more
    write_parquet(metrics.plain(marked.observe(obs, *[m.alias(k) for k, m in measures.items()])), path)
    found = dict(obs.get)
    store.write_json(spark, _p(path, MEASURES_FILE), {"measures": found, "files": store.fingerprint(spark, path)})
    return found


def _measures(spark: SparkSession, path: str, mart: str) -> dict:
    """The measures from the mart's write; by a scan where it was not written
    here, or its files are others by now."""
    kept = store.read_json(spark, _p(path, MEASURES_FILE))
    if kept and kept["files"] == store.fingerprint(spark, path):
        return kept["measures"]
    return metrics.measured(_read(spark, path, mart, "Build the marts first."), mart).first().asDict()


# --- stage -------------------------------------------------------------------

def prepare_events(spark: SparkSession, source_path: str | None, stage_path: str,
                   settings: Settings = DEFAULT, source_df: DataFrame | None = None) -> dict:
    """Profile and gate the source, write the stage with its base and tracks,
    reconcile its row count, then let readers of ``stage_path`` see the three.
    Returns the source profile."""
    src = source_df if source_df is not None else read_interactions(spark, source_path)
    # taken before the rows are read: a file that changes meanwhile makes the stage one of other files
    files = store.fingerprint(spark, source_path) if source_path else {}
    profile = source.check_gate(src)
    version, obs = store.begin(spark, stage_path), Observation()
    # no sort: the window already leaves rows clustered by user and time
    events = stage_ops.stage_events(src, settings).observe(obs, cnt().alias("events"), count_if("is_listen").alias("listens"))
    write_parquet(events, version.path(STAGE_FILE))
    written = obs.get
    if written["events"] != profile["events"]:
        raise RuntimeError(f"stage rows {written['events']} != source rows {profile['events']}")
    stage = spark.read.parquet(version.path(STAGE_FILE))
    _concurrently({
        "base": lambda: write_parquet(user_day_base(stage), version.path(BASE_FILE)),
        "tracks": lambda: write_parquet(user_day_tracks(stage), version.path(TRACKS_FILE)),
    })
    version.commit(profile=profile, files=files, settings={k: getattr(settings, k) for k in STAGE_SETTINGS},
                   totals={"events": written["events"], "listens": written["listens"], "users": profile["users"], "items": profile["items"]})
    return _without_content(profile)


def _without_content(profile: dict) -> dict:
    return {k: v for k, v in profile.items() if k != "content"}


def _table(spark: SparkSession, stage_path: str, name: str, what: str) -> DataFrame:
    version = store.current(spark, stage_path)
    if version is None and name == STAGE_FILE:  # nothing was committed here: a folder of another kind has its own error
        _read(spark, stage_path, what, "Run prepare_events first.")
    if version is None:
        raise FileNotFoundError(f"{what} not found at {stage_path}. Run prepare_events first.")
    return _read(spark, version.path(name), what, "Run prepare_events first.")


def _stage(spark, stage_path):
    return _table(spark, stage_path, STAGE_FILE, "stage")


def _base(spark, stage_path):
    return _table(spark, stage_path, BASE_FILE, "user-day base")


def _tracks(spark, stage_path):
    return _table(spark, stage_path, TRACKS_FILE, "listened tracks")


def reused_profile(spark: SparkSession, source_path: str | None, stage_path: str, settings: Settings = DEFAULT,
                   source_df: DataFrame | None = None) -> dict:
    """The source profile of the committed stage, if it is a stage of this
    source under these settings; ValueError says which differ. Unchanged
    files say so by themselves; other files, or a frame, have to hold the
    same rows."""
    version = store.current(spark, stage_path)
    if version is None:
        raise FileNotFoundError(f"stage not found at {stage_path}. Run prepare_events first.")
    other = {k: v for k in STAGE_SETTINGS if (v := getattr(settings, k)) != version.facts["settings"][k]}
    if other:
        raise ValueError(f"the stage at {stage_path} was prepared with other settings than {other}")
    held = version.facts["profile"]
    if source_df is None and version.facts["files"] and store.fingerprint(spark, source_path) == version.facts["files"]:
        return _without_content(held)
    src = source_df if source_df is not None else read_interactions(spark, source_path)
    found = source.source_identity(src).withColumn("content", F.col("content").cast("string")).first().asDict()
    if found != held:
        raise ValueError(f"the stage at {stage_path} is of another source: {held}, not {found}")
    return _without_content(held)


# --- marts -------------------------------------------------------------------

def build_product_mart(spark, stage_path: str, output_path: str) -> dict:
    found = _write_mart(product.product_day(_stage(spark, stage_path), _base(spark, stage_path), _tracks(spark, stage_path)),
                        output_path, "mart_product_day")
    return {k: found[k] for k in ("rows", "events", "listens")}


def build_recommendation_funnel(spark, stage_path: str, output_path: str) -> dict:
    found = _write_mart(funnel.recommendation_funnel(_stage(spark, stage_path), _base(spark, stage_path)),
                        output_path, "mart_recommendation_funnel")
    return {"rows": found["rows"]}


def build_user_mart(spark, stage_path: str, output_path: str) -> dict:
    mart = user.user_mart(_stage(spark, stage_path), _base(spark, stage_path), _tracks(spark, stage_path))
    found = _write_mart(mart, output_path, "mart_user")
    return {k: found[k] for k in ("rows", "sessions")}


def build_user_day_mart(spark, stage_path: str, output_path: str) -> dict:
    mart = user.user_day(_stage(spark, stage_path), _base(spark, stage_path), _tracks(spark, stage_path))
    found = _write_mart(mart, output_path, "mart_user_day")
    return {k: found[k] for k in ("rows", "users")}


def build_retention_mart(spark, stage_path: str, output_path: str) -> dict:
    found = _write_mart(retention.retention_cohort(_stage(spark, stage_path), _base(spark, stage_path)), output_path, "mart_retention_cohort")
    return {"rows": found["rows"]}


def build_track_mart(spark, stage_path: str, output_path: str, settings: Settings = DEFAULT) -> dict:
    # the brackets of the quality quartiles come with the write
    brackets = bracket_measures(reports.QUALITY_SHARES, F.col("is_reliable_sample"))
    found = _write_mart(track.track_mart(_stage(spark, stage_path), settings), output_path, "mart_track", **brackets)
    return {"rows": found["rows"]}


def validate_all_marts(spark, stage_path: str, mart_dir: str) -> dict[str, bool]:
    """The eleven reconciliation checks of the written marts, from the totals
    of the stage's version and the measures of each mart; raises on failure."""
    version = store.current(spark, stage_path)
    if version is None:
        raise FileNotFoundError(f"stage not found at {stage_path}. Run prepare_events first.")
    found = _concurrently({name: partial(_measures, spark, _p(mart_dir, file), name) for name, file in MART_FILES.items()})
    return checks.raise_unless_all(metrics.checks_of(version.facts["totals"], found))


def _concurrently(jobs: dict) -> dict:
    """Run independent write jobs from driver threads (the marts only share
    their written inputs); Spark schedules their stages side by side."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def _write_report(spark: SparkSession, report: dict, path: str) -> None:
    """The (small, fixed-shape) report dict as indented UTF-8 JSON text."""
    text = json.dumps(report, ensure_ascii=False, indent=2, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def build_marts(spark: SparkSession, source_path: str | None, output_dir: str, stage_path: str | None = None,
                settings: Settings = DEFAULT, reuse_stage: bool = False,
                source_df: DataFrame | None = None) -> dict:
    """Gate the source, write the stage, the six marts and the report.

    ``reuse_stage`` keeps the committed stage, base and tracks instead of
    rebuilding them; a stage of another source or settings is refused."""
    stage_path = stage_path or _p(output_dir, "_stage_events.parquet")
    if reuse_stage:
        profile = reused_profile(spark, source_path, stage_path, settings, source_df)
    else:
        profile = prepare_events(spark, source_path, stage_path, settings, source_df)

    paths = {name: _p(output_dir, f) for name, f in MART_FILES.items()}
    builders = {
        "mart_product_day": lambda: build_product_mart(spark, stage_path, paths["mart_product_day"]),
        "mart_recommendation_funnel": lambda: build_recommendation_funnel(
            spark, stage_path, paths["mart_recommendation_funnel"]),
        "mart_user": lambda: build_user_mart(spark, stage_path, paths["mart_user"]),
        "mart_user_day": lambda: build_user_day_mart(spark, stage_path, paths["mart_user_day"]),
        "mart_retention_cohort": lambda: build_retention_mart(spark, stage_path, paths["mart_retention_cohort"]),
        "mart_track": lambda: build_track_mart(spark, stage_path, paths["mart_track"], settings),
    }
    summaries = _concurrently(builders)
    result = validate_all_marts(spark, stage_path, output_dir)
    report = {
        "source": {k: profile[k] for k in ("events", "listens", "users", "items")},
        "marts": {MART_FILES[k]: {"rows": v["rows"], "key": MART_KEYS[k]} for k, v in summaries.items()},
        "summaries": summaries,
        "checks": result,
        "definitions": {
            "day_seconds": settings.day_seconds,
            "session_gap_seconds": settings.session_gap_seconds,
            "listen_plus_threshold": settings.listen_plus_threshold,
            "track_min_listens": settings.track_min_listens,
        },
    }
    _write_report(spark, report, _p(output_dir, "mart_build_report.json"))
    return report


# --- extracts ----------------------------------------------------------------

EXTRACT_FILES = {
    "product_day": "01_product/product_day.csv",
    "track_quality": "02_tracks/track_quality.csv",
    "retention_cohort": "03_retention/retention_cohort.csv",
    "recommendation_funnel": "03_retention/recommendation_funnel.csv",
    "recommendation_quality": "03_retention/recommendation_quality.csv",
}


def _mart(spark, mart_dir, name):
    return _read(spark, _p(mart_dir, MART_FILES[name]), f"mart {name}", "Run build_marts first.")


@dataclass(frozen=True)
class Extract:
    """A written extract: its frame, kept for the checks, its rows, and its
    values and column names that hold text of a broken encoding."""
    frame: DataFrame
    rows: int
    broken: int


def _write_extract(df: DataFrame, output_dir: str, name: str, single_file: bool) -> Extract:
    """Write one extract; count its rows, and the broken ones of its rendered
    values, on the way. The frame stays in executor memory and disk, so that
    the checks don't compute it again."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    text, obs = csv_frame(df), Observation()
    broken = [F.count(F.when(checks.is_broken(F.col(f"`{c}`")), 1)) for c in text.columns]
    write_csv_text(text.observe(obs, cnt().alias("rows"), sum(broken[1:], broken[0]).alias("broken")),
                   _p(output_dir, EXTRACT_FILES[name]), single_file)
    names = sum(any(b in c for b in checks.BAD_TEXT) for c in text.columns)
    return Extract(df, obs.get["rows"], obs.get["broken"] + names)


def export_product(spark, mart_dir: str, output_dir: str, single_file: bool = True) -> Extract:
    df = exports.export_product_day(_mart(spark, mart_dir, "mart_product_day"))
    return _write_extract(df, output_dir, "product_day", single_file)


def track_thresholds(spark, mart_dir: str) -> DataFrame:
    """The quartile thresholds of the track mart as a written table of one
    row, which the extract and the report read. With the brackets from the
    mart's write the mart is read once for them."""
    t, path = _mart(spark, mart_dir, "mart_track"), _p(mart_dir, MART_FILES["mart_track"])
    kept = _measures(spark, path, "mart_track")
    brackets = {n: kept[n] for n in reports.QUALITY_SHARES} if set(reports.QUALITY_SHARES) <= set(kept) else None
    return materialize(exports.track_thresholds(t, brackets), "track_thresholds")


def export_tracks(spark, mart_dir: str, output_dir: str) -> tuple[Extract, dict]:
    """Reliable tracks (one row each, so the CSV stays multi-part) and the
    quartile thresholds. A mart without the columns of the contract raises."""
    t = _mart(spark, mart_dir, "mart_track")
    missing = checks.track_columns_contract(t)
    if missing:
        raise ValueError(f"mart_track is missing {missing}; its columns: {source.source_schema(t)}")
    limits = track_thresholds(spark, mart_dir)
    written = _write_extract(exports.export_track_quality(t, limits), output_dir, "track_quality", single_file=False)
    return written, limits.first().asDict()


def export_retention(spark, mart_dir: str, output_dir: str) -> Extract:
    """Cohort x buckets x lifetime days (grows with the square of the day
    span): written multi-part, like the track extract."""
    df = exports.export_retention_cohort(_mart(spark, mart_dir, "mart_retention_cohort"))
    return _write_extract(df, output_dir, "retention_cohort", single_file=False)


def export_funnel(spark, mart_dir: str, output_dir: str) -> Extract:
    df = exports.export_funnel(_mart(spark, mart_dir, "mart_recommendation_funnel"))
    return _write_extract(df, output_dir, "recommendation_funnel", single_file=True)


def export_source_quality(product_mart: DataFrame, output_dir: str) -> Extract:
    return _write_extract(exports.export_recommendation_quality(product_mart), output_dir, "recommendation_quality", single_file=True)


def validate_exports(extracts: dict[str, Extract], min_listens: int = DEFAULT.track_min_listens) -> dict[str, bool]:
    """Export checks, with the broken values that the writes counted: nothing is read back."""
    frames = [extracts[n].frame for n in ("product_day", "track_quality", "retention_cohort", "recommendation_funnel", "recommendation_quality")]
    return checks.raise_on_failure(checks.export_checks(
        *frames, min_listens=min_listens, text_ok=F.lit(not any(e.broken for e in extracts.values()))), "export checks")


def export_files(spark: SparkSession, output_dir: str) -> DataFrame:
    """extract, files, bytes of the written extracts, from the listing."""
    extract = F.regexp_extract("path", r"([^/]+/[^/]+\.csv)/[^/]*$", 1)
    return store.files_of(spark, _p(output_dir, "*/*.csv")).groupBy(extract.alias("extract")).agg(
        cnt().alias("files"), F.sum("length").alias("bytes"))


def export_all(spark: SparkSession, mart_dir: str, output_dir: str, settings: Settings = DEFAULT,
               single_file: bool = True) -> dict:
    """Write the five dashboard extracts as CSV, check them, report rows,
    thresholds and file sizes. Each extract is computed once."""
    done = _concurrently({
        "product_day": lambda: export_product(spark, mart_dir, output_dir, single_file),
        "track_quality": lambda: export_tracks(spark, mart_dir, output_dir),
        "retention_cohort": lambda: export_retention(spark, mart_dir, output_dir),
        "recommendation_funnel": lambda: export_funnel(spark, mart_dir, output_dir),
        "recommendation_quality": lambda: export_source_quality(
            _mart(spark, mart_dir, "mart_product_day"), output_dir),
    })
    done["track_quality"], thresholds = done["track_quality"]
    try:
        result = validate_exports(done, settings.track_min_listens)
    finally:
        for written in done.values():
            written.frame.unpersist()
    return {
        "rows": {EXTRACT_FILES[name]: written.rows for name, written in done.items()},
        "track_thresholds": thresholds,
        "checks": result,
        # one row per extract, however many part files it has
        "files": {r["extract"]: {"files": r["files"], "bytes": r["bytes"]} for r in export_files(spark, output_dir).collect()},
    }
