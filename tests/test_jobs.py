"""End-to-end build and export on the smallest fixture."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from listenlab.plans import jobs, store
from listenlab.settings import DEFAULT
from listenlab.sources import load_fixture
from listenlab.sources.sinks import csv_frame


def test_build_and_export(spark, tmp_path):
    out = str(tmp_path / "marts")
    src = load_fixture(spark, SF001)
    low = DEFAULT.with_(track_min_listens=20)  # sf0.001 tracks have < 100 listens
    report = jobs.build_marts(spark, None, out, source_df=src, settings=low)
    events = src.count()
    assert report["source"]["events"] == events
    assert all(report["checks"].values()) and len(report["checks"]) == 11
    assert report["marts"]["mart_recommendation_funnel.parquet"]["rows"] == 4
    # observed totals (collected during the writes) equal a re-count of the files
    for name, summary in report["summaries"].items():
        assert summary["rows"] == spark.read.parquet(f"{out}/{name}.parquet").count(), name
    assert report["summaries"]["mart_product_day"]["events"] == events
    text = "".join(open(p, encoding="utf-8").read()
                   for p in glob.glob(f"{out}/mart_build_report.json/part-*"))
    assert json.loads(text)["definitions"]["session_gap_seconds"] == 1800

    # reuse the written stage: same marts
    again = jobs.build_marts(spark, None, out + "2", stage_path=f"{out}/_stage_events.parquet",
                                 reuse_stage=True, source_df=src, settings=low)
    assert again["marts"] == report["marts"]

    exp = str(tmp_path / "exports")
    er = jobs.export_all(spark, out, exp, settings=low)
    assert er["rows"]["03_retention/recommendation_funnel.csv"] == 4
    assert er["rows"]["03_retention/recommendation_quality.csv"] == 2
    assert all(er["checks"].values())
    part = glob.glob(os.path.join(exp, "03_retention/recommendation_quality.csv/part-*.csv"))[0]
    raw = open(part, "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfsource_order,")               # BOM before the header
    lines = raw.decode("utf-8-sig").splitlines()
    assert lines[1].split(",")[5].count(".") == 1 and len(lines[1].split(",")[5].split(".")[1]) == 8
    assert er["files"]["03_retention/recommendation_quality.csv"]["files"] == 1
    product_csv = glob.glob(os.path.join(exp, "01_product/product_day.csv/part-*.csv"))[0]
    assert ",True" in open(product_csv, encoding="utf-8-sig").read()  # booleans as True/False


def _marts(spark, stage, out):
    jobs.build_product_mart(spark, stage, f"{out}/p")
    jobs.build_recommendation_funnel(spark, stage, f"{out}/f")
    jobs.build_user_mart(spark, stage, f"{out}/u")
    jobs.build_user_day_mart(spark, stage, f"{out}/d")
    jobs.build_retention_mart(spark, stage, f"{out}/r")
    jobs.build_track_mart(spark, stage, f"{out}/t")
    return {n: sorted(map(str, spark.read.parquet(f"{out}/{n}").collect())) for n in "pfudrt"}


def test_a_rebuilt_stage_renews_what_is_derived_from_it(spark, tmp_path):
    src = load_fixture(spark, SF001)
    stage = str(tmp_path / "stage")
    jobs.prepare_events(spark, None, stage, source_df=src)
    _marts(spark, stage, str(tmp_path / "all"))
    jobs.prepare_events(spark, None, stage, source_df=src.where("uid = 3"))
    jobs.prepare_events(spark, None, str(tmp_path / "fresh"), source_df=src.where("uid = 3"))
    assert _marts(spark, stage, str(tmp_path / "again")) == _marts(spark, str(tmp_path / "fresh"), str(tmp_path / "new"))


def test_builders_need_a_prepared_stage(spark, tmp_path):
    load_fixture(spark, SF001).write.parquet(str(tmp_path / "stage"))
    with pytest.raises(FileNotFoundError):
        jobs.build_user_mart(spark, str(tmp_path / "stage"), str(tmp_path / "u"))
    (tmp_path / "not-parquet").mkdir()
    (tmp_path / "not-parquet" / "x.parquet").write_text("no")
    with pytest.raises(Exception) as caught:  # any other error keeps its own name
        jobs._stage(spark, str(tmp_path / "not-parquet"))
    assert not isinstance(caught.value, FileNotFoundError)


def test_retention_mart_is_ordered_by_cohort_then_lifetime(spark, tmp_path):
    stage = str(tmp_path / "stage")
    jobs.prepare_events(spark, None, stage, source_df=load_fixture(spark, SF001))
    jobs.build_retention_mart(spark, stage, str(tmp_path / "r"))
    rows = [tuple(r) for r in spark.read.parquet(str(tmp_path / "r")).select(
        "cohort_day", "recommendation_bucket", "engagement_bucket", "lifetime_day").coalesce(1).collect()]
    files = sorted(glob.glob(str(tmp_path / "r" / "part-*")))
    ordered = [tuple(r) for f in files for r in spark.read.parquet(f).select(
        "cohort_day", "recommendation_bucket", "engagement_bucket", "lifetime_day").collect()]
    assert ordered == sorted(rows)


def test_floats_are_written_as_their_binary_value(spark):
    values = [1 / 512, 5 / 512, 0.123456785, 1 / 3, 0.0, -0.5, 1e15, float("nan"), None]
    text = [r[0] for r in csv_frame(spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)).collect()]
    assert text == ["%.8f" % v if v is not None and v == v else None for v in values]
    assert text[:2] == ["0.00195312", "0.00976562"]


def test_a_track_mart_without_its_columns_is_not_exported(spark, tmp_path):
    spark.range(3).withColumnRenamed("id", "item_id").write.parquet(str(tmp_path / "mart_track.parquet"))
    with pytest.raises(ValueError, match="is_reliable_sample"):
        jobs.export_tracks(spark, str(tmp_path), str(tmp_path / "out"))


def test_a_failed_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    src, stage = load_fixture(spark, SF001), str(tmp_path / "stage")
    jobs.prepare_events(spark, None, stage, source_df=src)
    tables = ("_stage", "_base", "_tracks")
    held = [sorted(map(str, getattr(jobs, t)(spark, stage).collect())) for t in tables]
    real = jobs.write_parquet

    def fails_at(file):
        def write(df, path, *args):
            if path.endswith(file):
                raise OSError("lost the disk")
            real(df, path, *args)
        return write

    for file in (jobs.STAGE_FILE, jobs.BASE_FILE, jobs.TRACKS_FILE):
        monkeypatch.setattr(jobs, "write_parquet", fails_at(file))
        with pytest.raises(OSError):
            jobs.prepare_events(spark, None, stage, source_df=src.where("uid = 3"))
        monkeypatch.setattr(jobs, "write_parquet", real)
        assert [sorted(map(str, getattr(jobs, t)(spark, stage).collect())) for t in tables] == held
    # a failing manifest is no commit either
    monkeypatch.setattr(store, "write_json", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.prepare_events(spark, None, stage, source_df=src.where("uid = 3"))
    monkeypatch.undo()
    assert [sorted(map(str, getattr(jobs, t)(spark, stage).collect())) for t in tables] == held
    reader = jobs._stage(spark, stage)
    jobs.prepare_events(spark, None, stage, source_df=src.where("uid = 3"))
    assert {r[0] for r in jobs._base(spark, stage).select("uid").distinct().collect()} == {3}
    assert reader.count() == len(held[0])  # who follows the version before still can
    for _ in range(3):
        jobs.prepare_events(spark, None, stage, source_df=src.where("uid = 3"))
    versions = [n for n in os.listdir(stage) if n.startswith("v")]
    assert len(versions) == 2 and store.current(spark, stage).number == 5


def test_only_a_stage_of_the_same_source_is_reused(spark, tmp_path):
    src, stage = load_fixture(spark, SF001), str(tmp_path / "stage")
    with pytest.raises(FileNotFoundError):
        jobs.reused_profile(spark, None, stage, source_df=src)
    profile = jobs.prepare_events(spark, None, stage, source_df=src)
    assert jobs.reused_profile(spark, None, stage, source_df=src.repartition(5)) == profile
    with pytest.raises(ValueError, match="another source"):
        jobs.reused_profile(spark, None, stage, source_df=src.where("uid = 3"))
    with pytest.raises(ValueError, match="another source"):  # the same totals, other rows
        jobs.reused_profile(spark, None, stage, source_df=src.withColumn("played_ratio_pct", F.col("played_ratio_pct") + 1))
    with pytest.raises(ValueError, match="session_gap_seconds"):
        jobs.reused_profile(spark, None, stage, DEFAULT.with_(session_gap_seconds=60), src)
    assert jobs.reused_profile(spark, None, stage, DEFAULT.with_(track_min_listens=5), src) == profile
    version = store.current(spark, stage)
    jobs.build_marts(spark, None, str(tmp_path / "marts"), stage, reuse_stage=True, source_df=src)
    assert store.current(spark, stage) == version  # kept, not written again


def test_unchanged_files_are_known_without_a_scan(spark, tmp_path, monkeypatch):
    src, stage = str(tmp_path / "src"), str(tmp_path / "stage")
    load_fixture(spark, SF001).write.parquet(src)
    profile = jobs.prepare_events(spark, src, stage)
    monkeypatch.setattr(jobs.source, "source_identity", lambda *_: 1 / 0)
    assert jobs.reused_profile(spark, src, stage) == profile
    monkeypatch.undo()
    load_fixture(spark, SF001).write.mode("overwrite").parquet(src)  # other files, the same rows
    assert jobs.reused_profile(spark, src, stage) == profile
    load_fixture(spark, SF001).limit(1).write.mode("append").parquet(src)
    with pytest.raises(ValueError, match="another source"):
        jobs.reused_profile(spark, src, stage)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("built"))
    jobs.build_marts(spark, None, out, f"{out}/stage", source_df=load_fixture(spark, SF001), settings=DEFAULT.with_(track_min_listens=20))
    return out


def test_checks_need_no_scan_after_the_writes(spark, built, monkeypatch):
    monkeypatch.setattr(jobs.metrics, "measured", lambda *_: 1 / 0)
    assert all(jobs.validate_all_marts(spark, f"{built}/stage", built).values())


def test_measures_of_the_writes_are_those_of_a_scan(spark, built):
    for name, file in jobs.MART_FILES.items():
        scanned = jobs.metrics.measured(spark.read.parquet(f"{built}/{file}"), name).first().asDict()
        kept = store.read_json(spark, f"{built}/{file}/{jobs.MEASURES_FILE}")["measures"]
        assert {k: kept[k] for k in scanned} == scanned and kept["rows"] > 0


@pytest.mark.parametrize("mart, change, failing", [
    ("mart_product_day", lambda d: d.withColumn("events", F.col("events") + 1), "product_events_match_source"),
    ("mart_product_day", lambda d: d.withColumn("listens", F.col("listens") + 1), "product_listens_match_source"),
    ("mart_product_day", lambda d: d.withColumn("listener_like_rate", F.lit(1.5)), "product_reaction_rates_are_valid"),
    ("mart_product_day", lambda d: d.withColumn("listener_likers", F.col("listener_likers") + 1), "product_reactions_match_user_day"),
    ("mart_user", lambda d: d.unionByName(d.limit(1)), "user_key_is_unique"),
    ("mart_user", lambda d: d.where("uid <> 3"), "user_key_is_unique"),
    ("mart_user_day", lambda d: d.unionByName(d.limit(1)), "user_day_key_is_unique"),
    ("mart_user_day", lambda d: d.withColumn("listens", F.col("listens") * 2), "user_day_listens_match_source"),
    ("mart_retention_cohort", lambda d: d.unionByName(d.limit(1)), "retention_key_is_unique"),
    ("mart_retention_cohort", lambda d: d.withColumn("retention_rate", F.col("retention_rate") / 2), "retention_rates_are_valid"),
    ("mart_track", lambda d: d.where("item_id <> 0"), "track_key_is_unique"),
    ("mart_track", lambda d: d.unionByName(d.limit(1)), "track_key_is_unique"),
    ("mart_recommendation_funnel", lambda d: d.withColumn("events", F.when(F.col("step_order") == 4, 10 ** 9).otherwise(F.col("events"))), "funnel_is_valid"),
    ("mart_recommendation_funnel", lambda d: d.where("step_order < 4"), "funnel_is_valid"),
])
def test_a_corrupted_mart_fails_its_check(spark, built, mart, change, failing):
    totals = store.current(spark, f"{built}/stage").facts["totals"]
    bad = change(spark.read.parquet(f"{built}/{mart}.parquet"))
    # by the measures of its own write, and by a scan of what somebody else wrote
    marked = jobs.metrics.in_order(bad, jobs.MART_KEYS[mart])
    written = marked.agg(*[m.alias(k) for k, m in jobs.metrics.observed(marked, mart).items()]).first().asDict()
    for measures in (written, jobs.metrics.measured(bad, mart).first().asDict()):
        held = {n: measures if n == mart else jobs._measures(spark, f"{built}/{f}", n) for n, f in jobs.MART_FILES.items()}
        result = jobs.metrics.checks_of(totals, held)
        assert result[failing] is False and sum(result.values()) >= 8


def test_a_mart_written_by_others_is_measured_again(spark, built, tmp_path):
    import shutil

    shutil.copytree(built, tmp_path / "copy")
    out = str(tmp_path / "copy")
    user = spark.read.parquet(f"{built}/mart_user.parquet")
    user.limit(1).write.mode("append").parquet(f"{out}/mart_user.parquet")  # the measures of the write lie there still
    with pytest.raises(RuntimeError, match="'user_key_is_unique': False"):
        jobs.validate_all_marts(spark, f"{out}/stage", out)
    user.write.mode("overwrite").parquet(f"{out}/mart_user.parquet")
    assert not os.path.exists(f"{out}/mart_user.parquet/{jobs.MEASURES_FILE}")
    assert all(jobs.validate_all_marts(spark, f"{out}/stage", out).values())


def test_marts_lie_in_the_order_of_their_keys(spark, tmp_path):
    rows = [(u, d) for u in range(200) for d in range(u % 5 + 1)]
    df = spark.createDataFrame(rows, "uid long, day_idx long").repartition(7)
    marked = jobs.metrics.in_order(df, ["uid", "day_idx"])
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("rangepartitioning") == 1  # the marks need no shuffle of their own
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        jobs.metrics.plain(marked).write.parquet(str(tmp_path / "t"))
        df.write.parquet(str(tmp_path / "mixed"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(str(tmp_path / "t" / "part-*"))) > 4
    found = jobs.metrics.file_order(spark.read.parquet(str(tmp_path / "t")), ["uid", "day_idx"]).first()
    assert tuple(found) == (len(rows), True, True)
    found = jobs.metrics.file_order(spark.read.parquet(str(tmp_path / "mixed")), ["uid", "day_idx"]).first()
    assert tuple(found) == (len(rows), False, False)


def test_broken_text_is_counted_by_the_write(spark, tmp_path):
    df = spark.createDataFrame([("fine", 1.5), ("bad ??? text", None), (None, 2.0), ("�", 3.0)], "a string, b double")
    written = jobs._write_extract(df, str(tmp_path), "product_day", False)
    assert (written.rows, written.broken) == (4, 2)
    written.frame.unpersist()
    clean = jobs._write_extract(df.where("b = 1.5").withColumnRenamed("a", "na???me"), str(tmp_path), "product_day", True)
    assert (clean.rows, clean.broken) == (1, 1)
