"""Source gate and profile (T27), contract, fixture mapping."""

import pytest

from conftest import SF001, SF01, interactions, listen, react
from listenlab.operators import source
from listenlab.sources import load_fixture, read_interactions


@pytest.mark.parametrize("sf", [SF001, SF01, "/root/testdata/sf0.1"])
def test_fixture_mapping_keeps_every_event(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    copies = events.where("event_id % 50 = 0").count()
    p = source.source_profile(load_fixture(spark, sf)).first()
    assert p.events == events.count() + copies and p.items == 52


def test_fixture_reaches_day_thirty(spark):
    from listenlab.operators import exports
    from listenlab.plans.registry import Marts

    out = exports.export_retention_cohort(Marts(spark, SF01).retention)
    assert out.where("lifetime_day = 30").count() > 0 and out.where("is_mature_d30").count() > 0


def test_profile_reads_the_source_once(spark, tmp_path):
    load_fixture(spark, SF001).write.parquet(str(tmp_path / "src"))
    src = read_interactions(spark, str(tmp_path / "src"))
    for df in (source.source_profile(src), source.source_quality(src)):
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_gate_fails_on_null_required_and_unknown_type(spark):
    bad_null = interactions(spark, [listen(1, 1, 0), (None, 1, 5, 1, "listen", 10.0, 100.0)])
    with pytest.raises(ValueError):
        source.check_gate(bad_null)
    bad_type = interactions(spark, [listen(1, 1, 0), (1, 1, 5, 1, "skip", None, None)])
    with pytest.raises(ValueError):
        source.check_gate(bad_type)


def test_gate_accepts_unknown_organic_flag(spark):
    src = interactions(spark, [listen(1, 1, 0, organic=2)])
    assert source.check_gate(src)["invalid_is_organic"] == 1


def test_gate_fails_on_empty_source(spark):
    empty = interactions(spark, [listen(1, 1, 0)]).limit(0)
    with pytest.raises(ValueError):
        source.check_gate(empty)
    assert source.source_gate(empty).first().ok is False


def test_contract_requires_columns(spark):
    from listenlab.sources import to_contract

    with pytest.raises(ValueError):
        to_contract(spark.createDataFrame([(1, 2)], "uid long, item_id long"))


def test_missing_source_raises_with_advice(spark):
    with pytest.raises(FileNotFoundError):
        read_interactions(spark, "/nonexistent/events.parquet")


def test_source_manifest_checks_expected_rows(spark):
    raw = spark.read.parquet(f"{SF01}/events.parquet")
    ok = source.source_manifest(raw, expected_rows=10_000).collect()
    assert len(ok) == 1 and ok[0].rows == 10_000 and ok[0].rows_match_expected is True
    assert ok[0].file_size > 0
    bad = source.source_manifest(raw, expected_rows=47_790_449).first()
    assert bad.rows_match_expected is False


def test_duplicates_are_compared_where_hashes_repeat(spark, monkeypatch):
    rows = [listen(1, 1, 0), listen(1, 1, 0), listen(1, 1, 0), react(1, 1, 0), react(1, 1, 0), listen(2, 1, 0), listen(1, 1, 0, ratio=float("nan")),
            listen(1, 1, 0, ratio=float("nan")), listen(3, 1, 0, ratio=0.0), listen(3, 1, 0, ratio=-0.0), listen(1, 1, 5, length=None), listen(1, 1, 5, length=None)]
    df = interactions(spark, rows).repartition(3)
    assert source.duplicate_rows(df).first()[0] == 2 + 1 + 1 + 1 + 1
    plan = source.duplicate_rows(df)._jdf.queryExecution().executedPlan().toString()
    # before the join, hashes and counts are all that moves
    wide = [line for line in plan.split("\n") if "hashpartitioning(uid" in line]
    assert len(wide) == 1 and "LeftSemi" in plan.split(wide[0])[1] and "LeftSemi" not in plan.split(wide[0])[0]
    # rows that only share a hash are no duplicates
    monkeypatch.setattr(source.F, "xxhash64", lambda *_: source.F.lit(7))
    assert source.duplicate_rows(df).first()[0] == 6
