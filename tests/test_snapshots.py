"""Versioned archive: atomic merges, readers of old versions, clones, and the index from serial to day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyscope.schema import ROUND
from tallyscope.sources import archive as ar
from tallyscope.sources import snapshots as sn
from tests.test_jobs import round_row

DAY = dt.datetime(2024, 1, 1)


def rounds(spark, rows):
    return spark.createDataFrame(rows, ROUND)


def source(spark, rows):
    return rounds(spark, rows).withColumns(
        {"ReportDate": F.col("report_date"), "validBet": F.col("valid_bet"), "hasFreegame": F.lit("False"), "test_demo_play": F.lit("False")}
    ).drop("report_date", "valid_bet", "triggered")


@pytest.fixture
def archive(spark, place):
    path = f"{place}/archive"
    ar.bootstrap_archive(rounds(spark, [round_row(i, DAY + dt.timedelta(days=i % 5)) for i in range(40)]), path)
    return path


def moved(serial, day, later=9):
    return round_row(serial, DAY + dt.timedelta(days=day), win=5.0, modified=DAY + dt.timedelta(days=later))


def held(spark, path, version=None):
    return sorted((r["serial"], str(r["event_date"]), r["win"]) for r in ar.read_archive(spark, path, version).collect())


def test_a_crash_before_the_commit_shows_the_old_version(spark, archive, monkeypatch):
    before = held(spark, archive)

    def broken(self, *a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sn.Snapshots, "commit", broken)
        with pytest.raises(RuntimeError):
            ar.merge_increment(spark, archive, source(spark, [moved(7, 3)]), serial_watermark=-1, modified_since=DAY)
    assert held(spark, archive) == before
    assert ar.merge_increment(spark, archive, source(spark, [moved(7, 3)]), serial_watermark=-1, modified_since=DAY) == [
        "2024-01-03", "2024-01-04"]
    after = held(spark, archive)
    assert len(after) == 40 and (7, "2024-01-04", 5.0) in after and all(s != 7 or d == "2024-01-04" for s, d, _ in after)


def test_readers_keep_their_version(spark, archive):
    old = ar.read_archive(spark, archive)
    before = held(spark, archive)
    ar.merge_increment(spark, archive, source(spark, [moved(7, 3), moved(100, 6)]), serial_watermark=-1, modified_since=DAY)
    assert sorted((r["serial"], str(r["event_date"]), r["win"]) for r in old.collect()) == before
    assert held(spark, archive, 1) == before and len(held(spark, archive)) == 41


def test_only_touched_days_are_read(spark, archive, monkeypatch):
    seen = []
    whole = ar.touched_days
    monkeypatch.setattr(ar, "touched_days", lambda a, d: seen.append(whole(a, d)) or seen[-1])
    ar.merge_increment(spark, archive, source(spark, [moved(7, 3)]), serial_watermark=-1, modified_since=DAY)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [event_date" in plan
    read = {r["f"].rsplit("event_date=", 1)[1][:10] for r in seen[0].select(F.input_file_name().alias("f")).distinct().collect()}
    assert read == {"2024-01-03", "2024-01-04"}


def test_the_index_prunes_blocks_and_finds_days(spark, archive, monkeypatch):
    monkeypatch.setattr(ar, "SERIAL_BITS", 3)
    path = archive + "2"
    ar.bootstrap_archive(rounds(spark, [round_row(i, DAY + dt.timedelta(days=i // 8)) for i in range(64)]), path)
    serials = spark.createDataFrame([(17,), (18,), (1000,)], "serial bigint")
    assert [str(d) for d in ar.indexed_days(spark, path, serials)] == ["2024-01-03"]
    ar.merge_increment(spark, path, source(spark, [moved(17, 6)]), serial_watermark=-1, modified_since=DAY)
    assert {str(d) for d in ar.indexed_days(spark, path, serials)} == {"2024-01-03", "2024-01-07"}


def test_a_clone_copies_a_list_and_lives_on_its_own(spark, archive):
    clone = archive + "-clone"
    ar.clone_archive(spark, archive, clone)
    assert held(spark, clone) == held(spark, archive)
    assert sn.Snapshots(spark, clone)._names(f"{clone}/rounds") == []
    ar.merge_increment(spark, clone, source(spark, [moved(7, 3)]), serial_watermark=-1, modified_since=DAY)
    assert (7, "2024-01-03", 0.0) in held(spark, archive) and (7, "2024-01-04", 5.0) in held(spark, clone)
    assert len(held(spark, clone)) == 40
    with pytest.raises(FileExistsError):
        ar.clone_archive(spark, archive, clone)


def test_of_two_writers_one_wins(spark, archive):
    table = sn.Snapshots(spark, archive)
    base = table.version()
    table.commit(base, base.entries)
    with pytest.raises(sn.ConcurrentCommit):
        table.commit(base, base.entries)


def test_a_version_without_its_end_is_skipped(spark, archive):
    table = sn.Snapshots(spark, archive)
    before = held(spark, archive)
    table._create(f"{archive}/_versions/v{2:012d}.json", '{}\n{"table": "rounds"')
    assert table.version().number == 1 and held(spark, archive) == before
    assert table.commit(table.version(), table.version().entries).number == 3


def test_expiry_keeps_what_a_kept_version_lists(spark, archive):
    ar.merge_increment(spark, archive, source(spark, [moved(7, 3)]), serial_watermark=-1, modified_since=DAY)
    before = held(spark, archive)
    table = sn.Snapshots(spark, archive)
    ar.merge_increment(spark, archive, source(spark, [moved(7, 3, 10), moved(8, 0)]), serial_watermark=-1, modified_since=DAY)
    table.expire(2)
    assert held(spark, archive, 2) == before and len(held(spark, archive)) == 40
    with pytest.raises(Exception):
        held(spark, archive, 1)


def test_empty_loads_and_ranges(spark, place):
    path = f"{place}/none"
    ar.bootstrap_archive(rounds(spark, []), path)
    assert held(spark, path) == []
    assert sn.range_count(spark.range(10)) == 1


def test_ticks_count_rounds_on_before_and_after_them(spark):
    from tallyscope.settings import Thresholds

    times = [DAY, DAY - dt.timedelta(days=3), DAY + dt.timedelta(hours=2), DAY + dt.timedelta(hours=2, microseconds=1), DAY + dt.timedelta(days=9)]
    r = rounds(spark, [round_row(i, w) for i, w in enumerate(times)])
    got = ar.rounds_by_tick(r, "2024-01-01 00:00:00", "2024-01-01 06:00:00", Thresholds().but(replay_step_hours=2)).orderBy("as_of").collect()
    want = [sum(w <= t["as_of"] for w in times) for t in got]
    assert [g["rounds"] for g in got] == want == [2, 3, 4, 4]


def test_frozen_parameters_are_versions(spark, place):
    from tallyscope.operators import calibration as cal

    rows = spark.createDataFrame([("m", 1.5)], "metric string, bound double")
    checked = spark.createDataFrame([(None,)], "breach string")
    with pytest.raises(FileNotFoundError):
        cal.load_frozen(spark, f"{place}/f")
    for bound, end in ((1.5, "a"), (2.5, "b")):
        cal.write_frozen(rows.withColumn("bound", F.lit(bound)), checked, f"{place}/f", train_as_of=end, validated_as_of=end)
    newest, first = cal.load_frozen(spark, f"{place}/f").first(), cal.load_frozen(spark, f"{place}/f", 1).first()
    assert (newest["bound"], newest["train_as_of"], newest["validation_verdict"]) == (2.5, "b", "PASS")
    assert (first["bound"], first["train_as_of"]) == (1.5, "a")
    with pytest.raises(FileNotFoundError):
        cal.load_frozen(spark, f"{place}/f", 3)
