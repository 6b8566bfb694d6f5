"""Figures of round 4: what a query writes to disk must follow what it needs of the rounds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyscope.operators import features as ft
from tallyscope.operators import fusion as fu
from tallyscope.operators import timing as tm
from tallyscope.plans import all_queries  # noqa: F401
from tallyscope.plans import rule_queries as rq
from tallyscope.plans.registry import QUERIES
from tallyscope.schema import ROUND, SIGNAL
from tallyscope.settings import Thresholds
from tallyscope.sources import fixtures as fx
from tallyscope.sources import sinks as sk
from tests.conftest import DATA
from tests.test_fusion import sig
from tests.test_jobs import round_row

T = Thresholds().but(min_rounds=1, physical_rpm=3)
DAY = dt.datetime(2024, 1, 1)


def refuse(*args, **options):
    raise AssertionError("rounds were shuffled for something that the query does not read")


def without_timing_and_levels(spark, monkeypatch, name):
    for module, step in ((tm, "player_timing"), (tm, "player_pace"), (ft, "with_levels"), (ft, "duplicate_rounds")):
        monkeypatch.setattr(module, step, refuse, raising=False)
    return QUERIES[name](spark, DATA).count()


def test_trigger_rates_are_made_without_timing(spark, monkeypatch):
    """gaps, stake levels and repeated ids of all rounds were made and not read."""
    assert without_timing_and_levels(spark, monkeypatch, "MET_6_trigger_rate_z") > 0


def test_hit_rates_are_made_without_timing(spark, monkeypatch):
    """gaps, stake levels and repeated ids of all rounds were made and not read."""
    assert without_timing_and_levels(spark, monkeypatch, "MET_7_hit_rate_z") > 0


def test_excess_money_is_made_without_timing(spark, monkeypatch):
    """gaps, stake levels and repeated ids of all rounds were made and not read."""
    assert without_timing_and_levels(spark, monkeypatch, "MET_8_excess_turnover_z") > 0


def summed(spark, monkeypatch, name):
    for module, step in ((tm, "player_timing"), (tm, "whole_timing"), (ft, "with_levels"), (ft, "duplicate_rounds")):
        monkeypatch.setattr(module, step, refuse)
    return QUERIES[name](spark, DATA).count()


def test_a_fit_needs_sums_and_pace(spark, monkeypatch):
    """F8: stake levels, repeated ids, stakes of sessions and hours of the day were made and not read."""
    assert summed(spark, monkeypatch, "ST_5_fit") == 8


def odd_rounds(spark):
    at = [0, 0, 5, 10, 59, 60, 3599, 3600, 5400, 5401, 9000, 86399, 86400]
    rows = [round_row(i, DAY + dt.timedelta(seconds=s), game=f"g{i % 3}") for i, s in enumerate(at)]
    r = spark.createDataFrame(rows, ROUND)
    return r.unionByName(r.limit(2).withColumn("game_time", F.lit(None).cast("timestamp_ntz")))


@pytest.mark.parametrize("view", ["events", "lineitem", "odd"])
@pytest.mark.parametrize("share", [None, 0.5, 0])
def test_pace_is_the_timing_of_all_rounds_and_of_the_earlier_half(spark, view, share):
    r, until = {
        "events": lambda: (fx.rounds_from_events(spark, DATA), "2024-01-16 00:00:00"),
        "lineitem": lambda: (fx.rounds_from_lineitem(spark, DATA), "1998-06-01 00:00:00"),
        "odd": lambda: (odd_rounds(spark), "2024-01-01 00:59:59"),
    }[view]()
    counted = r.groupBy("parent", "uid").agg(F.count("*").alias("rounds"))
    most = counted.agg(F.max("rounds")).first()[0]
    t = T if share is None else T.but(whole_player_rounds=int((most - 1) * 2 * share))
    pace = tm.player_pace(r, t, counted=counted, until=until)
    rows = lambda df: sorted(map(tuple, df.select("parent", "uid", *cols).collect()), key=str)
    cols = tm.PACE
    assert rows(pace) == rows(tm.player_timing(r, t))
    cols = ("rounds", "n_gaps", "same_second_gaps", "in_range_gaps", "concurrent_rounds")
    early = r.where(F.col("game_time") <= F.lit(until).cast("timestamp_ntz"))
    assert rows(tm.half_pace(pace, 1)) == rows(tm.player_timing(early, t))


def test_validation_needs_sums_and_pace(spark, monkeypatch):
    """as F8, once more for the validation."""
    assert summed(spark, monkeypatch, "ST_7_validate") > 0


def test_calibrated_signals_need_sums_and_pace(spark, monkeypatch):
    """as F8, for the signals."""
    assert summed(spark, monkeypatch, "L1_1_calibrated_signals") > 0


def test_persistence_times_the_rounds_once(spark, monkeypatch):
    """gaps of all rounds were made twice and those of the earlier half once more, cells twice."""
    made = []
    pace = tm.player_pace
    monkeypatch.setattr(tm, "player_pace", lambda *a, **k: made.append(k["until"]) or pace(*a, **k))
    assert summed(spark, monkeypatch, "L1_9_split_half_persistence") > 0
    assert made == [rq.HALF_END]


def shuffled_records(spark) -> int:
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = store.stageList(None, False, False, none, None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_signals_are_shuffled_once_for_their_documents(spark):
    """signals were shuffled to be fused, again for the id of their case and again to be nested."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on tables too large to broadcast
    before = shuffled_records(spark)
    try:
        assert QUERIES["SNK_1_emit_candidates"](spark, DATA).count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert shuffled_records(spark) - before < 1.2 * fx.signals_from_lineitem(spark, DATA).count()


def documents(spark, path):
    return sorted(map(str, (sorted(r.asDict(recursive=True).items()) for r in spark.read.json(path).collect())))


def test_documents_made_in_passes_are_those_of_all_cases(spark, place, monkeypatch):
    sg = fx.signals_from_lineitem(spark, DATA)
    cases = fu.fuse(sg)
    sk.emit_candidates(sk.candidate_documents(cases, fu.signals_with_case(sg, cases), "a", "b"), f"{place}/want")
    for passes in (1, 3):
        monkeypatch.setattr(sk, "PASS_SIGNALS", sg.count() // passes)
        assert sk.emit_fused(sg, f"{place}/got", "a", "b") == passes
        assert documents(spark, f"{place}/got") == documents(spark, f"{place}/want")
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_a_signal_survives_its_way_as_a_text(spark):
    nan, odd = float("nan"), 'a "quoted" \\ line\n, \x01 and \u00e9[]{}'
    rows = [sig("A", "F", value=0.1 + 0.2, desc=odd), sig("B", "F", value=nan, p=1e-300, effect=float("inf")),
            sig(None, None, value=None, desc=None)]
    rows = [(*rows[0][:-2], [odd, None, ""], {"event_date": None, odd: odd}), (*rows[1][:-2], None, None), (*rows[2][:-2], [], {})]
    table = spark.createDataFrame([*rows, rows[0]], SIGNAL)
    got = fu.by_case(table, 3).drop("_slot")
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in table.schema]
    assert sorted(map(str, got.collect())) == sorted(map(str, table.collect()))
    parts = [fu.by_case(table, 2, i, 3).count() for i in range(3)]
    assert sum(parts) == 4
