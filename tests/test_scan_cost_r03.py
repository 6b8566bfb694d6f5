"""Steps of the scan that read the rounds once where they read them many times."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyscope.functions.tasks import grow_tree
from tallyscope.operators import features as ft
from tallyscope.operators import timing as tm
from tallyscope.plans import all_queries  # noqa: F401
from tallyscope.plans import case_queries as cq
from tallyscope.plans import rule_queries as rq
from tallyscope.plans import scan as sc
from tallyscope.schema import ROUND
from tallyscope.settings import Thresholds
from tallyscope.sources import fixtures as fx
from tests.conftest import DATA
from tests.test_jobs import round_row

T = Thresholds().but(min_rounds=1, physical_rpm=3)
DAY = dt.datetime(2024, 1, 1)


def rows_of(df, *order):
    return df.orderBy(*(order or ("parent", "uid"))).collect()


@pytest.mark.parametrize("view", ["events", "lineitem"])
def test_players_taken_whole_have_the_timing_of_players_taken_by_hours(spark, view):
    """every round was read for three tables and sorted with a row for each player and hour."""
    r = fx.rounds_from_events(spark, DATA) if view == "events" else fx.rounds_from_lineitem(spark, DATA)
    counted = r.groupBy("parent", "uid").agg(F.count("*").alias("rounds"))
    limit = counted.agg(F.max("rounds")).first()[0] - 1
    want = tm.player_timing(r, T)
    assert [f.dataType for f in tm.whole_timing(r, T).schema] == [f.dataType for f in want.schema]
    assert tm.whole_timing(r, T).columns == want.columns
    want = rows_of(want)
    assert rows_of(tm.player_timing(r, T, counted=counted)) == want
    assert rows_of(tm.player_timing(r, T.but(whole_player_rounds=limit), counted=counted)) == want
    assert rows_of(tm.player_timing(r, T.but(whole_player_rounds=0), counted=counted)) == want


def test_whole_timing_of_odd_times(spark):
    """Rounds without a time, equal times, a minute at its ends, an hour passed inside a session."""
    at = [0, 0, 5, 10, 59, 60, 3599, 3600, 5400, 5401, 9000, 86399, 86400]
    rows = [round_row(i, DAY + dt.timedelta(seconds=s), win=50.0 * (i % 3)) for i, s in enumerate(at)]
    r = spark.createDataFrame(rows, ROUND)
    r = r.unionByName(r.limit(2).withColumn("game_time", F.lit(None).cast("timestamp_ntz")))
    assert rows_of(tm.whole_timing(r, T)) == rows_of(tm.player_timing(r, T))


def test_calibration_makes_only_what_metrics_read(spark):
    """two windows made stake levels, repeated ids and daily series that no metric reads."""
    r = fx.rounds_from_lineitem(spark, DATA)
    a, b = sc.extract(r, rq.TRAIN_END, rq.T, for_metrics=True), sc.extract(r, rq.TRAIN_END, rq.T)
    assert a.game_day is None and "dup_seq_rounds" not in a.player_cell.columns
    keys = ["parent", "uid", "game_id", "play_type", "currency", "sm_tag"]
    assert rows_of(a.player_cell.select(*keys, "rounds", "turnover", "n_win"), *keys) == rows_of(
        b.player_cell.select(*keys, "rounds", "turnover", "n_win"), *keys)


def test_a_tree_cuts_between_neighbouring_numbers():
    """a cut rounded up to the larger of two neighbouring numbers left no row on one side."""
    x = np.array([[1.0], [np.nextafter(1.0, 2.0)]])
    for seed in range(20):
        assert len(grow_tree(x, np.random.default_rng(seed), 8)) == 3


def test_discovery_makes_the_aggregates_once(spark, monkeypatch):
    """cells and timing of all rounds were made for the rules and again for the forest."""
    made = []
    timing, levels = tm.player_timing, ft.with_levels
    monkeypatch.setattr(tm, "player_timing", lambda *a, **k: made.append("timing") or timing(*a, **k))
    monkeypatch.setattr(ft, "with_levels", lambda *a, **k: made.append("levels") or levels(*a, **k))
    monkeypatch.setattr(cq, "_rule_signals", lambda s, a: a.player_cell)
    cq._discovered(spark, DATA)
    assert sorted(made) == ["levels", "timing"]


def test_a_half_of_the_window_is_told_by_sums(spark, monkeypatch):
    """the earlier boundary made stake levels, repeated ids and daily series that nothing reads."""
    class Enough(Exception):
        pass

    asked = []

    def extract(rounds, as_of, t, **options):
        asked.append((as_of, options.get("for_metrics", False)))
        if len(asked) == 2:
            raise Enough
        return sc.Aggregates(*[spark.range(1).select(F.col("id").alias("rounds"))] * 6)

    monkeypatch.setattr(sc, "extract", extract)
    with pytest.raises(Enough):
        sc.scan(None, None, None, "2024-01-31 00:00:00", persistence_mid="2024-01-16 00:00:00")
    assert asked == [("2024-01-31 00:00:00", False), ("2024-01-16 00:00:00", True)]
