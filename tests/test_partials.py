"""Daily partial tables against aggregates of all rounds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyscope.operators import features as ft
from tallyscope.operators import partials as pt
from tallyscope.operators import timing as tm
from tallyscope.plans import scan as sc
from tallyscope.plans.feature_queries import T
from tallyscope.schema import ROUND
from tallyscope.sources import archive as ar
from tallyscope.sources import fixtures as fx
from tests.conftest import DATA
from tests.test_jobs import round_row


def same(a, b):
    """Rows of equal names and values, floats but for their last digits."""
    names = sorted(a.columns)
    assert names == sorted(b.columns)

    def rows(df):
        shown = [[round(v, 6) if isinstance(v, float) else v for v in r] for r in df.select(*names).collect()]
        return sorted(map(str, shown))

    assert rows(a) == rows(b)


def test_stored_aggregates_equal_those_of_all_rounds(spark, place):
    rounds = fx.rounds_from_events(spark, DATA)
    store = pt.PartialStore(spark, place, T)
    for as_of in ("2024-01-06 00:00:00", "2024-01-13 17:20:00", "2024-01-25 23:59:59"):
        whole, stored = sc.extract(rounds, as_of, T), sc.extract_stored(store, rounds, as_of, T)
        for name in ("player_cell", "player_timing", "cell_constants", "cell_operator", "game_day"):
            same(getattr(stored, name), getattr(whole, name))
        same(sc.top_rounds(stored.wins, ft.PLAYER_CELL), sc.top_rounds(whole.wins, ft.PLAYER_CELL))
    # an earlier boundary is served from the days before it
    as_of = "2024-01-10 03:00:00"
    same(pt.player_cell(store.asof(rounds, as_of)), ft.player_cell_features(ar.rounds_asof(rounds, as_of), T, min_rounds=1, evidence=False))


def made(spark, rows):
    return spark.createDataFrame(rows, ROUND)


def without(row, *names):
    return tuple(None if f in names else v for f, v in zip(ROUND.fieldNames(), row))


def test_what_crosses_days_is_counted_once(spark, place):
    day = dt.datetime(2024, 1, 1)
    rows = [
        round_row(1, day, gsid="a", bet=1.0), round_row(2, day + dt.timedelta(hours=23, minutes=59, seconds=50), gsid="b", bet=2.0),
        round_row(3, day + dt.timedelta(days=1, seconds=5), gsid="a", bet=2.0), without(round_row(4, day + dt.timedelta(days=1, seconds=5)), "game_seq_id", "bet"),
        round_row(5, day + dt.timedelta(days=3), gsid="b", bet=1.0), without(round_row(6, day + dt.timedelta(days=3), bet=3.0), "game_seq_id", "uid"),
        without(round_row(7, day, gsid="z"), "game_time"),
    ]
    rounds, store = made(spark, rows), pt.PartialStore(spark, place, T)
    for through in ("2024-01-01", "2024-01-02", "2024-01-04"):
        assert store.advance(rounds, through)
    assert not store.advance(rounds, "2024-01-03") and store.through() == "2024-01-04"
    as_of = "2024-01-09 00:00:00"
    seen, p = ar.rounds_asof(rounds, as_of), store.asof(rounds, as_of)
    same(pt.player_cell(p), ft.player_cell_features(seen, T, min_rounds=1, evidence=False))
    same(pt.player_timing(p, T, min_rounds=1), tm.player_timing(seen, T, min_rounds=1))
    gaps = pt.player_timing(p, T, min_rounds=1).where("uid IS NOT NULL").first()
    assert gaps["n_gaps"] == 4 and gaps["in_range_gaps"] == 1


def test_a_corrected_day_takes_back_those_after_it(spark, place):
    day = dt.datetime(2024, 1, 1)
    rows = [round_row(i, day + dt.timedelta(days=i), gsid=f"g{i // 2}", bet=float(i % 2)) for i in range(6)]
    store = pt.PartialStore(spark, place, T)
    store.advance(made(spark, rows), "2024-01-06")
    rows[1] = round_row(1, day + dt.timedelta(days=1), gsid="other", bet=9.0)
    store.take_back("2024-01-02")
    assert store.through() == "2024-01-01"
    store.advance(made(spark, rows), "2024-01-06")
    seen = ar.rounds_asof(made(spark, rows), "2024-01-07 00:00:00")
    same(pt.player_cell(store.asof(made(spark, rows), "2024-01-07 00:00:00")), ft.player_cell_features(seen, T, min_rounds=1, evidence=False))


def test_only_missing_days_of_an_archive_are_read(spark, place):
    path = f"{place}/archive"
    day = dt.datetime(2024, 1, 1)
    ar.bootstrap_archive(made(spark, [round_row(i, day + dt.timedelta(days=i)) for i in range(8)]), path)
    fresh = pt._of_days(ar.read_archive(spark, path), "2024-01-03", "2024-01-05")
    read = {r["f"].rsplit("event_date=", 1)[1][:10] for r in fresh.select(F.input_file_name().alias("f")).distinct().collect()}
    assert read == {"2024-01-04", "2024-01-05"}


def test_empty(spark, place):
    store = pt.PartialStore(spark, place, T)
    assert store.advance(made(spark, []), "2024-01-05")
    assert pt.player_cell(store.asof(made(spark, []), "2024-01-09 00:00:00")).count() == 0
    assert pytest.approx(0) == pt.cell_constants(store.asof(made(spark, []), "2024-01-09 00:00:00")).count()
