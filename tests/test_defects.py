"""Cases that once went wrong: missing tags, unordered sheets, large means, broken merges, long lists."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tallyscope.functions.normal import normal_ppf, normal_sf
from tallyscope.functions.ranks import bh_select
from tallyscope.operators import features as ft
from tallyscope.operators import lookups as lk
from tallyscope.operators import reporting as rp
from tallyscope.operators.cohorts import cadence_prints
from tallyscope.schema import ROUND
from tallyscope.settings import Thresholds
from tallyscope.sources import archive as ar
from tallyscope.sources import fixtures as fx
from tests.conftest import DATA
from tests.test_jobs import DAY, round_row


def test_groups_without_a_build_tag_stay(spark):
    rows = [(f"P_{u}", "2024-01-01", "op", u, "g1", 0, None, "L1-DUP_ROUND", 1.0, 0.0, "Critical", "queued") for u in ("a", "b")]
    b = spark.createDataFrame(
        rows, "case_id string, day string, operator string, uid string, game_id string, play_type int, sm_tag string, "
        "breach string, value double, threshold double, severity string, status string")
    assert rp.cell_rollup(b).first()["group_id"] == "G_op_g1_pt0_none_L1-DUP_ROUND@2024-01-01"
    assert {r["group_id"] for r in rp.group_members(b).collect()} == {"G_op_g1_pt0_none_L1-DUP_ROUND@2024-01-01"}


def test_first_sheet_row_of_a_stem_follows_the_sheet(spark):
    schema = "line long, game_id string, play_type int, rtp double, max_multiplier double"
    sheet = spark.createDataFrame([(9, "77b", 0, 0.90, 10.0), (2, "77a", 0, 0.95, 20.0), (3, "77a", 0, 0.95, 20.0)], schema)
    live = spark.createDataFrame([("77", 0)], "game_id string, play_type int")
    for df in (sheet.repartition(3), sheet.orderBy(F.desc("line")).coalesce(1)):
        assert [(r["rtp_cert"], r["cap_cert"]) for r in lk.with_certified(live, df).collect()] == [(0.95, 20.0)]


def test_deviation_of_large_means(spark):
    win = [1e9 + i % 3 for i in range(90)]
    rows = [round_row(i, DAY + dt.timedelta(minutes=i), uid=f"u{i % 7}", win=w) for i, w in enumerate(win)]
    got = ft.cell_constants(spark.createDataFrame(rows, ROUND)).first()["sigma_spin"]
    mean = sum(win) / len(win)
    assert math.isclose(got, math.sqrt(sum((w - mean) ** 2 for w in win) / (len(win) - 1)), rel_tol=1e-6)


def test_a_merge_heals_a_round_left_in_two_days(spark, place):
    path = place + "/archive"
    old = round_row(1, DAY)
    ar.bootstrap_archive(spark.createDataFrame([old, round_row(2, DAY)], ROUND), path)
    moved = round_row(1, DAY + dt.timedelta(days=1), modified=DAY + dt.timedelta(days=2))
    ar._store(spark.createDataFrame([moved], ROUND), path, "append")  # as a merge that ended between its two steps
    source = spark.createDataFrame([moved], ROUND).withColumns(
        {"ReportDate": F.col("report_date"), "validBet": F.col("valid_bet"), "hasFreegame": F.lit("False"),
         "test_demo_play": F.lit("False")}).drop("report_date", "valid_bet", "triggered")
    ar.merge_increment(spark, path, source, serial_watermark=0, modified_since=DAY)
    assert sorted((r["serial"], str(r["event_date"])) for r in ar.read_archive(spark, path).collect()) == [
        (1, "2024-01-02"), (2, "2024-01-01")]


def test_ten_thousand_accounts_are_excluded(spark):
    x = lk.Exclusions(accounts=tuple(("op", f"u{i}") for i in range(10_000)))
    df = spark.createDataFrame([("op", "u9999"), ("op", "v1"), (None, "u1"), ("other", "u1")], "parent string, uid string")
    assert {tuple(r) for r in lk.apply_exclusions(df, x).collect()} == {("op", "v1"), (None, "u1"), ("other", "u1")}


def test_normal_tail_against_the_error_function(spark):
    z = [i / 4 for i in range(-160, 149)]
    rows = spark.createDataFrame([(v,) for v in z], "z double").withColumn("p", normal_sf("z")).collect()
    assert all(math.isclose(r["p"], 0.5 * math.erfc(r["z"] / math.sqrt(2)), rel_tol=1e-6) for r in rows)
    back = spark.createDataFrame([(1 - 10.0**-k,) for k in range(1, 9)], "p double").withColumn("z", normal_ppf("p"))
    assert all(math.isclose(0.5 * math.erfc(r["z"] / math.sqrt(2)), 1 - r["p"], rel_tol=1e-5) for r in back.collect())


def test_selection_level_may_exceed_a_tenth_and_z_be_huge(spark):
    df = spark.createDataFrame([("a", z, q) for z, q in [(0.6, 0.4), (5.0, 0.4), (45.0, 0.4), (1e7, 0.4), (-1.0, 0.4)]], "f string, z double, q double")
    got = {r["z"]: r["selected"] for r in bh_select(df, ["f"], "z", F.col("q")).collect()}
    assert got == {0.6: True, 5.0: True, 45.0: True, 1e7: True, -1.0: False}


def test_cadence_uses_every_member(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    profiles = [[int(x) for x in rng.integers(0, 5, 24)] for _ in range(60)]
    people = spark.createDataFrame([("op", f"u{i}", "sk") for i in range(60)], "parent string, uid string, skeleton string")
    timing = spark.createDataFrame([("op", f"u{i}", p) for i, p in enumerate(profiles)], "parent string, uid string, hour_profile array<long>")
    t = Thresholds()
    got = cadence_prints(people, timing, t).first()["mean_correlation"]
    want = []
    for i in range(60):
        for j in range(i):
            a, b = np.array(profiles[i]), np.array(profiles[j])
            if ((a > 0) & (b > 0)).sum() >= t.cohort_min_shared_hours:
                want.append(np.corrcoef(a, b)[0, 1])
    assert math.isclose(got, float(np.mean(want)), rel_tol=1e-9)


def test_calibration_queries_hold_all_metrics_and_segments(spark):
    import __spark_entry__ as entry_module
    from tallyscope.settings import METRIC_RULES, SEGMENT_KEYS

    queries = entry_module.queries()
    frozen = queries["SNK_6_frozen_parameters"](spark, DATA).where("train_eligible > 0")
    assert {r["metric"] for r in frozen.collect()} == set(METRIC_RULES)
    rates = queries["AGG_16_segment_rates"](spark, DATA).collect()
    assert {r["segment_key"] for r in rates} == {"overall", *SEGMENT_KEYS}


def test_streams_pair_twins_of_different_batches(spark, place):
    import json

    from tallyscope.operators.casegate import GateStore
    from tallyscope.schema import LOG_ENTRY
    from tallyscope.streaming import jobs

    store = GateStore(spark, f"{place}/rounds-state")
    run = jobs.integrity_batch(store, fx.catalog(spark))
    for i, (serial, gsid) in enumerate(((900_000, "x"), (5, "y"), (9, "x"))):
        run(spark.createDataFrame([round_row(serial, DAY + dt.timedelta(seconds=i), gsid=gsid)], ROUND), i)
        assert store.state().count() == (i == 2)

    def entry(second, code):
        payload = "Spin-Server Response info " + json.dumps({"resCode": code, "response": {"gameSeqId": "g"}})
        row = {"ts": DAY + dt.timedelta(seconds=second), "container": "spin-server", "payload": payload}
        return spark.createDataFrame([tuple(row.get(f.name) for f in LOG_ENTRY.fields)], LOG_ENTRY)

    store = GateStore(spark, f"{place}/log-state")
    run = jobs.log_batch(store, "salt")
    for i, (second, code) in enumerate(((0, 802), (4000, 1000))):
        run(entry(second, code), i)
        assert store.state().count() == i


def test_players_without_a_game_or_currency_are_scored(spark):
    from tallyscope.operators import anomaly as an
    from tallyscope.operators import timing as tm

    rows = []
    for i, (uid, game, currency) in enumerate((
        ("a", None, "USD"), ("a", "g1", "USD"), ("b", "g1", None), ("b", "g2", "USD"), ("c", None, None), ("d", "g1", "USD"),
    )):
        row = list(round_row(i, DAY + dt.timedelta(seconds=i), uid=uid))
        row[6], row[8] = game, currency
        rows.append(tuple(row))
    r = spark.createDataFrame(rows, ROUND)
    cells = ft.player_cell_features(r, min_rounds=1, evidence=False)
    z = an.normalised(an.player_features(cells, tm.player_timing(r)))
    got = {x["uid"]: (x["game_id"], x["currency"]) for x in z.collect()}
    assert got == {"a": ("g1", "USD"), "b": ("g1", None), "c": (None, None), "d": ("g1", "USD")}


def test_discovery_and_scan_take_real_inputs(spark, monkeypatch):
    from tallyscope.plans import case_queries as cq
    from tallyscope.plans import scan as sc
    from tallyscope.plans.registry import QUERIES

    players = fx.rounds_from_lineitem(spark, DATA).select("parent", "uid").distinct()
    flags = players.withColumns({"flag": F.lit(True), "score": F.lit(0.9), "currency": F.lit("USD")})
    one = players.orderBy("parent", "uid").first()
    monkeypatch.setattr(cq, "_flags", lambda s, d: flags)
    monkeypatch.setattr(cq, "_rule_signals", lambda s, d: players.where(F.col("uid") == one["uid"]))
    got = {(r["parent"], r["uid"]) for r in QUERIES["L3_13_discovery_signals"](spark, DATA).collect()}
    assert got == {(r["parent"], r["uid"]) for r in players.where(F.col("uid") != one["uid"]).collect()}
    given = {}
    monkeypatch.setattr(sc, "scan", lambda *a, **k: given.update(k) or type("S", (), {"cases": None}))
    cq._scan(spark, DATA)
    assert given.get("discover", True) and given["persistence_mid"]
