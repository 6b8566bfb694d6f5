"""Archive, statistics, sheets, outbound guard, streaming and the composed scan."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyscope import Thresholds
from tallyscope.functions import ranks
from tallyscope.operators import casegate as cg
from tallyscope.operators import reporting as rp
from tallyscope.operators import timing as tm
from tallyscope.schema import ROUND
from tallyscope.sources import archive as ar
from tallyscope.sources import catalog as ct
from tallyscope.sources import fixtures as fx
from tests.conftest import DATA

NAN = float("nan")


def round_row(serial, when, uid="u1", parent="op", gsid=None, bet=1.0, win=0.0, gap=0.0, game="g1", play=0, trig=False,
              before=100.0, modified=None):
    return (when, when.date(), serial, gsid or f"r{serial}", parent, uid, game, play, "USD", "v", "b1", bet, bet, win, before,
            before - bet + win + gap, trig, modified or when)


DAY = dt.datetime(2024, 1, 1)


# --- statistics ---------------------------------------------------------------------


def test_robust_bounds_match_a_direct_computation(spark):
    rnd = random.Random(1)
    sets = {"wide": [rnd.gauss(0, 1) for _ in range(301)], "flat": [0.0] * 200 + [rnd.random() for _ in range(60)],
            "steps": [0.0] * 100 + [1.0] * 40 + [2.0] * 10, "same": [3.0] * 50, "tiny": [1.0, 2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in sets.items() for v in vs] + [("wide", NAN)], "g string, v double")
    got = {r["g"]: r for r in ranks.robust_bounds(df, ["g"], "v", 12, 20).collect()}

    def direct(v):
        v = np.array(v)
        if v.size < 20:
            return None
        med = np.median(v)
        mad = np.median(abs(v - med))
        if mad > 0:
            return med + 12 * mad
        nz = v[v > med]
        if nz.size >= 20:
            m = np.median(nz)
            a = np.median(abs(nz - m))
            if a > 0:
                return m + 12 * a
            if nz.std() > 0:
                return m + 12 * nz.std()
        return None

    for k, vs in sets.items():
        assert got[k]["bound"] == pytest.approx(direct(vs)) if direct(vs) is not None else got[k]["bound"] is None


def test_order_stats_match_numpy(spark):
    rnd = random.Random(2)
    vals = [round(rnd.expovariate(1), 2) for _ in range(5000)]
    got = ranks.order_stats(spark.createDataFrame([(v,) for v in vals], "v double"), [], "v",
                            {"a": 0.5, "b": 0.999, "c": F.floor(F.col("n") / 2)}).first()
    assert got["a"] == pytest.approx(np.quantile(vals, 0.5)) and got["b"] == pytest.approx(np.quantile(vals, 0.999))
    assert got["c"] == sorted(vals)[len(vals) // 2]


def test_bh_matches_the_textbook_and_is_empty_on_clean_data(spark):
    import math

    rnd = random.Random(3)
    z = [round(rnd.gauss(0, 1), 2) for _ in range(3000)] + [round(3.5 + rnd.random() * 2, 1) for _ in range(60)]
    got = ranks.bh_select(spark.createDataFrame([(v,) for v in z], "z double"), [], "z", 0.01).where("selected").count()
    p = np.sort([0.5 * math.erfc(v / math.sqrt(2)) for v in z])
    ok = np.nonzero(p <= 0.01 * np.arange(1, len(p) + 1) / len(p))[0]
    assert got == ok.max() + 1
    clean = spark.createDataFrame([(i / 1000 - 2,) for i in range(4000)], "z double")
    assert ranks.bh_select(clean, [], "z", 0.01).where("selected").count() == 0


# --- timing --------------------------------------------------------------------------


def test_sequences_cross_hours_like_one_window(spark):
    from pyspark.sql import Window

    rnd = random.Random(4)
    t, rows = DAY, []
    for i in range(400):
        t += dt.timedelta(seconds=rnd.choice([0, 0, 1, 5, 60, 1700, 1801, 4000, 9000]))
        rows.append(round_row(i, t, game=rnd.choice(["g1", "g2"])))
    df = spark.createDataFrame(rows, ROUND)
    w = Window.partitionBy("parent", "uid").orderBy("game_time", "serial")
    want = df.select("serial", F.timestamp_diff("SECOND", F.lag("game_time").over(w), F.col("game_time")).alias("g"),
                     (F.col("game_id") != F.lag("game_id").over(w)).alias("c"))
    got = tm.sequence_rounds(df, 1800).select("serial", F.col("gap_s").alias("g"), F.col("game_changed").alias("c"))
    assert sorted(got.collect()) == sorted(want.collect())
    sess = {r["serial"]: r["session_no"] for r in tm.sessionise(df).collect()}
    n, expect = 0, {}
    for r in sorted(want.collect(), key=lambda r: r["serial"]):
        n += r["g"] is None or r["g"] > 1800
        expect[r["serial"]] = n
    assert sess == expect


# --- archive ---------------------------------------------------------------------------


def test_archive_refuses_a_second_load_and_merges_idempotently(spark, place):
    src = fx.source_from_events(spark, DATA)
    path = f"{place}/archive"
    ar.bootstrap_archive(ar.load_rounds(src), path)
    with pytest.raises(Exception):
        ar.bootstrap_archive(ar.load_rounds(src), path)
    before = ar.read_archive(spark, path).count()
    ar.merge_increment(spark, path, src)
    assert ar.read_archive(spark, path).count() == before
    # A correction that empties a day moves the round and removes the day.
    lone = spark.createDataFrame([round_row(10**9, dt.datetime(2030, 1, 1))], ROUND)
    ar._store(lone, path, "append")
    moved = spark.createDataFrame(
        [round_row(10**9, dt.datetime(2030, 1, 5), modified=dt.datetime(2030, 1, 6))], ROUND).withColumns(
        {"ReportDate": F.col("report_date"), "validBet": F.col("valid_bet"), "hasFreegame": F.lit("False"),
         "test_demo_play": F.lit("False")}).drop("report_date", "valid_bet", "triggered")
    days = ar.merge_increment(spark, path, moved)
    assert days == ["2030-01-01", "2030-01-05"]
    got = ar.read_archive(spark, path).where("serial = 1000000000").collect()
    assert [str(r["event_date"]) for r in got] == ["2030-01-05"]


def test_ties_keep_the_archive_row(spark):
    old = spark.createDataFrame([round_row(1, DAY, win=1.0)], ROUND)
    same = spark.createDataFrame([round_row(1, DAY, win=2.0)], ROUND)
    newer = spark.createDataFrame([round_row(1, DAY, win=3.0, modified=DAY + dt.timedelta(seconds=1))], ROUND)
    assert ar.merged_rounds(old, same).first()["win"] == 1.0
    assert ar.merged_rounds(old, newer).first()["win"] == 3.0


def test_replay_boundary_prunes_days_and_needs_its_argument(spark, place):
    path = f"{place}/archive"
    ar.bootstrap_archive(fx.rounds_from_events(spark, DATA), path)
    df = ar.read_archive(spark, path)
    asof = ar.rounds_asof(df, "2024-01-10 06:00:00")
    assert asof.count() == df.where("game_time <= timestamp_ntz'2024-01-10 06:00:00'").count()
    plan = asof._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date" in plan.split("PartitionFilters")[1][:120]
    df.createOrReplaceTempView("rounds_for_function")
    ar.create_rounds_asof(spark, "rounds_for_function")
    assert spark.sql("SELECT * FROM rounds_asof(timestamp_ntz'2024-01-10 06:00:00')").count() == asof.count()
    with pytest.raises(Exception):
        spark.sql("SELECT * FROM rounds_asof()").count()


# --- sheet -------------------------------------------------------------------------------


@pytest.mark.parametrize("encoding", ["cp950", "utf-8-sig"])
def test_sheet_file_is_read_in_its_encoding(spark, place, encoding):
    text = ('GameID,GameType,GameName,Game PlayWay,RTP,max mutilipier\n1049s,0,Name,Base,96.90%,"5,000x"\n'
            '1049s,2,Name,"Feature\nBuy 35倍",96.50%,\n1013,,Other,Base,200%,n/a\n1049s,0,Again,Base,96%,1x\n')
    path = f"{place}/sheet.csv"
    with open(path, "wb") as f:
        f.write(text.encode(encoding))
    parsed = ct.parse_sheet(ct.read_sheet(spark, path))
    rows = {(r["game_id"], r["play_type"]): r for r in ct.catalog_rows(parsed).collect()}
    assert rows[("1049s", 0)]["rtp"] == pytest.approx(0.969) and rows[("1049s", 0)]["max_multiplier"] == 5000.0
    assert rows[("1049s", 2)]["buy_price_x"] == 35.0 and rows[("1013", None)]["rtp"] is None
    codes = sorted(r["code"] for r in ct.catalog_issues(parsed).collect())
    assert codes == ["duplicate_row", "game_id_missing_suffix", "max_multiplier_unparseable", "play_type_blank", "rtp_out_of_range"]


# --- outbound guard -------------------------------------------------------------------------


def alert(spark, families=("INTEGRITY",), case_id="P_northop_g77_u5501"):
    return spark.createDataFrame([(
        case_id, "opened", "human_review", "Critical", list(families), "2025-03-02T07:15", True, "seen twice",
        "u5501", "northop", "g77", "EUR", "41.20", "someone@example.org")],
        "case_id string, action string, escalation string, severity string, families array<string>, scan string, "
        "l4_route boolean, note string, uid string, parent string, game_id string, currency string, amount string, email string")


def test_outbound_columns_and_leak_guard(spark):
    out = rp.outbound_alerts(rp.with_sla(alert(spark).withColumn("t", F.col("scan").cast("timestamp_ntz")), "t"), source="daily")
    assert set(out.columns) <= {*rp.OUTBOUND_COLUMNS, "sla_label", "sla_due_utc", "source", "link"}
    row = out.first()
    assert row["sla_label"] == "1h" and str(row["sla_due_utc"]) == "2025-03-02 08:15:00"
    assert "note" in rp.outbound_alerts(alert(spark), source="x", include_note=True).columns
    assert rp.outbound_alerts(alert(spark, ("INTEGRITY", "u5501")), source="x").count() == 0
    assert rp.outbound_alerts(alert(spark, case_id=None), source="x").count() == 0
    opaque = rp.outbound_alerts(alert(spark), source="x", opaque_salt="pin", base_url="https://e.org").first()
    assert opaque["case_id"].startswith("c_") and "u5501" not in repr(opaque)
    for c in ("uid", "parent", "game_id", "currency", "risk_type"):
        assert c in rp.OUTBOUND_COLUMNS or c in rp.PRIVATE_COLUMNS


# --- rules on planted and clean rounds ---------------------------------------------------------


def planted(spark):
    rows, s = [], 0
    for i in range(8):
        rows.append(round_row(s := s + 1, DAY + dt.timedelta(minutes=i), uid="dup"))
    rows += [round_row(s := s + 1, DAY + dt.timedelta(minutes=9 + i), uid="dup", gsid="twice") for i in range(2)]
    rows.append(round_row(s := s + 1, DAY, uid="cap", win=5200.0))
    rows.append(round_row(s := s + 1, DAY, uid="gap", gap=5.0))
    rows += [round_row(s := s + 1, DAY + dt.timedelta(minutes=i), uid="clean", win=float(i % 2)) for i in range(20)]
    return spark.createDataFrame(rows, ROUND)


def test_integrity_rules_hit_exactly_the_planted_accounts(spark):
    from tallyscope.operators import features as ft
    from tallyscope.operators.fastpath import fast_signals
    from tallyscope.operators.layer1 import integrity_signals

    cat = spark.createDataFrame([("g1", 0, 0.96, 5000.0)], "game_id string, play_type int, rtp double, max_multiplier double")
    r = planted(spark)
    want = {("dup", "L1-DUP_ROUND"), ("cap", "L1-MAX_X_BREACH"), ("gap", "L1-BALANCE_IDENTITY")}
    full = integrity_signals(ft.player_cell_features(r, min_rounds=1), cat).collect()
    fast = fast_signals(r, cat).collect()
    assert {(x["uid"], x["signal_id"]) for x in full} == want == {(x["uid"], x["signal_id"]) for x in fast}
    assert all(x["evidence"] for x in full)


def test_a_missing_build_tag_is_a_cell_of_its_own(spark):
    from tallyscope.operators import features as ft
    from tallyscope.operators.fastpath import fast_signals

    r = planted(spark).withColumn("sm_tag", F.lit(None).cast("string"))
    row = ft.player_cell_features(r, min_rounds=1).where("uid = 'dup'").first()
    assert row["dup_seq_rounds"] == 1 and row["top_win_seq_ids"]
    daily = ft.player_cell_daily(r)
    both = ft.rollup_asof(ft.rollup_daily(daily), ft.rollup_daily(daily)).where("uid = 'dup'").collect()
    assert [(b["rounds"], b["dup_seq_rounds"]) for b in both] == [(20, 2)]
    cat = spark.createDataFrame([("g1", 0, 0.96, 5000.0)], "game_id string, play_type int, rtp double, max_multiplier double")
    assert {x["uid"] for x in fast_signals(r, cat).where("size(evidence) > 0").collect()} == {"dup", "cap", "gap"}


def test_prescient_stakes_are_found_and_honest_ones_are_not(spark):
    from tallyscope.operators import features as ft
    from tallyscope.operators.layer1 import prescient_signals

    rnd, rows = random.Random(5), []
    for uid in ("fore", "fair"):
        for i in range(2600):
            trig = i % 36 == 0
            bet = 50.0 if (trig and uid == "fore") else rnd.choice([0.4, 0.6, 1.0])
            rows.append(round_row(len(rows), DAY + dt.timedelta(seconds=30 * i), uid=uid, bet=bet, trig=trig))
    pc = ft.player_cell_features(spark.createDataFrame(rows, ROUND), evidence=False)
    assert [x["uid"] for x in prescient_signals(pc).collect()] == ["fore"]


# --- streaming ------------------------------------------------------------------------------------


def test_integrity_stream_equals_batch_and_is_idempotent(spark, place):
    from tallyscope.operators.fastpath import fast_signals
    from tallyscope.operators.fusion import fuse
    from tallyscope.streaming import jobs

    cat = fx.catalog(spark)
    rounds = fx.rounds_from_events(spark, DATA)
    rounds.coalesce(1).write.parquet(f"{place}/in")
    store = cg.GateStore(spark, f"{place}/state")
    for _ in range(2):  # the second start has nothing new
        q = jobs.start_integrity(spark, f"{place}/in", cat, store, f"{place}/cp", available_now=True)
        q.awaitTermination(120)
        assert q.exception() is None
    want = {(r["case_id"], r["severity"]) for r in fuse(fast_signals(rounds, cat)).collect()}
    got = spark.read.json(f"{place}/state/alerts")
    assert {(r["case_id"], r["severity"]) for r in got.collect()} == want and got.count() == len(want)


def test_integrity_stream_pairs_a_twin_before_the_batch(spark, place):
    from tallyscope.streaming import jobs

    cat = fx.catalog(spark)
    old = spark.createDataFrame([round_row(5, DAY, gsid="x")], ROUND)
    new = spark.createDataFrame([round_row(9, DAY + dt.timedelta(seconds=5), gsid="x")], ROUND)
    store = cg.GateStore(spark, f"{place}/state")
    jobs.integrity_batch(store, cat, lambda: old)(new, 0)
    assert store.state().count() == 1


def test_log_stream_equals_batch(spark, place):
    from tallyscope.operators.fusion import fuse
    from tallyscope.operators.logs import log_signals, parse_entries
    from tallyscope.streaming import jobs

    logs = fx.logs_from_events(spark, DATA).select("ts", "container", "pod", "severity", "payload")
    logs.coalesce(1).write.json(f"{place}/in")
    store = cg.GateStore(spark, f"{place}/state")
    q = jobs.start_log_monitor(spark, f"{place}/in", store, f"{place}/cp", "salt", available_now=True)
    q.awaitTermination(120)
    assert q.exception() is None
    want = {r["case_id"] for r in fuse(log_signals(parse_entries(logs, "salt"))).collect()}
    assert {r["case_id"] for r in store.state().collect()} == want and want


def test_settlement_counts_stream(spark, place):
    from tallyscope.schema import LOG_ENTRY
    from tallyscope.streaming import jobs

    fx.logs_from_events(spark, DATA).select("ts", "container", "pod", "severity", "payload").coalesce(1).write.json(f"{place}/in")
    stream = spark.readStream.schema(LOG_ENTRY).json(f"{place}/in")
    q = jobs.settlement_counts(stream).writeStream.format("memory").queryName("settled").outputMode("complete").option(
        "checkpointLocation", f"{place}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("settled").count() == jobs.settlement_counts(
        spark.read.schema(LOG_ENTRY).json(f"{place}/in")).count() > 0


# --- composed scan ----------------------------------------------------------------------------------


def test_calibrate_scan_and_replay(spark, place):
    from tallyscope.operators.calibration import load_frozen
    from tallyscope.plans import scan as sc
    from tallyscope.plans.rule_queries import T

    t = T.but(forest_trees=10, forest_min_players=10, detection_window_days=0, cohort_min_members=3)
    rounds, cat = fx.rounds_from_events(spark, DATA, None), fx.catalog(spark)
    with pytest.raises(FileNotFoundError):
        load_frozen(spark, f"{place}/none")
    verdict = sc.calibrate(rounds, cat, "2024-01-10 00:00:00", "2024-01-20 00:00:00", f"{place}/frozen", t)
    assert verdict in {"PASS", "WARN", "FAIL"}
    frozen = load_frozen(spark, f"{place}/frozen")
    assert frozen.count() == 8
    store = cg.GateStore(spark, f"{place}/gate")
    n = sc.replay(spark, rounds, cat, frozen, ["2024-01-20 00:00:00", "2024-01-30 00:00:00"], store, t,
                  persistence_mid="2024-01-10 00:00:00")
    assert n["2024-01-20 00:00:00"] > 0
    assert store.state().count() >= n["2024-01-20 00:00:00"]


def test_thresholds_are_immutable():
    with pytest.raises(Exception):
        Thresholds().min_rounds = 1
