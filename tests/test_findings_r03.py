"""Defects found in round 3."""

from pyspark.sql import functions as F

from tallyscope.functions.ranks import order_stats
from tallyscope.operators import behaviour as bh
from tallyscope.operators import layer1 as l1
from tallyscope.operators import logs as lg
from tallyscope.plans import rule_queries as rq
from tallyscope.settings import Thresholds
from tallyscope.sources import sinks as sk
from tallyscope.sources import fixtures as fx
from tallyscope.streaming.history import with_history
from tests.conftest import DATA


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_log_records_are_never_broadcast_to_the_evidence(spark):
    records = lg.parse_entries(fx.logs_from_events(spark, DATA), "salt")
    wanted = fx.rounds_from_events(spark, DATA).selectExpr(
        "uid AS case_id", "game_seq_id AS gsid", "date_format(game_time, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS utc")
    got = plan(lg.evidence_pull(wanted, records, "2024-02-10 00:00:00", pad_s=3600))
    assert "SortMergeJoin" in got and "Broadcast" not in got


def test_a_sketch_is_taken_once_for_both_its_readers(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.sqrt("id").alias("v"))
    got = order_stats(df, ["g"], "v", {"mid": 0.5})
    assert "percentile" not in got._jdf.queryExecution().toString()
    assert {r["g"]: r["n"] for r in got.collect()} == {0: 1667, 1: 1667, 2: 1666}


def test_a_return_at_the_limit_passes_whatever_the_order_of_its_days(spark):
    wins = (0.1, 0.2, 0.3, 0.4)
    rows = [("p", u, "g", f"2024-01-0{i + 1}", 10, 1.0, x) for u, order in (("u", wins), ("v", wins[::-1]))
            for i, x in enumerate(order)]
    daily = spark.createDataFrame(
        rows, "parent string, uid string, game_id string, event_date string, rounds long, turnover double, total_win double")
    got = {r["uid"]: r["rtp"] for r in bh.rtp_screen(daily.coalesce(1), 20, 0.25).collect()}
    assert got == {"u": 0.25, "v": 0.25}


def test_the_cell_at_the_bound_reaches_it(spark):
    wins = [1.2, 2.5, 3.6, 4.4, 4.7, 5.2, 5.4]  # number 5 is one median distance above the median, which sums in doubles may miss
    cells = spark.createDataFrame(
        [("op", f"u{i}", "g1", 0, "CNY", "b", 10, 1.0, w) for i, w in enumerate(wins)],
        "parent string, uid string, game_id string, play_type int, currency string, sm_tag string, rounds long, "
        "turnover double, total_win double")
    t = Thresholds().but(min_rounds=60, watch_n_mad=1.0, watch_min_population=3, watch_min_rounds=3)
    got = l1.magnitude_watch(cells, fx.catalog(spark), t)
    assert sorted(r["total_win"] for r in got.collect()) == wins[5:]


def test_metrics_read_stored_aggregates_and_not_the_rounds(spark):
    got = rq._all_metrics(spark, DATA, rq.lineitem(spark, DATA))
    assert not [f for f in got.inputFiles() if "lineitem" in f] and got.where("metric = 'hit_rate_z'").count()


def test_keys_of_a_stream_share_states(spark, place):
    rows = spark.range(300).selectExpr("id", "concat('k', id % 150) AS key", "timestamp_ntz'2024-01-01 00:00:00' AS at")
    rows.coalesce(1).write.parquet(f"{place}/in")
    stream = with_history(spark.readStream.schema(rows.schema).parquet(f"{place}/in"), "key", "at", 3600, buckets=8)
    q = stream.writeStream.format("memory").queryName("shared_states").option("checkpointLocation", f"{place}/cp").trigger(
        availableNow=True).start()
    assert q.awaitTermination(90) and q.exception() is None
    assert spark.table("shared_states").count() == 300
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 8


def test_documents_and_findings_are_stored_compressed(spark, place):
    import glob

    df = spark.range(100).selectExpr("concat('c', id) AS case_id")
    sk.emit_candidates(df, f"{place}/a")
    sk.emit_findings(df, f"{place}/b")
    assert glob.glob(f"{place}/a/*.json.gz") and glob.glob(f"{place}/b/*.csv.gz")
    assert spark.read.json(f"{place}/a").count() == spark.read.option("header", True).csv(f"{place}/b").count() == 100
