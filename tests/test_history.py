"""Keyed stream state: late twins, expiry and rows without a key."""

import datetime as dt

from pyspark.sql import functions as F

from tallyscope.operators import casegate as cg
from tallyscope.schema import ROUND
from tallyscope.sources import fixtures as fx
from tallyscope.streaming import jobs
from tallyscope.streaming.history import with_history
from tests.test_jobs import DAY, round_row

COLUMNS = "id long, key string, at timestamp_ntz, n int"


def batches(spark, place, files, retention_s):
    """Rows that each batch sees, the files being one batch each."""
    seen = []
    for rows in files:
        spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(f"{place}/in")
        stream = with_history(spark.readStream.schema(COLUMNS).parquet(f"{place}/in"), "key", "at", retention_s)
        q = stream.writeStream.foreachBatch(lambda b, i: seen.append(sorted((r["id"], r["n"]) for r in b.collect()))).option(
            "checkpointLocation", f"{place}/cp").trigger(availableNow=True).start()
        assert q.awaitTermination(90) and q.exception() is None
    return [s for s in seen if s]


def test_twins_meet_late_and_old_rows_leave(spark, place):
    t = lambda h: DAY + dt.timedelta(hours=h)
    files = [
        [(1, "a", t(0), 1), (2, "b", t(0), None), (3, None, t(0), 3), (4, None, None, 4)],
        [(5, "a", t(1), 5), (6, "c", t(-900), 6), (7, None, t(1), 7)],
        [(8, "a", t(30), 8), (9, "c", t(-900), 9), (10, "b", None, 10)],
        [(11, "a", t(31), 11)],
    ]
    got = batches(spark, place, files, 24 * 3600)
    assert got == [
        [(1, 1), (2, None), (3, 3), (4, 4)], [(1, 1), (5, 5), (6, 6), (7, 7)],
        # what is too old for the newest row of its key is seen once more beside it, then gone
        [(1, 1), (2, None), (5, 5), (6, 6), (8, 8), (9, 9), (10, 10)], [(8, 8), (11, 11)],
    ]


def test_a_case_opens_closes_and_reopens_over_keyed_batches(spark, place):
    cat, store = fx.catalog(spark), cg.GateStore(spark, f"{place}/state")
    t = lambda h: DAY + dt.timedelta(hours=h)
    files = [
        [round_row(1, t(0), gsid="x")], [round_row(2, t(1), gsid="x")], [round_row(3, t(2), uid="other")],
        [round_row(4, t(3), gsid="x")],
    ]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, ROUND).coalesce(1).write.mode("append").parquet(f"{place}/in")
        jobs.start_integrity(spark, f"{place}/in", cat, store, f"{place}/cp", available_now=True, retention_s=86400).awaitTermination(90)
    found = spark.read.json(f"{place}/state/alerts").where(F.col("uid") == "u1").orderBy("scan").collect()
    assert [r["action"] for r in found] == ["opened", "reopened"]
