"""Figures of round 3 that must not grow faster than the input."""

import datetime as dt

from pyspark.sql import functions as F

from tallyscope.functions.columns import sanitize
from tallyscope.operators import fusion as fu
from tallyscope.plans import all_queries  # noqa: F401
from tallyscope.plans.registry import QUERIES
from tallyscope.schema import ROUND
from tallyscope.sources import fixtures as fx
from tallyscope.sources import archive as ar
from tallyscope.sources import snapshots as sn
from tests.conftest import DATA
from tests.test_jobs import round_row

DAY = dt.datetime(2024, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranges_follow_the_rows_and_not_their_compressed_size(spark, place, monkeypatch):
    """F16: a day that compresses well was sorted by one task, however many rows it held."""
    monkeypatch.setattr(sn, "RANGE_ROWS", 100, raising=False)
    rows = spark.range(1000).select(F.lit(1).alias("a"), F.col("id").alias("serial"))
    rows.write.parquet(f"{place}/rows")
    assert sn.range_count(spark.read.parquet(f"{place}/rows")) == 10
    path = f"{place}/archive"
    ar.bootstrap_archive(spark.createDataFrame([round_row(i, DAY) for i in range(1000)], ROUND), path)
    assert len(ar.read_archive(spark, path).inputFiles()) >= 5


def test_a_merge_sorts_rounds_once_and_keeps_the_rule(spark):
    """F16: whole rounds were sorted four times, as aggregates of structs are."""
    later = DAY + dt.timedelta(days=1)
    old = spark.createDataFrame([
        round_row(1, DAY, win=1.0, modified=DAY), round_row(2, DAY, win=1.0, modified=later),
        (*round_row(3, DAY, win=1.0)[:-1], None), round_row(4, DAY, win=1.0, modified=DAY),
        round_row(4, later, win=2.0, modified=later), round_row(6, DAY, win=1.0, modified=DAY)], ROUND)
    new = spark.createDataFrame([
        round_row(1, DAY, win=5.0, modified=later), round_row(2, DAY, win=5.0, modified=later),
        round_row(3, DAY, win=5.0, modified=later), round_row(4, DAY, win=5.0, modified=later),
        round_row(5, DAY, win=4.0, modified=DAY), round_row(5, DAY, win=5.0, modified=later),
        (*round_row(6, DAY, win=5.0)[:-1], None)], ROUND)
    got = ar.merged_rounds(old, new)
    assert {r["serial"]: r["win"] for r in got.collect()} == {1: 5.0, 2: 1.0, 3: 1.0, 4: 2.0, 5: 5.0, 6: 1.0}
    shown = plan(ar.merged_rounds(old, new))
    assert "Aggregate" not in shown and "Join" not in shown and shown.count("Exchange hashpartitioning") == 1


def test_an_id_is_cleaned_by_two_patterns_and_no_more(spark):
    """a condition on the cleaned text held its patterns three times, in each branch of a case id."""
    rows = spark.createDataFrame([("a b",), ("..x.",), ("",), (None,), ("__",), ("y" * 70,)], "t string")
    got = rows.select(sanitize("t", "NA").alias("x"))
    assert [r["x"] for r in got.collect()] == ["a_b", "x", "NA", "NA", "NA", "y" * 64]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") <= 2


def test_fusion_keeps_one_least_row_a_route(spark):
    """the order of a signal was built and kept for each of five attributes."""
    got = plan(fu.fuse(fx.signals_from_lineitem(spark, DATA)))
    assert "min_by(" not in got


def test_cohort_annotation_groups_the_rounds_once(spark):
    """the cells of all rounds were computed for the groups, their ids and their members."""
    got = plan(QUERIES["FU_9_cohort_annotation"](spark, DATA))
    assert got.count("lineitem.parquet") == 1  # the signals
