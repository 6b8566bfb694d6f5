"""Escalation routes of fusion."""

import pytest

from tallyscope import Thresholds
from tallyscope.operators.fusion import fuse
from tallyscope.schema import SIGNAL


def sig(signal_id, family, method="ABSOLUTE", baseline="identity", value=1.0, p=None, effect=None, unit="",
        persistence="not_computable", grain="player_cell", layer=1, desc=""):
    player = grain != "game_cell"
    return (signal_id, family, layer, grain, "opX" if player else None, "uidX" if player else None, "1049s", 0, "MMK",
            "0.0.1", "m", value, 0.0, method, baseline, p, effect, unit, 50, persistence, desc, ["g1@2024-01-01T00:00:00Z"], None)


def one(spark, *rows, t=Thresholds(), **kw):
    got = fuse(spark.createDataFrame(list(rows), SIGNAL), t, **kw).collect()
    assert len(got) == 1
    return got[0]


@pytest.mark.parametrize("rule,baseline,severity", [
    ("L1-MAX_X_BREACH", "certified", "Critical"), ("L1-BALANCE_IDENTITY", "identity", "High"),
    ("L1-DUP_ROUND", "identity", "High"), ("LOG-DOUBLE_SETTLE", "identity", "High"),
])
def test_lone_integrity_breach_is_reviewed(spark, rule, baseline, severity):
    c = one(spark, sig(rule, "INTEGRITY", baseline=baseline))
    assert (c["escalation"], c["severity"]) == ("human_review", severity)
    assert "integrity single-family" in c["notes"][0]


def test_route_can_be_disabled(spark):
    c = one(spark, sig("L1-MAX_X_BREACH", "INTEGRITY", baseline="certified"), t=Thresholds().but(integrity_enabled=False))
    assert c["escalation"] == "monitor"


def test_weak_statistic_stays_monitor(spark):
    c = one(spark, sig("L1-EXCESS_TURNOVER", "OUTCOME_MAGNITUDE", "BH", "certified", 3.0, 0.01, 5.0, "rtp_points", "not_evaluated"))
    assert c["escalation"] == "monitor"


@pytest.mark.parametrize("persistence,tier", [("not_evaluated", "monitor"), ("held", "human_review")])
def test_high_z_needs_persistence(spark, persistence, tier):
    c = one(spark, sig("L1-EXCESS_TURNOVER", "OUTCOME_MAGNITUDE", "BH", "certified", 12.1, 1e-9, 1094.9, "rtp_points", persistence))
    assert c["escalation"] == tier


@pytest.mark.parametrize("effects,tier", [((43.0, 41.0), "human_review"), ((43.0,), "monitor"), ((1.0, 1.5), "monitor")])
def test_drift_route(spark, effects, tier):
    rows = [sig("L2-OFF_TARGET_RTP", "OUTCOME_MAGNITUDE", "ABSOLUTE+BH", "certified", e, None, e, "rtp_points",
                "not_evaluated", "game_cell", 2, str(e)) for e in effects]
    assert one(spark, *rows)["escalation"] == tier


def test_two_families_are_reviewed_and_watch_families_do_not_count(spark):
    a = sig("L1-SAME_SECOND", "TIMING", "ROBUST", "empirical_loo")
    b = sig("L1-FEATURE_ROUTING", "ROUTING", "ROBUST", "empirical_loo")
    w = sig("L1-MAGNITUDE_WATCH", "MAGNITUDE_WATCH", "ROBUST", "certified")
    assert one(spark, a, b)["escalation"] == "human_review"
    c = one(spark, a, w)
    assert (c["escalation"], c["independent_families"]) == ("monitor", 1)
    assert one(spark, sig("L1-SAME_SECOND", "TIMING", "ROBUST", "empirical_loo", persistence="held"))["escalation"] == "enhanced"


def test_cohort_is_annotated_not_suppressed(spark):
    members = spark.createDataFrame([("opX", "uidX", "cohort_1")], "parent string, uid string, cohort_id string")
    c = one(spark, sig("L1-SAME_SECOND", "TIMING", "ROBUST", "empirical_loo"), cohort_members=members, population=1000)
    assert c["cohort_id"] == "cohort_1" and any("not suppressed" in n for n in c["notes"])
