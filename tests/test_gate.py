"""State transitions of the case gate."""

import pytest

from tallyscope.operators import casegate as cg


def cand(cid, esc="monitor", sev="Low", fams=("OUTCOME_MAGNITUDE",)):
    return (cid, esc, sev, list(fams))


class Gate:
    def __init__(self, spark, **knobs):
        from tallyscope.sources.durable import materialise

        self.spark, self.knobs, self.keep = spark, knobs, materialise
        self.state = cg.empty_state(spark)

    def __call__(self, scan, rows, decisions=None):
        c = self.spark.createDataFrame(rows, "case_id string, escalation string, severity string, families array<string>")
        d = self.spark.createDataFrame(list(decisions.items()), "case_id string, decision string") if decisions else None
        decided = self.keep(cg.gate_step(self.state, c, scan, dispositions=d, **self.knobs))
        self.state = cg.state_of(decided)
        self.decided = decided
        return cg.alerts_of(decided).collect()

    def case(self, cid="X"):
        return self.state.where(f"case_id = '{cid}'").first()


def actions(alerts):
    return [a["action"] for a in alerts]


def test_opened_once_then_suppressed(spark):
    g = Gate(spark)
    seen = [actions(g(f"d{i}", [cand("X")])) for i in range(1, 5)]
    assert seen == [["opened"], [], [], []]


def test_escalation_alerts_again(spark):
    g = Gate(spark)
    assert actions(g("d1", [cand("X")])) == ["opened"]
    a = g("d2", [cand("X", "human_review", "High")])
    assert actions(a) == ["escalated"] and "escalation tier increased" in a[0]["note"]
    assert g("d3", [cand("X", "human_review", "High")]) == []


def test_new_family_is_material(spark):
    g = Gate(spark)
    g("d1", [cand("X")])
    a = g("d2", [cand("X", fams=("OUTCOME_MAGNITUDE", "INTEGRITY"))])
    assert actions(a) == ["escalated"] and "INTEGRITY" in a[0]["note"]


def test_disposition_suppresses_until_material(spark):
    g = Gate(spark)
    g("d1", [cand("X")])
    assert g("d2", [cand("X")], {"X": "dismiss_benign"}) == []
    a = g("d3", [cand("X", "human_review", "Critical")], {"X": "dismiss_benign"})
    assert actions(a) == ["reopened"] and "after 'dismiss_benign'" in a[0]["note"]


def test_close_and_reopen(spark):
    g = Gate(spark)
    g("d1", [cand("X")])
    g("d2", [])
    assert g.case()["status"] == "closed"
    assert cg.transitions_of(g.decided).collect()[0]["action"] == "closed"
    assert actions(g("d3", [cand("X")])) == ["reopened"]


def test_debounce_and_reset(spark):
    g = Gate(spark, min_persistence=3)
    assert g("t1", [cand("X")]) == []
    g("t2", [])
    assert g.case() is None
    assert g("t3", [cand("X")]) == [] and g("t4", [cand("X")]) == []
    assert g.case()["status"] == "pending"
    assert actions(g("t5", [cand("X")])) == ["opened"]


def test_close_hysteresis(spark):
    g = Gate(spark, close_after_absent=3)
    g("t1", [cand("X")])
    g("t2", [])
    g("t3", [])
    assert g.case()["status"] == "monitoring"
    assert g("t4", [cand("X")]) == []


def test_review_tier_queues_once_and_again_on_reopen(spark):
    g = Gate(spark)
    two = ("INTEGRITY", "OUTCOME_MAGNITUDE")
    assert g("d1", [cand("Y")])[0]["l4_route"] is False
    a = g("d2", [cand("X", "human_review", "High", two)])
    assert a[0]["l4_route"] is True
    g.state = cg.mark_investigated(g.state, spark.createDataFrame([("X",), ("Y",)], "case_id string"))
    assert g.case()["l4_status"] == "investigated"
    g("d3", [cand("X", "human_review", "High", two)])
    assert cg.investigation_queue(g.state).count() == 0
    a = g("d4", [cand("X", "human_review", "Critical", (*two, "TIMING"))], {"X": "dismiss_benign"})
    assert a[0]["action"] == "reopened" and a[0]["l4_route"] is True


def test_store_is_idempotent_and_survives_reload(spark, place):
    c = spark.createDataFrame([cand("X")], "case_id string, escalation string, severity string, families array<string>")
    assert cg.GateStore(spark, place).ingest("d1", c).count() == 1
    again = cg.GateStore(spark, place)
    assert again.ingest("d1", c).count() == 0
    assert again.ingest("d2", c).count() == 0
    row = again.state().first()
    assert (row["status"], row["seen_scans"], row["last_seen"]) == ("monitoring", 1, "d2")


@pytest.mark.parametrize("min_persistence", [1, 2, 3])
def test_replay_equals_manual_fold(spark, min_persistence):
    rows = [("s1", *cand("A")), ("s2", *cand("A")), ("s2", *cand("B")), ("s3", *cand("A")), ("s3", *cand("B"))]
    df = spark.createDataFrame(rows, "scan string, case_id string, escalation string, severity string, families array<string>")
    _, alerts = cg.replay_scans(spark, df, ["s1", "s2", "s3", "s3"], min_persistence=min_persistence)
    g = Gate(spark, min_persistence=min_persistence)
    want = []
    for s in ("s1", "s2", "s3"):
        want += [(a["case_id"], a["scan"], a["action"]) for a in g(s, [r[1:] for r in rows if r[0] == s])]
    assert sorted((a["case_id"], a["scan"], a["action"]) for a in alerts.collect()) == sorted(want)


SHAPE = "case_id string, escalation string, severity string, families array<string>"


def test_store_equals_fold_over_merged_runs(spark, place):
    """Cases come and go over many scans; runs are merged and old versions forgotten on the way."""
    g, store = Gate(spark), cg.GateStore(spark, place, buckets=2, fanout=2, keep=2)
    for i in range(7):
        cases = [cand(x, *(("human_review", "High") if i % 3 == 2 else ())) for j, x in enumerate("ABCD") if (i + j) % (j + 2) == 0]
        want = {(a["case_id"], a["action"], a["l4_route"]) for a in g(f"d{i}", cases)}
        got = store.ingest(f"d{i}", spark.createDataFrame(cases, SHAPE))
        assert {(a["case_id"], a["action"], a["l4_route"]) for a in got.collect()} == want
    columns = g.state.columns
    assert sorted(map(str, store.state().select(*columns).collect())) == sorted(map(str, g.state.select(*columns).collect()))
    levels = [e["level"] for e in store.tables.version().of("archive")]
    assert max(levels) >= 1 and len(levels) <= 2 * 2 * 3


def test_store_writes_no_closed_case_that_stays_away(spark, place):
    store = cg.GateStore(spark, place, buckets=2)
    store.ingest("d1", spark.createDataFrame([cand(f"X{i}") for i in range(20)], SHAPE))
    store.ingest("d2", spark.createDataFrame([cand("Y")], SHAPE))
    store.ingest("d3", spark.createDataFrame([cand("Y"), cand("X7")], SHAPE))
    assert sorted(r["case_id"] for r in store.decided().collect()) == ["X7", "Y"]
    state = {r["case_id"]: r["status"] for r in store.state().collect()}
    assert len(state) == 21 and state["X7"] == "monitoring" and state["X3"] == "closed"


def test_a_scan_that_stopped_before_its_version_is_repeated(spark, place, monkeypatch):
    store, c = cg.GateStore(spark, place), spark.createDataFrame([cand("X")], SHAPE)
    with monkeypatch.context() as m:
        m.setattr(store, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.ingest("d1", c)
    assert store.state().count() == 0
    assert [a["action"] for a in store.ingest("d1", c).collect()] == ["opened"]


def test_archived_cases_are_marked_investigated(spark, place):
    store = cg.GateStore(spark, place)
    store.ingest("d1", spark.createDataFrame([cand("X", "human_review", "High"), cand("Y", "human_review", "High")], SHAPE))
    store.ingest("d2", spark.createDataFrame([cand("Y", "human_review", "High")], SHAPE))
    store.mark_investigated(spark.createDataFrame([("X",), ("Y",), ("Z",)], "case_id string"))
    assert {r["case_id"]: r["l4_status"] for r in store.state().collect()} == {"X": "investigated", "Y": "investigated"}
