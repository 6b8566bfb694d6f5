"""Log detectors, positive and negative, and redaction."""

import datetime as dt
import json

import pytest

from tallyscope.operators import logs as lg
from tallyscope.operators import redaction as rd
from tallyscope.schema import LOG_ENTRY

T0 = dt.datetime(2024, 1, 1, 12, 59, 59)


def entry(gsid=None, code=None, s=0.0, path=None, agent=None, message="", token="tok", container="spin-server", **more):
    doc = {"resCode": code, "response": {"gameSeqId": gsid}, "params": {"token": token, "agent": agent}, "path": path,
           "method": "POST" if path else None, "data": {"message": message}, **more}
    if path is None:
        del doc["path"]
    label = "Request" if path else "Info Spin-Server Response info -"
    return (T0 + dt.timedelta(seconds=s), container, "pod", "INFO", f"{label} {json.dumps(doc)}".replace('"path": ', '"path":'))


def recs(spark, *rows):
    return lg.parse_entries(spark.createDataFrame(list(rows), LOG_ENTRY), "s")


@pytest.mark.parametrize("rows,n", [
    ([entry("g1", 1000), entry("g1", 1000, 0.3), entry("g2", 1000)], 1),
    ([entry("g1", 1000), entry("g2", 1000)], 0), ([entry("g1", 802), entry("g1", 1000)], 0)])
def test_double_settlement(spark, rows, n):
    assert lg.double_settlements(lg.responses(recs(spark, *rows))).count() == n


@pytest.mark.parametrize("rows,n", [
    ([entry("g1", 802), entry("g1", 1000, 2)], 1), ([entry("g1", 802)], 0), ([entry("g1", 1000)], 0),
    ([entry("g1", 0), entry("g1", 1000)], 0)])
def test_round_replay(spark, rows, n):
    assert lg.round_replays(lg.responses(recs(spark, *rows))).count() == n


@pytest.mark.parametrize("row,kind", [
    (entry("g1", 0, path="/internal/admin/settle"), "path"), (entry("g1", 0, path="/v2/1049s/spin"), None),
    (entry("g1", 901, agent="ag1", message="Agent not found: ag1"), "unknown_agent")])
def test_bypass(spark, row, kind):
    assert [r["kind"] for r in lg.path_bypasses(recs(spark, row)).collect()] == ([kind] if kind else [])


def test_cadence_spans_the_hour_and_separates_players(spark):
    r = recs(spark, entry("g1", 1000, 0.0), entry("g2", 1000, 0.02), entry("g3", 1000, 1.2), entry("g4", 1000, 0.5, token="other"))
    c = lg.cadence_census(lg.responses(r)).collect()
    assert [(x["rounds"], round(x["min_gap_s"], 6), round(x["median_gap_s"], 6)) for x in c] == [(3, 0.02, 1.18)]
    assert {x["bucket"]: x["gaps"] for x in lg.gap_buckets(lg.responses(r)).collect()} == {"<50ms": 1, ">=1s": 1}


def test_signals_are_attributed_when_the_second_stream_knows_the_round(spark):
    who = (T0, "play-go", "pod", "INFO", 'play {"parent":"op","uid":"u1","params":{"gameSeqId":"g1","gameId":"1049s"}}')
    s = {x["signal_id"]: x for x in lg.log_signals(recs(
        spark, entry("g1", 1000), entry("g1", 1000, 1), entry("g2", 802), entry("g2", 1000, 1), who,
        entry("g3", 0, path="/x"))).collect()}
    assert (s["LOG-DOUBLE_SETTLE"]["uid"], s["LOG-DOUBLE_SETTLE"]["grain"]) == ("u1", "player_cell")
    assert (s["LOG-ROUND_REPLAY"]["uid"], s["LOG-ROUND_REPLAY"]["grain"]) == (None, "game_cell")
    assert s["LOG-PATH_BYPASS"]["family"] == "ENVIRONMENT"


def test_non_object_parts_and_plain_text_are_tolerated(spark):
    odd = (T0, "spin-server", "p", "INFO", 'x {"params":"text","response":[1],"resCode":1000}')
    plain = (T0, "spin-server", "p", "INFO", "no json here")
    got = recs(spark, odd, plain).collect()
    assert len(got) == 1 and got[0]["gsid"] is None and got[0]["res_code"] == 1000


def test_token_never_leaves_the_parser(spark):
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.c2lnbmF0dXJl"
    out = lg.log_signals(recs(spark, entry("g1", 1000, token=jwt), entry("g1", 1000, 1, token=jwt))).collect()
    assert out and "eyJ" not in repr(out)


def test_window(spark):
    assert lg.log_window("2024-01-01T00:01:00", "2024-01-01T00:05:00") is None
    start, end = lg.log_window("2024-01-01T00:10:00", "2024-01-01T00:05:00")
    assert (start.minute, start.second, end.minute, end.second) == (4, 0, 8, 30)


def test_redaction_of_text_and_json(spark):
    import re

    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.c2lnbmF0dXJl"
    texts = [f"a {jwt} b {jwt}", "Authorization: abc next", "eyJ0ZXN0 eyJ0ZXN0Mg==", "clean text", f"bearer={jwt}", ""]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    got = {r["i"]: r["text"] for r in rd.redact_text(df, "text", "s").collect()}
    import hashlib

    def tagged(kind, secret):
        return f"REDACTED:{kind}:sha256=" + hashlib.sha256(("s" + secret).encode()).hexdigest()[:12]

    for i, x in enumerate(texts):
        for kind, rx in rd.PATTERNS:
            x = re.sub(rx, lambda m, k=kind: tagged(k, m.group(0)), x)
        assert got[i] == x
    doc = json.dumps({"token": "abc", "inner": {"note": jwt, "n": 1, "list": [{"Password": "x"}]}})
    j = rd.redact_json(spark.createDataFrame([(doc,), (None,)], "payload string"), "payload", "s").collect()
    clean = json.loads(j[0]["payload"])
    assert clean["token"].startswith("REDACTED:token_field") and clean["inner"]["note"].startswith("REDACTED:jwt")
    assert clean["inner"]["list"][0]["Password"].startswith("REDACTED:token_field") and j[0]["redactions"] == 3
    plain = '{"a": "Bearer: x\\n y", "token" : "q\\"q", "a": 1.50, "session": "", "b": "authorization=z"}'
    row = rd.redact_json(spark.createDataFrame([(plain,)], "payload string"), "payload", "s").first()
    assert row["redactions"] == 3 and '"a": 1.50, "session": ""' in row["payload"]
    assert row["payload"].startswith('{"a": "REDACTED:bearer') and '\\n y", "token" : "' + tagged("token_field", 'q\\"q') in row["payload"]
    with pytest.raises(ValueError):
        rd.assert_clean(df, ["text"])
