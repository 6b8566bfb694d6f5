"""Queries of the review tables and the behavioural engine."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyscope.functions.columns import multiple
from tallyscope.operators import behaviour as bh
from tallyscope.operators import casegate as cg
from tallyscope.operators import features as ft
from tallyscope.operators import fusion as fu
from tallyscope.operators import reporting as rp
from tallyscope.plans import sqltext as q
from tallyscope.plans.case_queries import _CD, _FZ
from tallyscope.plans.registry import register
from tallyscope.plans.rule_queries import accounts, events, lineitem
from tallyscope.settings import Thresholds
from tallyscope.sources import fixtures as fx
from tallyscope.sources.durable import materialise

T = Thresholds().but(min_rounds=5)
EV, EVA, LI = q.rounds_events(), q.rounds_events(None), q.rounds_lineitem()

# --- review events over candidates --------------------------------------------------
REVIEW_COLUMNS = """concat(case_id, '@2024-01-', day) AS id, case_id, concat('2024-01-', day) AS scan,
  concat('2024-01-', day, 'T00:00:00Z') AS detected_at, escalation, severity,
  CASE WHEN n_sig > 1 THEN 'Bot/Automation' WHEN n_buy > 0 THEN 'Abnormal RTP' ELSE 'Settlement Anomaly' END AS risk_type,
  CASE WHEN escalation <> 'human_review' THEN 'monitoring' WHEN n_buy = 0 THEN 'confirmed' WHEN n_buy = 1 THEN 'queued'
    WHEN n_buy = 2 THEN 'rejected' ELSE 'downgraded' END AS status,
  concat('case of ', uid) AS title, parent AS operator, uid, 'g1' AS game_id, n_buy, n_sig"""
_RE = f"""re AS (SELECT {REVIEW_COLUMNS} FROM (SELECT *, lpad(CAST(seq * 3 AS VARCHAR), 2, '0') AS day FROM (
    SELECT {fx.CANDIDATE_COLUMNS} FROM ({fx.CANDIDATE_SHAPE}) b WHERE n_err >= 1)))"""


def review_events(s, d):
    c = fx.candidates_from_events(s, d).withColumn("day", F.lpad((F.col("seq") * 3).cast("string"), 2, "0"))
    return _view(c, "review_src", REVIEW_COLUMNS)


def _view(df, name, columns):
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(f"SELECT {columns} FROM {name}")


_EVENT = "id case_id detected_at severity status risk_type operator uid"
_FILTERS = dict(date_from="2024-01-09", date_to="2024-01-24", severity="High", q="U1", actionable=True)
register("FLT_8_event_filters", lambda s, d: rp.filter_events(review_events(s, d), **_FILTERS), _EVENT,
         """SELECT * FROM re WHERE scan BETWEEN '2024-01-09' AND '2024-01-24' AND severity = 'High' AND status != 'monitoring'
         AND contains(lower(id || ' ' || title || ' ' || uid || ' ' || operator || ' ' || game_id), 'u1')""", _RE)
_COLLAPSED = """SELECT case_id, arg_max(id, detected_at) AS id, arg_max(severity, detected_at) AS severity,
    arg_max(status, detected_at) AS status, count(*) AS occurrences, min(scan) AS first_seen, max(scan) AS last_seen
    FROM re GROUP BY case_id"""
_ROW = "case_id id severity status occurrences:i first_seen last_seen"
register("WIN_11_case_lifecycle", lambda s, d: rp.collapse_days(review_events(s, d)), _ROW, _COLLAPSED, _RE)
_SEV = "CASE severity WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END"
for _name in ("RL_9_list_events", "SRT_3_event_ranking"):
    register(_name, lambda s, d: rp.list_events(review_events(s, d)), _ROW,
             f"SELECT * FROM ({_COLLAPSED}) ORDER BY {_SEV}, last_seen DESC, case_id", _RE)


def _alerts(s, d):
    """Alerts of every scan against the state of the scan before it."""
    c = fx.candidates_from_events(s, d)
    return cg.replay_scans(s, c, [f"s{i:02d}" for i in range(1, 11)])[1].withColumn(
        "scan", F.concat(F.lit("2024-01-"), F.lpad((F.substring("scan", 2, 2).cast("int") * 3).cast("string"), 2, "0")))


_AL = f"""{_CD}, al AS (SELECT case_id, action, severity, escalation, uid, parent,
    '2024-01-' || lpad(CAST(seq * 3 AS VARCHAR), 2, '0') AS scan FROM ca WHERE action IS NOT NULL), {_RE}"""
register("RL_8_daily_summary", lambda s, d: rp.daily_summary(review_events(s, d), _alerts(s, d)),
         "date events:i critical:i high:i medium:i low:i status_confirmed:i alerts:i opened:i escalated:i reopened:i",
         """SELECT e.scan AS date, events, critical, high, medium, low, status_confirmed, alerts, opened, escalated, reopened
         FROM (SELECT scan, count(*) AS events, count(*) FILTER (severity = 'Critical') AS critical,
         count(*) FILTER (severity = 'High') AS high, count(*) FILTER (severity = 'Medium') AS medium,
         count(*) FILTER (severity = 'Low') AS low, count(*) FILTER (status = 'confirmed') AS status_confirmed
         FROM re GROUP BY 1) e JOIN (SELECT scan, count(*) AS alerts, count(*) FILTER (action = 'opened') AS opened,
         count(*) FILTER (action = 'escalated') AS escalated, count(*) FILTER (action = 'reopened') AS reopened
         FROM al GROUP BY 1) a ON e.scan = a.scan""", _AL)
register("RL_11_alert_queue", lambda s, d: rp.alert_queue(_alerts(s, d), review_events(s, d)),
         "case_id action severity scan event_id event_risk_type",
         """SELECT al.case_id, action, al.severity, al.scan, re.id AS event_id, risk_type AS event_risk_type
         FROM al LEFT JOIN re ON re.id = al.case_id || '@' || al.scan""", _AL)
register("RL_10_daily_series", lambda s, d: rp.daily_series(review_events(s, d), "2024-01-01", "2024-01-31"),
         "date events:i critical_high:i",
         """SELECT strftime(g, '%Y-%m-%d') AS date, count(id) AS events,
         count(*) FILTER (severity IN ('Critical', 'High')) AS critical_high
         FROM generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) t(g)
         LEFT JOIN re ON re.scan = strftime(g, '%Y-%m-%d') GROUP BY 1""", _RE)
register("RL_10_breakdown", lambda s, d: rp.breakdown(review_events(s, d)), "dimension label n:i",
         """SELECT dimension, label, count(*) AS n FROM (SELECT unnest(['risk_type', 'severity', 'status', 'operator']) AS dimension,
         unnest([risk_type, severity, status, operator]) AS label FROM re) GROUP BY 1, 2""", _RE)
register("RL_10_confirm_rate", lambda s, d: rp.confirm_rate(review_events(s, d)), "confirm_rate:f",
         """SELECT round(count(*) FILTER (status = 'confirmed') / count(*) FILTER (status IN ('confirmed', 'rejected',
         'downgraded', 'closed')), 3) AS confirm_rate FROM re""", _RE)
register("SRT_6_top_operators", lambda s, d: rp.top_operators(review_events(s, d)), "operator n:i",
         "SELECT operator, count(*) AS n FROM re GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", _RE)
register("RL_3_event_status", lambda s, d: rp.event_status(
    review_events(s, d).drop("status"), review_events(s, d).where("n_buy < 3").selectExpr(
        "case_id", "scan", "CASE n_buy WHEN 0 THEN 'Verdict: **Confirmed**' WHEN 1 THEN 'verdict: rejected' ELSE 'pending' END AS text")
    .groupBy("case_id").agg(F.min("text").alias("text"))), "id status",
    """SELECT re.id, CASE WHEN escalation != 'human_review' THEN 'monitoring' WHEN f.t IS NULL THEN 'queued'
    WHEN f.t = 0 THEN 'confirmed' WHEN f.t = 2 THEN 'rejected' ELSE 'skeptic_review' END AS status FROM re LEFT JOIN (
    SELECT case_id, min(CASE n_buy WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END) AS t FROM re WHERE n_buy < 3 GROUP BY 1) f
    ON f.case_id = re.case_id""", _RE)
register("RL_2_event_dating", lambda s, d: review_events(s, d).select(
    "id", F.when(F.col("n_buy") > 1, F.col("detected_at")).alias("latest_evidence_utc"),
    F.when(F.col("n_sig") > 0, F.lit("2024-01-30T00:00:00Z")).otherwise("").alias("last_active_utc"),
    F.lit("2024-01-31").alias("window_end")).withColumn("dated", rp.detected_at()), "id dated",
    """SELECT id, CASE WHEN n_buy > 1 THEN detected_at WHEN n_sig > 0 THEN '2024-01-30T00:00:00Z' ELSE '2024-01-31' END AS dated
    FROM re""", _RE)


def _decisions(s, d):
    return review_events(s, d).where("n_buy > 0").select(
        F.col("id").alias("event_id"), F.explode(F.array(
            F.struct(F.lit("keep_monitoring").alias("decision"), F.lit("2024-02-01").alias("at")),
            F.struct(F.when(F.col("n_sig") > 0, "dismiss_benign").otherwise("confirmed_for_action").alias("decision"),
                     F.lit("2024-02-02").alias("at")))).alias("x")).select(
        "event_id", "x.decision", "x.at", F.lit("r").alias("reviewer"), F.lit("").alias("notes"))


register("RL_12_disposition_overlay", lambda s, d: rp.overlay_dispositions(review_events(s, d), _decisions(s, d)).withColumn(
    "decision", F.col("disposition.decision")), "id status decision decisions:i",
    """SELECT id, CASE WHEN n_buy = 0 THEN status WHEN n_sig > 0 THEN 'rejected' ELSE 'confirmed' END AS status,
    CASE WHEN n_buy > 0 THEN CASE WHEN n_sig > 0 THEN 'dismiss_benign' ELSE 'confirmed_for_action' END END AS decision,
    CASE WHEN n_buy > 0 THEN 2 END AS decisions FROM re""", _RE)
register("RL_15_sla_due", lambda s, d: rp.with_sla(review_events(s, d).withColumn(
    "scan_time", F.to_timestamp_ntz(F.col("scan"), F.lit("yyyy-MM-dd")))), "id sla_label sla_due_utc:t",
    """SELECT id, CASE severity WHEN 'Critical' THEN '1h' WHEN 'High' THEN 'same-day' WHEN 'Medium' THEN '48h' ELSE 'weekly' END
    AS sla_label, CAST(scan AS TIMESTAMP) + CASE severity WHEN 'Critical' THEN INTERVAL 1 HOUR WHEN 'High' THEN
    INTERVAL '23 hours 59 minutes' WHEN 'Medium' THEN INTERVAL 48 HOUR ELSE INTERVAL 168 HOUR END AS sla_due_utc FROM re""", _RE)
register("RL_16_outbound_alerts", lambda s, d: rp.outbound_alerts(
    review_events(s, d).withColumn("families", F.when(F.col("n_sig") > 1, F.array("uid")).otherwise(F.array(F.lit("TIMING")))),
    source="daily", base_url="https://example.org"), "case_id severity families:o scan source link",
    """SELECT case_id, severity, CASE WHEN n_sig > 1 THEN [uid] ELSE ['TIMING'] END AS families, scan, 'daily' AS source,
    'https://example.org/case/' || case_id AS link FROM re WHERE NOT (n_sig > 1 AND length(uid) >= 3)""", _RE)
register("RL_17_burst_rollup", lambda s, d: rp.burst_rollup(review_events(s, d)), "scan severity alerts:i",
         "SELECT scan, severity, count(*) AS alerts FROM re GROUP BY 1, 2", _RE)

# --- risk type and group roll-ups over signals ---------------------------------------


def _cased(s, d):
    sg = fx.signals_from_lineitem(s, d)
    return fu.signals_with_case(sg, fu.fuse(sg))


_TYPE = """CASE WHEN signal_id IN ('L1-DUP_ROUND', 'L1-MAX_X_BREACH') THEN 0 WHEN signal_id = 'L1-BALANCE_IDENTITY' THEN 1
    WHEN signal_id = 'L2-OFF_TARGET_RTP' OR family = 'ENVIRONMENT' THEN 8 WHEN family = 'TIMING' THEN 5
    WHEN family = 'OUTCOME_FREQUENCY' THEN 6 ELSE 7 END"""
_TYPED = f"""{_FZ}, ty AS (SELECT case_id, list_extract(['Settlement Anomaly', 'Balance Reconciliation', 'API Anomaly',
    'Advantage Play', 'Feature Buy Abuse', 'Bot/Automation', 'Suspicious Betting Pattern', 'Abnormal RTP',
    'Game RTP Shift'], CAST(min({_TYPE}) + 1 AS BIGINT)) AS risk_type FROM en JOIN fz
    ON en.isg = fz.isg AND en.ep IS NOT DISTINCT FROM fz.ep AND en.eu IS NOT DISTINCT FROM fz.eu
    AND en.eg IS NOT DISTINCT FROM fz.eg AND en.ept IS NOT DISTINCT FROM fz.ept
    AND en.ec IS NOT DISTINCT FROM fz.ec AND en.et IS NOT DISTINCT FROM fz.et GROUP BY case_id)"""
register("RL_1_risk_type", lambda s, d: rp.risk_types(_cased(s, d)), "case_id risk_type", "SELECT * FROM ty", _TYPED)
_BE = f"""{_FZ}, be AS (SELECT * FROM (SELECT fz.case_id, en.parent AS operator, en.uid, substr(split_part(en.key, '@', 2), 1, 4)
    AS day, en.game_id, en.play_type, en.sm_tag, en.signal_id AS breach, en.value, en.threshold, row_number() OVER (
    PARTITION BY en.parent, en.uid, substr(split_part(en.key, '@', 2), 1, 4) ORDER BY CASE en.signal_id
    WHEN 'L1-MAX_X_BREACH' THEN 0 WHEN 'L1-BALANCE_IDENTITY' THEN 1 ELSE 2 END, -en.value, en.description) AS i
    FROM en JOIN fz ON NOT en.isg AND NOT fz.isg AND en.ep = fz.ep AND en.eu = fz.eu
    WHERE en.signal_id IN ('L1-MAX_X_BREACH', 'L1-BALANCE_IDENTITY', 'L1-DUP_ROUND')) WHERE i = 1),
  cr AS (SELECT day, operator, game_id, play_type, sm_tag, breach, count(*) AS accounts, max(value) AS peak,
    'G_' || operator || '_' || game_id || '_pt' || play_type || '_' || sm_tag || '_' || breach || '@' || day AS group_id
    FROM be GROUP BY 1, 2, 3, 4, 5, 6 HAVING count(*) >= 2),
  br AS (SELECT day, sm_tag, breach, count(DISTINCT operator || '/' || game_id || '/' || play_type) AS cells,
    count(DISTINCT operator) AS operators, count(*) AS accounts, max(value) AS peak,
    'B_' || sm_tag || '_' || breach || '@' || day AS group_id FROM be GROUP BY 1, 2, 3
    HAVING count(DISTINCT operator || '/' || game_id || '/' || play_type) >= 2)"""


def _breaches(s, d):
    return rp.breach_events(_cased(s, d), F.substring(F.substring_index(F.col("evidence")[0], "@", -1), 1, 4))


register("RL_4_cell_breach_rollup", lambda s, d: rp.cell_rollup(_breaches(s, d)),
         "group_id day operator game_id play_type:i sm_tag breach accounts:i peak:f", "SELECT * FROM cr", _BE)
register("RL_5_build_breach_rollup", lambda s, d: rp.build_rollup(_breaches(s, d)),
         "group_id day sm_tag breach cells:i operators:i accounts:i peak:f", "SELECT * FROM br", _BE)


def _members(s, d):
    m = rp.group_members(_breaches(s, d))
    return m.withColumns({
        "detected_at": F.col("day"), "severity": F.when(F.col("breach") == "L1-MAX_X_BREACH", "Critical").otherwise("High"),
        "status": F.when(F.col("value") > 9.5, "queued").otherwise("monitoring")})


register("RL_6_group_status", lambda s, d: rp.group_status(_members(s, d)), "group_id members:i status severity",
         """SELECT br.group_id, count(*) AS members, CASE WHEN bool_or(value > 9.5) THEN 'queued' ELSE 'monitoring' END AS status,
         CASE WHEN any_value(be.breach) = 'L1-MAX_X_BREACH' THEN 'Critical' ELSE 'High' END AS severity FROM be
         JOIN br USING (day, sm_tag, breach) GROUP BY 1""", _BE)
for _name in ("RL_7_member_rounds", "SRT_5_member_rounds"):
    register(_name, lambda s, d: rp.member_rounds(
        rp.group_members(_breaches(s, d)), fu.case_evidence(_cased(s, d))), "group_id pos:i uid key",
        """SELECT group_id, uid, key, pos FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY uid, key) AS pos FROM (
        SELECT br.group_id, be.uid, x.key
        FROM be JOIN br USING (day, sm_tag, breach) JOIN (SELECT DISTINCT ep, eu, key FROM en WHERE NOT isg) x
        ON x.ep = be.operator AND x.eu = be.uid))""", _BE)


def _series(s, d):
    r = events(s, d)
    return rp.drilldown_series(ft.player_cell_daily(r, T, evidence=False), ft.cell_constants(r), fx.catalog(s))


_DAILY = f"""{EV}, {q.catalog()}, dy AS (SELECT {q.PC}, CAST(game_time AS DATE) AS day, sum(win) AS w, sum(valid_bet) AS b,
    max(win / nullif(valid_bet, 0)) AS m, count(*) - count(DISTINCT game_seq_id) AS u FROM r GROUP BY {q.PC}, CAST(game_time AS DATE)),
  ds AS (SELECT {q.PC}, list(strftime(day, '%m-%d') ORDER BY day) AS days, list(round(100 * w / greatest(b, 1e-9), 2) ORDER BY day) AS rtp,
    list(m ORDER BY day) AS mult, list(u ORDER BY day) AS dup FROM dy GROUP BY {q.PC})"""
register("RL_14_drilldown_series", lambda s, d: _series(s, d).select(
    "*", F.transform("points", lambda p: F.date_format(p["event_date"], "MM-dd")).alias("days"),
    F.transform("points", lambda p: p["dup_rounds"]).alias("dup")),
    "parent uid game_id play_type:i currency sm_tag days:o dup:o ref_rtp_pct:f ref_source ref_max_multiple:f",
    f"""SELECT *, round(100 * rtp_cert, 2) AS ref_rtp_pct, 'certified' AS ref_source, cap_cert AS ref_max_multiple
    FROM {q.certified('ds')}""", _DAILY)
register("RL_13_suspect_flags", lambda s, d: _series(s, d).select(
    "*", F.size(F.filter("suspect_rtp", lambda x: x)).alias("n_rtp"), F.size(F.filter("suspect_dup", lambda x: x)).alias("n_dup")),
    "parent uid game_id play_type:i currency sm_tag n_rtp:i n_dup:i",
    f"""SELECT *, len(list_filter(rtp, lambda x: x > round(100 * rtp_cert, 2))) AS n_rtp,
    len(list_filter(dup, lambda x: x > 0)) AS n_dup FROM {q.certified('ds')}""", _DAILY)

# --- behavioural engine ---------------------------------------------------------------
_BSEQ = f"""{EVA}, seq AS (SELECT *, date_diff('second', lag(game_time) OVER w, game_time) AS gap_s FROM r
    WINDOW w AS (PARTITION BY parent, uid ORDER BY game_time, serial)),
  se AS (SELECT *, sum(CASE WHEN gap_s IS NULL OR gap_s > 1800 THEN 1 ELSE 0 END) OVER (PARTITION BY parent, uid
    ORDER BY game_time, serial) AS session_no FROM seq),
  dp AS (SELECT parent, uid, sum(c) AS dup_rounds FROM (SELECT parent, uid, count(*) AS c FROM r WHERE win > 0
    GROUP BY parent, uid, win, bet HAVING count(*) > 1) GROUP BY 1, 2),
  ht AS (SELECT parent, uid, count(*) AS sessions, count(*) FILTER (n < 30 AND st > 0 AND wo > 2 * st) AS hot_small FROM (
    SELECT parent, uid, session_no, count(*) AS n, sum(valid_bet) AS st, sum(win) AS wo FROM se GROUP BY 1, 2, 3) GROUP BY 1, 2),
  bp AS (SELECT parent, uid, count(*) AS rounds, count(*) FILTER (play_type IN (2, 3, 4)) AS buys,
    count(*) FILTER (triggered) AS triggers, count(DISTINCT bet) AS bet_levels, count(DISTINCT game_id) AS games,
    count(DISTINCT report_date) AS days, avg(gap_s) FILTER (gap_s BETWEEN 0 AND 600) AS gap_mean,
    stddev_samp(gap_s) FILTER (gap_s BETWEEN 0 AND 600) AS gap_sd,
    coalesce(count(*) FILTER (gap_s = 0) / nullif(count(gap_s), 0), 0) AS same_second_share FROM se GROUP BY 1, 2
    HAVING count(*) >= 5),
  bf AS (SELECT bp.*, sessions, coalesce(hot_small, 0) AS hot_small, coalesce(dup_rounds, 0) AS dup_rounds,
    buys / rounds AS buy_share, triggers / rounds AS trigger_share, coalesce(dup_rounds, 0) / rounds AS dup_share
    FROM bp LEFT JOIN ht USING (parent, uid) LEFT JOIN dp USING (parent, uid))"""


def _players(s, d):
    return bh.player_behaviour(accounts(s, d), T)


register("BH_1_player_features", _players,
         "parent uid rounds:i buys:i triggers:i bet_levels:i games:i days:i sessions:i gap_mean:f gap_sd:f same_second_share:f "
         "hot_small:i dup_rounds:i buy_share:f trigger_share:f dup_share:f", "SELECT * FROM bf", _BSEQ)
register("BH_3_outcome_repetition", lambda s, d: bh.repeated_outcomes(lineitem(s, d)), "parent uid dup_rounds:i",
         """SELECT parent, uid, sum(c) AS dup_rounds FROM (SELECT parent, uid, count(*) AS c FROM r WHERE win > 0
         GROUP BY parent, uid, win, bet HAVING count(*) > 1) GROUP BY 1, 2""", LI)
register("SRT_4_top_ten_wins", lambda s, d: bh.with_top_wins(_players(s, d), accounts(s, d)), "parent uid top_win_seq_ids",
         f"SELECT bf.parent, bf.uid, e.top_win_seq_ids FROM bf JOIN {q.evidence('parent, uid', 'r', 10)} e USING (parent, uid)", _BSEQ)


def _thresholds(s, d):
    p = materialise(_players(s, d), "players")
    return p, bh.behaviour_thresholds(p, 1.0)


_THR = """lg AS (SELECT unnest(['buy_share', 'trigger_share', 'dup_share', 'same_second_share']) AS measure,
    unnest([0.03, 0.05, 0.05, 0.20]) AS fl, unnest([buy_share, trigger_share, dup_share, same_second_share]) AS v FROM bf),
    lm AS (SELECT measure, max(fl) AS fl, median(v) AS med, quantile_cont(v, 0.999) AS p999, max(v) AS mx FROM lg GROUP BY 1),
    ld AS (SELECT lg.measure, v, med FROM lg JOIN lm USING (measure)),
    la AS (SELECT measure, median(abs(v - med)) AS mad FROM ld GROUP BY 1),
    lz AS (SELECT measure, count(*) AS nn, median(v) AS nzmed, stddev_pop(v) AS nzsd FROM ld WHERE v > med GROUP BY 1),
    ly AS (SELECT measure, median(abs(v - nzmed)) AS nzmad FROM ld JOIN lz USING (measure) WHERE v > med GROUP BY 1),
    rbj AS (SELECT * FROM lm LEFT JOIN la USING (measure) LEFT JOIN lz USING (measure) LEFT JOIN ly USING (measure)),
    th AS (SELECT measure, greatest(fl, CASE WHEN mad > 0 THEN med + mad WHEN nn < 20 THEN p999 WHEN nzmad > 0 THEN nzmed + nzmad
    WHEN nzsd > 0 THEN nzmed + nzsd ELSE mx END) AS bound FROM rbj)"""
register("BH_4_robust_thresholds", lambda s, d: s.createDataFrame(
    [(k, float(v[0])) for k, v in _thresholds(s, d)[1].items()], "measure string, bound double"), "measure bound:f",
    "SELECT * FROM th", f"{_BSEQ}, {_THR}")


def _bands(rounds, width):
    m = multiple()
    return rounds.groupBy(F.col("game_id").alias("table_id"), F.round(m, 4).alias("x")).agg(
        F.count(F.lit(1)).cast("double").alias("weight")).select(
        "table_id", (F.col("x") * (1 - width)).alias("lo"), (F.col("x") * (1 + width)).alias("hi"), "weight")


_DIST_STEPS = """bn AS (SELECT game_id, x * 0.9 AS lo, x * 1.1 AS hi, c AS w FROM (SELECT game_id, round(win / valid_bet, 4) AS x,
    count(*) AS c FROM r GROUP BY 1, 2) WHERE x > 0),
  mo AS (SELECT game_id, sum(w * (ln(lo) + ln(hi)) / 2) / sum(w) AS m,
    sum(w * (pow((ln(lo) + ln(hi)) / 2, 2) + pow(ln(hi) - ln(lo), 2) / 12)) / sum(w) AS s2 FROM bn GROUP BY 1),
  tst AS (SELECT parent, uid, count(*) AS n_wins, (sum(ln(win / valid_bet)) - sum(m)) / sqrt(sum(s2 - m * m)) AS z,
    exp((sum(ln(win / valid_bet)) - sum(m)) / count(*)) AS shift FROM r JOIN mo USING (game_id) WHERE win > 0
    GROUP BY 1, 2 HAVING count(*) >= 10)"""


def _inflated(rounds):
    """Players whose wins are larger than their tables' outcomes explain."""
    wins = rounds.where("win > 0").select("parent", "uid", F.col("game_id").alias("table_id"), multiple().alias("outcome_x"))
    return bh.distribution_test(wins, bh.band_moments(_bands(rounds, 0.1)), 0.1, 10, 1.0)


def _flagged(s, d):
    return bh.behaviour_rules(*_thresholds(s, d))


_LIMIT = "(SELECT bound FROM th WHERE measure = '{}')"
_FLAG = f"""{_THR}, fl AS (SELECT *, list_filter([CASE WHEN buy_share >= {_LIMIT.format('buy_share')} THEN 'BEH_1' END,
    CASE WHEN trigger_share >= {_LIMIT.format('trigger_share')} THEN 'BEH_2' END,
    CASE WHEN gap_sd <= 1 AND rounds >= 500 THEN 'BEH_3' END, CASE WHEN same_second_share >= {_LIMIT.format('same_second_share')} AND rounds >= 500 THEN 'BEH_3b' END,
    CASE WHEN dup_share >= {_LIMIT.format('dup_share')} AND dup_rounds >= 20 THEN 'BEH_4' END, CASE WHEN hot_small >= 3 THEN 'BEH_5' END],
    lambda x: x IS NOT NULL) AS rules FROM bf)"""
register("BH_5_behaviour_rules", _flagged, "parent uid rules:o n_rules:i",
         "SELECT parent, uid, rules, len(rules) AS n_rules FROM fl WHERE len(rules) > 0", f"{_BSEQ}, {_FLAG}")
register("BH_6_multi_rule_findings", lambda s, d: _flagged(s, d).where("n_rules >= 2"), "parent uid rules:o n_rules:i",
         "SELECT parent, uid, rules, len(rules) AS n_rules FROM fl WHERE len(rules) > 1", f"{_BSEQ}, {_FLAG}")


def _directions(s, d):
    return bh.fuse_directions(behavioural=_flagged(s, d), distribution=_inflated(accounts(s, d)).where("selected"))


_DIR = f"""{_BSEQ}, {_FLAG}, {_DIST_STEPS}, di AS (SELECT parent, uid, 'behavioural' AS x FROM fl WHERE len(rules) > 0 UNION ALL
    SELECT parent, uid, 'distribution' FROM {q.bh('tst', '', 'z', '0.1')} WHERE selected AND z > 0 AND shift >= 1.0),
  dd AS (SELECT parent, uid, list_sort(list(DISTINCT x)) AS directions, count(DISTINCT x) AS n_directions,
    count(DISTINCT x) >= 2 AS corroborated FROM di GROUP BY 1, 2)"""
register("BH_7_direction_fusion", _directions, "parent uid directions:o n_directions:i corroborated", "SELECT * FROM dd", _DIR)
register("SET_4_direction_union", lambda s, d: _directions(s, d).select("parent", "uid"), "parent uid",
         "SELECT DISTINCT parent, uid FROM di", _DIR)


def _labels(s, d):
    return fx.table(s, d, "events").where("user_id % 7 = 0").selectExpr(
        "concat('op', user_id % 4) AS parent", "concat('u', user_id) AS uid",
        "CASE WHEN user_id % 3 = 0 THEN 'bot' ELSE 'routing' END AS case_type", "user_id % 21 = 14 AS is_decoy").distinct()


_LAB = f"""{_DIR}, lb AS (SELECT DISTINCT 'op' || (user_id % 4) AS parent, 'u' || user_id AS uid, CASE WHEN user_id % 3 = 0
    THEN 'bot' ELSE 'routing' END AS case_type, user_id % 21 = 14 AS is_decoy FROM events WHERE user_id % 7 = 0),
  sc AS (SELECT case_type IS NOT NULL AND NOT coalesce(is_decoy, FALSE) AS rl, coalesce(is_decoy, FALSE) AS dc,
    dd.uid IS NOT NULL AS hit FROM (SELECT parent, uid FROM bf) p FULL JOIN lb USING (parent, uid) LEFT JOIN dd USING (parent, uid))"""
register("BH_8_score_labels", lambda s, d: bh.score(_directions(s, d), _labels(s, d), _players(s, d)),
         "labelled:i true_positives:i false_positives:i decoys_flagged:i honest:i recall:f precision:f",
         """SELECT count(*) FILTER (rl) AS labelled, count(*) FILTER (rl AND hit) AS true_positives,
         count(*) FILTER (NOT rl AND NOT dc AND hit) AS false_positives, count(*) FILTER (dc AND hit) AS decoys_flagged,
         count(*) FILTER (NOT rl AND NOT dc) AS honest, count(*) FILTER (rl AND hit) / nullif(count(*) FILTER (rl), 0) AS recall,
         count(*) FILTER (rl AND hit) / nullif(count(*) FILTER (rl AND hit) + count(*) FILTER (NOT rl AND NOT dc AND hit), 0)
         AS precision FROM sc""", _LAB)
register("BH_8_score_by_type", lambda s, d: bh.score_by_type(_directions(s, d), _labels(s, d)), "case_type hit:i total:i",
         """SELECT case_type, count(dd.uid) AS hit, count(*) AS total FROM lb LEFT JOIN dd USING (parent, uid)
         WHERE NOT is_decoy GROUP BY 1""", _LAB)


def _daily(s, d):
    return ft.player_cell_daily(lineitem(s, d), T, evidence=False)


# A return is shown at six decimals, halves up, in the same double arithmetic on both sides.
_SCREEN = """SELECT * REPLACE (floor(rtp * 1e6 + 0.5) / 1e6 AS rtp) FROM (
    SELECT parent, uid, count(*) AS rounds, count(DISTINCT CAST(game_time AS DATE)) AS days,
    count(DISTINCT game_id) AS games, round(sum(win), 4) / round(sum(valid_bet), 4) AS rtp FROM r GROUP BY 1, 2)
    WHERE rounds >= 20 AND rtp >= 0.9"""
register("BH_9_rtp_screen", lambda s, d: bh.rtp_screen(_daily(s, d), 20, 0.9).withColumn(
    "rtp", F.floor(F.col("rtp") * 1e6 + 0.5) / 1e6), "parent uid rounds:i days:i games:i rtp:f", _SCREEN, LI)


register("ST_9_distribution_test", lambda s, d: _inflated(lineitem(s, d)), "parent uid n_wins:i z:f shift:f selected",
         f"SELECT * REPLACE (selected AND z > 0 AND shift >= 1.0 AS selected) FROM {q.bh('tst', '', 'z', '0.1')}",
         f"{LI}, {_DIST_STEPS}")
