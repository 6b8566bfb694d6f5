"""Queries of cohorts, unsupervised discovery, fusion and the case gate."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from tallyscope.operators import anomaly as an
from tallyscope.operators import casegate as cg
from tallyscope.operators import cohorts as co
from tallyscope.operators import features as ft
from tallyscope.operators import fusion as fu
from tallyscope.operators import layer1 as l1
from tallyscope.operators import layer2 as l2
from tallyscope.operators import timing as tm
from tallyscope.operators.calibration import fit
from tallyscope.plans import scan as sc
from tallyscope.plans import sqltext as q
from tallyscope.plans.registry import register
from tallyscope.plans.rule_queries import _GAPS, _PC_CTE, accounts, cells, lineitem
from tallyscope.settings import Thresholds
from tallyscope.sources import fixtures as fx
from tallyscope.sources.durable import materialise, shared_dir

T = Thresholds().but(
    min_rounds=5, cohort_min_members=3, cohort_birth_window_s=48 * 3600, cohort_cv_max=0.25, cohort_corr_min=0.1,
    cohort_min_shared_hours=8, cohort_duty_share=0.5, cohort_scale_factor=1.0, cohort_null_sigma=3.0,
    forest_trees=50, forest_min_players=15, forest_contamination=0.05, min_segment=20,
)

# --- cohorts ------------------------------------------------------------------
_SKEL = r"regexp_replace(regexp_replace(uid, '[A-Za-z]', 'a', 'g'), '\d', '#', 'g')"
_ACC = f"""{q.rounds_events(None)}, acc AS (SELECT parent, uid, {_SKEL} AS skeleton, count(*) AS rounds,
    min(game_time) AS first_seen, CAST(nullif(regexp_extract(uid, '(\\d+)\\D*$', 1), '') AS BIGINT) AS suffix
    FROM r GROUP BY 1, 2, 3)"""


def _groups(s, d):
    r = accounts(s, d)
    return co.detect_cohorts(cells(r), tm.player_timing(r, T), ft.cell_constants(r), fx.catalog(s), T)


register("L3_1_cohort_groups", lambda s, d: co.structural_groups(co.accounts(cells(accounts(s, d))), T),
         "parent skeleton members:i", "SELECT parent, skeleton, count(*) AS members FROM acc GROUP BY 1, 2 HAVING count(*) >= 3", _ACC)
register("L3_2_uid_suffix_block", lambda s, d: co.structural_groups(co.accounts(cells(accounts(s, d))), T),
         "parent skeleton suffix_density:f",
         """SELECT parent, skeleton, count(suffix) / (max(suffix) - min(suffix) + 1) AS suffix_density FROM acc
         GROUP BY 1, 2 HAVING count(*) >= 3""", _ACC)
register("L3_3_synchronised_birth", lambda s, d: co.structural_groups(co.accounts(cells(accounts(s, d))), T),
         "parent skeleton birth_spread_s:i",
         """SELECT parent, skeleton, date_diff('second', min(first_seen), max(first_seen)) AS birth_spread_s FROM acc
         GROUP BY 1, 2 HAVING count(*) >= 3""", _ACC)
_TV = f"""{_ACC}, {_GAPS},
  md AS (SELECT parent, uid, gap_s AS modal_gap_s FROM (SELECT parent, uid, gap_s, row_number() OVER (
    PARTITION BY parent, uid ORDER BY count(*) DESC, gap_s) AS rn FROM seq WHERE gap_s BETWEEN 1 AND 30
    GROUP BY parent, uid, gap_s) WHERE rn = 1),
  mi AS (SELECT parent, uid, max(c) AS rpm FROM (SELECT parent, uid, date_trunc('minute', game_time) AS m,
    count(*) AS c FROM r GROUP BY 1, 2, 3) GROUP BY 1, 2),
  tv AS (SELECT acc.parent, skeleton, uid, modal_gap_s, rpm, hrs FROM acc JOIN (SELECT parent, uid,
    count(DISTINCT hour(game_time)) AS hrs FROM r GROUP BY 1, 2 HAVING count(*) >= 5) USING (parent, uid)
    LEFT JOIN md USING (parent, uid) LEFT JOIN mi USING (parent, uid)),
  big AS (SELECT parent, skeleton FROM acc GROUP BY 1, 2 HAVING count(*) >= 3)"""


def _timed(s, d, f):
    r = accounts(s, d)
    people = co.accounts(cells(r))
    kept = people.join(co.structural_groups(people, T).select(*co.GROUP), co.GROUP, "left_semi")
    return f(kept, tm.player_timing(r, T), T)


register("L3_4_5_timing_similarity", lambda s, d: _timed(s, d, co.timing_prints),
         "parent skeleton timed:i mean_cv:f duty_share:f",
         """SELECT parent, skeleton, count(*) AS timed, list_avg([stddev_samp(modal_gap_s) / nullif(avg(modal_gap_s), 0),
         stddev_samp(hrs) / nullif(avg(hrs), 0), stddev_samp(rpm) / nullif(avg(rpm), 0)]) AS mean_cv,
         avg(CASE WHEN hrs >= 22 THEN 1.0 ELSE 0 END) AS duty_share FROM tv JOIN big USING (parent, skeleton)
         GROUP BY 1, 2 HAVING count(*) >= 3""", _TV)
_HP = ", ".join(f"count(*) FILTER (hour(game_time) = {h})" for h in range(24))
register("L3_6_cadence_correlation", lambda s, d: _timed(s, d, co.cadence_prints),
         "parent skeleton mean_correlation:f",
         """SELECT parent, skeleton, avg(c) AS mean_correlation FROM (
         SELECT a.parent, a.skeleton, corr(a.v, b.v) AS c FROM hx a JOIN hx b ON a.parent = b.parent
         AND a.skeleton = b.skeleton AND a.h = b.h AND a.i < b.i GROUP BY a.parent, a.skeleton, a.i, b.i
         HAVING count(*) FILTER (a.v > 0 AND b.v > 0) >= 8 AND stddev_pop(a.v) > 0 AND stddev_pop(b.v) > 0) GROUP BY 1, 2""",
         f"""{_ACC}, big AS (SELECT parent, skeleton FROM acc GROUP BY 1, 2 HAVING count(*) >= 3),
         hp AS (SELECT parent, uid, [{_HP}] AS p FROM r GROUP BY 1, 2 HAVING count(*) >= 5),
         hi AS (SELECT parent, skeleton, p, row_number() OVER (PARTITION BY parent, skeleton ORDER BY uid) AS i
           FROM hp JOIN acc USING (parent, uid) JOIN big USING (parent, skeleton)),
         hx AS (SELECT parent, skeleton, i, unnest(range(24)) AS h, CAST(unnest(p) AS DOUBLE) AS v FROM hi)""")
register("L3_7_variance_spread_money",
         lambda s, d: (lambda r: co.money_prints(
             co.accounts(cells(r)), cells(r), ft.cell_constants(r), fx.catalog(s), T))(lineitem(s, d)),
         "parent skeleton money_z:f priced_members:i rtp_spread:f",
         f"""SELECT parent, skeleton, money_z, priced_members, rtp_spread FROM (
         SELECT parent, skeleton, sum(z) / sqrt(count(z)) AS money_z FROM (
           SELECT parent, skeleton, currency, sum(total_win - rtp_cert * turnover)
             / nullif(sqrt(sum(sigma_spin * sigma_spin * sumsq_valid_bet)), 0) AS z FROM sub GROUP BY 1, 2, 3)
           GROUP BY 1, 2) JOIN (SELECT parent, skeleton, count(*) AS priced_members, max(m) - min(m) AS rtp_spread FROM (
           SELECT parent, skeleton, uid, sum(total_win) / greatest(sum(turnover), 1e-9) AS m FROM sub GROUP BY 1, 2, 3)
           GROUP BY 1, 2) USING (parent, skeleton)""",
         f"""{q.rounds_lineitem()}, {q.catalog()}, {_PC_CTE}, cc AS (SELECT {q.CELL},
         stddev_samp(win / nullif(valid_bet, 0)) AS sigma_spin FROM r GROUP BY {q.CELL}),
         sub AS (SELECT *, {_SKEL} AS skeleton FROM {q.certified('pc')} JOIN cc USING ({q.CELL})
           WHERE rtp_cert IS NOT NULL AND sigma_spin > 0 AND sumsq_valid_bet > 0)""")
register("L3_8_scale_outlier", _groups, "parent skeleton median_rounds:f parent_median:f",
         """SELECT parent, skeleton, median(rounds) AS median_rounds, any_value(pm) AS parent_median FROM acc
         JOIN (SELECT parent, median(rounds) AS pm FROM acc GROUP BY 1) USING (parent) GROUP BY 1, 2 HAVING count(*) >= 3""",
         _ACC)
register("L3_9_proposals", lambda s, d: co.proposals(_groups(s, d), T.but(cohort_min_agreeing=1)),
         "parent skeleton members:i cohort_id",
         """SELECT parent, skeleton, any_value(members) AS members,
         'cohort_' || substr(sha256(parent || '|' || skeleton), 1, 12) AS cohort_id
         FROM (SELECT *, count(*) OVER (PARTITION BY parent, skeleton) AS members FROM acc) WHERE members >= 3 GROUP BY 1, 2""",
         _ACC)
register("JN_8_cohort_membership",
         lambda s, d: co.membership(_groups(s, d), cells(accounts(s, d))), "parent uid cohort_id",
         """SELECT parent, uid, cohort_id FROM acc JOIN (SELECT parent, skeleton,
         'cohort_' || substr(sha256(parent || '|' || skeleton), 1, 12) AS cohort_id
         FROM (SELECT *, count(*) OVER (PARTITION BY parent, skeleton) AS members FROM acc) WHERE members >= 3 GROUP BY 1, 2)
         USING (parent, skeleton)""", _ACC)

# --- unsupervised discovery ------------------------------------------------------
_MLF = """SELECT parent, uid, sum(valid_bet) FILTER (play_type IN (2, 3, 4)) / nullif(sum(valid_bet), 0) AS b0,
    coalesce(b0, 0) AS buy_share_turnover, count(*) FILTER (triggered) / count(*) AS trigger_rate,
    count(*) FILTER (win > 0) / count(*) AS hit_rate, sum(win) / nullif(sum(valid_bet), 0) AS rtp,
    log10(count(*)) AS log_rounds FROM r GROUP BY 1, 2"""


def _features(s, d):
    r = lineitem(s, d)
    return an.player_features(cells(r), tm.player_timing(r, T.but(min_rounds=1)))


register("L3_10_ml_features", _features,
         "parent uid buy_share_turnover:f trigger_rate:f hit_rate:f rtp:f log_rounds:f", _MLF, q.rounds_lineitem())
register("WIN_6_group_z_norm", lambda s, d: an.normalised(_features(s, d)), "parent uid game_id currency rtp:f hit_rate:f",
         """SELECT parent, uid, game_id, currency,
         coalesce((rtp - avg(rtp) OVER w) / nullif(stddev_samp(rtp) OVER w, 0), 0) AS rtp,
         coalesce((hit_rate - avg(hit_rate) OVER w) / nullif(stddev_samp(hit_rate) OVER w, 0), 0) AS hit_rate
         FROM mlf WINDOW w AS (PARTITION BY game_id, currency)""",
         f"""{q.rounds_lineitem()}, cx AS (SELECT parent, uid, game_id, currency FROM (SELECT parent, uid, game_id, currency,
         row_number() OVER (PARTITION BY parent, uid ORDER BY game_id, play_type, currency, sm_tag) AS i FROM r) WHERE i = 1),
         mlf AS (SELECT * FROM ({_MLF}) JOIN cx USING (parent, uid))""")


def _flags(s, features):
    z = materialise(an.normalised(features), "features")
    return an.flagged(materialise(an.forest_scores(z, T, z.count()), "scores"), T.forest_contamination)


register("L3_11_isolation_forest", lambda s, d: _flags(s, _features(s, d)), "parent uid score:f flag")
register("L3_12_segment_stability",
         lambda s, d: an.segment_gate(_flags(s, _features(s, d)), T, T.forest_contamination),
         "segment_key segment_value players:i rate:f concentrated")


def _rule_signals(s, a):
    """Signals of layers 1 and 2 at their policy, which is what discovery leaves out."""
    t, cat = Thresholds(), fx.catalog(s)
    a = replace(a, player_timing=a.player_timing.where(F.col("rounds") >= t.min_rounds))
    m = sc._metrics(a, cat, t, sc.DEFAULT_EXCLUSIONS)
    return l1.layer1_signals(
        m, fit(m, t), a.gated(t), a.player_timing, a.cell_constants, cat, t, ungated_player_cell=a.player_cell,
    ).unionByName(l2.layer2_signals(a.game_day, cat, t))


def _discovered(s, d):
    """The forest and the rules read the same aggregates; a round without a time is seen by neither."""
    a = sc.extract(lineitem(s, d), "9999-12-31 00:00:00", Thresholds(), timed_rounds=1)
    touched = _rule_signals(s, a).where("parent IS NOT NULL AND uid IS NOT NULL").select("parent", "uid")
    flags = _flags(s, an.player_features(a.player_cell, a.player_timing))
    return an.discovery_signals(flags, materialise(touched.distinct(), "touched"))


register("L3_13_discovery_signals", _discovered, "signal_id family parent uid value:f")
register("JN_9_rule_flagged_anti_join",
         lambda s, d: co.accounts(cells(lineitem(s, d))).join(
             cells(lineitem(s, d)).where("balance_violations > 0").select("parent", "uid").distinct(),
             ["parent", "uid"], "left_anti"), "parent uid rounds:i",
         f"SELECT parent, uid, count(*) AS rounds FROM r GROUP BY 1, 2 HAVING count(*) FILTER ({q.BREAKS}) = 0",
         q.rounds_lineitem())

# --- fusion ------------------------------------------------------------------------
_SG = f"sg AS (SELECT {fx.SIGNAL_COLUMNS} FROM ({fx.SIGNAL_SHAPE}) b)"
_G = "grain = 'game_cell'"
_INT = ("family = 'INTEGRITY' AND signal_id IN ('L1-MAX_X_BREACH', 'L1-BALANCE_IDENTITY', 'L1-DUP_ROUND') "
        "AND threshold_method = 'ABSOLUTE' AND baseline_source IN ('identity', 'certified')")
_DRIFT = "signal_id = 'L2-OFF_TARGET_RTP' AND baseline_source LIKE '%certified%' AND coalesce(effect, 0) >= 2.0"
_EXC = ("family NOT IN ('ENVIRONMENT', 'MAGNITUDE_WATCH') AND p_value IS NOT NULL AND value >= 6.0 AND "
        "((effect_unit = 'rtp_points' AND effect >= 3.0) OR (effect_unit = 'lift' AND effect >= 2.0)) "
        "AND persistence = 'held' AND (baseline_source LIKE '%certified%' OR baseline_source = 'identity')")
_ORD = ("ORDER BY layer, signal_id, game_id NULLS FIRST, play_type NULLS FIRST, currency NULLS FIRST, "
        "sm_tag NULLS FIRST, description")
_FZ = f"""{_SG}, en AS (SELECT *, {_G} AS isg, CASE WHEN {_G} THEN NULL ELSE parent END AS ep,
    CASE WHEN {_G} THEN NULL ELSE uid END AS eu, CASE WHEN {_G} THEN game_id END AS eg,
    CASE WHEN {_G} THEN play_type END AS ept, CASE WHEN {_G} THEN currency END AS ec,
    CASE WHEN {_G} THEN sm_tag END AS et FROM sg),
  ag AS (SELECT isg, ep, eu, eg, ept, ec, et, count(*) AS n_signals,
    list_sort(list(DISTINCT family)) AS families, list_sort(list(DISTINCT signal_id)) AS signal_ids,
    count(DISTINCT family) FILTER (family NOT IN ('ENVIRONMENT', 'MAGNITUDE_WATCH')) AS independent_families,
    bool_or(persistence = 'held') AS held, max(abs(value)) AS max_abs_value,
    max(value) FILTER (p_value IS NOT NULL) AS max_z,
    bool_or(family = 'INTEGRITY' AND baseline_source IN ('certified', 'identity')) AS ic,
    bool_or(signal_id = 'L1-MAX_X_BREACH') AS cap, bool_or({_INT}) AS ri, count(*) FILTER ({_DRIFT}) AS dd,
    max(effect) FILTER ({_DRIFT}) AS dp, bool_or(coalesce({_EXC}, FALSE)) AS rx,
    max(split_part(key, '@', 2)) AS latest_evidence_utc,
    first(game_id {_ORD}) AS fg, first(play_type {_ORD}) AS fp, first(currency {_ORD}) AS fc,
    first(coalesce(event_date, '~') {_ORD}) AS fe FROM en GROUP BY 1, 2, 3, 4, 5, 6, 7),
  l1 AS (SELECT *, CASE WHEN independent_families >= 2 THEN 'human_review'
    WHEN independent_families >= 1 AND held THEN 'enhanced' ELSE 'monitor' END AS byf FROM ag),
  l2 AS (SELECT *, CASE WHEN byf != 'human_review' AND (ri OR dd >= 2 OR rx) THEN 'human_review' ELSE byf END AS escalation
    FROM l1),
  fz AS (SELECT *, CASE WHEN isg THEN 'game_cell' ELSE 'player' END AS grain, ep AS parent, eu AS uid,
    coalesce(eg, fg) AS game_id, coalesce(ept, fp) AS play_type, coalesce(ec, fc) AS currency,
    CASE WHEN isg THEN 'G_' || eg || '_pt' || ept || '_' || et || '_' || (CASE WHEN fe = '~' THEN 'window' ELSE fe END)
      ELSE 'P_' || ep || '_' || fg || '_' || eu END AS case_id,
    CASE WHEN escalation = 'human_review' AND ic THEN CASE WHEN cap THEN 'Critical' ELSE 'High' END
      WHEN escalation = 'human_review' THEN CASE WHEN held THEN 'High' ELSE 'Medium' END
      WHEN escalation = 'enhanced' THEN 'Medium' ELSE 'Low' END AS severity FROM l2)"""


def _cases(s, d, **kw):
    return fu.fuse(fx.signals_from_lineitem(s, d), **kw)


_CASE = "case_id grain parent uid currency"
register("FU_1_group_signals", _cases, f"{_CASE} game_id play_type:i n_signals:i signal_ids:a max_abs_value:f",
         "SELECT * FROM fz", _FZ)
register("FU_2_independence", _cases, f"{_CASE} families:a independent_families:i", "SELECT * FROM fz", _FZ)
register("FU_3_escalation_ladder", _cases, f"{_CASE} escalation", "SELECT * FROM fz", _FZ)
_NOTES = """SELECT *, CASE WHEN byf = 'human_review' THEN 0 WHEN ri THEN 1 WHEN dd >= 2 THEN 2 WHEN rx THEN 3 ELSE 0 END AS r
    FROM fz"""
for _name, _r, _text in (("FU_4_exceptional_route", 3, "exceptional"), ("FU_5_integrity_route", 1, "integrity single"),
                         ("FU_6_drift_route", 2, "drift route")):
    register(_name, lambda s, d, x=_text: _cases(s, d).where(
        F.exists("notes", lambda v: F.startswith(v, F.lit(x)))), f"{_CASE} escalation severity",
        f"SELECT * FROM ({_NOTES}) WHERE r = {_r}", _FZ)
register("FU_7_severity", _cases, f"{_CASE} escalation severity", "SELECT * FROM fz", _FZ)
register("FU_8_population_max_note",
         lambda s, d: _cases(s, d, population=100000).withColumn(
             "near_null_max", F.exists("notes", lambda v: F.startswith(v, F.lit("max z")))),
         f"{_CASE} max_z:f near_null_max",
         "SELECT *, coalesce(max_z < 5.264890793922, FALSE) AS near_null_max FROM fz", _FZ)
register("FU_10_case_evidence",
         lambda s, d: (lambda sg: fu.case_evidence(fu.signals_with_case(sg, fu.fuse(sg))))(
             fx.signals_from_lineitem(s, d)), "case_id key gsid utc",
         """SELECT DISTINCT case_id, key, split_part(key, '@', 1) AS gsid, split_part(key, '@', 2) AS utc FROM en JOIN fz
         ON en.isg = fz.isg AND en.ep IS NOT DISTINCT FROM fz.ep AND en.eu IS NOT DISTINCT FROM fz.eu
         AND en.eg IS NOT DISTINCT FROM fz.eg AND en.ept IS NOT DISTINCT FROM fz.ept
         AND en.ec IS NOT DISTINCT FROM fz.ec AND en.et IS NOT DISTINCT FROM fz.et""", _FZ)
register("FLT_3_recency_window",
         lambda s, d: fu.recent_cases(
             _cases(s, d).withColumn("last_active_utc", F.lit(None).cast("string")), "2000-06-01 00:00:00", 365),
         f"{_CASE} latest_evidence_utc",
         "SELECT * FROM fz WHERE latest_evidence_utc >= '1999-06-02T00:00:00Z'", _FZ)
register("SRT_2_candidate_ranking", lambda s, d: fu.ranked(_cases(s, d)),
         "case_id escalation severity independent_families:i max_abs_value:f",
         """SELECT * FROM fz ORDER BY CASE escalation WHEN 'human_review' THEN 0 WHEN 'enhanced' THEN 1 ELSE 2 END,
         CASE severity WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END,
         independent_families DESC, max_abs_value DESC, case_id""", _FZ)
register("SET_2_signal_union",
         lambda s, d: (lambda a: a.where("layer = 1").unionByName(a.where("layer = 2")).unionByName(a.where("layer = 3")))(
             fx.signals_from_lineitem(s, d)).groupBy("layer", "signal_id", "family").agg(F.count("*").alias("n")),
         "layer:i signal_id family n:i", "SELECT layer, signal_id, family, count(*) AS n FROM sg GROUP BY 1, 2, 3", _SG)
register("SET_3_family_difference", _cases, f"{_CASE} independent_families:i", "SELECT * FROM fz", _FZ)


_TWO = T.but(cohort_min_members=2)


def _annotated_members(s, d):
    """Cases with the cohorts found on the same rounds."""
    # Read for the groups, their ids and their members; no other column of a cell is needed for that.
    pc = materialise(cells(lineitem(s, d)).select("parent", "uid", "rounds", "first_round_utc"), "player_cell")
    people = co.accounts(pc)
    groups = materialise(co.structural_groups(people, _TWO).join(co.cohort_ids(people), co.GROUP), "cohorts")
    return fu.fuse(fx.signals_from_lineitem(s, d), cohort_members=co.membership(groups, pc))


register("FU_9_cohort_annotation", _annotated_members, f"{_CASE} cohort_id escalation",
         "SELECT fz.*, mb.cohort_id FROM fz LEFT JOIN mb ON fz.parent = mb.parent AND fz.uid = mb.uid",
         f"""{_FZ}, {q.rounds_lineitem()}, pl AS (SELECT DISTINCT parent, uid, {_SKEL} AS skeleton FROM r),
         mb AS (SELECT parent, uid, CASE WHEN count(*) OVER (PARTITION BY parent, skeleton) >= 2 THEN
         'cohort_' || substr(sha256(parent || '|' || skeleton), 1, 12) END AS cohort_id FROM pl)""")
register("FU_11_scan_summary", lambda s, d: fu.summary(_cases(s, d)), "escalation cases:i mean_families:f high_share:f",
         """SELECT escalation, count(*) AS cases, avg(independent_families) AS mean_families,
         count(*) FILTER (severity IN ('Critical', 'High')) / count(*) AS high_share FROM fz GROUP BY 1""", _FZ)

# --- case gate ---------------------------------------------------------------------
_CD = f"""cd AS (SELECT *, CASE escalation WHEN 'human_review' THEN 3 WHEN 'enhanced' THEN 2 ELSE 1 END AS tier,
    CASE severity WHEN 'Critical' THEN 4 WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END AS sev,
    n_buy > 0 AS f1, n_sig > 1 AS f2 FROM (SELECT {fx.CANDIDATE_COLUMNS} FROM ({fx.CANDIDATE_SHAPE}) b WHERE n_err >= 1)),
  cw AS (SELECT *, lag(seq) OVER w AS ps, max(tier) OVER p AS pt, max(sev) OVER p AS pv,
    bool_or(f1) OVER p AS p1, bool_or(f2) OVER p AS p2 FROM cd
    WINDOW w AS (PARTITION BY case_id ORDER BY seq),
           p AS (PARTITION BY case_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  ca AS (SELECT *, CASE WHEN ps IS NULL THEN 'opened' WHEN ps < seq - 1 THEN 'reopened'
    WHEN tier > pt OR sev > pv OR (f1 AND NOT p1) OR (f2 AND NOT p2) THEN 'escalated' END AS action,
    printf('s%02d', seq) AS scan FROM cw)"""
SCANS = [f"s{i:02d}" for i in range(1, 11)]


def _replay(s, d):
    return cg.replay_scans(s, fx.candidates_from_events(s, d), SCANS)


register("CS_1_gate_first_scan",
         lambda s, d: cg.alerts_of(cg.gate_step(
             cg.empty_state(s), fx.candidates_from_events(s, d).where("scan = 's01'"), "s01")),
         "case_id action scan escalation severity l4_route parent uid",
         "SELECT *, tier = 3 AS l4_route FROM ca WHERE scan = 's01' AND action IS NOT NULL", _CD)
register("CS_7_gate_replay", lambda s, d: _replay(s, d)[1],
         "case_id action scan escalation severity l4_route parent uid",
         "SELECT *, tier = 3 AS l4_route FROM ca WHERE action IS NOT NULL", _CD)
register("CS_6_open_cases", lambda s, d: cg.open_cases(_replay(s, d)[0]),
         "case_id status last_alert_scan max_tier:i max_sev:i",
         """SELECT case_id, last_alert_scan, max_tier, max_sev, CASE WHEN lt >= 3 THEN 'open' ELSE 'monitoring' END AS status
         FROM (SELECT case_id, max(scan) FILTER (action IS NOT NULL) AS last_alert_scan, max(tier) AS max_tier,
         max(sev) AS max_sev, max(seq) AS ls, arg_max(tier, seq) FILTER (action IN ('opened', 'reopened')) AS lt
         FROM ca GROUP BY 1) WHERE ls = 10""", _CD)
register("CS_5_investigation_queue", lambda s, d: cg.investigation_queue(_replay(s, d)[0]),
         "case_id l4_queued_scan",
         "SELECT case_id, max(scan) AS l4_queued_scan FROM ca WHERE action IS NOT NULL AND tier = 3 GROUP BY 1", _CD)


def _with_dispositions(s, d):
    """All scans; a case seen with a buy is dismissed before the next scan."""
    c = materialise(fx.candidates_from_events(s, d), "candidates")
    state, alerts, said = cg.empty_state(s), None, None
    for scan in SCANS:
        own = c.where(F.col("scan") == scan)
        decided = materialise(cg.gate_step(state, own, scan, dispositions=said), "gate")
        said = own.select("case_id", F.when(F.col("n_buy") > 0, "dismiss_benign").otherwise("").alias("decision"))
        state, step = cg.state_of(decided), cg.alerts_of(decided)
        alerts = step if alerts is None else alerts.unionByName(step)
    return alerts


register("CS_3_dispositions", _with_dispositions, "case_id action scan",
         """SELECT x.case_id, x.scan, CASE WHEN x.action = 'escalated' AND y.n_buy > 0 THEN 'reopened' ELSE x.action END AS action
         FROM ca x LEFT JOIN ca y ON x.case_id = y.case_id AND y.seq = x.seq - 1 WHERE x.action IS NOT NULL""", _CD)
register("CS_2_material_change",
         lambda s, d: cg.replay_decided(s, fx.candidates_from_events(s, d), SCANS)[1].where("action = 'escalated'"),
         "case_id scan max_tier:i max_sev:i families_ever:a",
         """SELECT case_id, scan, greatest(tier, pt) AS max_tier, greatest(sev, pv) AS max_sev,
         list_filter(['INTEGRITY', CASE WHEN f1 OR p1 THEN 'OUTCOME_MAGNITUDE' END, CASE WHEN f2 OR p2 THEN 'TIMING' END],
           lambda v: v IS NOT NULL) AS families_ever FROM ca WHERE action = 'escalated'""", _CD)
register("CS_4_debounce", lambda s, d: cg.replay_scans(
    s, fx.candidates_from_events(s, d), SCANS, min_persistence=3)[1], "case_id action scan",
    """SELECT * FROM (SELECT case_id, printf('s%02d', seq) AS scan, CASE WHEN seq = since THEN 'opened' WHEN seq > since AND ps < seq - 1
    THEN 'reopened' WHEN seq > since AND (tier > pt OR sev > pv OR (f1 AND NOT p1) OR (f2 AND NOT p2)) THEN 'escalated' END
    AS action FROM (SELECT cd.*, since, lag(seq) OVER w AS ps, max(tier) OVER p AS pt, max(sev) OVER p AS pv,
      bool_or(f1) OVER p AS p1, bool_or(f2) OVER p AS p2 FROM cd JOIN (
        SELECT case_id, min(seq) AS since FROM (SELECT case_id, seq, lag(seq, 2) OVER (PARTITION BY case_id ORDER BY seq) AS b
        FROM cd) WHERE b = seq - 2 GROUP BY 1) USING (case_id) WHERE seq >= since - 2
      WINDOW w AS (PARTITION BY case_id ORDER BY seq),
             p AS (PARTITION BY case_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
    WHERE action IS NOT NULL""", _CD)


def _investigated(s, d):
    """Every case queued by the fifth scan gets its file then; the state after all ten."""
    store = cg.GateStore(s, f"{shared_dir(s)}/investigated-{uuid.uuid4().hex}", buckets=4, fanout=3)
    c = materialise(fx.candidates_from_events(s, d), "candidates")
    for scan in SCANS:
        store.ingest(scan, c.where(F.col("scan") == scan))
        if scan == SCANS[4]:
            store.mark_investigated(cg.investigation_queue(store.state()).select("case_id"))
    return store.state().where("l4_status != ''")


register("CS_6_mark_investigated", _investigated, "case_id l4_status l4_queued_scan",
         """SELECT e.case_id, CASE WHEN any_value(marked) AND any_value(back) IS NULL THEN 'investigated' ELSE 'queued' END AS l4_status,
         max(scan) FILTER (seq <= 5 OR NOT marked OR seq >= back) AS l4_queued_scan FROM e JOIN (
           SELECT case_id, bool_or(seq <= 5) AS marked, min(seq) FILTER (seq > 5 AND action = 'reopened') AS back FROM e GROUP BY 1)
         USING (case_id) GROUP BY 1""", f"{_CD}, e AS (SELECT * FROM ca WHERE action IS NOT NULL AND tier = 3)")


# --- the composed scan ---------------------------------------------------------------
def _scan(s, d):
    from tallyscope.plans.rule_queries import T as small

    t = small.but(detection_window_days=0, cohort_min_members=3)
    r, cat = fx.rounds_from_events(s, d, None), fx.catalog(s)
    trained = sc._metrics(sc.extract(r, "2024-01-15 00:00:00", t, for_metrics=True), cat, t, sc.DEFAULT_EXCLUSIONS)
    return sc.scan(r, cat, fit(trained, t), "2024-01-31 00:00:00", t, persistence_mid="2024-01-16 00:00:00").cases


register("FU_11_scan", _scan, "case_id grain escalation severity independent_families:i n_signals:i")
