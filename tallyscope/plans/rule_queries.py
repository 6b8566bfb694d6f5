"""Queries of lookups, statistics, calibration and the rule layers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyscope.functions.columns import (
    game_case_id, log_multiple, multiple, player_case_id, uid_skeleton, uid_trailing_number,
)
from tallyscope.functions.normal import normal_ppf, normal_sf, normal_sf_sql
from tallyscope.functions.ranks import bh_select, order_stats, robust_bounds, volume_group
from tallyscope.operators import calibration as cal
from tallyscope.operators import features as ft
from tallyscope.operators import layer1 as l1
from tallyscope.operators import layer2 as l2
from tallyscope.operators import metrics as mt
from tallyscope.operators import timing as tm
from tallyscope.operators.lookups import Exclusions, apply_exclusions, exclusion_counts, with_certified
from tallyscope.plans import scan as sc
from tallyscope.plans import sqltext as q
from tallyscope.plans.registry import register
from tallyscope.settings import Thresholds
from tallyscope.sources import fixtures as fx
from tallyscope.sources.durable import materialise, shared_dir

T = Thresholds().but(
    min_rounds=5, physical_rpm=3, n_mad=2.0, mad_min_members=5, same_second_min_gaps=5, cadence_min_gaps=5,
    rate_min_rounds=10, peer_min_players=2, rate_fdr_q=0.1, rate_min_lift=1.0, excess_fdr_q=0.1,
    excess_min_points=1.0, prescient_min_rounds=5, prescient_min_triggers=2, prescient_fdr_q=0.1,
    drift_min_day_rounds=5, drift_fdr_q=0.1, drift_min_lift=1.2, deploy_min_rounds=20, deploy_min_z=0.1,
    duty_min_hours=20, duty_max_idle_s=12 * 3600, alert_ceiling=0.05, min_segment=20,
)
EV, LI, EVA = q.rounds_events(), q.rounds_lineitem(), q.rounds_events(None)
CAT = q.catalog()
PC_KEYS = "parent uid game_id play_type:i currency sm_tag"


def events(s, d):
    return fx.rounds_from_events(s, d)


def accounts(s, d):
    return fx.rounds_from_events(s, d, None)


def lineitem(s, d):
    return fx.rounds_from_lineitem(s, d)


def cells(r, t=T):
    return ft.player_cell_features(r, t, min_rounds=1, evidence=False)


# --- filters and expressions -----------------------------------------------------
X = Exclusions(fleets=(("op1", "u[0-9]$"), (None, "u1[01]")), accounts=(("op2", "u2"),),
               parents=("op3",), games=("g2",))
_REASON = """CASE WHEN (parent = 'op1' AND regexp_matches(uid, '^(?:u[0-9]$)')) OR regexp_matches(uid, '^(?:u1[01])')
    THEN 'fleet' WHEN parent = 'op2' AND uid = 'u2' THEN 'account' WHEN parent = 'op3' THEN 'scope_parent'
    WHEN game_id = 'g2' THEN 'scope_game' ELSE 'kept' END"""
register("FLT_1_exclusion_counts", lambda s, d: exclusion_counts(events(s, d), X), "reason n_rows:i",
         f"SELECT {_REASON} AS reason, count(*) AS n_rows FROM r GROUP BY 1", EV)
register("FLT_1_apply_exclusions", lambda s, d: apply_exclusions(events(s, d), X), "serial:i parent uid game_id",
         f"SELECT * FROM r WHERE {_REASON} = 'kept'", EV)
register("FLT_4_like_filter", lambda s, d: lineitem(s, d).where(F.col("parent").like("op1_")).groupBy("parent").agg(
    F.count("*").alias("rounds")), "parent rounds:i",
    "SELECT parent, count(*) AS rounds FROM r WHERE parent LIKE 'op1_' GROUP BY 1", LI)
register("FLT_6_safe_ratio", lambda s, d: events(s, d).select(
    "serial", multiple().alias("multiple"), log_multiple().alias("log_multiple")),
    "serial:i multiple:f log_multiple:f",
    f"SELECT serial, win / nullif(valid_bet, 0) AS multiple, {q.LOGM} AS log_multiple FROM r", EV)
register("FLT_7_uid_skeleton", lambda s, d: fx.table(s, d, "customer").select(
    "c_custkey", uid_skeleton("c_name").alias("skeleton"),
    uid_trailing_number("c_name").cast("bigint").alias("suffix")), "c_custkey:i skeleton suffix:i",
    r"""SELECT c_custkey, regexp_replace(regexp_replace(c_name, '[A-Za-z]', 'a', 'g'), '\d', '#', 'g') AS skeleton,
    CAST(nullif(regexp_extract(c_name, '(\d+)\D*$', 1), '') AS BIGINT) AS suffix FROM customer""")


def _san(c: str, fallback: str = "NA") -> str:
    t = rf"regexp_replace(regexp_replace(CAST({c} AS VARCHAR), '[^A-Za-z0-9_.-]', '_', 'g'), '^[._-]+|[._-]+$', '', 'g')"
    return f"CASE WHEN coalesce({t}, '') = '' THEN '{fallback}' ELSE substr({t}, 1, 64) END"


register("FLT_9_case_ids", lambda s, d: fx.table(s, d, "part").select(
    "p_partkey",
    player_case_id("p_brand", "p_type", "p_name").alias("player_case"),
    game_case_id("p_type", "p_size", "p_name", "p_brand").alias("game_case")),
    "p_partkey:i player_case game_case",
    f"""SELECT p_partkey, 'P_' || {_san('p_brand')} || '_' || {_san('p_type', 'ALL')} || '_' || {_san('p_name')}
    AS player_case, 'G_' || {_san('p_type')} || '_pt' || {_san('p_size')} || '_' || {_san('p_name', 'NOTAG')} || '_'
    || {_san('p_brand')} AS game_case FROM part""")

# --- reference-data joins --------------------------------------------------------
_PC_CTE = f"""pc AS (SELECT {q.PC}, {q.player_cell_sums()}, count(DISTINCT bet) AS bet_levels FROM r GROUP BY {q.PC})"""
_CC_CTE = f"""cc AS (SELECT {q.CELL}, count(*) AS rounds, stddev_samp(win / nullif(valid_bet, 0)) AS sigma_spin,
    count(*) FILTER (win > 0) AS n_win, count(*) FILTER (triggered) AS n_trigger FROM r GROUP BY {q.CELL})"""
_CO_CTE = f"""co AS (SELECT {q.CELL}, parent, count(*) AS rounds, count(*) FILTER (win > 0) AS n_win,
    count(*) FILTER (triggered) AS n_trigger FROM r GROUP BY {q.CELL}, parent)"""
_CERT = f"{PC_KEYS} rtp_cert:f rtp_source cap_cert:f cap_source"
register("JN_4_certified_return", lambda s, d: with_certified(cells(events(s, d)), fx.catalog(s)), _CERT,
         f"SELECT * FROM {q.certified('pc')}", f"{EV}, {CAT}, {_PC_CTE}")
register("JN_5_certified_cap", lambda s, d: with_certified(cells(lineitem(s, d)), fx.catalog(s)), _CERT,
         f"SELECT * FROM {q.certified('pc')}", f"{LI}, {CAT}, {_PC_CTE}")

# --- statistics ------------------------------------------------------------------
register("ST_1_robust_bound",
         lambda s, d: robust_bounds(lineitem(s, d), ["parent"], "win", 12.0, 20), "parent n:i bound:f branch",
         "SELECT g AS parent, n, bound, branch FROM rb", f"{LI}, {q.robust('rb', 'r', 'parent', 'win', 12.0, 20)}")
register("ST_1_robust_bound_global",
         lambda s, d: robust_bounds(fx.table(s, d, "orders"), [], "o_totalprice", 5.0, 20), "n:i bound:f branch",
         "SELECT n, bound, branch FROM rb", q.robust("rb", "orders", "", "o_totalprice", 5.0, 20))
_Z = "(SELECT l_returnflag AS fam, round(l_discount * 40 + l_tax * 20 - 1, 3) AS z FROM lineitem)"
register("ST_2_bh_select",
         lambda s, d: bh_select(
             fx.table(s, d, "lineitem").selectExpr(
                 "l_returnflag AS fam", "round(l_discount * 40 + l_tax * 20 - 1, 3) AS z"), ["fam"], "z", 0.05)
         .groupBy("fam", "z", "selected").agg(F.count("*").alias("n")),
         "fam z:f selected n:i",
         f"SELECT fam, z, selected, count(*) AS n FROM {q.bh('zs', 'fam', 'z', '0.05')} GROUP BY 1, 2, 3",
         f"zs AS {_Z}")
register("ST_3_normal_tail",
         lambda s, d: fx.table(s, d, "customer").select(
             "c_custkey", (F.col("c_acctbal") / 1000).alias("z")).withColumn("p", normal_sf("z")),
         "c_custkey:i z:f p:f",
         f"SELECT c_custkey, c_acctbal / 1000 AS z, {normal_sf_sql('c_acctbal / 1000')} AS p FROM customer")
register("ST_4_expected_max_z",
         lambda s, d: lineitem(s, d).groupBy("game_id").agg(F.count_distinct("uid").alias("n")).withColumn(
             "p", 1 - 1 / F.greatest(F.col("n"), F.lit(2))).withColumn("z", normal_ppf("p")).withColumn("tail", normal_sf("z")),
         "game_id n:i tail:f",
         # the quantile has no SQL form; the tail beyond it has to be one in n
         "SELECT game_id, count(DISTINCT uid) AS n, 1 / greatest(count(DISTINCT uid), 2) AS tail FROM r GROUP BY 1", LI)
register("AGG_19_quantiles",
         lambda s, d: order_stats(lineitem(s, d), ["parent"], "bet", {"med": 0.5, "p90": 0.9, "p999": 0.999}),
         "parent n:i med:f p90:f p999:f",
         """SELECT parent, count(*) AS n, median(bet) AS med, quantile_cont(bet, 0.9) AS p90,
         quantile_cont(bet, 0.999) AS p999 FROM r GROUP BY 1""", LI)
register("WIN_9_volume_group",
         lambda s, d: volume_group(lineitem(s, d).groupBy("parent", "uid").agg(F.count("*").alias("rounds"))),
         "parent uid rounds:i volume_group",
         """SELECT parent, uid, rounds, CASE WHEN NOT (mn < t1 AND t1 < t2 AND t2 < mx) THEN 'all'
         WHEN rounds <= t1 THEN 'low' WHEN rounds <= t2 THEN 'mid' ELSE 'high' END AS volume_group
         FROM p, (SELECT min(rounds) AS mn, quantile_cont(rounds, 1/3::DOUBLE) AS t1,
         quantile_cont(rounds, 2/3::DOUBLE) AS t2, max(rounds) AS mx FROM p)""",
         f"{LI}, p AS (SELECT parent, uid, count(*) AS rounds FROM r GROUP BY 1, 2)")

# --- metrics ---------------------------------------------------------------------


def _buy_share(s, d):
    return ft.per_player_buys(cells(lineitem(s, d))).where("buy_share IS NOT NULL")


register("MET_1_buy_share_turnover", _buy_share, "parent uid rounds:i buy_share:f",
         """SELECT parent, uid, count(*) AS rounds, sum(CASE WHEN play_type IN (2, 3, 4) THEN valid_bet ELSE 0 END)
         / nullif(sum(valid_bet), 0) AS buy_share FROM r GROUP BY 1, 2""", LI)


def _tables(r, t=T, only=mt.METRIC_RULES, until=None):
    """Sums per player and cell, pace, cells and operators: just those that the metrics named in ``only`` read."""
    sums = pace = cc = co = None
    if all(m in mt.OF_TIMING for m in only):
        parts = materialise(r.groupBy("parent", "uid").agg(F.count(F.lit(1)).alias("rounds")), "counted")
    else:
        parts = materialise(ft.cell_parts(r, t), "cell_parts")
        sums = parts.drop(*ft.MOMENTS)
        cc, co = materialise(ft.pool_cells(parts), "cell_constants"), materialise(ft.cell_operator_from_player_cell(sums), "cell_operator")
    if any(m in mt.OF_TIMING for m in only):
        pace = materialise(tm.player_pace(r, t, counted=parts, until=until), "player_pace")
    return sums, pace, cc, co


def _metrics_of(s, tables, t=T, segments=False, only=mt.METRIC_RULES):
    sums, pace, cc, co = tables
    pc = None if sums is None else sums.where(F.col("rounds") >= t.min_rounds)
    return mt.build_metrics(pc, pace, cc, co, fx.catalog(s), t, segments=segments, only=only)


def _all_metrics(s, d, r, t=T, segments=False, only=mt.METRIC_RULES):
    return _metrics_of(s, _tables(r, t, only), t, segments, only)


_GAPS = """seq AS (SELECT *, date_diff('second', lag(game_time) OVER w, game_time) AS gap_s,
    game_id != lag(game_id) OVER w AS game_changed FROM r
    WINDOW w AS (PARTITION BY parent, uid ORDER BY game_time, serial))"""
_PT_CTE = f"""{_GAPS}, pt AS (SELECT parent, uid, count(*) AS rounds, count(gap_s) AS n_gaps,
    count(*) FILTER (gap_s = 0) AS same_second_gaps, count(*) FILTER (gap_s BETWEEN 1 AND 30) AS in_range_gaps,
    count(*) FILTER (gap_s <= 0 AND game_changed) AS concurrent_rounds,
    count(DISTINCT hour(game_time)) AS hours_of_day_covered, max(gap_s) AS max_idle_s,
    count(DISTINCT CAST(game_time AS DATE)) AS active_days FROM seq GROUP BY 1, 2 HAVING count(*) >= 5),
  mg AS (SELECT parent, uid, max(c) AS modal_count FROM (SELECT parent, uid, gap_s, count(*) AS c FROM seq
    WHERE gap_s BETWEEN 1 AND 30 GROUP BY 1, 2, 3) GROUP BY 1, 2),
  mm AS (SELECT parent, uid, max(c) AS max_rounds_per_minute FROM (SELECT parent, uid,
    date_trunc('minute', game_time) AS m, count(*) AS c FROM r GROUP BY 1, 2, 3) GROUP BY 1, 2)"""
_TIMING_METRICS = {
    "MET_2_same_second_share": ("same_second_share", "same_second_gaps / n_gaps", "n_gaps >= 5"),
    "MET_3_modal_share": ("modal_share", "modal_count / in_range_gaps", "in_range_gaps >= 5"),
    "MET_4_concurrent_rounds": ("concurrent_rounds", "concurrent_rounds", "TRUE"),
    "MET_5_max_rounds_per_minute": ("max_rounds_per_minute", "max_rounds_per_minute", "TRUE"),
}
for _name, (_metric, _expr, _gate) in _TIMING_METRICS.items():
    register(_name, lambda s, d, m=_metric: _all_metrics(s, d, accounts(s, d), only=(m,)),
             "metric rule kind parent uid rounds:i value:f",
             f"""SELECT '{_metric}' AS metric, '{mt.METRIC_RULES[_metric][0]}' AS rule, 'ROBUST' AS kind, parent, uid,
             rounds, {_expr} AS value FROM pt LEFT JOIN mg USING (parent, uid) LEFT JOIN mm USING (parent, uid)
             WHERE {_gate}""", f"{EVA}, {_PT_CTE}")


def _rate_sql(own: str) -> str:
    p0 = (f"greatest(least(greatest(cc.{own} - coalesce(co.{own}, 0), 0) / nullif(greatest(cc.rounds - "
          f"coalesce(co.rounds, 0), 0), 0), 1 - 1e-9), 1e-9)")
    return f"""SELECT *, (phat - p0_frozen) / sqrt(p0_frozen * (1 - p0_frozen) / rounds) AS value,
    phat / p0_frozen AS lift FROM (SELECT pc.*, pc.{own} / pc.rounds AS phat, {p0} AS p0_frozen,
    cc.rounds - co.rounds AS peer_rounds FROM pc JOIN cc USING ({q.CELL}) JOIN co USING ({q.CELL}, parent)
    WHERE pc.play_type = 0 AND pc.rounds >= 10) WHERE peer_rounds >= 10"""


_RATE_CTES = f"{LI}, {_PC_CTE}, {_CC_CTE}, {_CO_CTE}"
for _name, _metric, _own in (("MET_6_trigger_rate_z", "trigger_rate_z", "n_trigger"),
                             ("MET_7_hit_rate_z", "hit_rate_z", "n_win")):
    register(_name, lambda s, d, m=_metric: _all_metrics(s, d, lineitem(s, d), only=(m,)),
             f"{PC_KEYS} rounds:i value:f lift:f p0_frozen:f peer_rounds:i", _rate_sql(_own), _RATE_CTES)
register("JN_3_leave_operator_out",
         lambda s, d: mt.leave_operator_out(
             cells(lineitem(s, d)).where("play_type = 0 AND rounds >= 10"), ft.cell_constants(lineitem(s, d)),
             ft.cell_operator_constants(lineitem(s, d)), "n_win", "p_hit").where("peer_rounds >= 10"),
         f"{PC_KEYS} p0_frozen:f peer_rounds:i", _rate_sql("n_win"), _RATE_CTES)
_MONEY_SQL = f"""SELECT *, excess / (sigma_spin * sqrt(sumsq_valid_bet)) AS value,
    100 * excess / nullif(turnover, 0) AS effect_rtp_points FROM (
    SELECT c.*, cc.sigma_spin, total_win - rtp_cert * turnover AS excess FROM {q.certified('pc')} c
    JOIN cc USING ({q.CELL}) WHERE rtp_cert IS NOT NULL AND sigma_spin > 0 AND sumsq_valid_bet > 0 AND c.rounds >= 5)"""
_MONEY_CTES = f"{LI}, {CAT}, {_PC_CTE}, {_CC_CTE}"
register("MET_8_excess_turnover_z",
         lambda s, d: _all_metrics(s, d, lineitem(s, d), only=("excess_turnover_z",)),
         f"{PC_KEYS} rounds:i value:f effect_rtp_points:f sigma_spin:f rtp_cert:f", _MONEY_SQL, _MONEY_CTES)
register("JN_12_cell_sigma_join",
         lambda s, d: mt.excess_money(
             cells(lineitem(s, d)).where("rounds >= 5"), ft.cell_constants(lineitem(s, d)), fx.catalog(s)),
         f"{PC_KEYS} sigma_spin:f value:f", _MONEY_SQL, _MONEY_CTES)

# --- calibration ------------------------------------------------------------------


_BUY_SRC = """b AS (SELECT parent, uid, count(*) AS rounds,
    sum(CASE WHEN play_type IN (2, 3, 4) THEN valid_bet ELSE 0 END) / nullif(sum(valid_bet), 0) AS value
    FROM r JOIN (SELECT parent, uid, game_id, play_type, currency, sm_tag FROM pc WHERE rounds >= 5)
    USING (parent, uid, game_id, play_type, currency, sm_tag) GROUP BY 1, 2)"""


# --- layer 1 ------------------------------------------------------------------------
_SIG = "signal_id family layer:i grain parent uid game_id play_type:i currency sm_tag metric value:f"
_PRES_SRC = f"""pz0 AS (SELECT *, CAST(rounds AS DOUBLE) AS n, CAST(n_trigger AS DOUBLE) AS k FROM pc
    WHERE play_type = 0 AND rounds >= 5 AND n_trigger >= 2 AND bet_levels > 1),
  pz1 AS (SELECT *, (sumsq_bet / n - pow(sum_bet / n, 2)) / k * (n - k) / greatest(n - 1, 1) AS nv FROM pz0),
  pz AS (SELECT *, CASE WHEN nv > 0 THEN (sum_bet_trigger / k - sum_bet / n) / sqrt(nv) END AS z FROM pz1)"""
register("L1_2_prescient_bet", lambda s, d: l1.prescient_bets(cells(lineitem(s, d)), T),
         f"{PC_KEYS} z:f selected", f"SELECT * FROM {q.bh('pz', '', 'z', '0.1')}", f"{LI}, {_PC_CTE}, {_PRES_SRC}")
_INTEGRITY = f"""SELECT signal_id, 'INTEGRITY' AS family, 1 AS layer, 'player_cell' AS grain, {q.PC}, metric, value,
    threshold, rounds AS n, keys FROM (
    SELECT 'L1-BALANCE_IDENTITY' AS signal_id, *, 'balance_identity_violations' AS metric,
      CAST(balance_violations AS DOUBLE) AS value, 0.0 AS threshold FROM src WHERE balance_violations > 0
    UNION ALL SELECT 'L1-DUP_ROUND', *, 'dup_seq_rounds', CAST(dup_seq_rounds AS DOUBLE), 0.0 FROM src
      WHERE dup_seq_rounds > 0
    UNION ALL SELECT 'L1-MAX_X_BREACH', *, 'max_multiple', max_multiple, cap_cert FROM src
      WHERE max_multiple > cap_cert)"""
_INT_CTES = f"""{CAT}, {_PC_CTE}, src AS (SELECT c.*, e.top_win_seq_ids AS keys FROM {q.certified('pc')} c
    LEFT JOIN {q.evidence(q.PC)} e USING ({q.PC}))"""


def _integrity(r, s, evidence=True):
    return l1.integrity_signals(
        ft.player_cell_features(r, T, min_rounds=1, evidence=evidence), fx.catalog(s)
    ).withColumn("keys", F.array_join("evidence", "|"))


register("L1_3_4_integrity_signals",
         lambda s, d: _integrity(events(s, d), s).where("signal_id IN ('L1-BALANCE_IDENTITY', 'L1-DUP_ROUND')"),
         f"{_SIG} threshold:f n:i keys",
         f"SELECT * FROM ({_INTEGRITY}) WHERE signal_id != 'L1-MAX_X_BREACH'", f"{EV}, {_INT_CTES}")
for _id, _rule in (("L1_3_balance_identity", "L1-BALANCE_IDENTITY"), ("L1_4_dup_round", "L1-DUP_ROUND"),
                   ("L1_5_max_x_breach", "L1-MAX_X_BREACH")):
    register(_id, lambda s, d, k=_rule: _integrity(lineitem(s, d), s).where(F.col("signal_id") == k),
             f"{_SIG} threshold:f n:i keys", f"SELECT * FROM ({_INTEGRITY}) WHERE signal_id = '{_rule}'",
             f"{LI}, {_INT_CTES}")
_WATCH = T.but(min_rounds=60, watch_n_mad=1.0, watch_min_population=10, watch_min_rounds=3)
_WATCH_CTES = f"""{LI}, {CAT}, {_PC_CTE}, w AS (SELECT *, round(total_win / turnover / rtp_cert, 9) AS rtp_ratio,
    round(total_win - turnover, 6) AS net_profit FROM {q.certified('pc')} WHERE rounds < 60 AND rounds >= 3 AND turnover > 0
    AND rtp_cert > 0), {q.robust('ra', 'w', '', 'rtp_ratio', 1.0, 10)}, wp AS (SELECT * FROM w WHERE net_profit > 0),
    {q.robust('rn', 'wp', 'currency', 'net_profit', 1.0, 10)}"""
register("L1_6_magnitude_watch",
         lambda s, d: l1.magnitude_watch(cells(lineitem(s, d)), fx.catalog(s), _WATCH),
         f"{PC_KEYS} rtp_ratio:f net_profit:f ratio_bound:f net_bound:f",
         """SELECT w.*, (SELECT bound FROM ra) AS ratio_bound, rn.bound AS net_bound FROM w
         JOIN rn ON rn.g = w.currency WHERE rtp_ratio >= (SELECT round(bound, 9) FROM ra) AND net_profit >= round(rn.bound, 6)""",
         _WATCH_CTES)
register("L1_7_duty_cycle", lambda s, d: l1.duty_cycle_signals(tm.player_timing(events(s, d), T), T),
         "signal_id family grain parent uid value:f threshold:f n:i",
         """SELECT 'L1-DUTY_CYCLE' AS signal_id, 'TIMING' AS family, 'player' AS grain, parent, uid,
         hours_of_day_covered AS value, 20.0 AS threshold, rounds AS n FROM pt
         WHERE hours_of_day_covered >= 20 AND active_days >= 7 AND max_idle_s < 43200""", f"{EV}, {_PT_CTE}")
register("L1_8_beta_in_prod", lambda s, d: l1.beta_signals(ft.cell_constants(events(s, d))),
         "signal_id family grain game_id play_type:i currency sm_tag value:f n:i",
         f"""SELECT 'L1-BETA_IN_PROD' AS signal_id, 'ENVIRONMENT' AS family, 'game_cell' AS grain, {q.CELL},
         count(*) FILTER (sm_v = 'feature_beta') AS value, count(*) AS n FROM r GROUP BY {q.CELL}
         HAVING count(*) FILTER (sm_v = 'feature_beta') > 0""", EV)


# --- all eight metrics and all segments, where the queries above show one metric ---------


def _every_metric(s, d, r=None):
    return materialise(_all_metrics(s, d, lineitem(s, d) if r is None else r, segments=True), "metrics")


def _tertiles(name: str, src: str) -> str:
    return f"""{name} AS (SELECT x.*, CASE WHEN NOT (mn < t1 AND t1 < t2 AND t2 < mx) THEN 'all' WHEN rounds <= t1 THEN 'low'
    WHEN rounds <= t2 THEN 'mid' ELSE 'high' END AS volume_group FROM {src} x, (SELECT min(rounds) AS mn, max(rounds) AS mx,
    quantile_cont(rounds, 1/3::DOUBLE) AS t1, quantile_cont(rounds, 2/3::DOUBLE) AS t2 FROM {src}) e)"""


def _rows_sql(metric: str, src: str, value: str = "value") -> str:
    kind = mt.METRIC_RULES[metric][2]
    cell = q.PC.replace("parent, uid, ", "") if kind == "Z" else (
        "NULL AS game_id, NULL AS play_type, NULL AS currency, NULL AS sm_tag")
    lift = "lift" if metric.endswith("_rate_z") else "NULL AS lift"
    p0 = "p0_frozen" if metric.endswith("_rate_z") else "NULL AS p0_frozen"
    money = ("effect_rtp_points, sigma_spin, rtp_cert" if metric == "excess_turnover_z" else
             "NULL AS effect_rtp_points, NULL AS sigma_spin, NULL AS rtp_cert")
    return (f"SELECT '{metric}' AS metric, parent, uid, {cell}, rounds, CAST({value} AS DOUBLE) AS value, {lift}, "
            f"{p0}, {money}, volume_group FROM {src}")


_EVERY = " UNION ALL ".join([
    _rows_sql("buy_share_turnover", "bv WHERE value IS NOT NULL"),
    *[_rows_sql(m, f"tv WHERE {gate}", e) for m, e, gate in _TIMING_METRICS.values()],
    _rows_sql("trigger_rate_z", f"({_rate_sql('n_trigger').replace('FROM pc JOIN', 'FROM pv pc JOIN')})"),
    _rows_sql("hit_rate_z", f"({_rate_sql('n_win').replace('FROM pc JOIN', 'FROM pv pc JOIN')})"),
    _rows_sql("excess_turnover_z", "mv WHERE value IS NOT NULL"),
])
_RULES_SQL = ", ".join(f"('{m}', '{r}', '{f}', '{k}', '{g}')" for m, (r, f, k, g) in mt.METRIC_RULES.items())
_FT_CTE = """ft AS (SELECT ru.*, kind = 'Z' OR rb.bound IS NOT NULL AS enabled,
    CASE WHEN kind = 'Z' THEN 'analytic_null+BH_FDR' ELSE coalesce(branch, 'insufficient_population') END AS branch,
    CASE WHEN rb.bound IS NOT NULL THEN greatest(rb.bound, ceiling_bound) END AS bound, ceiling_bound,
    CASE WHEN kind = 'Z' THEN 0.1 END AS fdr_q, CASE WHEN metric IN ('trigger_rate_z', 'hit_rate_z') THEN 1.0 END AS min_lift,
    CASE WHEN metric = 'excess_turnover_z' THEN 1.0 END AS min_effect_rtp_points
    FROM ru LEFT JOIN rb ON rb.g = ru.metric LEFT JOIN cl USING (metric))"""
_EVERY_CTES = f"""{_MONEY_CTES}, {_CO_CTE}, {_BUY_SRC}, {_PT_CTE}, {_tertiles('bv', 'b')},
  tj AS (SELECT * FROM pt LEFT JOIN mg USING (parent, uid) LEFT JOIN mm USING (parent, uid)), {_tertiles('tv', 'tj')},
  p0 AS (SELECT * FROM pc WHERE play_type = 0 AND rounds >= 5), {_tertiles('pv', 'p0')},
  mny AS ({_MONEY_SQL}), {_tertiles('mv', 'mny')},
  ru AS (SELECT * FROM (VALUES {_RULES_SQL}) v(metric, rule, family, kind, grain)),
  am AS (SELECT ru.*, a.* EXCLUDE (metric) FROM ({_EVERY}) a JOIN ru USING (metric)),
  ar AS (SELECT * FROM am WHERE kind = 'ROBUST'), az AS (SELECT * FROM am WHERE kind = 'Z'),
  {q.robust('rb', 'ar', 'metric', 'value', 2.0, 5)},
  cl AS (SELECT metric, quantile_cont(value, 0.95) AS ceiling_bound FROM ar GROUP BY 1),
  {_FT_CTE},
  ev AS (SELECT a.*, ft.bound, ft.enabled, coalesce(ft.enabled AND (CASE WHEN a.kind = 'ROBUST' THEN a.value > ft.bound ELSE
    a.selected AND (min_lift IS NULL OR lift IS NULL OR lift >= min_lift)
    AND (min_effect_rtp_points IS NULL OR effect_rtp_points >= min_effect_rtp_points) END), FALSE) AS fired
    FROM (SELECT *, FALSE AS selected FROM ar UNION ALL SELECT * FROM {q.bh('az', 'metric', 'value', '0.1')}) a
    JOIN ft USING (metric)),
  sr AS (SELECT metric, k AS segment_key, v AS segment_value, count(*) AS eligible, count(*) FILTER (fired) AS n_fired,
    count(*) FILTER (fired) / count(*) AS rate FROM (SELECT metric, fired,
      unnest(['overall', 'game_id', 'play_type', 'currency', 'sm_tag', 'parent', 'volume_group']) AS k,
      unnest(['all', game_id, CAST(play_type AS VARCHAR), currency, sm_tag, parent, volume_group]) AS v
      FROM ev WHERE enabled) WHERE v IS NOT NULL GROUP BY 1, 2, 3),
  vl AS (SELECT *, CASE WHEN segment_key = 'overall' AND rate > {T.saturation_abort} THEN 'saturation'
    WHEN segment_key = 'overall' AND rate > 0.05 THEN 'ceiling' WHEN segment_key != 'overall' AND eligible >= 20
    AND rate > greatest({T.alert_ceiling * T.segment_factor}, 1.0 / eligible) THEN 'segment' END AS breach FROM sr)"""


_FIT_SQL = """SELECT ft.*, coalesce(n, 0) AS train_eligible, coalesce(fired_share, 0) AS train_fire_rate FROM ft LEFT JOIN (
         SELECT metric, count(*) AS n, avg(CASE WHEN fired THEN 1.0 ELSE 0 END) AS fired_share FROM ev GROUP BY 1)
         USING (metric)"""
_VERDICT_SQL = """SELECT CASE WHEN count(*) FILTER (breach = 'saturation') > 0 THEN 'FAIL' WHEN count(breach) > 0 THEN 'WARN'
         ELSE 'PASS' END AS verdict, count(breach) AS breaches FROM vl"""


def _every_evaluated(s, d):
    m = _every_metric(s, d)
    return cal.evaluate(m, cal.fit(m, T))


def _every_validation(s, d):
    m = _every_metric(s, d)
    return cal.validate(m, cal.fit(m, T), T)


register("ST_5_fit", lambda s, d: cal.fit(_every_metric(s, d), T),
         "metric rule kind enabled branch bound:f ceiling_bound:f fdr_q:f min_lift:f min_effect_rtp_points:f "
         "train_eligible:i train_fire_rate:f",
         _FIT_SQL, _EVERY_CTES)
register("ST_6_evaluate", _every_evaluated,
         f"metric rule kind {PC_KEYS} rounds:i value:f lift:f effect_rtp_points:f fired", "SELECT * FROM ev", _EVERY_CTES)
register("AGG_16_segment_rates", lambda s, d: cal.segment_rates(_every_evaluated(s, d)),
         "metric segment_key segment_value eligible:i n_fired:i rate:f", "SELECT * FROM sr", _EVERY_CTES)
register("ST_7_validate", _every_validation,
         "metric segment_key segment_value eligible:i n_fired:i rate:f breach", "SELECT * FROM vl", _EVERY_CTES)
register("ST_8_calibration_verdict", lambda s, d: cal.verdict(_every_validation(s, d)), "verdict breaches:i",
         _VERDICT_SQL, _EVERY_CTES)
register("L1_1_calibrated_signals",
         lambda s, d: (lambda m: l1.calibrated_signals(m, cal.fit(m, T), T))(_every_metric(s, d)),
         f"{_SIG} threshold:f effect:f effect_unit n:i p_value:f persistence",
         f"""SELECT rule AS signal_id, family, 1 AS layer, grain, {q.PC}, metric, value, bound AS threshold,
         coalesce(lift, effect_rtp_points) AS effect, CASE WHEN metric IN ('trigger_rate_z', 'hit_rate_z') THEN 'lift'
         ELSE 'rtp_points' END AS effect_unit, rounds AS n, CASE WHEN kind = 'Z' THEN {normal_sf_sql('value')} END AS p_value,
         CASE WHEN metric IN ('buy_share_turnover', 'modal_share', 'concurrent_rounds', 'max_rounds_per_minute')
         THEN 'not_computable' ELSE 'not_evaluated' END AS persistence FROM ev WHERE fired""", _EVERY_CTES)


TRAIN_END, VALIDATION_END = "1995-06-30 00:00:00", "1998-06-01 00:00:00"


def _until(end: str) -> str:
    return _EVERY_CTES.replace(
        LI, f"{q.rounds_lineitem('every_r')}, r AS (SELECT * FROM every_r WHERE game_time <= TIMESTAMP '{end}')", 1)


TWO_WINDOW_CTES = _until(VALIDATION_END).replace(
    _FT_CTE, f"fz AS (WITH {_until(TRAIN_END)} {_FIT_SQL}), ft AS (SELECT * EXCLUDE (train_eligible, train_fire_rate) FROM fz)", 1)


def _two_windows(s, d):
    """Parameters fitted at one boundary, judged on the rounds of a later one."""
    r, cat = lineitem(s, d), fx.catalog(s)
    path = f"{shared_dir(s)}/frozen-{uuid.uuid4().hex}"
    sc.calibrate(r, cat, TRAIN_END, VALIDATION_END, path, T)
    return cal.load_frozen(s, path)


def _later_validation(s, d):
    r, cat = lineitem(s, d), fx.catalog(s)
    trained, later = (sc.extract(r, end, T, for_metrics=True) for end in (TRAIN_END, VALIDATION_END))
    frozen = materialise(cal.fit(sc._metrics(trained, cat, T, sc.DEFAULT_EXCLUSIONS), T), "frozen")
    return cal.validate(sc._metrics(later, cat, T, sc.DEFAULT_EXCLUSIONS, segments=True), frozen, T)


register("SNK_6_frozen_parameters", _two_windows,
         "metric rule kind enabled branch bound:f ceiling_bound:f fdr_q:f min_lift:f min_effect_rtp_points:f "
         "train_eligible:i train_fire_rate:f validation_verdict train_as_of validated_as_of",
         f"""SELECT fz.*, verdict AS validation_verdict, '{TRAIN_END}' AS train_as_of, '{VALIDATION_END}' AS validated_as_of
         FROM fz, ({_VERDICT_SQL})""", TWO_WINDOW_CTES)
register("ST_8_calibrate_two_windows", _later_validation,
         "metric segment_key segment_value eligible:i n_fired:i rate:f breach", "SELECT * FROM vl", TWO_WINDOW_CTES)


HALF_END = "1998-06-01 00:00:00"


def _persist_every(s, d):
    r = lineitem(s, d)
    tables = sums, pace, _, _ = _tables(r, until=HALF_END)
    half = ft.cell_parts(r.where(F.col("game_time") <= F.lit(HALF_END).cast("timestamp_ntz")), T).drop(*ft.MOMENTS)
    m = materialise(_metrics_of(s, tables, segments=True), "metrics")
    return l1.with_persistence(
        cal.evaluate(m, cal.fit(m, T)), T.but(half_window_z=0.2), player_cell=sums,
        half_player_cell=materialise(half, "half_cells"), player_timing=pace, half_player_timing=tm.half_pace(pace, T.min_rounds))


def _half_z(h: str) -> str:
    return f"""CASE metric WHEN 'excess_turnover_z' THEN CASE WHEN {h}.q > 0 THEN
    ({h}.w - rtp_cert * {h}.b) / (sigma_spin * sqrt({h}.q)) END
    ELSE ((CASE metric WHEN 'trigger_rate_z' THEN {h}.t ELSE {h}.h END) / greatest({h}.n, 1) - p0_frozen)
      / sqrt(p0_frozen * (1 - p0_frozen) / greatest({h}.n, 1)) END"""


_HALF = f"""SELECT {q.PC}, count(*) AS n, count(*) FILTER (triggered) AS t, count(*) FILTER (win > 0) AS h,
    sum(win) AS w, sum(valid_bet) AS b, sum(valid_bet * valid_bet) AS q FROM"""
_PERSIST_CTES = f"""{_EVERY_CTES}, hr AS (SELECT * FROM r WHERE game_time <= TIMESTAMP '1998-06-01'),
  h1 AS ({_HALF} hr GROUP BY {q.PC}), hw AS ({_HALF} r GROUP BY {q.PC}),
  h2 AS (SELECT {q.PC}, {', '.join(f'hw.{c} - coalesce(h1.{c}, 0) AS {c}' for c in 'nthwbq')} FROM hw LEFT JOIN h1 USING ({q.PC})),
  g1 AS (SELECT parent, uid, count(gap_s) AS n_gaps, count(*) FILTER (gap_s = 0) AS zero FROM (SELECT parent, uid,
    date_diff('second', lag(game_time) OVER (PARTITION BY parent, uid ORDER BY game_time, serial), game_time) AS gap_s FROM hr)
    GROUP BY 1, 2 HAVING count(*) >= 5),
  g2 AS (SELECT parent, uid, pt.n_gaps - coalesce(g1.n_gaps, 0) AS n_gaps, same_second_gaps - coalesce(g1.zero, 0) AS zero
    FROM pt LEFT JOIN g1 USING (parent, uid))"""
register("L1_9_split_half_persistence", _persist_every, f"metric {PC_KEYS} value:f persistence",
         f"""SELECT ev.*, CASE WHEN kind = 'Z' THEN CASE WHEN h1.parent IS NULL THEN 'not_computable'
         WHEN {_half_z('h1')} >= 0.2 AND {_half_z('h2')} >= 0.2 THEN 'held' ELSE 'failed' END
         WHEN metric = 'same_second_share' THEN CASE WHEN g1.parent IS NULL THEN 'not_computable'
         WHEN g1.zero / greatest(g1.n_gaps, 1) > bound AND g2.zero / greatest(g2.n_gaps, 1) > bound THEN 'held' ELSE 'failed' END
         ELSE 'not_computable' END AS persistence FROM ev
         LEFT JOIN h1 USING ({q.PC}) LEFT JOIN h2 USING ({q.PC}) LEFT JOIN g1 USING (parent, uid) LEFT JOIN g2 USING (parent, uid)""",
         _PERSIST_CTES)

# --- layer 2 ---------------------------------------------------------------------------
_GD_CTE = f"""gd AS (SELECT {q.CELL}, CAST(game_time AS DATE) AS event_date, count(*) AS rounds,
    sum(valid_bet) AS turnover, sum(win) AS total_win, sum(valid_bet * valid_bet) AS sumsq_valid_bet,
    count(*) FILTER (triggered) AS n_trigger FROM r GROUP BY {q.CELL}, CAST(game_time AS DATE) HAVING count(*) >= 5),
  gx AS (SELECT *, sum(rounds) OVER w AS c_rounds, sum(n_trigger) OVER w AS c_trigger, count(*) OVER w AS c_days
    FROM gd WINDOW w AS (PARTITION BY {q.CELL}))"""
_DAYKEY = "game_id play_type:i currency sm_tag event_date:d"


def _series(s, d):
    return ft.game_day_series(events(s, d))


_OFF_CTES = f"""{EV}, {CAT}, {_GD_CTE}, ot AS (SELECT *, total_win - rtp_cert * turnover AS excess,
    stddev_samp(total_win / nullif(turnover, 0)) OVER (PARTITION BY {q.CELL}) AS sd FROM {q.certified('gx')}
    WHERE rtp_cert IS NOT NULL AND sumsq_valid_bet > 0),
  oz AS (SELECT *, CASE WHEN c_days >= 5 THEN excess / nullif(sd * sqrt(rounds) * sqrt(sumsq_valid_bet), 0) END AS z,
    100 * excess / nullif(turnover, 0) AS effect FROM ot)"""
register("L2_1_off_target_rtp", lambda s, d: l2.off_target_days(_series(s, d), fx.catalog(s), T),
         f"{_DAYKEY} z:f effect:f selected",
         f"SELECT * REPLACE (selected AND effect >= 2.0 AS selected) FROM {q.bh('oz', '', 'z', '0.1')}", _OFF_CTES)
register("WIN_7_daily_rtp_sd", lambda s, d: l2.off_target_days(_series(s, d), fx.catalog(s), T),
         f"{_DAYKEY} sigma_round:f", "SELECT *, sd * sqrt(rounds) AS sigma_round FROM ot", _OFF_CTES)
register("WIN_10_cell_totals", lambda s, d: l2.eligible_days(_series(s, d), T),
         f"{_DAYKEY} rounds:i c_rounds:i c_trigger:i c_days:i", "SELECT * FROM gx", f"{EV}, {_GD_CTE}")
_TD_CTES = f"""{EV}, {_GD_CTE}, tp AS (SELECT *, greatest(least((c_trigger - n_trigger) / (c_rounds - rounds),
    1 - 1e-9), 1e-9) AS p0, n_trigger / rounds AS phat FROM gx WHERE c_rounds > rounds),
  tz AS (SELECT *, (phat - p0) / sqrt(p0 * (1 - p0) / rounds) AS z, phat / p0 AS lift FROM tp)"""
register("L2_2_trigger_drift", lambda s, d: l2.trigger_drift_days(_series(s, d), T),
         f"{_DAYKEY} z:f lift:f selected",
         f"SELECT * REPLACE (selected AND lift >= 1.2 AND c_days >= 5 AS selected) FROM {q.bh('tz', '', 'z', '0.1')}",
         _TD_CTES)
_BUILD_CTES = f"""{EV}, {_GD_CTE}, bd AS (SELECT {q.CELL}, min(event_date) AS first_day, sum(rounds) AS rounds,
    sum(total_win) / nullif(sum(turnover), 0) AS rtp FROM gd GROUP BY {q.CELL}),
  bs AS (SELECT *, lag(sm_tag) OVER w AS prev_tag, lag(rtp) OVER w AS prev_rtp FROM bd
    WINDOW w AS (PARTITION BY game_id, play_type, currency ORDER BY first_day, sm_tag))"""
_BUILD = "game_id play_type:i currency sm_tag first_day:d rounds:i rtp:f prev_tag prev_rtp:f"
register("WIN_5_previous_build", lambda s, d: l2.build_sequence(_series(s, d), T), _BUILD, "SELECT * FROM bs", _BUILD_CTES)
register("L2_3_deploy_shift", lambda s, d: l2.deploy_shifts(_series(s, d), T), f"{_BUILD} shift:f z:f",
         """SELECT *, rtp - prev_rtp AS shift, (rtp - prev_rtp) / (0.02 / sqrt(rounds / 500.0)) AS z FROM bs
         WHERE prev_tag IS NOT NULL AND rounds >= 20 AND abs(rtp - prev_rtp) >= 0.02
         AND abs((rtp - prev_rtp) / (0.02 / sqrt(rounds / 500.0))) >= 0.1""", _BUILD_CTES)
