"""Queries of the aggregations and windows over rounds."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import functions as F

from tallyscope.functions.columns import top_rounds
from tallyscope.operators import features as ft
from tallyscope.operators import partials as pt
from tallyscope.operators import timing as tm
from tallyscope.plans import sqltext as q
from tallyscope.plans.registry import register
from tallyscope.settings import PLAYER_CELL, Thresholds
from tallyscope.sources import fixtures as fx
from tallyscope.sources.durable import shared_dir

T = Thresholds().but(min_rounds=5, physical_rpm=3, hot_session_rounds=30)
EV, LI = q.rounds_events(), q.rounds_lineitem()

_SUMS = ("rounds:i turnover:f total_win:f n_win:i n_trigger:i dup_seq_rounds:i sum_bet:f sumsq_bet:f "
         "sum_bet_trigger:f sumsq_valid_bet:f sum_log_mult:f sumsq_log_mult:f max_multiple:f "
         "balance_violations:i first_round_utc:t last_round_utc:t")
_PC = "parent uid game_id play_type:i currency sm_tag"
_CELL = "game_id play_type:i currency sm_tag"


def _ev(f):
    return lambda s, d: f(fx.rounds_from_events(s, d))


def _li(f):
    return lambda s, d: f(fx.rounds_from_lineitem(s, d))


_PC_SQL = f"""SELECT {q.PC}, {q.player_cell_sums()}, count(DISTINCT bet) AS bet_levels,
    count(DISTINCT CAST(game_time AS DATE)) AS active_days FROM r GROUP BY {q.PC}"""

register(
    "AGG_1_player_cell_features", _ev(lambda r: ft.player_cell_features(r, T)),
    f"{_PC} {_SUMS} bet_levels:i active_days:i top_win_seq_ids",
    f"SELECT * FROM ({_PC_SQL} HAVING count(*) >= 5) JOIN {q.evidence(q.PC)} USING ({q.PC})", EV,
)
register(
    "AGG_1_player_cell_features_lineitem",
    _li(lambda r: ft.player_cell_features(r, T, evidence=False)),
    f"{_PC} {_SUMS} bet_levels:i active_days:i", f"{_PC_SQL} HAVING count(*) >= 5", LI,
)
register(
    "AGG_2_top_rounds",
    _li(lambda r: top_rounds(r, ["parent", "uid"])),
    "parent uid top_win_seq_ids",
    """SELECT parent, uid, string_agg(key, '|' ORDER BY rn) AS top_win_seq_ids FROM (
        SELECT parent, uid, game_seq_id || '@' || strftime(game_time, '%Y-%m-%dT%H:%M:%SZ') AS key,
        row_number() OVER (PARTITION BY parent, uid ORDER BY win DESC, serial, game_seq_id, game_time) rn
        FROM r) WHERE rn <= 5 GROUP BY ALL""", LI,
)
register(
    "FLT_2_volume_floor",
    _ev(lambda r: ft.player_cell_features(r, T, min_rounds=1, evidence=False).withColumn(
        "above_floor", F.col("rounds") >= 100)),
    f"{_PC} rounds:i above_floor",
    f"SELECT {q.PC}, count(*) AS rounds, count(*) >= 100 AS above_floor FROM r GROUP BY {q.PC}", EV,
)
_CC_SQL = f"""SELECT {q.CELL}, count(*) AS rounds, count(DISTINCT parent || ':' || uid) AS n_players,
    sum(valid_bet) AS turnover, sum(win) / nullif(sum(valid_bet), 0) AS rtp_emp,
    stddev_samp(win / nullif(valid_bet, 0)) AS sigma_spin,
    count(*) FILTER (win > 0) / count(*) AS p_hit, count(*) FILTER (triggered) / count(*) AS p_trigger,
    count(*) FILTER (sm_v = 'feature_beta') AS beta_rounds, avg({q.LOGM}) AS mean_log_mult,
    stddev_samp({q.LOGM}) AS sd_log_mult, max(win / nullif(valid_bet, 0)) AS max_multiple_observed,
    min(game_time) AS first_round_utc, max(game_time) AS last_round_utc FROM r GROUP BY {q.CELL}"""
_CC = (f"{_CELL} rounds:i n_players:i turnover:f rtp_emp:f sigma_spin:f p_hit:f p_trigger:f beta_rounds:i "
       "mean_log_mult:f sd_log_mult:f max_multiple_observed:f first_round_utc:t last_round_utc:t")
register("AGG_3_cell_constants", _ev(ft.cell_constants), _CC, _CC_SQL, EV)
register("AGG_3_cell_constants_lineitem", _li(ft.cell_constants), _CC, _CC_SQL, LI)
_CS = "rounds:i turnover:f total_win:f n_win:i n_trigger:i sumsq_valid_bet:f"
_CS_SQL = """count(*) AS rounds, sum(valid_bet) AS turnover, sum(win) AS total_win,
    count(*) FILTER (win > 0) AS n_win, count(*) FILTER (triggered) AS n_trigger,
    sum(valid_bet * valid_bet) AS sumsq_valid_bet"""
_CO_SQL = f"SELECT {q.CELL}, parent, {_CS_SQL}, count(DISTINCT uid) AS n_players FROM r GROUP BY {q.CELL}, parent"
register("AGG_4_cell_operator_constants", _li(ft.cell_operator_constants),
         f"{_CELL} parent {_CS} n_players:i", _CO_SQL, LI)
_GD_SQL = f"""SELECT {q.CELL}, CAST(game_time AS DATE) AS event_date, max(report_date) AS report_date_utc8,
    {_CS_SQL}, count(DISTINCT parent || ':' || uid) AS n_players,
    count(*) FILTER (sm_v = 'feature_beta') AS beta_rounds, max(win) AS max_round_win
    FROM r GROUP BY {q.CELL}, CAST(game_time AS DATE)"""
register("AGG_5_game_day_series", _ev(ft.game_day_series),
         f"{_CELL} event_date:d report_date_utc8:d n_players:i {_CS} beta_rounds:i max_round_win:f", _GD_SQL, EV)
register(
    "AGG_6_cohort_game_profile", _li(lambda r: ft.cohort_game_profile(r, "op1%")),
    "parent game_id play_type:i currency rounds:i players:i active_days:i turnover:f total_win:f rtp:f "
    "sumsq_valid_bet:f builds:i first_round_utc:t last_round_utc:t",
    """SELECT parent, game_id, play_type, currency, count(*) AS rounds, count(DISTINCT uid) AS players,
    count(DISTINCT CAST(game_time AS DATE)) AS active_days, sum(valid_bet) AS turnover, sum(win) AS total_win,
    sum(win) / nullif(sum(valid_bet), 0) AS rtp, sum(valid_bet * valid_bet) AS sumsq_valid_bet,
    count(DISTINCT sm_tag) AS builds, min(game_time) AS first_round_utc, max(game_time) AS last_round_utc
    FROM r WHERE parent LIKE 'op1%' GROUP BY parent, game_id, play_type, currency""", LI,
)
_CASE = "parent uid game_id"
register(
    "AGG_7_case_daily", _ev(ft.case_daily),
    f"{_CASE} event_date:d rounds:i turnover:f total_win:f n_trigger:i avg_bet_trigger:f avg_bet_no_trigger:f max_multiple:f",
    """SELECT parent, uid, game_id, CAST(game_time AS DATE) AS event_date, count(*) AS rounds,
    sum(valid_bet) AS turnover, sum(win) AS total_win, count(*) FILTER (triggered) AS n_trigger,
    avg(bet) FILTER (triggered) AS avg_bet_trigger, avg(bet) FILTER (NOT triggered) AS avg_bet_no_trigger,
    max(win / nullif(valid_bet, 0)) AS max_multiple FROM r WHERE play_type = 0 GROUP BY 1, 2, 3, 4""", EV,
)
register(
    "AGG_8_case_bet_split", _ev(ft.case_bet_split),
    f"{_CASE} bet:f triggered rounds:i total_win:f turnover:f",
    """SELECT parent, uid, game_id, bet, triggered, count(*) AS rounds, sum(win) AS total_win,
    sum(valid_bet) AS turnover FROM r WHERE play_type = 0 GROUP BY 1, 2, 3, 4, 5""", EV,
)
register(
    "AGG_9_case_per_second", _ev(ft.case_per_second),
    "parent uid sec_utc:t rounds:i turnover:f total_win:f n_trigger:i max_multiple:f",
    """SELECT parent, uid, game_time AS sec_utc, count(*) AS rounds, sum(valid_bet) AS turnover,
    sum(win) AS total_win, count(*) FILTER (triggered) AS n_trigger,
    max(win / nullif(valid_bet, 0)) AS max_multiple FROM r GROUP BY 1, 2, 3""", EV,
)
_BREAK_SQL = f"""SELECT parent, uid, game_seq_id, game_time, game_id, play_type, bet, win,
    after_balance - (before_balance - bet + win) AS identity_gap FROM r WHERE {q.BREAKS}"""
register("AGG_10_case_identity_breaks", _ev(ft.case_identity_breaks),
         "parent uid game_seq_id game_time:t game_id play_type:i bet:f win:f identity_gap:f", _BREAK_SQL, EV)
register("FLT_5_balance_identity", _li(ft.case_identity_breaks),
         "parent uid game_seq_id game_time:t game_id play_type:i bet:f win:f identity_gap:f", _BREAK_SQL, LI)
_DAY_SQL = f"""SELECT {q.PC}, CAST(game_time AS DATE) AS event_date, {q.player_cell_sums()},
    count(DISTINCT bet) AS bet_levels_day FROM r GROUP BY {q.PC}, CAST(game_time AS DATE)"""
register("AGG_11_player_cell_daily", _ev(lambda r: ft.player_cell_daily(r, T, evidence=False)),
         f"{_PC} event_date:d {_SUMS} bet_levels_day:i", _DAY_SQL, EV)

_ROLL_SQL = f"""SELECT {q.PC}, {', '.join(f'sum({c}) AS {c}' for c in ft.ADDITIVE)},
    max(max_multiple) AS max_multiple, max(bet_levels_day) AS bet_levels, count(*) AS active_days,
    min(first_round_utc) AS first_round_utc, max(last_round_utc) AS last_round_utc
    FROM dly WHERE event_date <= DATE '2024-01-20' GROUP BY {q.PC}"""


def _rollup(r):
    daily = ft.player_cell_daily(r, T)
    base = ft.rollup_daily(daily, "2024-01-10")
    inc = ft.rollup_daily(daily.where("event_date > date'2024-01-10'"), "2024-01-20")
    return ft.rollup_asof(base, inc)


_ROLL = f"{_PC} {_SUMS} bet_levels:i active_days:i"
_DLY = f"{EV}, dly AS ({_DAY_SQL})"
register("AGG_12_rollup_asof", _ev(_rollup), _ROLL, _ROLL_SQL, _DLY)
register("JN_7_rollup_full_outer", _ev(_rollup), f"{_PC} rounds:i turnover:f last_round_utc:t",
         f"SELECT {q.PC}, rounds, turnover, last_round_utc FROM ({_ROLL_SQL})", _DLY)
register("AGG_13_cell_operator_from_player_cell",
         _li(lambda r: ft.cell_operator_from_player_cell(
             ft.player_cell_features(r, T, min_rounds=1, evidence=False))),
         f"{_CELL} parent {_CS} n_players:i", _CO_SQL, LI)
register("AGG_14_cell_day_from_daily",
         _ev(lambda r: ft.cell_day_from_daily(ft.player_cell_daily(r, T, evidence=False))),
         f"{_CELL} event_date:d rounds:i total_win:f turnover:f n_trigger:i sumsq_valid_bet:f", _GD_SQL, EV)
register("AGG_15_per_player_buys",
         _li(lambda r: ft.per_player_buys(ft.player_cell_features(r, T, min_rounds=1, evidence=False))),
         "parent uid rounds:i turnover:f buy_turnover:f buy_share:f",
         """SELECT parent, uid, count(*) AS rounds, sum(valid_bet) AS turnover,
         sum(CASE WHEN play_type IN (2, 3, 4) THEN valid_bet ELSE 0 END) AS buy_turnover,
         sum(CASE WHEN play_type IN (2, 3, 4) THEN valid_bet ELSE 0 END) / nullif(sum(valid_bet), 0) AS buy_share
         FROM r GROUP BY 1, 2""", LI)
register("AGG_17_distinct_players",
         _li(lambda r: r.groupBy("game_id").agg(
             F.count_distinct("parent", "uid").alias("players"), F.count_distinct("bet").alias("stakes"))),
         "game_id players:i stakes:i",
         "SELECT game_id, count(DISTINCT parent || ':' || uid) AS players, count(DISTINCT bet) AS stakes "
         "FROM r GROUP BY 1", LI)


def _widened(r):
    return ft.widened_baseline(ft.player_cell_features(r, T, min_rounds=1, evidence=False), T.but(min_rounds=900))


register(
    "AGG_21_widened_baseline", _ev(_widened), f"{_CELL} baseline_level p_hit:f p_trigger:f rtp:f",
    """SELECT c.game_id, c.play_type, c.currency, c.sm_tag,
    CASE WHEN c.n >= 900 THEN 'cell' WHEN a.n >= 900 THEN 'no_sm_tag'
         WHEN b.n >= 900 THEN 'no_currency_ratios_only' ELSE 'none' END AS baseline_level,
    CASE WHEN c.n >= 900 THEN c.h WHEN a.n >= 900 THEN a.h WHEN b.n >= 900 THEN b.h END AS p_hit,
    CASE WHEN c.n >= 900 THEN c.t WHEN a.n >= 900 THEN a.t WHEN b.n >= 900 THEN b.t END AS p_trigger,
    CASE WHEN c.n >= 900 THEN c.w WHEN a.n >= 900 THEN a.w WHEN b.n >= 900 THEN b.w END AS rtp
    FROM c JOIN a USING (game_id, play_type, currency) JOIN b USING (game_id, play_type)""",
    EV + "".join(
        f""", {n} AS (SELECT {keys}, count(*) AS n, avg(CASE WHEN win > 0 THEN 1.0 ELSE 0 END) AS h,
        avg(CASE WHEN triggered THEN 1.0 ELSE 0 END) AS t, sum(win) / nullif(sum(valid_bet), 0) AS w
        FROM r GROUP BY {keys})"""
        for n, keys in (("c", q.CELL), ("a", "game_id, play_type, currency"), ("b", "game_id, play_type"))),
)

# --- windows -------------------------------------------------------------------
_SEQ = f"""{EV}, seq AS (SELECT *, date_diff('second', lag(game_time) OVER w, game_time) AS gap_s,
    game_id != lag(game_id) OVER w AS game_changed FROM r
    WINDOW w AS (PARTITION BY parent, uid ORDER BY game_time, serial)),
  sess AS (SELECT *, sum(CASE WHEN gap_s IS NULL OR gap_s > 1800 THEN 1 ELSE 0 END)
    OVER (PARTITION BY parent, uid ORDER BY game_time) AS session_no FROM seq)"""
register("WIN_1_gaps", _ev(lambda r: tm.sequence_rounds(r, T.session_idle_s)),
         "parent uid serial:i gap_s:i game_changed", "SELECT * FROM seq", _SEQ)
register("WIN_2_sessions", _ev(lambda r: tm.sessionise(r, T)),
         "parent uid serial:i session_no:i", "SELECT * FROM sess", _SEQ)
_MODAL_SQL = """SELECT parent, uid, gap_s AS modal_gap_s, n AS modal_count FROM (
    SELECT parent, uid, gap_s, count(*) AS n,
    row_number() OVER (PARTITION BY parent, uid ORDER BY count(*) DESC, gap_s) AS rn
    FROM seq WHERE gap_s BETWEEN 1 AND 30 GROUP BY 1, 2, 3) WHERE rn = 1"""
register("WIN_3_modal_gap", _ev(lambda r: tm.modal_gaps(r, T)),
         "parent uid modal_gap_s:i modal_count:i", _MODAL_SQL, _SEQ)
_MINUTE_SQL = """SELECT parent, uid, max(n) AS max_rounds_per_minute,
    count(*) FILTER (n >= 3) AS superhuman_minutes FROM (
    SELECT parent, uid, date_trunc('minute', game_time) AS m, count(*) AS n FROM r GROUP BY 1, 2, 3) GROUP BY 1, 2"""
register("WIN_4_minute_peaks", _ev(lambda r: tm.minute_peaks(r, T)),
         "parent uid max_rounds_per_minute:i superhuman_minutes:i", _MINUTE_SQL, EV)
_HOT_SQL = """SELECT parent, uid, count(*) FILTER (n < 30 AND stake > 0 AND won > 2.0 * stake) AS hot_small_sessions,
    count(*) AS sessions FROM (SELECT parent, uid, session_no, count(*) AS n, sum(valid_bet) AS stake,
    sum(win) AS won FROM sess GROUP BY 1, 2, 3) GROUP BY 1, 2"""
_PROFILE = ", ".join(f"count(*) FILTER (hour(game_time) = {h})" for h in range(24))
_TIMING_SQL = f"""SELECT s.parent, s.uid, count(*) AS rounds, count(gap_s) AS n_gaps,
    count(*) FILTER (gap_s = 0) AS same_second_gaps, count(*) FILTER (gap_s BETWEEN 1 AND 30) AS in_range_gaps,
    any_value(m.modal_gap_s) AS modal_gap_s,
    any_value(m.modal_count) / nullif(count(*) FILTER (gap_s BETWEEN 1 AND 30), 0) AS modal_share,
    count(*) FILTER (gap_s <= 0 AND game_changed) AS concurrent_rounds,
    max(CASE WHEN gap_s <= 600 THEN gap_s END) AS max_played_gap_s, max(gap_s) AS max_idle_s,
    count(DISTINCT hour(game_time)) AS hours_of_day_covered, [{_PROFILE}] AS hour_profile,
    count(DISTINCT CAST(game_time AS DATE)) AS active_days,
    any_value(p.max_rounds_per_minute) AS max_rounds_per_minute,
    any_value(p.superhuman_minutes) AS superhuman_minutes,
    any_value(h.hot_small_sessions) AS hot_small_sessions, any_value(h.sessions) AS sessions
    FROM sess s LEFT JOIN ({_MODAL_SQL}) m USING (parent, uid) LEFT JOIN ({_MINUTE_SQL}) p USING (parent, uid)
    LEFT JOIN ({_HOT_SQL}) h USING (parent, uid) GROUP BY s.parent, s.uid HAVING count(*) >= 5"""
TIMING_CTES, TIMING_SQL = _SEQ, _TIMING_SQL
_TIMING = ("parent uid rounds:i n_gaps:i same_second_gaps:i in_range_gaps:i modal_gap_s:i modal_share:f "
           "concurrent_rounds:i max_played_gap_s:i max_idle_s:i hours_of_day_covered:i hour_profile:o "
           "active_days:i max_rounds_per_minute:i superhuman_minutes:i hot_small_sessions:i sessions:i")
register("AGG_20_player_timing", _ev(lambda r: tm.player_timing(r, T)), _TIMING, _TIMING_SQL, _SEQ)
register("JN_1_timing_left_joins",
         _ev(lambda r: tm.player_timing(r, T)),
         "parent uid modal_gap_s:i max_rounds_per_minute:i hot_small_sessions:i",
         f"SELECT parent, uid, modal_gap_s, max_rounds_per_minute, hot_small_sessions FROM ({_TIMING_SQL})", _SEQ)
register("BH_2_hot_small_sessions",
         _ev(lambda r: tm.session_totals(r, T).groupBy("parent", "uid").agg(
             F.count_if(tm.is_hot_session(T)).alias("hot_small_sessions"), F.count("*").alias("sessions"))),
         "parent uid hot_small_sessions:i sessions:i", _HOT_SQL, _SEQ)


def _halves(r):
    mid = ft.player_cell_features(r.where("game_time <= timestamp_ntz'2024-01-15 00:00:00'"), T,
                                  min_rounds=1, evidence=False)
    end = ft.player_cell_features(r, T, min_rounds=1, evidence=False)
    return ft.subtract_half(end, mid, PLAYER_CELL, ft.ADDITIVE)


register("JN_6_half_window_subtract", _ev(_halves),
         f"{_PC} rounds:i turnover:f total_win:f n_win:i n_trigger:i sumsq_valid_bet:f",
         f"""SELECT {q.PC}, count(*) - count(*) FILTER (m) AS rounds,
         sum(valid_bet) - coalesce(sum(valid_bet) FILTER (m), 0) AS turnover,
         sum(win) - coalesce(sum(win) FILTER (m), 0) AS total_win,
         count(*) FILTER (win > 0 AND NOT m) AS n_win, count(*) FILTER (triggered AND NOT m) AS n_trigger,
         sum(valid_bet * valid_bet) - coalesce(sum(valid_bet * valid_bet) FILTER (m), 0) AS sumsq_valid_bet
         FROM (SELECT *, game_time <= TIMESTAMP '2024-01-15' AS m FROM r) GROUP BY {q.PC}""", EV)
for _name, _fn, _spec, _sort, _sql in (
    ("SRT_1_case_daily_ordered", ft.case_daily, "parent uid game_id event_date:d rounds:i",
     ["parent", "uid", "game_id", "event_date"],
     "SELECT parent, uid, game_id, CAST(game_time AS DATE) AS event_date, count(*) AS rounds FROM r "
     "WHERE play_type = 0 GROUP BY 1, 2, 3, 4 ORDER BY 1, 2, 3, 4"),
):
    register(_name, _ev(lambda r, f=_fn, k=_sort: f(r).orderBy(*k)), _spec, _sql, EV)


# --- aggregates of replay boundaries from stored daily partials --------------------------
TICKS = ("2024-01-10 12:30:00", "2024-01-21 23:00:00")


def _from_partials(aggregate, tables):
    """An aggregate of these partial tables at each boundary; rounds of a day are read when it is over, or for the day that is open."""
    def build(s, d):
        rounds, out = fx.rounds_from_events(s, d), None
        store = pt.PartialStore(s, f"{shared_dir(s)}/partials-{uuid.uuid4().hex}", T, tables)
        for tick in TICKS:
            store.advance(rounds, (date.fromisoformat(tick[:10]) - timedelta(days=1)).isoformat())
            found = aggregate(store.asof(rounds, tick)).withColumn("tick", F.lit(tick))
            out = found if out is None else out.unionByName(found)
        return out

    return build


def _at_ticks(sql: str, ctes: str = EV) -> str:
    every = q.rounds_events(name="r0") + ", r AS (SELECT * FROM r0 WHERE game_time <= TIMESTAMP '{tick}')" + ctes[len(EV):].replace("{", "{{").replace("}", "}}")
    return " UNION ALL ".join(f"SELECT '{tick}' AS tick, * FROM (WITH {every.format(tick=tick)} {sql}) x" for tick in TICKS)


register("AGG_12_incremental_player_cell", _from_partials(pt.player_cell, pt.OF_PLAYER_CELL), f"tick {_PC} {_SUMS} bet_levels:i active_days:i", _at_ticks(_PC_SQL))
register("AGG_20_incremental_player_timing", _from_partials(lambda p: pt.player_timing(p, T), pt.OF_TIMING), f"tick {_TIMING}", _at_ticks(_TIMING_SQL, _SEQ))
register("AGG_3_incremental_cell_constants", _from_partials(pt.cell_constants, pt.OF_CELLS), f"tick {_CC}", _at_ticks(_CC_SQL))
register("AGG_14_incremental_game_day", _from_partials(pt.game_day, pt.OF_CELLS),
         f"tick {_CELL} event_date:d report_date_utc8:d n_players:i {_CS} beta_rounds:i max_round_win:f", _at_ticks(_GD_SQL))
register("AGG_2_incremental_top_wins", _from_partials(lambda p: top_rounds(p.wins, PLAYER_CELL), pt.OF_WINS), f"tick {_PC} top_win_seq_ids",
         _at_ticks(f"SELECT * FROM {q.evidence(q.PC)}"))
