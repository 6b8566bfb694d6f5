"""Plain-SQL forms of the data views, used by the comparison queries."""

from __future__ import annotations

from tallyscope.sources.fixtures import CATALOG_VALUES


def rounds_events(players: int | None = 12, name: str = "r") -> str:
    user = f"(user_id % {players})" if players else "user_id"
    return f"""
ev0 AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
ev1 AS (
  SELECT *, date_trunc('hour', ts) + to_seconds(minute(ts)) AS game_time,
         CAST(1 + k % 4 AS DOUBLE) AS bet,
         CASE event_type WHEN 'purchase' THEN value / 10 WHEN 'click' THEN 1.0 ELSE 0.0 END AS win
  FROM ev0),
{name} AS (
  SELECT game_time, CAST(game_time + INTERVAL 8 HOUR AS DATE) AS report_date, event_id AS serial,
    CASE WHEN k % 25 = 7 THEN 'd' || {user} || '-' || k || '-' || day(ts)
         ELSE 'e' || event_id END AS game_seq_id,
    'op' || (user_id % 4) AS parent, 'u' || {user} AS uid,
    CASE WHEN k < 60 THEN 'g1' ELSE 'g2' END AS game_id,
    CASE WHEN k % 10 = 9 THEN 2 ELSE 0 END AS play_type,
    CASE WHEN user_id % 2 = 1 THEN 'USD' ELSE 'CNY' END AS currency,
    CASE WHEN k = 98 THEN 'feature_beta' ELSE 'feature_base' END AS sm_v,
    CASE WHEN game_time < TIMESTAMP '2024-01-16' THEN 'b1' ELSE 'b2' END AS sm_tag,
    bet, bet AS valid_bet, CAST(win AS DOUBLE) AS win, 1000.0::DOUBLE AS before_balance,
    1000.0::DOUBLE - bet + win + (CASE WHEN event_id % 101 = 100 THEN 1 ELSE 0 END) AS after_balance,
    event_type = 'signup' AS triggered, game_time + INTERVAL 1 SECOND AS last_modify_time
  FROM ev1)"""


def rounds_lineitem(name: str = "r") -> str:
    return f"""
li0 AS (
  SELECT *, CAST(l_shipdate AS TIMESTAMP) + to_seconds(CAST(l_partkey % 86400 AS INTEGER)) AS game_time,
    CASE WHEN l_discount >= 0.07 THEN l_quantity * l_discount * 30 ELSE 0.0 END AS win
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
{name} AS (
  SELECT game_time, CAST(game_time + INTERVAL 8 HOUR AS DATE) AS report_date,
    l_orderkey * 10 + l_linenumber AS serial, l_orderkey || '-' || l_linenumber AS game_seq_id,
    'op' || s_nationkey AS parent, 's' || l_suppkey AS uid, 'g' || (l_partkey % 2) AS game_id,
    CASE WHEN l_linenumber % 4 = 0 THEN 2 ELSE 0 END AS play_type,
    CASE WHEN l_returnflag = 'N' THEN 'USD' ELSE 'CNY' END AS currency,
    'feature_base' AS sm_v, l_linestatus AS sm_tag, l_quantity AS bet, l_quantity AS valid_bet,
    CAST(win AS DOUBLE) AS win, 10000.0::DOUBLE AS before_balance,
    10000.0::DOUBLE - l_quantity + win + (CASE WHEN l_partkey % 997 = 0 THEN 1 ELSE 0 END) AS after_balance,
    l_tax >= 0.07 AS triggered, game_time + INTERVAL 1 SECOND AS last_modify_time
  FROM li0)"""


def catalog(name: str = "cat") -> str:
    def lit(v) -> str:
        return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else repr(v))

    rows = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in CATALOG_VALUES)
    return (f"{name} AS (SELECT column0 AS game_id, CAST(col1 AS INTEGER) AS play_type, "
            f"CAST(col2 AS DOUBLE) AS rtp, CAST(col3 AS DOUBLE) AS max_multiplier "
            f"FROM (VALUES {rows}) v(column0, col1, col2, col3))")


BREAKS = "abs(after_balance - (before_balance - bet + win)) > greatest(0.01, abs(before_balance) * 1e-6)"
PC = "parent, uid, game_id, play_type, currency, sm_tag"
CELL = "game_id, play_type, currency, sm_tag"


def ts(c: str) -> str:
    """Timestamp as text, to compare engines on the same form."""
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def evidence(keys: str, src: str = "r", k: int = 5) -> str:
    return f"""(SELECT {keys}, string_agg(game_seq_id || '@' || strftime(game_time, '%Y-%m-%dT%H:%M:%SZ'), '|'
        ORDER BY rn) AS top_win_seq_ids FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY win DESC, serial, game_seq_id, game_time) rn
        FROM {src}) WHERE rn <= {k} GROUP BY {keys})"""


LOGM = "CASE WHEN win > 0 THEN ln(win / nullif(valid_bet, 0)) END"


def player_cell_sums() -> str:
    return f"""count(*) AS rounds, sum(valid_bet) AS turnover, sum(win) AS total_win,
    count(*) FILTER (win > 0) AS n_win, count(*) FILTER (triggered) AS n_trigger,
    count(*) - count(DISTINCT game_seq_id) AS dup_seq_rounds, sum(bet) AS sum_bet,
    sum(bet * bet) AS sumsq_bet, sum(CASE WHEN triggered THEN bet ELSE 0 END) AS sum_bet_trigger,
    sum(valid_bet * valid_bet) AS sumsq_valid_bet, sum(coalesce({LOGM}, 0)) AS sum_log_mult,
    sum(coalesce(pow({LOGM}, 2), 0)) AS sumsq_log_mult, max(win / nullif(valid_bet, 0)) AS max_multiple,
    count(*) FILTER ({BREAKS}) AS balance_violations, min(game_time) AS first_round_utc,
    max(game_time) AS last_round_utc"""


def certified(src: str, columns: str = "x.*") -> str:
    """Rows of ``src`` with the certified return and cap of their game."""
    return f"""(SELECT {columns}, coalesce(e.rtp, g.rtp_untyped) AS rtp_cert,
    CASE WHEN e.rtp IS NOT NULL THEN 'certified' WHEN g.rtp_untyped IS NOT NULL
         THEN 'certified_game_level' ELSE 'none' END AS rtp_source,
    coalesce(e.max_multiplier, g.cap) AS cap_cert,
    CASE WHEN e.max_multiplier IS NOT NULL THEN 'certified' WHEN g.cap IS NOT NULL
         THEN 'certified_game_level' ELSE 'none' END AS cap_source
    FROM {src} x LEFT JOIN cat e ON x.game_id = e.game_id AND x.play_type = e.play_type
    LEFT JOIN (SELECT game_id, max(rtp) FILTER (play_type IS NULL) AS rtp_untyped,
               max(max_multiplier) AS cap FROM cat GROUP BY 1) g ON x.game_id = g.game_id)"""


def bh(src: str, family: str, z: str, q: str) -> str:
    """Rows of ``src`` with ``selected`` of the Benjamini-Hochberg procedure."""
    from tallyscope.functions.normal import normal_sf_sql

    fam = f"PARTITION BY {family}" if family else ""
    key = family or "1"
    return f"""(SELECT x.*, coalesce(x.{z} >= c.zc, FALSE) AS selected FROM {src} x LEFT JOIN (
      SELECT {key} AS fam_, min({z}) AS zc FROM (
        SELECT *, count(*) OVER ({fam} ORDER BY {z} DESC) AS rk_, count(*) OVER ({fam}) AS m_
        FROM {src} WHERE {z} IS NOT NULL) t
      WHERE {normal_sf_sql(z)} <= ({q}) * rk_ / m_ GROUP BY 1) c ON c.fam_ = {('x.' + family) if family else '1'})"""


def robust(name: str, src: str, group: str, value: str, n_mad: float, members: int) -> str:
    """CTEs ending in ``name(g, n, bound, branch)``."""
    g = group or "1"
    p = name
    return f"""
{p}v AS (SELECT {g} AS g, CAST({value} AS DOUBLE) AS v FROM {src} WHERE {value} IS NOT NULL),
{p}m AS (SELECT g, count(*) AS n, median(v) AS med FROM {p}v GROUP BY g),
{p}d AS (SELECT v.g, v.v, m.med, m.n FROM {p}v v JOIN {p}m m ON v.g = m.g),
{p}a AS (SELECT g, median(abs(v - med)) AS mad FROM {p}d GROUP BY g),
{p}z AS (SELECT g, v FROM {p}d WHERE v > med),
{p}zm AS (SELECT g, count(*) AS nn, median(v) AS nzmed, stddev_pop(v) AS nzsd FROM {p}z GROUP BY g),
{p}za AS (SELECT z.g, median(abs(z.v - m.nzmed)) AS nzmad FROM {p}z z JOIN {p}zm m ON z.g = m.g GROUP BY 1),
{p}j AS (SELECT m.g, m.n, m.med, a.mad, zm.nn, zm.nzmed, zm.nzsd, za.nzmad FROM {p}m m
  LEFT JOIN {p}a a ON m.g = a.g LEFT JOIN {p}zm zm ON m.g = zm.g LEFT JOIN {p}za za ON m.g = za.g),
{name} AS (SELECT g, n,
  CASE WHEN n < {members} THEN NULL WHEN mad > 0 THEN med + {n_mad} * mad
       WHEN nn >= {members} AND nzmad > 0 THEN nzmed + {n_mad} * nzmad
       WHEN nn >= {members} AND nzsd > 0 THEN nzmed + {n_mad} * nzsd END AS bound,
  CASE WHEN n < {members} THEN 'insufficient_population' WHEN mad > 0 THEN 'median+N*MAD'
       WHEN nn >= {members} AND nzmad > 0 THEN 'MAD=0->nonzero median+N*MAD'
       WHEN nn >= {members} AND nzsd > 0 THEN 'MAD=0->nonzero sd' ELSE 'degenerate_disabled' END AS branch
  FROM {p}j)"""
