"""Queries of ingestion, sinks, the fast path and the log monitor."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyscope.operators import casegate as cg
from tallyscope.operators import cohorts as co
from tallyscope.operators import fastpath as fp
from tallyscope.operators import features as ft
from tallyscope.operators import fusion as fu
from tallyscope.operators import logs as lg
from tallyscope.operators import redaction as rd
from tallyscope.plans import sqltext as q
from tallyscope.plans.case_queries import _CD, _FZ, SCANS
from tallyscope.plans.registry import register
from tallyscope.plans.rule_queries import _PC_CTE, events
from tallyscope.settings import Thresholds
from tallyscope.sources import archive as ar
from tallyscope.sources import catalog as ct
from tallyscope.sources import fixtures as fx
from tallyscope.sources import sinks as sk
from tallyscope.sources.durable import materialise, shared_dir
from tallyscope.streaming import jobs

T = Thresholds()
EV = q.rounds_events()


def _place(s, name):
    return f"{shared_dir(s)}/{name}-{uuid.uuid4().hex}"


# --- ingestion -----------------------------------------------------------------
_REAL = "serial % 89 <> 3 AND serial % 97 <> 5"
_ROUND = ("serial:i game_time:t report_date:d game_seq_id parent uid game_id play_type:i currency sm_v sm_tag bet:f "
          "valid_bet:f win:f before_balance:f after_balance:f triggered last_modify_time:t")


def _rounds(s, d):
    return ar.load_rounds(fx.source_from_events(s, d))


register("SRC_1_load_rounds", _rounds, _ROUND, f"SELECT * FROM r WHERE {_REAL}", EV)


def _archived(s, d):
    path = _place(s, "archive")
    ar.bootstrap_archive(_rounds(s, d), path)
    return path


register("SRC_2_bootstrap_archive",
         lambda s, d: ar.read_archive(s, _archived(s, d)).groupBy("event_date").agg(
             F.count("*").alias("rounds"), F.sum("win").alias("total_win")), "event_date:d rounds:i total_win:f",
         f"SELECT CAST(game_time AS DATE) AS event_date, count(*) AS rounds, sum(win) AS total_win FROM r WHERE {_REAL} GROUP BY 1",
         EV)


def _merged(s, d):
    """Half the rounds, then an increment with new rounds and moved corrections."""
    src = fx.source_from_events(s, d)
    path = _place(s, "archive")
    ar.bootstrap_archive(ar.load_rounds(src.where("serial % 2 = 0")), path)
    late = src.withColumns({
        "win": F.when(F.col("serial") % 10 == 0, F.col("win") + 1).otherwise(F.col("win")).cast("decimal(18,4)"),
        "game_time": F.expr("CASE WHEN serial % 10 = 0 THEN game_time + INTERVAL 1 DAY ELSE game_time END"),
        "last_modify_time": F.expr("CASE WHEN serial % 10 = 0 THEN last_modify_time + INTERVAL 2 DAYS ELSE last_modify_time END"),
    })
    for _ in range(2):  # the second merge changes nothing
        ar.merge_increment(s, path, late, T, serial_watermark=-1, modified_since="2024-01-01 00:00:00")
    return ar.read_archive(s, path)


register("SRC_3_merge_increment", _merged, "serial:i game_time:t win:f last_modify_time:t event_date:d",
         f"""SELECT serial, game_time + (CASE WHEN serial % 10 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END) AS game_time,
         win + (CASE WHEN serial % 10 = 0 THEN 1 ELSE 0 END) AS win,
         last_modify_time + (CASE WHEN serial % 10 = 0 THEN INTERVAL 2 DAY ELSE INTERVAL 0 DAY END) AS last_modify_time,
         CAST(game_time + (CASE WHEN serial % 10 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END) AS DATE) AS event_date
         FROM r WHERE {_REAL}""", EV)
register("SRC_4_watermarks", lambda s, d: ar.watermarks(_rounds(s, d)), "max_serial:i max_game_time:t",
         f"SELECT max(serial) AS max_serial, max(game_time) AS max_game_time FROM r WHERE {_REAL}", EV)


def _asof_sql(s, d):
    events(s, d).createOrReplaceTempView("rounds_view")
    ar.create_rounds_asof(s, "rounds_view")
    return s.sql("SELECT * FROM rounds_asof(timestamp_ntz'2024-01-15 12:00:00')")


for _name, _f in (("SRC_5_rounds_asof", lambda s, d: ar.rounds_asof(events(s, d), "2024-01-15 12:00:00")),
                  ("SRC_5_rounds_asof_table_function", _asof_sql)):
    register(_name, _f, "serial:i game_time:t", "SELECT * FROM r WHERE game_time <= TIMESTAMP '2024-01-15 12:00:00'", EV)
register("SRC_6_replay_ticks",
         lambda s, d: ar.rounds_by_tick(events(s, d), "2024-01-17 00:00:00", "2024-01-31 00:00:00", T.but(
             replay_step_hours=96)), "as_of:t rounds:i",
         """SELECT as_of, count(serial) AS rounds FROM generate_series(TIMESTAMP '2024-01-17', TIMESTAMP '2024-01-31',
         INTERVAL 96 HOUR) g(as_of) LEFT JOIN r ON game_time <= as_of GROUP BY 1""", EV)


def _cloned(s, d):
    a, b = _archived(s, d), _place(s, "clone")
    ar.clone_archive(s, a, b)
    return ar.read_archive(s, b)


register("SRC_7_clone_table", _cloned, "serial:i parent uid win:f", f"SELECT * FROM r WHERE {_REAL}", EV)


def _appended(s, d):
    path, extra = _place(s, "archive"), _place(s, "extra")
    rounds = _rounds(s, d)
    ar.bootstrap_archive(rounds.where("serial % 2 = 0"), path)
    rounds.where("serial % 2 = 1").select(*ar._COLUMNS).write.option("header", True).csv(extra)
    ar.append_rounds(s, extra, path)
    return ar.read_archive(s, path)


register("SRC_8_append_rounds", _appended, _ROUND, f"SELECT * FROM r WHERE {_REAL}", EV)
register("SET_1_union_of_frames",
         lambda s, d: _rounds(s, d).where("serial % 2 = 0").unionByName(_rounds(s, d).where("serial % 2 = 1")),
         "serial:i uid", f"SELECT * FROM r WHERE {_REAL}", EV)
register("SRC_9_collision_check",
         lambda s, d: ar.collision_check(events(s, d), fx.table(s, d, "customer").selectExpr(
             "concat('op', c_custkey % 4) AS parent", "concat('u', c_custkey % 7) AS uid")), "parent uid n:i",
         """SELECT parent, uid, count(*) AS n FROM r WHERE (parent, uid) IN (SELECT ('op' || (c_custkey % 4),
         'u' || (c_custkey % 7)) FROM customer) GROUP BY 1, 2""", EV)

# --- certified sheet over parts ---------------------------------------------------
_SHEET = """p_partkey AS line,
  CASE WHEN p_partkey % 50 = 3 THEN '' WHEN p_partkey % 9 = 1 THEN concat('10', p_partkey % 100)
       WHEN p_partkey % 31 = 2 THEN 'x-1' ELSE concat('10', p_partkey % 100, 's') END AS game_id,
  CASE WHEN p_size % 6 = 5 THEN '' WHEN p_size % 13 = 7 THEN 'two' ELSE concat('', p_size % 5) END AS play_type,
  p_name AS game_name,
  CASE WHEN p_size % 5 = 2 THEN concat('Feature Buy ', p_size, '倍') ELSE 'Base' END AS playway,
  CASE WHEN p_size % 11 = 0 THEN '' WHEN p_size % 17 = 0 THEN 'n/a' WHEN p_size % 19 = 0 THEN '30.00%'
       ELSE concat(90 + p_size % 8, '.5%') END AS rtp,
  CASE WHEN p_size % 7 = 0 THEN '' WHEN p_size % 23 = 0 THEN 'none' ELSE concat(1 + p_size % 9, ',000x') END AS multiplier"""


def _parsed(s, d):
    return ct.parse_sheet(_sheet_rows(fx.table(s, d, "part").select("p_partkey", "p_size", "p_name")))


def _sheet_rows(part):
    part.createOrReplaceTempView("sheet_part")
    return part.sparkSession.sql(f"SELECT {_SHEET} FROM sheet_part")


_SHEET_CTES = f"""sh AS (SELECT {_SHEET} FROM part), s1 AS (SELECT *, TRY_CAST(play_type AS INTEGER) AS pt,
    TRY_CAST(nullif(regexp_extract(rtp, '^\\s*(\\d+(?:\\.\\d+)?)\\s*%\\s*$', 1), '') AS DOUBLE) / 100.0 AS ra,
    TRY_CAST(replace(nullif(regexp_extract(multiplier, '(\\d+(?:[\\d,]*\\d)?(?:\\.\\d+)?)\\s*[xX]', 1), ''), ',', '') AS DOUBLE) AS mm,
    TRY_CAST(nullif(regexp_extract(playway, '(\\d+(?:\\.\\d+)?)\\s*倍', 1), '') AS DOUBLE) AS bp FROM sh),
  s2 AS (SELECT *, CASE WHEN ra BETWEEN 0.5 AND 1.05 THEN ra END AS rt, game_id != '' AND row_number() OVER (
    PARTITION BY game_id, pt ORDER BY line) > 1 AS dup FROM s1),
  s3 AS (SELECT *, game_id != '' AND NOT dup AS kept, regexp_matches(game_id, '^\\d+[a-z]?$') AS ok FROM s2),
  iss AS (SELECT line, game_id, unnest(list_filter([CASE WHEN game_id = '' THEN 'blank_game_id' END,
    CASE WHEN game_id != '' AND NOT ok THEN 'game_id_unparseable' END,
    CASE WHEN regexp_matches(game_id, '^\\d+$') THEN 'game_id_missing_suffix' END,
    CASE WHEN game_id != '' AND play_type != '' AND pt IS NULL THEN 'play_type_unparseable' END,
    CASE WHEN game_id != '' AND play_type = '' THEN 'play_type_blank' END, CASE WHEN dup THEN 'duplicate_row' END,
    CASE WHEN kept AND multiplier != '' AND mm IS NULL THEN 'max_multiplier_unparseable' END,
    CASE WHEN kept AND rtp = '' THEN 'rtp_missing' END, CASE WHEN kept AND rtp != '' AND ra IS NULL THEN 'rtp_unparseable' END,
    CASE WHEN kept AND ra IS NOT NULL AND rt IS NULL THEN 'rtp_out_of_range' END], lambda x: x IS NOT NULL)) AS code FROM s3)"""
register("SRC_10_load_catalog", lambda s, d: ct.catalog_rows(_parsed(s, d)),
         "game_id play_type:i game_name playway rtp:f max_multiplier:f buy_price_x:f",
         "SELECT game_id, pt AS play_type, game_name, playway, rt AS rtp, mm AS max_multiplier, bp AS buy_price_x FROM s3 WHERE kept",
         _SHEET_CTES)
register("SRC_10_catalog_issues", lambda s, d: ct.catalog_issues(_parsed(s, d)), "line:i game_id code",
         "SELECT * FROM iss", _SHEET_CTES)
register("SRC_11_catalog_report",
         lambda s, d: (lambda p: ct.catalog_report(ct.catalog_rows(p), ct.catalog_issues(p)))(_parsed(s, d)),
         "games:i games_without_rtp:i n_rows:i n_issues:i verdict",
         """SELECT count(DISTINCT game_id) AS games, (SELECT count(*) FROM (SELECT game_id FROM s3 WHERE kept GROUP BY 1
         HAVING count(rt) = 0)) AS games_without_rtp, count(*) AS n_rows, (SELECT count(*) FROM iss) AS n_issues,
         'WARN' AS verdict FROM s3 WHERE kept""", _SHEET_CTES)


def _dumps(s, d):
    path = _place(s, "dump")
    fx.source_from_events(s, d).write.option("header", True).csv(path)
    return ar.read_row_dumps(s, path)


register("SRC_12_csv_slices", _dumps, "serial:i parent uid bet:f win:f triggered result_feature_code:i",
         f"SELECT *, 0 AS result_feature_code FROM r WHERE {_REAL}", EV)
register("SRC_13_parquet_artifacts",
         lambda s, d: ar.write_artifact(events(s, d).groupBy("parent", "uid").agg(F.count("*").alias("rounds")),
                                        _place(s, "artifacts"), "player", "2024-01-31 00:00:00"),
         "parent uid rounds:i", "SELECT parent, uid, count(*) AS rounds FROM r GROUP BY 1, 2", EV)

# --- sinks ---------------------------------------------------------------------------
W0, W1 = "1995-01-01T00:00:00", "2001-12-31T00:00:00"


def _cased(s, d):
    sg = fx.signals_from_lineitem(s, d)
    cases = materialise(fu.fuse(sg), "cases")  # read for the ids of the signals and again for the documents
    return cases, fu.signals_with_case(sg, cases)


def _emitted(s, d):
    path = _place(s, "candidates")
    sk.emit_fused(fx.signals_from_lineitem(s, d), path, W0, W1)
    return s.read.json(path).withColumn("n_nested", F.size("signals"))


register("SNK_1_emit_candidates", _emitted, "case_id currency escalation severity n_signals:i n_nested:i window_end",
         f"SELECT *, n_signals AS n_nested, '{W1}' AS window_end FROM fz", _FZ)


def _found(s, d):
    path = _place(s, "findings")
    sk.emit_findings(sk.findings(*_cased(s, d), W0, W1), path)
    return s.read.option("header", True).csv(path)


register("SNK_2_emit_findings", _found, "case_id signal_id currency family escalation description evidence_keys",
         """SELECT case_id, en.signal_id, en.currency, en.family, escalation, en.description, en.key AS evidence_keys FROM en
         JOIN fz ON en.isg = fz.isg AND en.ep IS NOT DISTINCT FROM fz.ep AND en.eu IS NOT DISTINCT FROM fz.eu
         AND en.eg IS NOT DISTINCT FROM fz.eg AND en.ept IS NOT DISTINCT FROM fz.ept
         AND en.ec IS NOT DISTINCT FROM fz.ec AND en.et IS NOT DISTINCT FROM fz.et""", _FZ)
register("SNK_3_case_queue", lambda s, d: sk.case_queue(*_cased(s, d)),
         "case_id escalation severity independent_families:i families signals",
         "SELECT * REPLACE (array_to_string(families, ', ') AS families), array_to_string(signal_ids, '; ') AS signals FROM fz", _FZ)


def _alert_log(s, d):
    path = _place(s, "alerts")
    c = fx.candidates_from_events(s, d)
    for scan in (f"s{i:02d}" for i in range(1, 11)):
        sk.write_alerts(cg.alerts_of(cg.gate_step(cg.empty_state(s), c.where(F.col("scan") == scan), scan)), path)
    return s.read.json(path)


register("SNK_4_write_alerts", _alert_log, "case_id action scan severity",
         f"""SELECT case_id, 'opened' AS action, printf('s%02d', seq) AS scan, severity FROM
         (SELECT {fx.CANDIDATE_COLUMNS} FROM ({fx.CANDIDATE_SHAPE}) b WHERE n_err >= 1) WHERE seq <= 10""")

def _written_proposals(s, d):
    r = fx.rounds_from_events(s, d, None)
    pc = ft.player_cell_features(r, T, min_rounds=1, evidence=False)
    people = co.accounts(pc)
    groups = materialise(co.structural_groups(people, T.but(cohort_min_members=3)).join(co.cohort_ids(people), co.GROUP), "cohorts")
    path = _place(s, "proposals")
    sk.write_proposals(groups, co.membership(groups, pc), path)
    return s.read.json(f"{path}/members").groupBy("parent").agg(
        F.count("*").alias("members"), F.count_distinct("cohort_id").alias("cohorts"))


register("SNK_5_write_proposals", _written_proposals, "parent members:i cohorts:i",
         r"""SELECT parent, sum(n) AS members, count(*) AS cohorts FROM (SELECT parent,
         regexp_replace(regexp_replace(uid, '[A-Za-z]', 'a', 'g'), '\d', '#', 'g') AS k, count(DISTINCT uid) AS n FROM r
         GROUP BY 1, 2) WHERE n >= 3 GROUP BY 1""", q.rounds_events(None))

# --- fast path ---------------------------------------------------------------------
_FAST = T.but(serial_margin=100)


def _newest(s, d):
    r = events(s, d)
    top = r.agg(F.max("serial")).first()[0]
    return fp.new_rounds(r, top // 2, _FAST)


_NEW = "n AS (SELECT * FROM r WHERE serial > greatest(0, (SELECT max(serial) FROM r) // 2 - 100))"
_NPC = _PC_CTE.replace("FROM r ", "FROM n ").replace("pc AS", "npc AS")
register("FP_1_incremental_slice", _newest, "serial:i parent uid", "SELECT * FROM n", f"{EV}, {_NEW}")
register("FP_2_absolute_aggregate", lambda s, d: fp.absolute_aggregate(_newest(s, d)),
         "parent uid game_id play_type:i currency sm_tag rounds:i balance_violations:i dup_seq_rounds:i max_multiple:f",
         "SELECT * FROM npc", f"{EV}, {_NEW}, {_NPC}")


def _with_summary(s, d):
    n = _newest(s, d)
    a = fp.absolute_aggregate(n)
    return fp.summary_with_violations(a, fp.violations(a, n, fx.catalog(s)), 0)


register("JN_2_summary_left_join", _with_summary,
         "scan_max_serial:i scan_rows:i parent uid game_id play_type:i currency sm_tag balance_violations:i top_win_seq_ids",
         f"""SELECT (SELECT max(serial) FROM n) AS scan_max_serial, (SELECT count(*) FROM n) AS scan_rows, npc.*,
         e.top_win_seq_ids FROM npc LEFT JOIN {q.evidence(q.PC, 'n')} e USING ({q.PC})
         WHERE balance_violations > 0 OR dup_seq_rounds > 0 OR max_multiple >= 2.9""", f"{EV}, {_NEW}, {_NPC}")
register("FP_3_lowest_cap", lambda s, d: fp.absolute_aggregate(_newest(s, d)).join(
    F.broadcast(fp.lowest_cap(fx.catalog(s))), F.lit(True), "left").where("max_multiple >= min_cap"),
    "parent uid game_id play_type:i currency sm_tag max_multiple:f min_cap:f",
    "SELECT *, 2.9 AS min_cap FROM npc WHERE max_multiple >= 2.9", f"{EV}, {_NEW}, {_NPC}")
register("FP_4_fast_integrity_cases", lambda s, d: fu.fuse(fp.fast_signals(_newest(s, d), fx.catalog(s))),
         "parent uid escalation severity signal_ids:a",
         f"""SELECT parent, uid, 'human_review' AS escalation, CASE WHEN bool_or(mx) THEN 'Critical' ELSE 'High' END AS severity,
         list_filter([CASE WHEN bool_or(b) THEN 'L1-BALANCE_IDENTITY' END, CASE WHEN bool_or(u) THEN 'L1-DUP_ROUND' END,
           CASE WHEN bool_or(mx) THEN 'L1-MAX_X_BREACH' END], lambda x: x IS NOT NULL) AS signal_ids FROM (
         SELECT *, balance_violations > 0 AS b, dup_seq_rounds > 0 AS u, coalesce(max_multiple > cap_cert, FALSE) AS mx
         FROM {q.certified('npc')}) WHERE b OR u OR mx GROUP BY 1, 2""", f"{EV}, {q.catalog()}, {_NEW}, {_NPC}")

# --- log monitor -----------------------------------------------------------------------
_LOGS = f"""log_events AS (SELECT event_id, event_type, user_id, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events), raw AS (SELECT {fx.LOG_COLUMNS} FROM ({fx.LOG_SHAPE}) b),
  js AS (SELECT *, regexp_extract(payload, '\\{{.*\\}}', 0, 's') AS doc FROM raw),
  rec AS (SELECT *, coalesce(doc ->> '$.response.gameSeqId', doc ->> '$.params.gameSeqId') AS gsid,
    CAST(coalesce(doc ->> '$.resCode', doc ->> '$.data.messageCode') AS INTEGER) AS res_code,
    doc ->> '$.path' AS path, doc ->> '$.params.gameId' AS game_id, doc ->> '$.params.agent' AS agent,
    doc ->> '$.params.currency' AS currency, doc ->> '$.params.token' AS token FROM js WHERE doc != ''),
  resp AS (SELECT * FROM rec WHERE container = 'spin-server' AND contains(payload, 'Spin-Server Response info'))"""


def _records(s, d):
    return lg.parse_entries(fx.logs_from_events(s, d), "salt")


def _kept(s, d):
    return materialise(_records(s, d), "log_records")


register("LG_1_parse", _records, "gsid res_code:i path game_id currency agent container player_key",
         "SELECT *, substr(sha256('salt' || token), 1, 12) AS player_key FROM rec", _LOGS)
register("LG_2_double_settle", lambda s, d: lg.double_settlements(lg.responses(_records(s, d))), "gsid n_responses:i",
         "SELECT gsid, count(*) AS n_responses FROM resp WHERE res_code = 1000 AND gsid IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
         _LOGS)
register("LG_3_round_replay", lambda s, d: lg.round_replays(lg.responses(_records(s, d))), "gsid codes:o failed_codes:o n_rows:i",
         """SELECT gsid, list_sort(list(DISTINCT res_code)) AS codes, [802] AS failed_codes, count(*) AS n_rows FROM resp
         WHERE gsid IS NOT NULL AND res_code != 0 GROUP BY 1 HAVING bool_or(res_code = 1000) AND bool_or(res_code != 1000)""", _LOGS)
_BYP = """SELECT 'path' AS kind, path AS detail FROM rec WHERE container = 'spin-server' AND path IS NOT NULL
    UNION ALL SELECT 'unknown_agent', agent FROM resp WHERE agent IS NOT NULL AND contains(payload, 'Agent not found')"""
register("LG_4_path_bypass", lambda s, d: lg.path_bypasses(_kept(s, d)).groupBy("kind", "detail").agg(
    F.count("*").alias("n")), "kind detail n:i", f"SELECT kind, detail, count(*) AS n FROM ({_BYP}) GROUP BY 1, 2", _LOGS)
_GAPS = f"""{_LOGS}, gp AS (SELECT substr(sha256('salt' || token), 1, 12) AS player_key, (epoch_us(ts) - epoch_us(lag(ts) OVER (
    PARTITION BY token ORDER BY ts))) / 1e6 AS gap_s FROM resp WHERE token IS NOT NULL AND res_code = 1000)"""
register("LG_5_cadence_census", lambda s, d: lg.cadence_census(lg.responses(_kept(s, d))),
         "player_key rounds:i min_gap_s:f median_gap_s:f",
         """SELECT player_key, count(*) AS rounds, min(gap_s) AS min_gap_s,
         list_sort(list(gap_s) FILTER (gap_s IS NOT NULL))[CAST(count(gap_s) // 2 + 1 AS INTEGER)] AS median_gap_s
         FROM gp GROUP BY 1 HAVING count(*) > 1""", _GAPS)
register("LG_5_gap_buckets", lambda s, d: lg.gap_buckets(lg.responses(_records(s, d))), "bucket gaps:i",
         """SELECT CASE WHEN gap_s < 0.05 THEN '<50ms' WHEN gap_s < 0.2 THEN '50-200ms' WHEN gap_s < 1 THEN '200ms-1s'
         ELSE '>=1s' END AS bucket, count(*) AS gaps FROM gp WHERE gap_s IS NOT NULL GROUP BY 1""", _GAPS)
_HITS = """h AS (SELECT gsid, 'LOG-DOUBLE_SETTLE' AS signal_id, count(*) AS value FROM resp WHERE res_code = 1000 AND gsid IS NOT NULL
    GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT gsid, 'LOG-ROUND_REPLAY', count(DISTINCT res_code) FROM resp
    WHERE gsid IS NOT NULL AND res_code != 0 GROUP BY 1 HAVING bool_or(res_code = 1000) AND bool_or(res_code != 1000)),
  who AS (SELECT gsid, arg_min(doc ->> '$.parent', (ts, doc ->> '$.parent', doc ->> '$.uid')) AS parent,
    arg_min(doc ->> '$.uid', (ts, doc ->> '$.parent', doc ->> '$.uid')) AS uid FROM rec WHERE container = 'play-go' GROUP BY 1)"""
register("LG_6_signals", lambda s, d: lg.log_signals(_kept(s, d)), "signal_id family grain parent uid metric value:f",
         f"""SELECT signal_id, 'INTEGRITY' AS family, CASE WHEN uid IS NULL THEN 'game_cell' ELSE 'player_cell' END AS grain,
         parent, uid, CASE signal_id WHEN 'LOG-DOUBLE_SETTLE' THEN 'spin_responses_per_round' ELSE 'round_replay_codes' END AS metric,
         value FROM h LEFT JOIN who USING (gsid) UNION ALL SELECT 'LOG-PATH_BYPASS', 'ENVIRONMENT', 'game_cell', NULL, NULL,
         'unexpected_' || kind, count(*) FROM ({_BYP}) GROUP BY kind, detail""", f"{_LOGS}, {_HITS}")
register("LG_7_time_window",
         lambda s, d: lg.in_window(fx.logs_from_events(s, d), lg.log_window(
             "2024-01-20T00:01:30", "2024-01-10T00:01:00")), "event_id:i",
         "SELECT event_id FROM raw WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'", _LOGS)
register("LG_8_attribution",
         lambda s, d: (lambda r: lg.attribution(r, lg.double_settlements(lg.responses(r))))(_kept(s, d)).select(
             "gsid", "who.parent", "who.uid"), "gsid parent uid",
         "SELECT gsid, parent, uid FROM who JOIN (SELECT DISTINCT gsid FROM h WHERE signal_id = 'LOG-DOUBLE_SETTLE') USING (gsid)",
         f"{_LOGS}, {_HITS}")
register("JN_11_log_attribution", lambda s, d: lg.log_signals(_kept(s, d)).where("uid IS NOT NULL"),
         "signal_id parent uid", "SELECT signal_id, parent, uid FROM h JOIN who USING (gsid)", f"{_LOGS}, {_HITS}")
register("LG_9_code_histogram", lambda s, d: lg.code_histogram(lg.responses(_records(s, d))), "res_code:i n:i",
         "SELECT res_code, count(*) AS n FROM resp WHERE res_code IS NOT NULL GROUP BY 1", _LOGS)


def _monitor(s, d):
    store = cg.GateStore(s, _place(s, "logstate"))
    return store.ingest("2024-01-30T00:00", fu.fuse(lg.log_signals(_kept(s, d))))


register("LG_9_monitor_alerts", _monitor, "case_id action escalation severity")


def _pulled(s, d):
    ev = events(s, d).selectExpr(
        "concat('P_', uid) AS case_id", "concat(game_seq_id, '@', date_format(game_time, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")) AS key",
        "game_seq_id AS gsid", "date_format(game_time, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS utc")
    return lg.evidence_pull(ev, _records(s, d), "2024-02-10 00:00:00", pad_s=3600).withColumn(
        "containers", F.array_join(F.transform(F.map_entries("by_container"), lambda e: F.concat(
            e["key"], F.lit("="), e["value"].cast("string"))), ";"))


_PULL = f"""{EV}, {_LOGS}, wanted AS (SELECT 'P_' || uid AS case_id, game_seq_id AS g, game_time FROM r),
  pl AS (SELECT case_id, g, game_time, container, count(rec.ts) AS n, count(*) FILTER (container = 'spin-server' AND
    contains(payload, 'Response')) AS rr FROM wanted LEFT JOIN rec ON rec.gsid = g AND game_time >= TIMESTAMP '2024-01-11'
    AND rec.ts BETWEEN game_time - INTERVAL 1 HOUR AND game_time + INTERVAL 1 HOUR GROUP BY 1, 2, 3, 4)"""
_PULL_SQL = """SELECT case_id, g AS gsid, CASE WHEN game_time < TIMESTAMP '2024-01-11' THEN 'older than log retention' END
    AS skipped_reason, sum(n) AS entries, sum(rr) AS spin_server_responses,
    coalesce(string_agg(container || '=' || n, ';' ORDER BY container), '') AS containers FROM pl GROUP BY case_id, g, game_time"""
for _name in ("JN_10_evidence_log_join", "AGG_18_evidence_index", "LG_10_evidence_pull"):
    register(_name, _pulled, "case_id gsid skipped_reason entries:i spin_server_responses:i containers", _PULL_SQL, _PULL)

# --- redaction over page text -----------------------------------------------------------
_JWT = "'eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.c2lnbmF0dXJl'"


def _texts(s, d):
    return fx.table(s, d, "documents").selectExpr(
        "doc_id", f"CASE WHEN doc_id % 3 = 0 THEN concat(text, ' token ', {_JWT}, ' end') "
        "WHEN doc_id % 3 = 1 THEN concat('Authorization: key', doc_id, ' ', text) "
        "ELSE concat(text, ' eyJ', doc_id, ' tail') END AS text")


# The SQL form weaves digests between the pieces around each match, one pattern after the other.
_RX = [(k, rx) for k, rx in rd.PATTERNS]


def _redacted_sql(source: str) -> str:
    steps, last = [], source
    for i, (kind, rx) in enumerate(_RX):
        hit = f"regexp_extract_all(text, '{rx}')"
        tag = f"'REDACTED:{kind}:sha256=' || substr(sha256('s' || m), 1, 12)"
        pieces = f"regexp_split_to_array(text, '{rx}')"
        counts = "".join(f", n_{k}" for k, _ in _RX[:i])
        steps.append(
            f"rd{i} AS (SELECT doc_id, array_to_string(list_transform(list_zip(pieces, tags), lambda z: z[1] || coalesce(z[2], '')), '') "
            f"AS text{counts}, n_{kind} FROM (SELECT doc_id{counts}, {pieces} AS pieces, "
            f"list_transform({hit}, lambda m: {tag}) AS tags, len({hit}) AS n_{kind} FROM {last}))")
        last = f"rd{i}"
    return ", ".join(steps)


register("LG_11_redact_text", lambda s, d: rd.redact_text(_texts(s, d), "text", "s"),
         "doc_id:i text n_jwt:i n_bearer:i n_b64_blob:i", "SELECT * FROM rd2",
         f"""tx AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' token ' || {_JWT} || ' end'
         WHEN doc_id % 3 = 1 THEN 'Authorization: key' || doc_id || ' ' || text ELSE text || ' eyJ' || doc_id || ' tail' END AS text
         FROM documents), {_redacted_sql("tx")}""")
register("LG_11_redact_json", lambda s, d: rd.redact_json(
    fx.table(s, d, "documents").select("doc_id", F.to_json(F.struct(
        F.col("source").alias("token"), F.struct(F.lit("eyJabc").alias("blob"), F.col("doc_id").alias("n")).alias("body")))
        .alias("payload")), "payload", "s"), "doc_id:i payload redactions:i",
    """SELECT doc_id, '{"token":"REDACTED:token_field:sha256=' || substr(sha256('s' || source), 1, 12)
    || '","body":{"blob":"REDACTED:b64_blob:sha256=' || substr(sha256('seyJabc'), 1, 12) || '","n":' || doc_id || '}}' AS payload,
    2 AS redactions FROM documents""")
register("LG_12_fail_closed_gate",
         lambda s, d: rd.assert_clean(rd.redact_text(_texts(s, d), "text", "s"), ["text"]).select("doc_id"),
         "doc_id:i", "SELECT doc_id FROM documents")


# --- gate over repeated and streamed scans --------------------------------------------------


def _scan_gate(s, d):
    """All scans through the store; a scan given twice is taken once."""
    store = cg.GateStore(s, _place(s, "scangate"))
    c = materialise(fx.candidates_from_events(s, d), "candidates")
    out = None
    for scan in SCANS + SCANS[::3]:
        alerts = store.ingest(scan, c.where(F.col("scan") == scan))
        out = alerts if out is None else out.unionByName(alerts)
    return out


register("CS_8_scan_gate", _scan_gate, "case_id action scan severity", "SELECT * FROM ca WHERE action IS NOT NULL", _CD)


def _streamed(s, d):
    source, state = _place(s, "stream"), _place(s, "state")
    events(s, d).write.parquet(source)
    store = cg.GateStore(s, state)
    run = jobs.start_integrity(s, source, fx.catalog(s), store, f"{state}/checkpoint", available_now=True)
    run.awaitTermination()
    return s.read.json(f"{state}/alerts")


register("CS_9_stream_gate", _streamed, "parent uid action escalation severity",
         f"""SELECT parent, uid, 'opened' AS action, 'human_review' AS escalation,
         CASE WHEN bool_or(mx) THEN 'Critical' ELSE 'High' END AS severity FROM (
         SELECT *, coalesce(max_multiple > cap_cert, FALSE) AS mx FROM {q.certified('pc')})
         WHERE balance_violations > 0 OR dup_seq_rounds > 0 OR mx GROUP BY 1, 2""", f"{EV}, {q.catalog()}, {_PC_CTE}")


def _streamed_batches(s, d):
    """Four files, one a batch, rounds dealt by serial, so twins fall in different batches."""
    source, state = _place(s, "stream"), _place(s, "state")
    rounds = materialise(events(s, d), "rounds")
    for i in range(4):
        rounds.where(F.pmod("serial", F.lit(4)) == i).coalesce(1).write.mode("append").parquet(source)
    store = cg.GateStore(s, state)
    run = jobs.start_integrity(
        s, source, fx.catalog(s), store, f"{state}/checkpoint", files_per_batch=1, available_now=True)
    run.awaitTermination()
    return s.read.json(f"{state}/alerts").groupBy("parent", "uid").agg(F.max(
        F.when(F.col("severity") == "Critical", 4).when(F.col("severity") == "High", 3).otherwise(0)).alias("severity"))


register("CS_9_stream_gate_batches", _streamed_batches, "parent uid severity:i",
         f"""SELECT parent, uid, CASE WHEN bool_or(mx) THEN 4 ELSE 3 END AS severity FROM (
         SELECT *, coalesce(max_multiple > cap_cert, FALSE) AS mx FROM {q.certified('pc')})
         WHERE balance_violations > 0 OR dup_seq_rounds > 0 OR mx GROUP BY 1, 2""", f"{EV}, {q.catalog()}, {_PC_CTE}")


_DAYS = 40 * 86400


def _keyed_batches(s, d):
    """As CS_9_stream_gate_batches, with the twins of earlier batches held as keyed state."""
    source, state = _place(s, "stream"), _place(s, "state")
    rounds = materialise(events(s, d), "rounds")
    for i in range(3):
        rounds.where(F.pmod("serial", F.lit(3)) == i).coalesce(1).write.mode("append").parquet(source)
    store = cg.GateStore(s, state)
    jobs.start_integrity(s, source, fx.catalog(s), store, f"{state}/checkpoint", files_per_batch=1, available_now=True,
                         retention_s=_DAYS).awaitTermination()
    return s.read.json(f"{state}/alerts").groupBy("parent", "uid").agg(F.max(
        F.when(F.col("severity") == "Critical", 4).when(F.col("severity") == "High", 3).otherwise(0)).alias("severity"))


register("CS_9_keyed_stream_gate", _keyed_batches, "parent uid severity:i",
         f"""SELECT parent, uid, CASE WHEN bool_or(mx) THEN 4 ELSE 3 END AS severity FROM (
         SELECT *, coalesce(max_multiple > cap_cert, FALSE) AS mx FROM {q.certified('pc')})
         WHERE balance_violations > 0 OR dup_seq_rounds > 0 OR mx GROUP BY 1, 2""", f"{EV}, {q.catalog()}, {_PC_CTE}")


def _monitored(s, d):
    """Log files of three days' ranges, one a batch: rounds that are attributed, with what was found of them in the end."""
    source, state = _place(s, "logs"), _place(s, "state")
    logs = materialise(fx.logs_from_events(s, d).select("ts", "container", "pod", "severity", "payload"), "logs")
    for low, high in (("2000-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2100-01-01")):
        part = logs.where(f"ts >= timestamp_ntz'{low} 00:00:00' AND ts < timestamp_ntz'{high} 00:00:00'")
        part.coalesce(1).write.mode("append").json(source)
    store = cg.GateStore(s, state)
    jobs.start_log_monitor(s, source, store, f"{state}/checkpoint", "salt", files_per_batch=1, available_now=True,
                           retention_s=_DAYS).awaitTermination()
    found = s.read.parquet(f"{state}/signals").where("family = 'INTEGRITY' AND uid IS NOT NULL")
    return found.groupBy("signal_id", "parent", "uid", "metric").agg(F.max("value").alias("value"))


register("LG_9_keyed_stream_signals", _monitored, "signal_id parent uid metric value:f",
         """SELECT signal_id, parent, uid, CASE signal_id WHEN 'LOG-DOUBLE_SETTLE' THEN 'spin_responses_per_round'
         ELSE 'round_replay_codes' END AS metric, max(value) AS value FROM h JOIN who USING (gsid) WHERE uid IS NOT NULL
         GROUP BY 1, 2, 3, 4""", f"{_LOGS}, {_HITS}")
