"""Round, log, catalog and candidate views over the provided tables.

Every view is plain integer and CASE arithmetic over ``events``, ``lineitem``
and ``supplier``, so each job can run on data of any size and be compared with
plain SQL over the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_EVENT_TIME = (
    "timestampadd(SECOND, minute(ts), "
    "cast(date_trunc('HOUR', ts) AS timestamp_ntz))"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounds_from_events(spark: SparkSession, sf_dir: str, players: int | None = 12) -> DataFrame:
    """Rounds for timing, ingest and integrity jobs.

    ``players`` folds users onto that many accounts; ``None`` keeps every user.
    """
    user = f"user_id % {players}" if players else "user_id"
    ev = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", "user_id",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    base = ev.selectExpr(
        "*", f"{_EVENT_TIME} AS game_time", "cast(1 + k % 4 AS double) AS bet",
        "CASE event_type WHEN 'purchase' THEN value / 10 WHEN 'click' THEN 1.0D ELSE 0.0D END AS win",
    )
    return base.selectExpr(
        "game_time",
        "to_date(game_time + INTERVAL 8 HOURS) AS report_date",
        "event_id AS serial",
        f"CASE WHEN k % 25 = 7 THEN concat_ws('-', concat('d', {user}), k, day(ts)) "
        "ELSE concat('e', event_id) END AS game_seq_id",
        "concat('op', user_id % 4) AS parent",
        f"concat('u', {user}) AS uid",
        "CASE WHEN k < 60 THEN 'g1' ELSE 'g2' END AS game_id",
        "CASE WHEN k % 10 = 9 THEN 2 ELSE 0 END AS play_type",
        "CASE WHEN user_id % 2 = 1 THEN 'USD' ELSE 'CNY' END AS currency",
        "CASE WHEN k = 98 THEN 'feature_beta' ELSE 'feature_base' END AS sm_v",
        "CASE WHEN game_time < timestamp_ntz'2024-01-16 00:00:00' THEN 'b1' ELSE 'b2' END AS sm_tag",
        "bet", "bet AS valid_bet", "win",
        "1000.0D AS before_balance",
        "1000.0D - bet + win + (CASE WHEN event_id % 101 = 100 THEN 1 ELSE 0 END) AS after_balance",
        "event_type = 'signup' AS triggered",
        "game_time + INTERVAL 1 SECOND AS last_modify_time",
    )


def source_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rounds in their unrenamed source form, with demo traffic."""
    r = rounds_from_events(spark, sf_dir)
    return r.selectExpr(
        "game_time", "report_date AS ReportDate", "serial", "game_seq_id",
        "CASE WHEN serial % 97 = 5 THEN 'acdemo' ELSE parent END AS parent",
        "uid", "game_id", "play_type", "currency", "sm_v", "sm_tag",
        "cast(bet AS decimal(18,4)) AS bet", "cast(valid_bet AS decimal(18,4)) AS validBet",
        "cast(win AS decimal(18,4)) AS win",
        "cast(before_balance AS decimal(18,4)) AS before_balance",
        "cast(after_balance AS decimal(18,4)) AS after_balance",
        "CASE WHEN triggered THEN 'True' ELSE 'False' END AS hasFreegame",
        "last_modify_time",
        "CASE WHEN serial % 89 = 3 THEN 'True' ELSE 'False' END AS test_demo_play",
    )


def rounds_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds for money statistics; it has no unique serial."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus",
        F.col("l_shipdate").cast("timestamp_ntz").alias("l_shipdate"),
    )
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    base = li.join(su, li.l_suppkey == su.s_suppkey).selectExpr(
        "*",
        "timestampadd(SECOND, cast(l_partkey % 86400 AS int), l_shipdate) AS game_time",
        "CASE WHEN l_discount >= 0.07 THEN l_quantity * l_discount * 30 ELSE 0.0D END AS win",
    )
    return base.selectExpr(
        "game_time",
        "to_date(game_time + INTERVAL 8 HOURS) AS report_date",
        "l_orderkey * 10 + l_linenumber AS serial",
        "concat(l_orderkey, '-', l_linenumber) AS game_seq_id",
        "concat('op', s_nationkey) AS parent",
        "concat('s', l_suppkey) AS uid",
        "concat('g', l_partkey % 2) AS game_id",
        "CASE WHEN l_linenumber % 4 = 0 THEN 2 ELSE 0 END AS play_type",
        "CASE WHEN l_returnflag = 'N' THEN 'USD' ELSE 'CNY' END AS currency",
        "'feature_base' AS sm_v",
        "l_linestatus AS sm_tag",
        "l_quantity AS bet", "l_quantity AS valid_bet", "win",
        "10000.0D AS before_balance",
        "10000.0D - l_quantity + win + (CASE WHEN l_partkey % 997 = 0 THEN 1 ELSE 0 END) AS after_balance",
        "l_tax >= 0.07 AS triggered",
        "game_time + INTERVAL 1 SECOND AS last_modify_time",
    )


# Fixed values: (game_id, play_type, rtp, cap) of the games in the views.
CATALOG_VALUES = (
    ("g0", 0, 0.85, 2.9), ("g0", None, 0.82, None), ("g1", 0, 0.46, 20.0),
    ("g1", 2, 0.30, None), ("g2", None, 0.44, 15.0),
)


def catalog(spark: SparkSession) -> DataFrame:
    return local_rows(
        spark, CATALOG_VALUES, "game_id string, play_type int, rtp double, max_multiplier double"
    )


def local_rows(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """A small literal table whose size the optimizer knows."""
    fields = StructType.fromDDL(ddl).fields

    def lit(v, f) -> str:
        text = "NULL" if v is None else ("'" + str(v) + "'" if isinstance(v, str) else repr(v))
        return f"CAST({text} AS {f.dataType.simpleString()})"

    values = ", ".join("(" + ", ".join(lit(v, f) for v, f in zip(r, fields)) + ")" for r in rows)
    names = ", ".join(f.name for f in fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


# Log entries with JSON payloads over (event_id, event_type, user_id, ts, k).
LOG_SHAPE = """SELECT *,
  CASE WHEN k % 5 = 2 THEN concat('d', user_id % 12, '-', day(ts)) ELSE concat('e', event_id) END AS gsid,
  CASE event_type WHEN 'error' THEN 802 WHEN 'signup' THEN 0 ELSE 1000 END AS code,
  CASE WHEN k < 60 THEN 'g1' ELSE 'g2' END AS game_id, CASE WHEN user_id % 2 = 1 THEN 'USD' ELSE 'CNY' END AS currency
  FROM log_events"""
LOG_COLUMNS = """event_id, ts, CASE WHEN event_id % 3 = 2 THEN 'play-go' ELSE 'spin-server' END AS container,
  concat('pod-', event_id % 3) AS pod, 'INFO' AS severity,
  CASE WHEN event_id % 211 = 7 THEN 'not a json line'
  WHEN event_id % 3 = 2 THEN concat('play {"parent":"op', user_id % 4, '","uid":"u', user_id % 12,
    '","params":{"gameSeqId":"', gsid, '","gameId":"', game_id, '"}}')
  WHEN event_id % 131 = 11 THEN concat('Info request - {"path":"/internal/', k % 3,
    '","method":"POST","params":{"gameId":"', game_id, '","currency":"', currency, '"}}')
  WHEN event_id % 137 = 13 THEN concat('Info Spin-Server Response info - {"resCode":901,"params":{"agent":"ag', k % 4,
    '"},"data":{"message":"Agent not found"}}')
  WHEN code = 802 THEN concat('Info Spin-Server Response info - {"params":{"gameSeqId":"', gsid, '","gameId":"', game_id,
    '","currency":"', currency, '","sm_tag":"b1","token":"tok', user_id % 12,
    '"},"data":{"messageCode":802,"message":"balance not enough"}}')
  ELSE concat('Info Spin-Server Response info - {"resCode":', code, ',"response":{"gameSeqId":"', gsid,
    '"},"params":{"gameId":"', game_id, '","currency":"', currency, '","sm_tag":"b1","token":"tok', user_id % 12, '"}}')
  END AS payload"""


def logs_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log entries over the events; sub-second times are kept."""
    table(spark, sf_dir, "events").select(
        "event_id", "event_type", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    ).createOrReplaceTempView("log_events")
    return spark.sql(f"SELECT {LOG_COLUMNS} FROM ({LOG_SHAPE}) b")


# Signal rows over line items: expressions valid in Spark and in other SQL engines.
SIGNAL_SHAPE = """
  SELECT *, CASE WHEN k = 0 AND l_quantity > 40 THEN 'L1-MAX_X_BREACH' WHEN k = 1 AND l_quantity > 40 THEN 'L1-BALANCE_IDENTITY'
    WHEN k = 2 AND l_quantity > 40 THEN 'L1-DUP_ROUND' WHEN k <= 5 THEN 'L1-EXCESS_TURNOVER'
    WHEN k = 6 THEN 'L1-SAME_SECOND' WHEN k = 7 THEN 'L1-TRIGGER_RATE' WHEN k = 8 THEN 'L2-OFF_TARGET_RTP'
    WHEN k = 9 THEN 'L1-BETA_IN_PROD' WHEN k = 10 THEN 'L1-MAGNITUDE_WATCH' ELSE 'L3-ML_DISCOVERY' END AS signal_id
  FROM (SELECT *, l_partkey % 12 AS k, cast(cast(l_shipdate AS date) AS varchar(10)) AS day FROM lineitem) a"""
SIGNAL_COLUMNS = """
  signal_id,
  CASE WHEN signal_id IN ('L1-MAX_X_BREACH', 'L1-BALANCE_IDENTITY', 'L1-DUP_ROUND') THEN 'INTEGRITY'
    WHEN signal_id IN ('L1-EXCESS_TURNOVER', 'L2-OFF_TARGET_RTP') THEN 'OUTCOME_MAGNITUDE'
    WHEN signal_id = 'L1-SAME_SECOND' THEN 'TIMING' WHEN signal_id = 'L1-TRIGGER_RATE' THEN 'OUTCOME_FREQUENCY'
    WHEN signal_id = 'L1-BETA_IN_PROD' THEN 'ENVIRONMENT' WHEN signal_id = 'L1-MAGNITUDE_WATCH' THEN 'MAGNITUDE_WATCH'
    ELSE 'ML_DISCOVERY' END AS family,
  CASE WHEN k = 8 THEN 2 WHEN k = 11 THEN 3 ELSE 1 END AS layer,
  CASE WHEN k IN (8, 9) THEN 'game_cell' ELSE 'player_cell' END AS grain,
  CASE WHEN k NOT IN (8, 9) THEN concat('op', l_orderkey % 25) END AS parent,
  CASE WHEN k NOT IN (8, 9) THEN concat('p', l_orderkey) END AS uid,
  concat('g', l_suppkey % 40) AS game_id, l_linenumber % 3 AS play_type,
  CASE WHEN l_returnflag = 'N' THEN 'USD' ELSE 'CNY' END AS currency, l_linestatus AS sm_tag,
  'metric' AS metric, l_quantity / 5 AS value, 0.0 AS threshold,
  CASE WHEN k <= 2 AND l_quantity > 40 THEN 'ABSOLUTE' ELSE 'OTHER' END AS threshold_method,
  CASE WHEN k IN (0, 3, 4, 5, 8) THEN 'certified' WHEN k IN (1, 2) THEN 'identity' ELSE 'empirical_loo' END AS baseline_source,
  CASE WHEN signal_id IN ('L1-EXCESS_TURNOVER', 'L1-TRIGGER_RATE') THEN 0.001 END AS p_value,
  l_discount * 100 AS effect,
  CASE WHEN signal_id = 'L1-TRIGGER_RATE' THEN 'lift' WHEN signal_id IN ('L1-EXCESS_TURNOVER', 'L2-OFF_TARGET_RTP')
    THEN 'rtp_points' ELSE '' END AS effect_unit,
  100 AS n, CASE WHEN l_tax >= 0.06 THEN 'held' ELSE 'failed' END AS persistence,
  concat('d', l_orderkey, '-', l_linenumber, '-', l_partkey) AS description,
  concat(l_orderkey, '-', l_linenumber, '@', day, 'T00:00:00Z') AS key,
  CASE WHEN k = 8 THEN day END AS event_date"""


def signals_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A signal table that exercises every fusion route, sized by the line items."""
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem")
    rows = spark.sql(f"SELECT {SIGNAL_COLUMNS} FROM ({SIGNAL_SHAPE}) b")
    return rows.withColumn("evidence", F.array("key")).withColumn(
        "context", F.when(F.col("event_date").isNotNull(), F.create_map(F.lit("event_date"), F.col("event_date"))))


# Ten scans of three days each over the events, one candidate per troubled account.
CANDIDATE_COLUMNS = """
  concat('P_op', user_id % 4, '_ALL_u', user_id) AS case_id, seq,
  CASE WHEN n_err >= 3 THEN 'human_review' WHEN n_err = 2 THEN 'enhanced' ELSE 'monitor' END AS escalation,
  CASE WHEN n_buy >= 3 THEN 'Critical' WHEN n_buy = 2 THEN 'High' WHEN n_buy = 1 THEN 'Medium' ELSE 'Low' END AS severity,
  n_buy, n_sig, concat('op', user_id % 4) AS parent, concat('u', user_id) AS uid"""
CANDIDATE_SHAPE = """
  SELECT user_id, cast(floor((day(ts) - 1) / 3) AS int) + 1 AS seq,
    sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS n_err,
    sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS n_buy,
    sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS n_sig
  FROM events GROUP BY user_id, cast(floor((day(ts) - 1) / 3) AS int) + 1"""


def candidates_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").createOrReplaceTempView("events")
    rows = spark.sql(f"SELECT {CANDIDATE_COLUMNS} FROM ({CANDIDATE_SHAPE}) b WHERE n_err >= 1")
    families = F.array_compact(F.array(
        F.lit("INTEGRITY"), F.when(F.col("n_buy") > 0, "OUTCOME_MAGNITUDE"), F.when(F.col("n_sig") > 1, "TIMING")))
    return rows.withColumn("families", families).withColumn("scan", F.format_string("s%02d", "seq"))
