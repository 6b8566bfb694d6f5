"""Explicit schemas of the tables that jobs exchange."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
    "decimal(18,4)": T.DecimalType(18, 4), "array<string>": T.ArrayType(T.StringType()),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def _struct(ddl: str) -> T.StructType:
    """Schema from ``name type, ...`` without needing a running session."""
    fields = [f.strip().split(" ") for f in ddl.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


ROUND = _struct(
    "game_time timestamp_ntz, report_date date, serial bigint, game_seq_id string, "
    "parent string, uid string, game_id string, play_type int, currency string, "
    "sm_v string, sm_tag string, bet double, valid_bet double, win double, "
    "before_balance double, after_balance double, triggered boolean, "
    "last_modify_time timestamp_ntz"
)

SOURCE_ROUND = _struct(
    "game_time timestamp_ntz, ReportDate date, serial bigint, game_seq_id string, "
    "parent string, uid string, game_id string, play_type int, currency string, "
    "sm_v string, sm_tag string, bet decimal(18,4), validBet decimal(18,4), "
    "win decimal(18,4), before_balance decimal(18,4), after_balance decimal(18,4), "
    "hasFreegame string, last_modify_time timestamp_ntz, test_demo_play string"
)

EVIDENCE = _struct("gsid string, ts timestamp_ntz, key string, retention_ok boolean")

SIGNAL = _struct(
    "signal_id string, family string, layer int, grain string, parent string, "
    "uid string, game_id string, play_type int, currency string, sm_tag string, "
    "metric string, value double, threshold double, threshold_method string, "
    "baseline_source string, p_value double, effect double, effect_unit string, "
    "n bigint, persistence string, description string, "
    "evidence array<string>, context map<string,string>"
)

CASE_STATE = _struct(
    "case_id string, status string, first_seen string, opened_scan string, "
    "last_seen string, last_alert_scan string, seen_scans int, absent_scans int, "
    "max_tier int, max_sev int, families_ever array<string>, l4_status string, "
    "l4_queued_scan string, disposition string, uid string, parent string, "
    "game_id string, currency string, risk_type string"
)

# What a scan decided: the new state of its cases and what became of them.
CASE_DECIDED = T.StructType([*CASE_STATE.fields, *_struct(
    "forgotten boolean, closed_now boolean, seen boolean, action string, note string, "
    "l4_route boolean, scan string, escalation string, severity string, families array<string>"
).fields])
CASE_ARCHIVED = T.StructType([*CASE_STATE.fields, T.StructField("archived_seq", T.LongType())])

LOG_ENTRY = _struct(
    "ts timestamp_ntz, container string, pod string, severity string, payload string"
)
