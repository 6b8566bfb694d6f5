"""Batch tables behind the review screens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.functions.columns import join_keys, ratio
from tallyscope.operators.fusion import severity_rank
from tallyscope.operators.lookups import with_certified
from tallyscope.settings import CELL, Thresholds

# Business risk types of signals and families, in priority order.
SIGNAL_TYPE = {
    "L1-DUP_ROUND": "Settlement Anomaly", "L1-MAX_X_BREACH": "Settlement Anomaly",
    "L1-BALANCE_IDENTITY": "Balance Reconciliation", "L1-CONCURRENT": "Bot/Automation",
    "L2-OFF_TARGET_RTP": "Game RTP Shift", "L2-DEPLOY_SHIFT": "Game RTP Shift", "L4-LOG_PATTERN": "API Anomaly",
}
FAMILY_TYPE = {
    "OUTCOME_MAGNITUDE": "Abnormal RTP", "MAGNITUDE_WATCH": "Abnormal RTP", "PRESCIENCE": "Advantage Play",
    "ROUTING": "Feature Buy Abuse", "OUTCOME_FREQUENCY": "Suspicious Betting Pattern", "TIMING": "Bot/Automation",
    "ENVIRONMENT": "Game RTP Shift",
}
TYPE_PRIORITY = (
    "Settlement Anomaly", "Balance Reconciliation", "API Anomaly", "Advantage Play", "Feature Buy Abuse",
    "Bot/Automation", "Suspicious Betting Pattern", "Abnormal RTP", "Game RTP Shift",
)
BREACH_RULES = ("L1-MAX_X_BREACH", "L1-BALANCE_IDENTITY", "L1-DUP_ROUND")
# Most actionable status first.
STATUS_PRIORITY = (
    "confirmed", "queued", "skeptic_review", "investigating", "new", "downgraded", "rejected", "monitoring", "closed",
)
DECISION_STATUS = {
    "dismiss_benign": "rejected", "keep_monitoring": "monitoring", "enhanced_monitoring": "monitoring",
    "needs_more_evidence": "investigating", "escalate_to_board": "confirmed", "confirmed_for_action": "confirmed",
}
VERDICT_STATUS = {"CONFIRMED": "confirmed", "DOWNGRADED": "downgraded", "REJECTED": "rejected"}
# Severity -> (label, hours to act; None means end of the day).
SLA = {"Critical": ("1h", 1), "High": ("same-day", None), "Medium": ("48h", 48), "Low": ("weekly", 168)}
# Outbound columns, and source columns whose values must not leave.
OUTBOUND_COLUMNS = ("case_id", "action", "escalation", "severity", "families", "scan", "l4_route")
PRIVATE_COLUMNS = (
    "uid", "parent", "operator", "game_id", "currency", "risk_type", "amount", "bet", "win", "balance",
    "turnover", "evidence_keys", "signals", "descriptions", "email",
)


def lookup(c: Column, table: dict, default=None) -> Column:
    """CASE over a small fixed table."""
    out = F.lit(default)
    for k, v in table.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def position(c: Column, order: tuple[str, ...]) -> Column:
    return lookup(c, {v: i for i, v in enumerate(order)}, len(order))


def signal_types(cased_signals: DataFrame) -> DataFrame:
    by_rule = lookup(F.col("signal_id"), SIGNAL_TYPE)
    return cased_signals.withColumn(
        "risk_type", F.coalesce(by_rule, lookup(F.col("family"), FAMILY_TYPE, "Abnormal RTP")))


def risk_types(cased_signals: DataFrame) -> DataFrame:
    """Dominant business type per case with the signal that carries it."""
    typed = signal_types(cased_signals)
    rank = position(F.col("risk_type"), TYPE_PRIORITY)
    top = F.struct("risk_type", "signal_id", "value", "threshold", "effect")
    order = F.struct(rank, F.col("signal_id"), F.col("description"))
    return typed.groupBy("case_id").agg(F.min_by(top, order).alias("_t")).select(
        "case_id", "_t.risk_type", F.col("_t.signal_id").alias("top_signal"), F.col("_t.value").alias("top_value"),
        F.col("_t.threshold").alias("top_threshold"), F.col("_t.effect").alias("top_effect"))


def detected_at() -> Column:
    """When the risk showed: latest evidence, else last activity, else window end."""
    return F.coalesce(
        F.nullif("latest_evidence_utc", F.lit("")), F.nullif("last_active_utc", F.lit("")), F.col("window_end"))


def event_status(events: DataFrame, case_files: DataFrame) -> DataFrame:
    """Status from escalation and the verdict text of a case file, if any."""
    verdict = F.upper(F.regexp_extract("text", r"(?i)Verdict:\s*\**\s*(CONFIRMED|DOWNGRADED|REJECTED)", 1))
    files = case_files.select("case_id", verdict.alias("_verdict"))
    status = (
        F.when(F.col("escalation") != "human_review", "monitoring")
        .when(F.col("_verdict").isNull(), "queued")
        .otherwise(lookup(F.col("_verdict"), VERDICT_STATUS, "skeptic_review"))
    )
    return events.join(files, "case_id", "left").withColumn("status", status).drop("_verdict")


def breach_events(cased_signals: DataFrame, days: Column) -> DataFrame:
    """One row per player case and day with its leading integrity breach."""
    hit = cased_signals.where(F.col("signal_id").isin(*BREACH_RULES) & (F.col("grain") != "game_cell"))
    first = F.struct(position(F.col("signal_id"), BREACH_RULES), -F.col("value"), F.col("description"))
    return hit.withColumn("day", days).groupBy("case_id", "day", "parent", "uid").agg(F.min_by(F.struct(
        "game_id", "play_type", "sm_tag", F.col("signal_id").alias("breach"), "value", "threshold"), first).alias("_b")
    ).select("case_id", "day", F.col("parent").alias("operator"), "uid", "_b.*")


def _named(column: str) -> Column:
    """A part of a group id; a missing build tag or cell field names a group as well."""
    return F.coalesce(F.col(column).cast("string"), F.lit("none"))


def _group_id(*parts) -> Column:
    return F.regexp_replace(F.concat(*parts), "[^A-Za-z0-9_.@-]", "-")


def cell_rollup(breaches: DataFrame) -> DataFrame:
    """At least two accounts sharing one breach on a cell: one platform case."""
    keys = ["day", "operator", "game_id", "play_type", "sm_tag", "breach"]
    g = breaches.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("accounts"), F.max("value").alias("peak"), F.max("threshold").alias("cap"))
    gid = _group_id(
        F.lit("G_"), _named("operator"), F.lit("_"), _named("game_id"), F.lit("_pt"), _named("play_type"), F.lit("_"),
        _named("sm_tag"), F.lit("_"), "breach", F.lit("@"), F.col("day").cast("string"))
    return g.where("accounts >= 2").withColumn("group_id", gid)


def build_rollup(breaches: DataFrame) -> DataFrame:
    """The same breach on one build over at least two cells: one build-wide case."""
    cells = breaches.groupBy("day", "sm_tag", "breach", "operator", "game_id", "play_type").agg(
        F.count(F.lit(1)).alias("_n"), F.max("value").alias("_peak"), F.max("threshold").alias("_cap"))
    operators = cells.groupBy("day", "sm_tag", "breach", "operator").agg(
        F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_cells"), F.max("_peak").alias("_peak"), F.max("_cap").alias("_cap"))
    g = operators.groupBy("day", "sm_tag", "breach").agg(
        F.sum("_cells").alias("cells"), F.count(F.lit(1)).alias("operators"), F.sum("_n").alias("accounts"),
        F.max("_peak").alias("peak"), F.max("_cap").alias("cap"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("operator", "_n")))).alias("accounts_per_operator"))
    gid = _group_id(F.lit("B_"), _named("sm_tag"), F.lit("_"), "breach", F.lit("@"), F.col("day").cast("string"))
    return g.where("cells >= 2").withColumn("group_id", gid)


def group_members(breaches: DataFrame) -> DataFrame:
    """Each breach case with the group it is shown under: build first, then cell."""
    build = build_rollup(breaches).select("day", "sm_tag", "breach", F.col("group_id").alias("_b"))
    cell = cell_rollup(breaches).select(
        "day", "operator", "game_id", "play_type", "sm_tag", "breach", F.col("group_id").alias("_c"))
    return (
        join_keys(
            join_keys(breaches, build, ["day", "sm_tag", "breach"]), cell,
            ["day", "operator", "game_id", "play_type", "sm_tag", "breach"])
        .withColumn("group_id", F.coalesce("_b", "_c")).drop("_b", "_c")
    )


def group_status(members: DataFrame) -> DataFrame:
    """Most actionable status and worst severity of each group."""
    return members.where("group_id IS NOT NULL").groupBy("group_id").agg(
        F.count(F.lit(1)).alias("members"), F.max("detected_at").alias("detected_at"),
        F.min_by("status", position(F.col("status"), STATUS_PRIORITY)).alias("status"),
        F.min_by("severity", severity_rank()).alias("severity"))


def member_rounds(
    members: DataFrame, evidence: DataFrame, per_account: int | None = None, cap: int | None = None
) -> DataFrame:
    """Round evidence of a group's accounts, in order; a screen may ask for some per account and in all."""
    a = Window.partitionBy("group_id", "case_id").orderBy("key")
    g = Window.partitionBy("group_id").orderBy("uid", "key")
    j = members.where("group_id IS NOT NULL").select("group_id", "case_id", "uid").join(evidence, "case_id", "left")
    if per_account is not None:
        j = j.withColumn("_a", F.row_number().over(a)).where(F.col("_a") <= per_account)
    j = j.withColumn("pos", F.row_number().over(g))
    if cap is not None:
        j = j.where(F.col("pos") <= cap)
    return (
        j.select("group_id", "pos", "uid", F.coalesce("key", F.lit("no round key on file")).alias("key"))
    )


def filter_events(
    events: DataFrame, *, date_from=None, date_to=None, severity=None, risk_type=None, status=None, operator=None,
    q=None, actionable=False,
) -> DataFrame:
    """Optional filters of the event list; text search ignores case."""
    day = F.substring("detected_at", 1, 10)
    out = events
    if date_from:
        out = out.where(day >= date_from)
    if date_to:
        out = out.where(day <= date_to)
    if actionable:
        out = out.where("status != 'monitoring'")
    for name, v in (("severity", severity), ("risk_type", risk_type), ("status", status), ("operator", operator)):
        if v:
            out = out.where(F.col(name) == v)
    if q:
        text = F.lower(F.concat_ws(" ", "id", "title", "uid", "operator", "game_id"))
        out = out.where(F.contains(text, F.lit(q.lower())))
    return out


def collapse_days(events: DataFrame) -> DataFrame:
    """One row per case over all its days: latest row, first and last day, count."""
    base = F.regexp_replace("case_id", r"@\d{4}-\d{2}-\d{2}$", "")
    cols = [c for c in events.columns if c != "case_id"]
    return events.withColumn("case", base).groupBy("case").agg(
        F.max_by(F.struct(*cols), F.struct("detected_at", "id")).alias("_e"), F.count(F.lit(1)).alias("occurrences"),
        F.substring(F.min("detected_at"), 1, 10).alias("first_seen"),
        F.substring(F.max("detected_at"), 1, 10).alias("last_seen"),
    ).select(F.col("case").alias("case_id"), "_e.*", "occurrences", "first_seen", "last_seen")


def list_events(events: DataFrame, limit: int | None = None, **filters) -> DataFrame:
    """The event screen: filtered, collapsed, worst and most recent first; ``limit`` pages it."""
    rows = collapse_days(filter_events(events, **filters))
    rows = rows.orderBy(severity_rank(), F.desc("last_seen"), "case_id")
    return rows if limit is None else rows.limit(limit)


def daily_summary(events: DataFrame, alerts: DataFrame) -> DataFrame:
    """Totals per day: events by severity and status, alerts by action."""
    sev = lambda s: F.count_if(F.col("severity") == s).alias(s.lower())
    st = lambda s: F.count_if(F.col("status") == s).alias(f"status_{s}")
    e = events.groupBy(F.substring("detected_at", 1, 10).alias("date")).agg(
        F.count(F.lit(1)).alias("events"), *[sev(s) for s in ("Critical", "High", "Medium", "Low")],
        st("confirmed"), st("downgraded"))
    act = lambda a: F.count_if(F.col("action") == a).alias(a)
    a = alerts.groupBy(F.col("scan").alias("date")).agg(
        F.count(F.lit(1)).alias("alerts"), act("opened"), act("escalated"), act("reopened"))
    return e.join(a, "date", "full").na.fill(0)


def daily_series(events: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """Dense daily counts, zero-filled."""
    days = events.sparkSession.range(1).select(F.explode(F.expr(
        f"sequence(date'{date_from}', date'{date_to}')")).alias("_d")).select(F.col("_d").cast("string").alias("date"))
    n = events.groupBy(F.substring("detected_at", 1, 10).alias("date")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("severity").isin("Critical", "High")).alias("critical_high"))
    return days.join(n, "date", "left").na.fill(0)


def breakdown(events: DataFrame) -> DataFrame:
    """Counts by type, severity, status and operator in one pass."""
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("v"))
                      for k in ("risk_type", "severity", "status", "operator")])
    return events.select(F.explode(pairs).alias("s")).groupBy(
        F.col("s.k").alias("dimension"), F.col("s.v").alias("label")).agg(F.count(F.lit(1)).alias("n"))


def confirm_rate(events: DataFrame) -> DataFrame:
    done = F.count_if(F.col("status").isin("confirmed", "rejected", "downgraded", "closed"))
    return events.agg(F.coalesce(F.round(ratio(
        F.count_if(F.col("status") == "confirmed"), F.nullif(done, F.lit(0))), 3), F.lit(0.0)).alias("confirm_rate"))


def top_operators(events: DataFrame, k: int = 10) -> DataFrame:
    return events.groupBy("operator").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "operator").limit(k)


def alert_queue(alerts: DataFrame, events: DataFrame) -> DataFrame:
    """Alerts with their event, reopened first, then by severity."""
    e = events.select(F.col("id").alias("event_id"), F.col("risk_type").alias("event_risk_type"))
    j = alerts.withColumn("_id", F.concat("case_id", F.lit("@"), "scan")).join(
        e, F.col("_id") == F.col("event_id"), "left").drop("_id")
    return j.orderBy(position(F.col("action"), ("reopened", "escalated", "opened")), severity_rank(), "case_id")


def overlay_dispositions(events: DataFrame, decisions: DataFrame) -> DataFrame:
    """Latest human decision per event on top of the engine status; history kept."""
    latest = decisions.groupBy("event_id").agg(
        F.max_by(F.struct("decision", "reviewer", "notes", "at"), F.struct("at", "decision")).alias("disposition"),
        F.count(F.lit(1)).alias("decisions"))
    return events.join(latest, F.col("id") == F.col("event_id"), "left").drop("event_id").withColumn(
        "status", F.coalesce(lookup(F.col("disposition.decision"), DECISION_STATUS), F.col("status")))


def suspect_flags(values: Column, ref: Column) -> Column:
    """Per point: above the reference, or above 0 for a zero reference; none without one."""
    return F.transform(values, lambda v: F.coalesce(v > ref, F.lit(False)))


def drilldown_series(daily: DataFrame, cells: DataFrame, catalog: DataFrame) -> DataFrame:
    """Ordered daily series per player-cell with peer and certified references."""
    d = daily.select(
        "parent", "uid", *CELL, "event_date",
        F.round(100 * F.col("total_win") / F.greatest(F.col("turnover"), F.lit(1e-9)), 2).alias("rtp_pct"),
        F.round(100 * F.col("n_trigger") / F.greatest(F.col("rounds"), F.lit(1)), 3).alias("trigger_rate_pct"),
        F.round(100 * F.col("n_win") / F.greatest(F.col("rounds"), F.lit(1)), 2).alias("hit_rate_pct"),
        F.round(F.col("sum_bet_trigger") / F.greatest(F.col("n_trigger"), F.lit(1)), 2).alias("avg_bet_trigger"),
        F.round((F.col("sum_bet") - F.col("sum_bet_trigger")) / F.greatest(
            F.col("rounds") - F.col("n_trigger"), F.lit(1)), 2).alias("avg_bet_nontrigger"),
        F.round("max_multiple", 1).alias("max_multiple"), F.col("dup_seq_rounds").alias("dup_rounds"), "balance_violations")
    points = F.array_sort(F.collect_list(F.struct(
        "event_date", "rtp_pct", "trigger_rate_pct", "hit_rate_pct", "avg_bet_trigger", "avg_bet_nontrigger",
        "max_multiple", "dup_rounds", "balance_violations")))
    s = d.groupBy("parent", "uid", *CELL).agg(points.alias("points"))
    peer = cells.select(*CELL, (100 * F.col("rtp_emp")).alias("_rtp"), F.round(100 * F.col("p_trigger"), 3).alias(
        "ref_trigger_rate_pct"), F.round(100 * F.col("p_hit"), 2).alias("ref_hit_rate_pct"))
    j = with_certified(join_keys(s, peer, CELL), catalog)
    ref = F.when(F.col("rtp_cert").isNotNull(), F.round(100 * F.col("rtp_cert"), 2)).otherwise(F.col("_rtp"))
    return j.withColumns({
        "ref_rtp_pct": ref,
        "ref_source": F.when(F.col("rtp_cert").isNotNull(), "certified").otherwise("peer_empirical"),
        "ref_max_multiple": F.col("cap_cert"),
        "suspect_rtp": suspect_flags(F.transform("points", lambda p: p["rtp_pct"]), ref),
        "suspect_multiple": suspect_flags(F.transform("points", lambda p: p["max_multiple"]), F.col("cap_cert")),
        "suspect_dup": suspect_flags(F.transform("points", lambda p: p["dup_rounds"]), F.lit(0)),
    }).drop("_rtp", "rtp_cert", "rtp_source", "cap_cert", "cap_source")


def with_sla(alerts: DataFrame, scan_time: str = "scan_time") -> DataFrame:
    """Label and due time of each alert by severity."""
    at = F.col(scan_time)
    due = F.lit(None).cast("timestamp_ntz")
    for sev, (_, hours) in SLA.items():
        when = (at + F.expr(f"interval {hours} hours")) if hours is not None else (
            F.to_date(at).cast("timestamp_ntz") + F.expr("interval 23 hours 59 minutes"))
        due = F.when(F.col("severity") == sev, when).otherwise(due)
    label = F.coalesce(lookup(F.col("severity"), {k: v[0] for k, v in SLA.items()}), F.col("severity"))
    return alerts.withColumn("sla_label", label).withColumn("sla_due_utc", due)


def outbound_alerts(
    alerts: DataFrame, *, source: str, base_url: str | None = None, opaque_salt: str | None = None,
    include_note: bool = False,
) -> DataFrame:
    """Allow-listed outbound columns; a row that would leak a private value is dropped."""
    a = alerts.where(F.coalesce("case_id", F.lit("")) != "")
    shown = [c for c in OUTBOUND_COLUMNS if c in a.columns and c != "case_id"]
    if include_note and "note" in a.columns:
        shown.append("note")
    shown += [c for c in ("sla_label", "sla_due_utc") if c in a.columns]
    scanned = F.lower(F.concat_ws(" ", *[
        F.array_join(c, " ") if a.schema[c].dataType.typeName() == "array" else F.col(c).cast("string") for c in shown]))
    leaks = []
    for c in PRIVATE_COLUMNS:
        if c in a.columns:
            v = F.lower(F.trim(F.col(c).cast("string")))
            leaks.append(F.coalesce((F.length(v) >= 3) & F.contains(scanned, v), F.lit(False)))
    clean = a.where(~reduce(lambda x, y: x | y, leaks)) if leaks else a
    out_id = F.col("case_id") if opaque_salt is None else F.concat(
        F.lit("c_"), F.substring(F.sha2(F.concat(F.lit(f"{opaque_salt}|"), "case_id"), 256), 1, 12))
    link = F.lit(None).cast("string") if base_url is None else F.concat(
        F.lit(f"{base_url}/case/"), F.url_encode(out_id))
    return clean.select(out_id.alias("case_id"), *shown, F.lit(source).alias("source"), link.alias("link"))


def burst_rollup(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("scan", "severity").agg(F.count(F.lit(1)).alias("alerts"))
