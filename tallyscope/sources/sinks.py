"""Outputs: candidates, findings, queues, alerts and proposals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.operators.fusion import by_case, fuse, ranked
from tallyscope.settings import Thresholds
from tallyscope.sources.durable import shuffles_removed

# Column order of the findings table.
FINDING_COLUMNS = (
    "case_id", "grain", "parent", "uid", "game_id", "play_type", "currency", "sm_tag", "escalation", "severity",
    "independent_families", "families", "signal_id", "family", "metric", "value", "threshold", "threshold_method",
    "baseline_source", "p_value", "effect", "effect_unit", "n", "persistence", "cohort_id", "description",
    "evidence_keys", "window_start", "window_end",
)


#: Signals of the cases that are fused in one pass, and passes at most: each reads all signals once more.
PASS_SIGNALS = 2_000_000
MOST_PASSES = 8
TASK_SIGNALS = 50_000
_NESTED = (
    "signal_id", "family", "layer", "metric", "value", "threshold", "threshold_method", "baseline_source",
    "p_value", "effect", "effect_unit", "n", "persistence", "description", "evidence",
)


def _documents(cases: DataFrame, window_start: str, window_end: str) -> DataFrame:
    return cases.withColumns({
        "window_start": F.lit(window_start), "window_end": F.lit(window_end),
        "evidence_keys": F.array_distinct(F.flatten(F.transform("signals", lambda s: F.coalesce(
            s["evidence"], F.array().cast("array<string>"))))),
    })


def candidate_documents(
    cases: DataFrame, cased_signals: DataFrame, window_start: str, window_end: str
) -> DataFrame:
    """One document per case with all its signals nested."""
    nested = cased_signals.groupBy("case_key").agg(
        F.array_sort(F.collect_list(F.struct(*_NESTED))).alias("signals"))
    return _documents(cases.join(nested, "case_key", "left"), window_start, window_end)


def emit_fused(signals: DataFrame, path: str, window_start: str, window_end: str, t: Thresholds = Thresholds()) -> int:
    """Fuse signals and write the documents of all cases; returns the passes made.

    Signals are shuffled once and cases made with them where they then are, in
    passes over parts of the cases; what a pass shuffled is removed at its end.
    """
    count = signals.count()
    parts = max(1, min(MOST_PASSES, count // PASS_SIGNALS))
    tasks = count // parts // TASK_SIGNALS + 1
    with shuffles_removed(signals.sparkSession):
        for part in range(parts):
            cases = fuse(by_case(signals, tasks, part, parts), t, nest=F.struct(*_NESTED), by="_slot")
            _write_documents(_documents(cases, window_start, window_end), path, "append" if part else "overwrite")
    return parts


def emit_candidates(documents: DataFrame, path: str) -> None:
    _write_documents(documents, path, "overwrite")


def _write_documents(documents: DataFrame, path: str, mode: str) -> None:
    documents.write.mode(mode).option("compression", "gzip").json(path)


def _general(c: str, digits: int):
    """Shortest form with the given significant digits, as text."""
    x = F.col(c)
    scale = digits - 1 - F.floor(F.log10(F.abs(F.when(x == 0, 1.0).otherwise(x))))
    p = F.pow(F.lit(10.0), scale)
    return F.when(x.isNull(), "").otherwise(F.regexp_replace((F.round(x * p) / p).cast("string"), r"\.0$", ""))


def findings(cases: DataFrame, cased_signals: DataFrame, window_start: str, window_end: str) -> DataFrame:
    """Flat rows, one per case and signal, with formatted numbers."""
    c = cases.select("case_key", "case_id", "grain", "parent", "uid", "escalation", "severity", "independent_families",
                     F.array_join("families", "|").alias("families"), "cohort_id")
    s = cased_signals.drop("case_id", "grain", "parent", "uid")
    j = c.join(s, "case_key").withColumns({
        "value": _general("value", 6), "threshold": _general("threshold", 6),
        "p_value": F.coalesce(F.format_string("%.3e", F.col("p_value").cast("double")), F.lit("")), "effect": _general("effect", 4),
        "evidence_keys": F.coalesce(F.array_join("evidence", "|"), F.lit("")),
        "window_start": F.lit(window_start), "window_end": F.lit(window_end),
    })
    blank = lambda x: F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x)
    return j.select(*[blank(x) for x in FINDING_COLUMNS])


def emit_findings(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def case_queue(cases: DataFrame, cased_signals: DataFrame, keys_per_case: int | None = None) -> DataFrame:
    """Queue table in investigation order with the evidence keys, all unless a number is given."""
    keys = cased_signals.select("case_key", F.explode("evidence").alias("k")).distinct()
    if keys_per_case is not None:
        w = Window.partitionBy("case_key").orderBy("k")
        keys = keys.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= keys_per_case)
    top = keys.groupBy("case_key").agg(
        F.array_join(F.array_sort(F.collect_list("k")), "<br>").alias("evidence"))
    return ranked(cases.join(top, "case_key", "left")).select(
        "case_id", "grain", "escalation", "severity", "independent_families",
        F.array_join("families", ", ").alias("families"), F.array_join("signal_ids", "; ").alias("signals"),
        F.array_join("persistences", "; ").alias("persistence"), "cohort_id",
        F.coalesce("evidence", F.lit("-")).alias("evidence"))


def queue_markdown(queue: DataFrame, window_start: str, window_end: str, top: int = 500) -> str:
    """Readable head of the queue; the whole queue stays a table."""
    counts = {r["escalation"]: r["n"] for r in queue.groupBy("escalation").agg(F.count("*").alias("n")).collect()}
    lines = [
        "# Case queue", "", f"- window (UTC event time): {window_start} .. {window_end}",
        f"- candidates: {sum(counts.values())} ({counts.get('human_review', 0)} for human review, "
        f"{counts.get('enhanced', 0)} enhanced monitoring, {counts.get('monitor', 0)} monitor)", "",
        "> A rule match is a reason to investigate, never a finding.", "",
    ]
    for grain, title in (("player", "Player cases"), ("game_cell", "Game-level cases")):
        rows = queue.where(F.col("grain") == grain).limit(top).collect()
        if rows:
            lines += [f"## {title}", "", "| case | escalation | severity | families | signals | persistence | cohort | evidence |",
                      "|---|---|---|---|---|---|---|---|"]
            lines += [f"| `{r['case_id']}` | {r['escalation']} | {r['severity']} | {r['independent_families']} "
                      f"({r['families']}) | {r['signals']} | {r['persistence']} | {r['cohort_id'] or '-'} | {r['evidence']} |"
                      for r in rows] + [""]
    return "\n".join(lines)


def write_alerts(alerts: DataFrame, path: str) -> None:
    """Append-only alert log."""
    alerts.write.mode("append").json(path)


def write_proposals(proposed: DataFrame, members: DataFrame, path: str) -> None:
    """Cohort proposals and, as rows, their complete membership."""
    proposed.write.mode("overwrite").json(f"{path}/proposals")
    members.join(proposed.select("cohort_id"), "cohort_id", "left_semi").write.mode("overwrite").json(f"{path}/members")
