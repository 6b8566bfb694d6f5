"""Case-state gate: turn the candidates of each scan into state transitions.

One scan is a full outer join of the stored state with the candidates; absent
cases are the rows without a candidate. The caller stores the result before
splitting it into state and alerts. A closed case that stays away is left as it
is, so a store may leave such cases out of the state it passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyscope.schema import CASE_ARCHIVED, CASE_DECIDED, CASE_STATE
from tallyscope.settings import ACKNOWLEDGING_DECISIONS, ESCALATION_TIER, SEVERITY_RANK
from tallyscope.sources.durable import materialise
from tallyscope.sources.snapshots import Snapshots, Version

_CONTEXT = ["uid", "parent", "game_id", "currency", "risk_type"]
_STATE = CASE_STATE.fieldNames()
_REVIEW = ESCALATION_TIER["human_review"]


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CASE_STATE)


def _scale(c: Column, scale: dict[str, int]) -> Column:
    out = F.lit(None)
    for label, rank in scale.items():
        out = F.when(c == label, rank).otherwise(out)
    return F.coalesce(out, F.lit(1))


def _candidates(cands: DataFrame) -> DataFrame:
    """One comparable row per case id (cases that share an id are merged)."""
    have = set(cands.columns)
    rows = cands.select(
        "case_id", "escalation", "severity", "families",
        *[(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in _CONTEXT],
    ).withColumn("tier", _scale(F.col("escalation"), ESCALATION_TIER)).withColumn(
        "sev", _scale(F.col("severity"), SEVERITY_RANK))
    return rows.withColumn("_f", F.explode_outer("families")).groupBy("case_id").agg(
        F.max("tier").alias("tier"), F.max("sev").alias("sev"),
        F.max_by("escalation", "tier").alias("escalation"), F.max_by("severity", "sev").alias("severity"),
        F.array_sort(F.collect_set("_f")).alias("families"),
        *[F.min(c).alias(f"c_{c}") for c in _CONTEXT],
    )


def gate_step(
    state: DataFrame,
    candidates: DataFrame,
    scan_id: str,
    *,
    dispositions: DataFrame | None = None,
    min_persistence: int = 1,
    close_after_absent: int = 1,
) -> DataFrame:
    """The decided rows of one scan: new state, action and note per case.

    ``dispositions`` (case_id, decision) are the human decisions known now.
    """
    min_persistence, close_after_absent = max(1, min_persistence), max(1, close_after_absent)
    c = F.col
    s = state.select("case_id", *[F.col(f).alias(f"s_{f}") for f in _STATE if f != "case_id"])
    j = s.join(_candidates(candidates), "case_id", "full")
    if dispositions is None:
        j = j.withColumn("decision", F.lit(""))
    else:
        d = dispositions.select("case_id", "decision")
        j = j.join(d, "case_id", "left").withColumn("decision", F.coalesce("decision", F.lit("")))
    empty = F.array().cast("array<string>")
    scan = F.lit(scan_id)
    j = j.withColumns({
        "seen": c("tier").isNotNull(),
        "was": F.coalesce("s_status", F.lit("pending")),
        "ever": F.coalesce("s_families_ever", empty),
        "top_tier": F.coalesce("s_max_tier", F.lit(0)),
        "top_sev": F.coalesce("s_max_sev", F.lit(0)),
        "acknowledged": c("decision").isin(*ACKNOWLEDGING_DECISIONS),
    }).withColumns({
        "new_families": F.when(c("seen"), F.array_except("families", "ever")).otherwise(empty),
        "worse_tier": c("seen") & (c("tier") > c("top_tier")),
        "worse_sev": c("seen") & (c("sev") > c("top_sev")),
        "streak": F.coalesce("s_seen_scans", F.lit(0)) + F.when(c("seen") & (c("was") == "pending"), 1).otherwise(0),
        "gone": F.coalesce("s_absent_scans", F.lit(0)) + F.when(~c("seen") & (c("was") != "closed"), 1).otherwise(0),
    }).withColumn("material", (F.size("new_families") > 0) | c("worse_tier") | c("worse_sev"))
    action = F.when(~c("seen"), F.lit(None).cast("string")).when(
        c("was") == "pending", F.when(c("streak") >= min_persistence, "opened")
    ).when(c("was") == "closed", "reopened").when(
        c("material"), F.when(c("acknowledged"), "reopened").otherwise("escalated"))
    why = F.concat_ws(
        "; ", F.when(c("worse_tier"), "escalation tier increased"), F.when(c("worse_sev"), "severity increased"),
        F.when(F.size("new_families") > 0,
               F.concat(F.lit("new signal family: "), F.array_join("new_families", ", "))))
    j = j.withColumn("action", action).withColumn("why", why)
    live = F.when(c("tier") >= _REVIEW, "open").otherwise("monitoring")
    expired = ~c("seen") & (c("was") != "closed") & (c("gone") >= close_after_absent)
    acted = c("action").isNotNull()
    route = acted & (c("tier") >= _REVIEW) & (
        (F.coalesce("s_l4_status", F.lit("")) != "investigated") | (c("action") == "reopened"))
    note = (
        F.when(c("action") == "opened", F.concat(F.lit("opened at "), "escalation", F.lit("/"), "severity"))
        .when((c("action") == "reopened") & (c("was") == "closed"), "recurred after close")
        .when(c("action") == "reopened", F.concat(F.lit("new evidence after '"), "decision", F.lit("': "), "why"))
        .when(c("action") == "escalated", c("why"))
    )
    any_context = F.coalesce(*[c(f"c_{k}") for k in _CONTEXT]).isNotNull()
    j = j.withColumns({
        "status": F.when((c("action") == "opened") | (c("seen") & (c("was") == "closed")), live)
        .when(expired & (c("was") != "pending"), "closed").otherwise(c("was")),
        "forgotten": expired & (c("was") == "pending"),
        "closed_now": expired & (c("was") != "pending"),
        "l4_route": F.coalesce(route, F.lit(False)),
        "note": note,
        "first_seen": F.coalesce("s_first_seen", scan),
        "opened_scan": F.when(c("action") == "opened", scan).otherwise(F.coalesce("s_opened_scan", F.lit(""))),
        "last_seen": F.when(c("seen"), scan).otherwise(c("s_last_seen")),
        "last_alert_scan": F.when(acted, scan).otherwise(F.coalesce("s_last_alert_scan", F.lit(""))),
        "seen_scans": F.when(~c("seen") & (c("was") == "pending"), 0).otherwise(c("streak")),
        "absent_scans": F.when(c("seen"), 0).otherwise(c("gone")),
        "max_tier": F.greatest(c("top_tier"), F.coalesce("tier", F.lit(0))),
        "max_sev": F.greatest(c("top_sev"), F.coalesce("sev", F.lit(0))),
        "families_ever": F.array_union("ever", "new_families"),
        "l4_status": F.when(route, "queued").otherwise(F.coalesce("s_l4_status", F.lit(""))),
        "l4_queued_scan": F.when(route, scan).otherwise(F.coalesce("s_l4_queued_scan", F.lit(""))),
        "disposition": F.when(c("seen") & (c("decision") != ""), c("decision"))
        .otherwise(F.coalesce("s_disposition", F.lit(""))),
        **{k: F.when(any_context, c(f"c_{k}")).otherwise(c(f"s_{k}")) for k in _CONTEXT},
        "scan": scan,
    })
    return j.select(
        *[F.col(f).cast(CASE_STATE[f].dataType) for f in _STATE], "forgotten", "closed_now", "seen", "action",
        "note", "l4_route", "scan", "escalation", "severity", "families")


def state_of(decided: DataFrame) -> DataFrame:
    return decided.where(~F.col("forgotten")).select(*_STATE)


def alerts_of(decided: DataFrame) -> DataFrame:
    """Only opened, escalated and reopened cases: what a person should see."""
    return decided.where("action IS NOT NULL").select(
        "case_id", "action", "scan", "escalation", "severity", "families", "note", "l4_route", *_CONTEXT)


def transitions_of(decided: DataFrame) -> DataFrame:
    """History rows of one scan: alerts, queue entries and closures."""
    acts = F.array_compact(F.array(
        F.when(F.col("action").isNotNull(), F.struct(F.col("action"), F.col("note"))),
        F.when(F.col("l4_route"), F.struct(
            F.lit("investigation_queued").alias("action"), F.col("action").alias("note"))),
        F.when(F.col("closed_now"), F.struct(F.lit("closed").alias("action"), F.concat(
            F.lit("absent "), F.col("absent_scans").cast("string"), F.lit(" scan(s)")).alias("note"))),
    ))
    return decided.select("case_id", "scan", F.explode(acts).alias("t")).select(
        "case_id", "scan", "t.action", "t.note")


def open_cases(state: DataFrame) -> DataFrame:
    newest = F.coalesce(F.nullif("last_alert_scan", F.lit("")), "opened_scan")
    return state.where(F.col("status").isin("open", "monitoring")).orderBy(newest.desc(), "case_id")


def investigation_queue(state: DataFrame) -> DataFrame:
    return state.where("l4_status = 'queued'").orderBy(F.desc("l4_queued_scan"), "case_id")


def mark_investigated(state: DataFrame, case_ids: DataFrame) -> DataFrame:
    """Clear queued cases that now have a case file; other cases are untouched."""
    done = case_ids.select("case_id").distinct().withColumn("_done", F.lit(True))
    cleared = F.when((F.col("l4_status") == "queued") & F.col("_done"), "investigated")
    return state.join(done, "case_id", "left").withColumn(
        "l4_status", F.coalesce(cleared, "l4_status")).select(*state.columns)


def replay_scans(
    spark: SparkSession, candidates: DataFrame, scan_ids: list[str], *, scan_col: str = "scan",
    dispositions: DataFrame | None = None, **knobs,
) -> tuple[DataFrame, DataFrame]:
    """Fold the gate over ordered scans; returns (final state, all alerts)."""
    state, decided = replay_decided(spark, candidates, scan_ids, scan_col=scan_col, dispositions=dispositions, **knobs)
    return state, None if decided is None else alerts_of(decided)


def replay_decided(
    spark: SparkSession, candidates: DataFrame, scan_ids: list[str], *, scan_col: str = "scan",
    dispositions: DataFrame | None = None, **knobs,
) -> tuple[DataFrame, DataFrame | None]:
    """Fold the gate over ordered scans; returns (final state, the decided rows of all scans).

    Every step is stored, so a lost executor costs one step, not the replay.
    A scan id given twice is taken once.
    """
    state, every, done = empty_state(spark), None, set()
    for scan_id in scan_ids:
        if scan_id in done:
            continue
        done.add(scan_id)
        decided = materialise(gate_step(
            state, candidates.where(F.col(scan_col) == scan_id), scan_id, dispositions=dispositions, **knobs),
            "gate")
        state = state_of(decided)
        every = decided if every is None else every.unionByName(decided)
    return state, every


class GateStore:
    """Case state of one detection scope: live cases as the rows of the last scan, closed ones as an archive.

    A scan reads the live cases and, of the archive, the hash buckets its own
    candidates fall in; it writes the rows it decided and a run of the cases it
    closed, so bytes written follow the scan and not the history. A case that
    returns leaves its archived row behind: live rows win over archived ones and
    later archived rows over earlier ones. Where a bucket holds ``fanout`` runs of
    one level they are merged into one of the next, so a row is rewritten as often
    as the logarithm of the history. All of it is published by one small file that
    exists whole or not at all and that also holds the scan ids taken; a crash
    before it repeats the scan, and an id taken is not taken again.
    """

    def __init__(self, spark: SparkSession, path: str, *, buckets: int = 16, fanout: int = 8, keep: int = 4, **knobs) -> None:
        self.spark, self.path, self.knobs = spark, path.rstrip("/"), knobs
        self.buckets, self.fanout, self.keep = buckets, fanout, keep
        self.tables = Snapshots(spark, f"{self.path}/cases", "bucket", T.IntegerType())

    def _bucketed(self, df: DataFrame, version: Version) -> DataFrame:
        n = version.notes.get("buckets", self.buckets)
        return df.withColumn("bucket", F.pmod(F.xxhash64("case_id"), F.lit(n)).cast("int"))

    def decided(self, version: Version | None = None) -> DataFrame:
        """The rows of the last scan: every live case and those it closed or forgot."""
        return self.tables.read("decided", CASE_DECIDED, version).select(*CASE_DECIDED.fieldNames())

    def _live(self, version: Version) -> DataFrame:
        return state_of(self.decided(version)).where("status != 'closed'")

    def _archived(self, version: Version, parts=None) -> DataFrame:
        """The latest archived row of each case, of all or the named buckets."""
        rows = self.tables.read("archive", CASE_ARCHIVED, version, parts)
        return _newest(rows).select(*_STATE)

    def state(self) -> DataFrame:
        version = self.tables.version()
        live = self._live(version)
        return live.unionByName(self._archived(version).join(live.select("case_id"), "case_id", "left_anti"))

    def _returning(self, version: Version, candidates: DataFrame) -> DataFrame:
        """Archived rows of the candidates; only their buckets are read."""
        ids = self._bucketed(candidates.select("case_id").distinct(), version)
        touched = {str(r["bucket"]) for r in ids.select("bucket").distinct().collect()}  # at most ``buckets``
        return self._archived(version, touched).join(ids.select("case_id"), "case_id", "left_semi")

    def ingest(self, scan_id: str, candidates: DataFrame, dispositions: DataFrame | None = None) -> DataFrame:
        """Run one scan; returns its alerts (empty when already taken)."""
        version = self.tables.version()
        taken = version.notes.get("scans", {})
        if scan_id in taken:
            return alerts_of(gate_step(empty_state(self.spark), candidates, scan_id)).limit(0)
        state = self._live(version)
        if version.of("archive"):
            candidates = materialise(candidates, "candidates")
            back = self._returning(version, candidates)
            state = state.unionByName(back.join(state.select("case_id"), "case_id", "left_anti"))
        seq = version.notes.get("seq", 0) + 1
        step = gate_step(state, candidates, scan_id, dispositions=dispositions, **self.knobs)
        entries = self._stored(step, "decided", version)
        new = Version(version.number, tuple(entries), version.notes)
        alerts, said = alerts_of(self.decided(new)), f"{self.path}/alerts/scan_seq={seq}"
        alerts.write.mode("overwrite").json(said)
        gone = self.decided(new).where("closed_now").select(*_STATE)
        runs = self._merged(version, [*version.of("archive"), *self._run(gone, seq, version)])
        self._publish(version, [*entries, *runs], {"seq": seq, "scans": {**taken, scan_id: seq}})
        return self.spark.read.schema(alerts.schema).json(said)

    def mark_investigated(self, case_ids: DataFrame) -> None:
        """Clear queued cases that now have a case file, live or archived."""
        version = self.tables.version()
        seq = version.notes.get("seq", 0) + 1
        ids = materialise(case_ids.select("case_id").distinct(), "investigated")
        entries = self._stored(mark_investigated(self.decided(version), ids), "decided", version)
        live = self._live(version).select("case_id")
        held = self._returning(version, ids).where("l4_status = 'queued'").join(live, "case_id", "left_anti")
        runs = self._merged(version, [*version.of("archive"), *self._run(mark_investigated(held, ids), seq, version)])
        self._publish(version, [*entries, *runs], {"seq": seq})

    # storage

    def _stored(self, df: DataFrame, table: str, version: Version) -> list[dict]:
        rows = self._bucketed(df, version)
        return self.tables.stage(rows.repartition("bucket"), table)

    def _run(self, rows: DataFrame, seq: int, version: Version) -> list[dict]:
        entries = self._stored(rows.withColumn("archived_seq", F.lit(seq).cast("bigint")), "archive", version)
        return [{**e, "level": 0} for e in entries]

    def _merged(self, version: Version, entries: list[dict]) -> list[dict]:
        """Runs of one level and bucket, once there are ``fanout`` of them, become one of the next level."""
        level = 0
        while level <= max([e["level"] for e in entries], default=-1):
            same: dict[str, list[dict]] = {}
            for e in entries:
                if e["level"] == level:
                    same.setdefault(e["part"], []).append(e)
            full = [e for runs in same.values() if len(runs) >= self.fanout for e in runs]
            if full:
                rows = _newest(self.tables.read("archive", CASE_ARCHIVED, Version(0, tuple(full))))
                merged = self._stored(rows.drop("bucket"), "archive", version)
                entries = [e for e in entries if e not in full] + [{**e, "level": level + 1} for e in merged]
            level += 1
        return entries

    def _publish(self, version: Version, entries: list[dict], notes: dict) -> None:
        notes = {"buckets": self.buckets, "scans": {}, **version.notes, **notes}
        number = self.tables.commit(version, entries, notes).number
        if number % self.keep == 0:
            self.tables.expire(self.keep)


def _newest(rows: DataFrame) -> DataFrame:
    """One row per case of archived rows: the one of the latest scan."""
    columns = rows.columns
    return rows.groupBy("case_id").agg(
        F.max_by(F.struct(*[c for c in columns if c != "case_id"]), "archived_seq").alias("_r")
    ).select("case_id", "_r.*").select(*columns)
