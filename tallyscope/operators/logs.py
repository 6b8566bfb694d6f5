"""Log-stream detectors: double settlement, replayed rounds, unexpected requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.functions.columns import utc_text
from tallyscope.functions.ranks import order_stats
from tallyscope.functions.signals import context, signals
from tallyscope.settings import Thresholds

# Message codes, the settlement label and the normal request shape.
SETTLED = 1000
REQUEST_LINE = 0
RESPONSE_LABEL = "Spin-Server Response info"
SPIN_PATH = "^/v2/[A-Za-z0-9_]+/spin$"
SPIN_CONTAINER = "spin-server"
ATTRIBUTION_CONTAINER = "play-go"


def _text(path: str) -> Column:
    return F.nullif(F.expr(f"try_variant_get(_doc, '$.{path}', 'string')"), F.lit(""))


def parse_entries(entries: DataFrame, salt: str = "") -> DataFrame:
    """Flat records from raw entries; rows without a JSON object are dropped.

    The session token is replaced by a salted digest and never kept.
    """
    blob = F.regexp_extract("payload", r"(?s)\{.*\}", 0)
    # a generated column is computed once, where a plain one would be put into each field again
    doc = entries.select("*", F.explode(F.array(F.try_parse_json(F.nullif(blob, F.lit(""))))).alias("_doc")).where(F.col("_doc").isNotNull())
    token = _text("params.token")
    return doc.select(
        "ts", "container", "pod", "payload",
        F.coalesce(_text("response.gameSeqId"), _text("params.gameSeqId")).alias("gsid"),
        F.coalesce(F.expr("try_variant_get(_doc, '$.resCode', 'int')"),
                   F.expr("try_variant_get(_doc, '$.data.messageCode', 'int')")).alias("res_code"),
        _text("path").alias("path"), _text("method").alias("method"), _text("params.agent").alias("agent"),
        F.coalesce(_text("params.gameId"), _text("params.gameID")).alias("game_id"),
        _text("params.sm_tag").alias("sm_tag"), _text("params.currency").alias("currency"),
        F.when(token.isNotNull(), F.substring(F.sha2(F.concat(F.lit(salt), token), 256), 1, 12)).alias("player_key"),
        F.coalesce(_text("data.message"), F.lit("")).alias("message"),
    )


def responses(records: DataFrame) -> DataFrame:
    """Settlement responses only; other messages repeat the round id."""
    return records.where((F.col("container") == SPIN_CONTAINER) & F.contains("payload", F.lit(RESPONSE_LABEL)))


def off_path(records: DataFrame) -> DataFrame:
    return records.where((F.col("container") == SPIN_CONTAINER) & F.contains("payload", F.lit('"path":'))
                         & ~F.contains("payload", F.lit("/spin")))


def _first(name: str) -> Column:
    return F.min_by(F.struct("ts", "game_id", "currency", "sm_tag"), F.struct("ts", "pod", "payload")).alias(name)


def double_settlements(recs: DataFrame) -> DataFrame:
    """More than one settled response for one round id."""
    return (
        recs.where(F.col("gsid").isNotNull() & (F.col("res_code") == SETTLED))
        .groupBy("gsid").agg(F.count(F.lit(1)).alias("n_responses"), _first("first"))
        .where("n_responses > 1")
    )


def round_replays(recs: DataFrame) -> DataFrame:
    """A round id that failed and also settled; a lone failure is ordinary."""
    g = (
        recs.where(F.col("gsid").isNotNull() & F.col("res_code").isNotNull() & (F.col("res_code") != REQUEST_LINE))
        .groupBy("gsid").agg(F.array_sort(F.collect_set("res_code")).alias("codes"),
                             F.count(F.lit(1)).alias("n_rows"), _first("first"))
    )
    return g.where(F.array_contains("codes", SETTLED) & (F.size("codes") > 1)).withColumn(
        "failed_codes", F.array_remove("codes", SETTLED))


def bypass_kind() -> Column:
    return (
        F.when(F.col("path").isNotNull() & ~F.col("path").rlike(SPIN_PATH), F.struct(
            F.lit("path").alias("kind"), F.col("path").alias("detail")))
        .when(F.col("method").isNotNull() & (F.col("method") != "POST"), F.struct(
            F.lit("method").alias("kind"), F.col("method").alias("detail")))
        .when(F.col("agent").isNotNull() & F.contains(F.lower("message"), F.lit("agent not found")), F.struct(
            F.lit("unknown_agent").alias("kind"), F.col("agent").alias("detail")))
    )


def path_bypasses(records: DataFrame) -> DataFrame:
    """Off-path requests plus unknown agents seen on the response stream."""
    hit = lambda df: df.withColumn("_b", bypass_kind()).where("_b IS NOT NULL")
    rows = hit(off_path(records)).unionByName(hit(responses(records)).where("_b.kind = 'unknown_agent'"))
    return rows.select("ts", "pod", "payload", "game_id", "currency", "sm_tag", "_b.kind", "_b.detail")


def cadence_gaps(recs: DataFrame) -> DataFrame:
    """Sub-second gap to the player's previous settled response.

    Windowed per (player, hour) with hour edges stitched, so a hot player is split.
    """
    base = recs.where(F.col("player_key").isNotNull() & (F.col("res_code") == SETTLED)).select(
        "player_key", "ts", F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("_hour"))
    w = Window.partitionBy("player_key", "_hour").orderBy("ts")
    ends = base.groupBy("player_key", "_hour").agg(F.max("ts").alias("_end"))
    before = ends.select("player_key", "_hour", F.lag("_end").over(
        Window.partitionBy("player_key").orderBy("_hour")).alias("_before"))
    j = base.withColumn("_in", F.lag("ts").over(w)).join(before, ["player_key", "_hour"], "left")
    gap = F.timestamp_diff("MICROSECOND", F.coalesce("_in", "_before"), F.col("ts")) / 1e6
    return j.select("player_key", "ts", gap.alias("gap_s"))


def cadence_census(recs: DataFrame) -> DataFrame:
    """Per player: rounds, shortest and upper-middle gap. Observation only."""
    gaps = cadence_gaps(recs)
    basic = gaps.groupBy("player_key").agg(
        F.count(F.lit(1)).alias("rounds"), F.min("gap_s").alias("min_gap_s")).where("rounds > 1")
    mid = order_stats(gaps, ["player_key"], "gap_s", {"median_gap_s": F.floor(F.col("n") / 2)}).drop("n")
    return basic.join(mid, "player_key")


def gap_buckets(recs: DataFrame) -> DataFrame:
    g = F.col("gap_s")
    label = F.when(g < 0.05, "<50ms").when(g < 0.2, "50-200ms").when(g < 1.0, "200ms-1s").otherwise(">=1s")
    return cadence_gaps(recs).where("gap_s IS NOT NULL").groupBy(label.alias("bucket")).agg(
        F.count(F.lit(1)).alias("gaps"))


def fastest_players(census: DataFrame, k: int = 5) -> DataFrame:
    return census.orderBy("min_gap_s", "player_key").limit(k)


def attribution(records: DataFrame, hits: DataFrame) -> DataFrame:
    """Round id -> (parent, uid, game) from the second log stream, for hits only."""
    named = records.where(F.col("container") == ATTRIBUTION_CONTAINER).select(
        "gsid", "ts", "game_id",
        F.regexp_extract("payload", r'"parent"\s*:\s*"([^"]+)"', 1).alias("parent"),
        F.regexp_extract("payload", r'"uid"\s*:\s*"([^"]+)"', 1).alias("uid"),
    ).where("parent != '' AND uid != ''")
    return (
        named.join(hits.select("gsid").distinct(), "gsid", "left_semi")
        .groupBy("gsid").agg(F.min_by(F.struct("parent", "uid", "game_id"),
                                      F.struct("ts", "parent", "uid")).alias("who"))
    )


def log_signals(records: DataFrame) -> DataFrame:
    """Signals of one window of parsed records.

    Several detectors read the records: pass a stored table.
    """
    recs = responses(records)
    dbl, rep = double_settlements(recs), round_replays(recs)
    who = attribution(records, dbl.select("gsid").unionByName(rep.select("gsid")))

    def named(hits: DataFrame) -> DataFrame:
        j = hits.join(who, "gsid", "left")
        return j.select(
            *hits.columns, F.col("who.parent").alias("parent"), F.col("who.uid").alias("uid"),
            F.coalesce("who.game_id", "first.game_id").alias("game_id"), F.col("first.currency").alias("currency"),
            F.col("first.sm_tag").alias("sm_tag"),
            F.array(F.concat("gsid", F.lit("@"), utc_text(F.col("first.ts")))).alias("keys"))

    grain = F.when(F.col("uid").isNotNull(), "player_cell").otherwise("game_cell")
    common = dict(family="INTEGRITY", layer=1, grain=grain, threshold=1.0, threshold_method="ABSOLUTE",
                  baseline_source="identity", persistence="not_computable", evidence=F.col("keys"))
    a = signals(
        named(dbl), signal_id="LOG-DOUBLE_SETTLE", metric="spin_responses_per_round", value=F.col("n_responses"),
        n=F.col("n_responses"), context=context(game_seq_id=F.col("gsid"), requires_log_adjudication="false"),
        description=F.concat(F.lit("round "), "gsid", F.format_string(" answered by %d responses", "n_responses")),
        **common)
    b = signals(
        named(rep), signal_id="LOG-ROUND_REPLAY", metric="round_replay_codes", value=F.size("codes"), n=F.col("n_rows"),
        context=context(game_seq_id=F.col("gsid"), res_codes=F.array_join(F.col("codes").cast("array<string>"), ",")),
        description=F.concat(F.lit("round "), "gsid", F.lit(" failed and later settled")), **common)
    by = path_bypasses(records).groupBy("kind", "detail").agg(F.count(F.lit(1)).alias("n_rows"), _first("first"))
    by = by.select("*", "first.game_id", "first.currency", "first.sm_tag")
    p = signals(
        by, signal_id="LOG-PATH_BYPASS", family="ENVIRONMENT", layer=1, grain="game_cell",
        metric=F.concat(F.lit("unexpected_"), "kind"), value=F.col("n_rows"), threshold=0.0,
        threshold_method="ABSOLUTE", baseline_source="identity", n=F.col("n_rows"), persistence="not_computable",
        context=context(kind=F.col("kind"), detail=F.col("detail"),
                        event_date=F.date_format("first.ts", "yyyy-MM-dd")),
        description=F.concat(F.col("n_rows").cast("string"), F.lit(" request(s) with unexpected "), "kind",
                             F.lit(" "), "detail"))
    return a.unionByName(b).unionByName(p)


def log_window(now: str, watermark: str | None, t: Thresholds = Thresholds(), since: str | None = None):
    """(start, end) of the next batch window, or None while it is not open."""
    from datetime import datetime, timedelta

    end = datetime.fromisoformat(now) - timedelta(seconds=t.log_lag_guard_s)
    if since is not None:
        start = datetime.fromisoformat(since)
    elif watermark is not None:
        start = datetime.fromisoformat(watermark) - timedelta(seconds=t.log_overlap_s)
    else:
        start = end - timedelta(minutes=t.log_window_minutes)
    return None if start >= end else (start, end)


def in_window(entries: DataFrame, window) -> DataFrame:
    start, end = window
    return entries.where((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") <= F.lit(end).cast("timestamp_ntz")))


def code_histogram(recs: DataFrame) -> DataFrame:
    return recs.where("res_code IS NOT NULL").groupBy("res_code").agg(F.count(F.lit(1)).alias("n"))


def evidence_pull(
    evidence: DataFrame, records: DataFrame, now: str, *, pad_s: int = 60, per_case: int | None = None,
    retention_days: int = 30,
) -> DataFrame:
    """Log index per evidence round: entries, containers and response count.

    All evidence of a case is pulled; ``per_case`` keeps its first keys only.

    Joined on the round id with a time range; rounds past retention are reported
    as skipped, never silently empty.
    """
    if per_case is not None:
        w = Window.partitionBy("case_id").orderBy("key")
        evidence = evidence.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= per_case)
    wanted = (
        evidence.select("case_id", "gsid", F.try_to_timestamp("utc", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
                .cast("timestamp_ntz").alias("round_time"))
    )
    floor = F.expr(f"timestamp_ntz'{now}' - interval {int(retention_days)} days")
    wanted = wanted.withColumn("skipped_reason", F.when(
        F.col("round_time").isNull(), "evidence key has no timestamp").when(
        F.col("round_time") < floor, "older than log retention"))
    answers = (F.col("container") == SPIN_CONTAINER) & F.contains("payload", F.lit("Response"))
    # parsed documents are dropped on the way here, so the size Spark expects is far too small to broadcast by
    logs = records.where("gsid IS NOT NULL").select(F.col("gsid").alias("_g"), "ts", "container", answers.alias("_a")).hint("merge")
    near = (
        (F.col("gsid") == F.col("_g")) & F.col("skipped_reason").isNull()
        & F.col("ts").between(F.expr(f"round_time - interval {int(pad_s)} seconds"),
                              F.expr(f"round_time + interval {int(pad_s)} seconds"))
    )
    per = (
        wanted.join(logs, near, "left")
        .groupBy("case_id", "gsid", "round_time", "skipped_reason", "container").agg(
            F.count("ts").alias("_n"),
            F.count_if("_a").alias("_r"))
    )
    return per.groupBy("case_id", "gsid", "round_time", "skipped_reason").agg(
        F.sum("_n").alias("entries"), F.sum("_r").alias("spin_server_responses"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(
            F.col("container").isNotNull(), F.struct("container", "_n"))))).alias("by_container"))
