"""Fuse signals into ranked cases by independent family.

Every case attribute is a mergeable aggregate, so a case with a very large
number of signals is reduced map-side; the signals themselves stay rows that
carry the case id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tallyscope.functions.columns import contributing, game_case_id, player_case_id, ratio
from tallyscope.functions.normal import expected_max_z
from tallyscope.settings import NON_CONTRIBUTING_FAMILIES, Thresholds

_ENTITY = ["_grain", "_parent", "_uid", "_game", "_play", "_ccy", "_tag"]
_ORDER = ["layer", "signal_id", "game_id", "play_type", "currency", "sm_tag", "description"]


def _entities(signals: DataFrame) -> DataFrame:
    game = F.col("grain") == "game_cell"
    pick = lambda c, when: F.when(when, F.col(c))
    return signals.withColumns({
        "_grain": F.when(game, "game_cell").otherwise("player"),
        "_parent": pick("parent", ~game), "_uid": pick("uid", ~game),
        "_game": pick("game_id", game), "_play": pick("play_type", game),
        "_ccy": pick("currency", game), "_tag": pick("sm_tag", game),
    })


def by_case(signals: DataFrame, tasks: int, part: int = 0, parts: int = 1) -> DataFrame:
    """Signals of one of several parts of the cases, all those of a case in one task, with its hash ``_slot``.

    A signal is shuffled as one text, which takes less room than its columns. ``tasks``
    should leave a task so few that it sorts them in memory.
    """
    types = {f.name: f.dataType for f in signals.schema.fields}
    deep = [c for c, t in types.items() if isinstance(t, (ArrayType, MapType, StructType))]
    slot = F.xxhash64(*_ENTITY).alias("_slot")
    text = F.to_json(F.array(*[F.to_json(c) if c in deep else F.col(c).cast("string") for c in types]))
    rows = _entities(signals).select(slot, text.alias("_text"))
    if parts > 1:
        rows = rows.where(F.pmod("_slot", F.lit(parts)) == part)
    held = rows.repartition(tasks, "_slot").select("_slot", F.from_json("_text", "array<string>").alias("_v"))
    at = {c: F.col("_v")[i] for i, c in enumerate(types)}
    return held.select("_slot", *[
        (F.from_json(at[c], t) if c in deep else at[c].cast(t)).alias(c) for c, t in types.items()])


def _routes(t: Thresholds) -> dict[str, Column]:
    c = F.col
    counted = ~c("family").isin(*NON_CONTRIBUTING_FAMILIES)
    integrity = (
        (c("family") == "INTEGRITY") & c("signal_id").isin(*t.integrity_ids)
        & (c("threshold_method") == "ABSOLUTE") & c("baseline_source").isin("identity", "certified")
    )
    drift = (
        (c("signal_id") == "L2-OFF_TARGET_RTP") & F.contains("baseline_source", F.lit("certified"))
        & (F.coalesce("effect", F.lit(0.0)) >= t.drift_route_min_points)
    )
    effect = F.coalesce("effect", F.lit(0.0))
    exceptional = (
        counted & c("p_value").isNotNull() & (c("value") >= t.exceptional_min_z)
        & (((c("effect_unit") == "rtp_points") & (effect >= t.exceptional_min_points))
           | ((c("effect_unit") == "lift") & (effect >= t.exceptional_min_lift)))
        & (F.lit(not t.exceptional_need_persistence) | (c("persistence") == "held"))
        & (F.contains("baseline_source", F.lit(t.exceptional_baseline)) | (c("baseline_source") == "identity"))
    )
    off = F.lit(False)
    return {
        "integrity": integrity if t.integrity_enabled else off,
        "drift": drift if t.drift_enabled else off,
        "exceptional": exceptional if t.exceptional_enabled else off,
    }


def fuse(
    signals: DataFrame,
    t: Thresholds = Thresholds(),
    *,
    cohort_members: DataFrame | None = None,
    population: int | None = None,
    nest: Column | None = None,
    by: str | None = None,
) -> DataFrame:
    """One row per case with families, escalation, severity and notes.

    ``nest`` is a value of a signal; ``signals`` then holds those of a case, sorted.
    ``by`` is a column, equal for all signals of a case, that they were dealt by.
    """
    c = F.col
    order = F.struct(*_ORDER)
    route = {k: F.coalesce(v, F.lit(False)) for k, v in _routes(t).items()}
    key_time = F.array_max(F.transform("evidence", lambda k: F.when(
        F.contains(k, F.lit("@")), F.substring_index(k, "@", -1))))
    # Once a row, before the aggregate: what several attributes read, and nothing that none reads.
    dealt = [] if by is None else [by]
    s = _entities(signals).select(
        *dealt, *_ENTITY, "family", "signal_id", "persistence", "effect",
        F.struct(*_ORDER, c("context")["event_date"].alias("event_date")).alias("_order"),
        F.when(route["integrity"], order).alias("_integrity"), F.when(route["exceptional"], order).alias("_exceptional"),
        route["drift"].alias("_drift"), F.abs("value").alias("_abs"), F.when(c("p_value").isNotNull(), c("value")).alias("_z"),
        ((c("family") == "INTEGRITY") & c("baseline_source").isin("certified", "identity")).alias("_certified"),
        key_time.alias("_key_time"), *([] if nest is None else [nest.alias("_nest")]),
    )
    cases = s.groupBy(*dealt, *_ENTITY).agg(
        F.min("_order").alias("_first"),
        F.array_sort(F.collect_set("family")).alias("families"),
        F.array_sort(F.collect_set("signal_id")).alias("signal_ids"),
        F.array_sort(F.collect_set("persistence")).alias("persistences"),
        F.count(F.lit(1)).alias("n_signals"),
        F.max("_abs").alias("max_abs_value"),
        F.max("_z").alias("max_z"),
        F.bool_or(c("persistence") == "held").alias("persistence_held"),
        F.bool_or("_certified").alias("_integrity_certified"),
        F.bool_or(c("signal_id") == "L1-MAX_X_BREACH").alias("_cap_breach"),
        F.min("_integrity").alias("_integrity"),
        F.count_if("_drift").alias("_drift_days"),
        F.max(F.when(c("_drift"), c("effect"))).alias("_drift_peak"),
        F.min("_exceptional").alias("_exceptional"),
        F.max("_key_time").alias("latest_evidence_utc"),
        *([] if nest is None else [F.array_sort(F.collect_list("_nest")).alias("signals")]),
    ).withColumns({
        f"_{k}_{name}": value for k in ("integrity", "exceptional")
        for name, value in (("route", c(f"_{k}").isNotNull()), ("signal", c(f"_{k}.signal_id")))})
    game = c("_grain") == "game_cell"
    cases = cases.select(
        c("_grain").alias("grain"), c("_parent").alias("parent"), c("_uid").alias("uid"),
        F.when(game, c("_game")).otherwise(c("_first.game_id")).alias("game_id"),
        F.when(game, c("_play")).otherwise(c("_first.play_type")).alias("play_type"),
        F.when(game, c("_ccy")).otherwise(c("_first.currency")).alias("currency"),
        F.when(game, c("_tag")).otherwise(c("_first.sm_tag")).alias("sm_tag"),
        F.coalesce(c("_first.event_date"), F.lit("window")).alias("event_date"),
        *[f for f in cases.columns if f not in (*dealt, *_ENTITY, "_first")],
    )
    cases = cases.withColumn("case_id", F.when(game_row(), game_case_id()).otherwise(player_case_id()))
    # The id of a game case leaves out the currency; the key does not.
    cases = cases.withColumn("case_key", F.when(game_row(), F.concat_ws("|", "case_id", "currency")).otherwise(
        F.col("case_id")))
    if cohort_members is None:
        cases = cases.withColumn("cohort_id", F.lit(None).cast("string"))
    else:
        cases = cases.join(cohort_members.select("parent", "uid", "cohort_id"), ["parent", "uid"], "left")
    independent = F.size(contributing(c("families")))
    by_families = (
        F.when(independent >= t.review_families, "human_review")
        .when((independent >= t.enhanced_families - 1) & c("persistence_held"), "enhanced")
        .otherwise("monitor")
    )
    not_review = c("_by_families") != "human_review"
    drift = c("_drift_days") >= t.drift_route_min_days
    routed = not_review & (c("_integrity_route") | drift | c("_exceptional_route"))
    review = c("escalation") == "human_review"
    severity = (
        F.when(review & c("_integrity_certified"), F.when(c("_cap_breach"), "Critical").otherwise("High"))
        .when(review, F.when(c("persistence_held"), "High").otherwise("Medium"))
        .when(c("escalation") == "enhanced", "Medium").otherwise("Low")
    )
    emz = expected_max_z(population) if population else None
    notes = [
        F.when(c("cohort_id").isNotNull(), F.concat(
            F.lit("member of detected cohort "), "cohort_id",
            F.lit(" (not suppressed): report inclusive and leave-cohort-out results"))),
        F.when(not_review & c("_integrity_route"), F.concat(
            F.lit("integrity single-family route: "), "_integrity_signal")),
        F.when(not_review & ~c("_integrity_route") & drift, F.format_string(
            "drift route: persisted %d cell-days (peak +%.1f points vs certified)", "_drift_days", "_drift_peak")),
        F.when(not_review & ~c("_integrity_route") & ~drift & c("_exceptional_route"), F.concat(
            F.lit("exceptional single-family route: "), "_exceptional_signal")),
    ]
    if emz is not None:
        notes.append(F.when(c("max_z") < emz + 1, F.format_string(
            f"max z %.1f is consistent with the maximum of {population} null tests ({emz:.1f})", "max_z")))
    out = (
        cases.withColumn("independent_families", independent)
        .withColumn("_by_families", by_families)
        .withColumn("escalation", F.when(routed, "human_review").otherwise(c("_by_families")))
        .withColumn("severity", severity)
        .withColumn("expected_max_z", F.lit(emz).cast("double"))
        .withColumn("notes", F.array_compact(F.array(*notes)))
    )
    return out.drop(*[x for x in out.columns if x.startswith("_")])


def game_row() -> Column:
    return F.col("grain") == "game_cell"


def escalation_rank(c="escalation") -> Column:
    return F.when(F.col(c) == "human_review", 0).when(F.col(c) == "enhanced", 1).otherwise(2)


def severity_rank(c="severity") -> Column:
    return (F.when(F.col(c) == "Critical", 0).when(F.col(c) == "High", 1)
            .when(F.col(c) == "Medium", 2).otherwise(3))


def ranked(cases: DataFrame) -> DataFrame:
    """Investigation order: tier, severity, families, size of the largest value."""
    return cases.orderBy(
        escalation_rank(), severity_rank(), F.desc("independent_families"), F.desc("max_abs_value"), "case_id")


def signals_with_case(signals: DataFrame, cases: DataFrame) -> DataFrame:
    """Signal rows with the id of the case they belong to."""
    s = _entities(signals)
    g = cases.select(
        "case_id", "case_key", F.col("grain").alias("_grain"), F.col("parent").alias("_parent"), F.col("uid").alias("_uid"),
        F.when(game_row(), F.col("game_id")).alias("_game"), F.when(game_row(), F.col("play_type")).alias("_play"),
        F.when(game_row(), F.col("currency")).alias("_ccy"), F.when(game_row(), F.col("sm_tag")).alias("_tag"))
    nn = lambda k, v: F.coalesce(F.col(k).cast("string"), F.lit(v))
    keys = [f"{k}_" for k in _ENTITY]
    s = s.withColumns({f"{k}_": nn(k, "\u0000") for k in _ENTITY}).drop(*_ENTITY)
    g = g.withColumns({f"{k}_": nn(k, "\u0000") for k in _ENTITY}).drop(*_ENTITY)
    return s.join(g, keys).drop(*keys)


def case_evidence(cased_signals: DataFrame) -> DataFrame:
    """Distinct evidence keys of each case, as rows."""
    return (
        cased_signals.select("case_id", F.explode("evidence").alias("key")).distinct()
        .withColumn("gsid", F.substring_index("key", "@", 1))
        .withColumn("utc", F.when(F.contains("key", F.lit("@")), F.substring_index("key", "@", -1)))
    )


def with_last_active(cases: DataFrame, player_cell: DataFrame) -> DataFrame:
    """Add the last time the player of a case was active."""
    last = player_cell.groupBy("parent", "uid").agg(
        F.date_format(F.max("last_round_utc"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_active_utc"))
    return cases.join(last, ["parent", "uid"], "left")


def recent_cases(cases: DataFrame, as_of: str, days: int) -> DataFrame:
    """Keep cases whose latest evidence, else activity, is within ``days``.

    Game cases without any date stay; 0 days means no filter.
    """
    if days <= 0:
        return cases
    cutoff = F.date_format(
        F.expr(f"timestamp_ntz'{as_of}' - interval {int(days)} days"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    seen = F.coalesce(F.nullif("latest_evidence_utc", F.lit("")), "last_active_utc")
    return cases.where(F.when(seen.isNull(), F.col("uid").isNull()).otherwise(seen >= cutoff))


def summary(cases: DataFrame) -> DataFrame:
    return cases.groupBy("escalation").agg(
        F.count(F.lit(1)).alias("cases"), F.avg("independent_families").alias("mean_families"),
        ratio(F.count_if(F.col("severity").isin("Critical", "High")), F.count(F.lit(1))).alias("high_share"))
