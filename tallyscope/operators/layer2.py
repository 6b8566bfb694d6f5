"""Game-level drift over the daily series of each peer cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.functions.columns import ratio
from tallyscope.functions.normal import normal_sf
from tallyscope.functions.ranks import bh_select
from tallyscope.functions.signals import context, signals
from tallyscope.operators.lookups import with_certified
from tallyscope.settings import CELL, Thresholds


def eligible_days(game_day: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Cell-days with enough rounds, with the totals of their cell.

    A cell has one row per day, so the per-cell window is bounded by the calendar.
    """
    w = Window.partitionBy(*CELL)
    return (
        game_day.where(F.col("rounds") >= t.drift_min_day_rounds)
        .withColumn("c_rounds", F.sum("rounds").over(w))
        .withColumn("c_trigger", F.sum("n_trigger").over(w))
        .withColumn("c_days", F.count("event_date").over(w))
    )


def off_target_days(game_day: DataFrame, catalog: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Cell-days tested against the certified return, with ``selected``."""
    d = with_certified(eligible_days(game_day, t), catalog).where("rtp_cert IS NOT NULL AND sumsq_valid_bet > 0")
    d = d.withColumn("day_rtp", ratio("total_win", F.nullif(F.col("turnover"), F.lit(0.0))))
    sd = F.stddev_samp("day_rtp").over(Window.partitionBy(*CELL))
    excess = F.col("total_win") - F.col("rtp_cert") * F.col("turnover")
    d = (
        d.withColumn("sigma_round", sd * F.sqrt(F.col("rounds").cast("double")))
        .withColumn("z", ratio(excess, F.nullif(F.col("sigma_round") * F.sqrt("sumsq_valid_bet"), F.lit(0.0))))
        .withColumn("z", F.when(F.col("c_days") >= t.drift_min_days, F.col("z")))
        .withColumn("effect", 100.0 * ratio(excess, F.nullif(F.col("turnover"), F.lit(0.0))))
    )
    out = bh_select(d, [], "z", t.drift_fdr_q)
    return out.withColumn("selected", F.col("selected") & F.coalesce(
        F.col("effect") >= t.drift_min_points, F.lit(False)))


def trigger_drift_days(game_day: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Cell-days tested against the cell's other days, with ``selected``."""
    d = eligible_days(game_day, t).where("c_rounds > rounds")
    p0, r = F.col("p0"), F.col("rounds")
    d = (
        d.withColumn("p0", F.greatest(F.least(
            (F.col("c_trigger") - F.col("n_trigger")) / (F.col("c_rounds") - r), F.lit(1 - 1e-9)), F.lit(1e-9)))
        .withColumn("_phat", F.col("n_trigger") / r)
        .withColumn("z", (F.col("_phat") - p0) / F.sqrt(p0 * (1 - p0) / r))
        .withColumn("lift", F.col("_phat") / p0)
        .drop("_phat")
    )
    out = bh_select(d, [], "z", t.drift_fdr_q)
    return out.withColumn("selected", F.col("selected") & (F.col("lift") >= t.drift_min_lift)
                          & (F.col("c_days") >= t.drift_min_days))


def build_sequence(game_day: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Builds of each game in deployment order with the previous build's return."""
    builds = (
        game_day.where(F.col("rounds") >= t.drift_min_day_rounds)
        .groupBy(*CELL).agg(
            F.min("event_date").alias("first_day"), F.sum("rounds").alias("rounds"),
            F.sum("total_win").alias("win"), F.sum("turnover").alias("turn"))
        .withColumn("rtp", ratio("win", "turn"))
    )
    w = Window.partitionBy("game_id", "play_type", "currency").orderBy("first_day", "sm_tag")
    return builds.withColumn("prev_tag", F.lag("sm_tag").over(w)).withColumn("prev_rtp", F.lag("rtp").over(w))


def deploy_shifts(game_day: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    shift = F.col("rtp") - F.col("prev_rtp")
    return (
        build_sequence(game_day, t)
        .where((F.col("prev_tag").isNotNull()) & (F.col("rounds") >= t.deploy_min_rounds))
        .withColumn("shift", shift)
        .withColumn("z", shift / (F.lit(t.deploy_day_sd) / F.sqrt(F.col("rounds") / t.deploy_day_rounds)))
        .where((F.abs("shift") >= t.drift_min_points / 100) & (F.abs("z") >= t.deploy_min_z))
    )


def layer2_signals(game_day: DataFrame, catalog: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    day = F.date_format("event_date", "yyyy-MM-dd")
    off = signals(
        off_target_days(game_day, catalog, t).where("selected"),
        signal_id="L2-OFF_TARGET_RTP", family="OUTCOME_MAGNITUDE", layer=2, grain="game_cell",
        metric="day_excess_rtp_points", value=F.col("effect"), threshold_method="ABSOLUTE+BH",
        baseline_source="certified", effect=F.col("effect"), effect_unit="rtp_points",
        description=F.concat(day, F.format_string(": day return %.4f vs certified %.4f", "day_rtp", "rtp_cert")),
        context=context(event_date=day),
    )
    trig = signals(
        trigger_drift_days(game_day, t).where("selected").withColumn("_p", normal_sf("z")),
        signal_id="L2-TRIGGER_DRIFT", family="OUTCOME_FREQUENCY", layer=2, grain="game_cell",
        metric="day_trigger_z", value=F.col("z"), threshold_method="BINOMIAL+BH",
        baseline_source="empirical_loo", p_value=F.col("_p"), effect=F.col("lift"), effect_unit="lift",
        description=F.concat(day, F.format_string(": trigger rate %.1fx the other days", "lift")),
        context=context(event_date=day),
    )
    ship = deploy_shifts(game_day, t).withColumn("event_date", F.col("first_day"))
    deploy = signals(
        ship, signal_id="L2-DEPLOY_SHIFT", family="ENVIRONMENT", layer=2, grain="game_cell",
        metric="build_rtp_shift", value=F.col("shift"), threshold_method="ABSOLUTE",
        baseline_source="empirical_build", effect=100 * F.col("shift"), effect_unit="rtp_points",
        description=F.concat(F.lit("build "), "sm_tag", F.format_string(" pays %.4f vs %.4f of build ", "rtp", "prev_rtp"),
                             "prev_tag"),
        context=context(event_date=day),
    )
    return off.unionByName(trig).unionByName(deploy)
