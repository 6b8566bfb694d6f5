"""Calibration metrics as one long table: a row per metric and entity."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.columns import join_keys, ratio
from tallyscope.functions.ranks import volume_group
from tallyscope.operators.features import per_player_buys
from tallyscope.operators.lookups import DEFAULT_EXCLUSIONS, Exclusions, apply_exclusions, with_certified
from tallyscope.settings import CELL, METRIC_RULES, PLAYER, Thresholds

_COLUMNS = {
    "parent": "string", "uid": "string", "game_id": "string", "play_type": "int",
    "currency": "string", "sm_tag": "string", "rounds": "bigint", "value": "double",
    "lift": "double", "effect_rtp_points": "double", "p0_frozen": "double",
    "peer_rounds": "double", "sigma_spin": "double", "rtp_cert": "double",
    "top_win_seq_ids": "string", "volume_group": "string",
}


def _metric(df: DataFrame, name: str) -> DataFrame:
    rule, family, kind, grain = METRIC_RULES[name]
    cols = [
        (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in _COLUMNS.items()
    ]
    return df.select(
        F.lit(name).alias("metric"), F.lit(rule).alias("rule"), F.lit(family).alias("family"),
        F.lit(kind).alias("kind"), F.lit(grain).alias("grain"), *cols,
    )


def leave_operator_out(
    cells: DataFrame, cell_constants: DataFrame, cell_operator: DataFrame, own: str, rate: str
) -> DataFrame:
    """Binomial z of a player-cell rate against its peers outside the operator."""
    cc = cell_constants.select(*CELL, F.col("rounds").alias("_cr"), (F.col(rate) * F.col("rounds")).alias("_cn"))
    co = cell_operator.select(*CELL, "parent", F.col("rounds").alias("_or"), F.col(own).alias("_on"))
    j = join_keys(join_keys(cells, cc, CELL), co, CELL + ["parent"])
    zero = F.lit(0.0)
    peers = F.greatest(F.col("_cr") - F.coalesce("_or", zero), zero)
    hits = F.greatest(F.col("_cn") - F.coalesce("_on", zero), zero)
    p0 = F.col("p0_frozen")
    return (
        j.withColumn("peer_rounds", peers)
        .withColumn("p0_frozen", F.greatest(F.least(
            ratio(hits, F.nullif(peers, zero)), F.lit(1 - 1e-9)), F.lit(1e-9)))
        .withColumn("p0_frozen", F.when(F.col("peer_rounds") > 0, F.col("p0_frozen")))
        .withColumn("_phat", ratio(own, "rounds"))
        .withColumn("value", (F.col("_phat") - p0) / F.sqrt(p0 * (1 - p0) / F.col("rounds")))
        .withColumn("lift", F.col("_phat") / p0)
        .drop("_cr", "_cn", "_or", "_on", "_phat")
    )


def excess_money(cells: DataFrame, cell_constants: DataFrame, catalog: DataFrame) -> DataFrame:
    """z of winnings above the certified return, weighted for unequal stakes."""
    sigma = cell_constants.select(*CELL, "sigma_spin")
    j = with_certified(join_keys(cells, sigma, CELL), catalog)
    j = j.where("rtp_cert IS NOT NULL AND sigma_spin > 0 AND sumsq_valid_bet > 0")
    excess = F.col("total_win") - F.col("rtp_cert") * F.col("turnover")
    return (
        j.withColumn("value", excess / (F.col("sigma_spin") * F.sqrt("sumsq_valid_bet")))
        .withColumn("effect_rtp_points", 100.0 * ratio(excess, F.nullif(F.col("turnover"), F.lit(0.0))))
    )


#: Metrics of the timing of a player; the others are of cells.
OF_TIMING = ("same_second_share", "modal_share", "concurrent_rounds", "max_rounds_per_minute")


def build_metrics(
    player_cell: DataFrame | None,
    player_timing: DataFrame | None,
    cell_constants: DataFrame | None,
    cell_operator: DataFrame | None,
    catalog: DataFrame,
    t: Thresholds = Thresholds(),
    *,
    exclusions: Exclusions = DEFAULT_EXCLUSIONS,
    segments: bool = False,
    only: Collection[str] = METRIC_RULES,
) -> DataFrame:
    """All eight metrics, or those named in ``only``; a table that none of them reads may be None.

    ``segments`` adds volume tertiles for validation.
    """
    tag = volume_group if segments else (lambda df: df)
    frames = []
    if any(m in OF_TIMING for m in only):
        timing = tag(apply_exclusions(player_timing, exclusions))
        of_timing = {
            "same_second_share": (F.col("n_gaps") >= t.same_second_min_gaps, ratio("same_second_gaps", "n_gaps")),
            "modal_share": (F.col("in_range_gaps") >= t.cadence_min_gaps, F.col("modal_share")),
            "concurrent_rounds": (F.lit(True), F.col("concurrent_rounds")),
            "max_rounds_per_minute": (F.lit(True), F.col("max_rounds_per_minute")),
        }
        frames += [_metric(timing.where(of_timing[m][0]).withColumn("value", of_timing[m][1]), m) for m in OF_TIMING if m in only]
    if all(m in OF_TIMING for m in only):
        return reduce(DataFrame.unionByName, frames)
    pc = apply_exclusions(player_cell, exclusions)
    if "buy_share_turnover" in only:
        buys = tag(per_player_buys(pc)).withColumn("value", F.col("buy_share")).where("value IS NOT NULL")
        frames.append(_metric(buys, "buy_share_turnover"))
    rated = [(n, own, rate) for n, own, rate in (("trigger_rate_z", "n_trigger", "p_trigger"), ("hit_rate_z", "n_win", "p_hit"))
             if n in only]
    if rated:
        base = tag(pc.where("play_type = 0")).where(F.col("rounds") >= t.rate_min_rounds)
        co = apply_exclusions(cell_operator, exclusions)
    enough_peers = t.peer_min_players * t.min_rounds
    for name, own, rate in rated:
        rates = leave_operator_out(base, cell_constants, co, own, rate)
        frames.append(_metric(
            rates.where((F.col("peer_rounds") >= enough_peers) & F.col("value").isNotNull()), name))
    if "excess_turnover_z" in only:
        money = tag(excess_money(pc, cell_constants, catalog)).where("value IS NOT NULL")
        frames.append(_metric(money, "excess_turnover_z"))
    return reduce(DataFrame.unionByName, frames)
