"""Absolute integrity rules over the newest rounds only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.columns import breaks_identity, join_keys, multiple, top_rounds
from tallyscope.operators.features import duplicate_rounds
from tallyscope.operators.layer1 import integrity_signals
from tallyscope.operators.lookups import DEFAULT_EXCLUSIONS, Exclusions, apply_exclusions
from tallyscope.settings import PLAYER_CELL, Thresholds


def new_rounds(rounds: DataFrame, watermark: int, t: Thresholds = Thresholds()) -> DataFrame:
    """Rounds above the watermark less the safety margin, so late twins pair up."""
    return rounds.where(F.col("serial") > max(0, watermark - t.serial_margin))


def lowest_cap(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.min("max_multiplier").alias("min_cap"))


def absolute_aggregate(rounds: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Counts per player-cell that the absolute rules need."""
    base = rounds.groupBy(*PLAYER_CELL).agg(
        F.count(F.lit(1)).alias("rounds"), F.count_if(breaks_identity(t)).alias("balance_violations"),
        F.max(multiple()).alias("max_multiple"), F.max("serial").alias("grp_max_serial"))
    dup = duplicate_rounds(rounds, PLAYER_CELL)
    return join_keys(base, dup, PLAYER_CELL).withColumn(
        "dup_seq_rounds", F.coalesce("dup_seq_rounds", F.lit(0)))


def violations(aggregate: DataFrame, rounds: DataFrame, catalog: DataFrame) -> DataFrame:
    """Cells that may break a rule, with evidence read for those cells only."""
    cap = lowest_cap(catalog)
    v = aggregate.join(F.broadcast(cap), F.lit(True), "left").where(
        (F.col("balance_violations") > 0) | (F.col("dup_seq_rounds") > 0)
        | F.coalesce(F.col("max_multiple") >= F.col("min_cap"), F.lit(False))).drop("min_cap")
    flagged = join_keys(rounds, v.select(*PLAYER_CELL), PLAYER_CELL, "left_semi")
    return join_keys(v, top_rounds(flagged, PLAYER_CELL), PLAYER_CELL)


def scan_summary(aggregate: DataFrame, watermark: int) -> DataFrame:
    """Exactly one row, also on an empty slice, so the watermark can advance."""
    return aggregate.agg(
        F.coalesce(F.max("grp_max_serial"), F.lit(watermark)).cast("bigint").alias("scan_max_serial"),
        F.coalesce(F.sum("rounds"), F.lit(0)).cast("bigint").alias("scan_rows"))


def summary_with_violations(aggregate: DataFrame, found: DataFrame, watermark: int) -> DataFrame:
    """The summary row joined to zero or more violating cells."""
    return F.broadcast(scan_summary(aggregate, watermark)).join(found, F.lit(True), "left")


def fast_signals(
    rounds: DataFrame, catalog: DataFrame, t: Thresholds = Thresholds(), exclusions: Exclusions = DEFAULT_EXCLUSIONS
) -> DataFrame:
    found = violations(absolute_aggregate(rounds, t), rounds, catalog)
    return integrity_signals(apply_exclusions(found, exclusions), catalog)
