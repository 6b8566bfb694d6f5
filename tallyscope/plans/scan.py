"""Composed jobs: calibrate on one window, scan at a replay boundary, replay many.

Aggregates are stored once per boundary and every later step reads the stored
tables, so rounds are read a fixed number of times whatever rules run, or, with a
store of daily partials, once in their life.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyscope.functions.columns import join_keys, top_rounds
from tallyscope.operators import anomaly, calibration, cohorts, features, fusion, layer1, layer2, metrics, partials, timing
from tallyscope.operators.casegate import GateStore
from tallyscope.operators.lookups import DEFAULT_EXCLUSIONS, Exclusions
from tallyscope.operators.partials import PartialStore
from tallyscope.settings import PLAYER, PLAYER_CELL, Thresholds
from tallyscope.sources.archive import rounds_asof
from tallyscope.sources.durable import materialise


@dataclass
class Aggregates:
    player_cell: DataFrame  # every cell; the volume floor is a filter on it
    player_timing: DataFrame
    cell_constants: DataFrame
    cell_operator: DataFrame
    game_day: DataFrame | None  # where daily series were asked for
    wins: DataFrame  # rounds, or the biggest wins of each cell, that evidence is read from

    def gated(self, t: Thresholds) -> DataFrame:
        return self.player_cell.where(F.col("rounds") >= t.min_rounds)


def extract(
    rounds: DataFrame, as_of: str, t: Thresholds = Thresholds(), *, for_metrics: bool = False, timed_rounds: int | None = None,
) -> Aggregates:
    """The five stored aggregates of all rounds visible at ``as_of``.

    Sums of player cells, cells and operators come from one pass over the rounds.
    ``for_metrics`` leaves out what no metric and no split of a window reads: stake
    levels, days and repeated ids of player cells, and the daily series.
    ``timed_rounds`` is the floor of the timing rows, by default that of ``t``.
    """
    r = rounds_asof(rounds, as_of)
    parts = materialise(features.cell_parts(r, t), "cell_parts")
    sums = parts.drop(*features.MOMENTS)
    return Aggregates(
        sums if for_metrics else materialise(features.with_levels(sums, r), "player_cell"),
        materialise(timing.player_timing(r, t, min_rounds=timed_rounds, counted=parts), "player_timing"),
        materialise(features.pool_cells(parts), "cell_constants"),
        materialise(features.cell_operator_from_player_cell(sums), "cell_operator"),
        None if for_metrics else materialise(features.game_day_series(r), "game_day"),
        r,
    )


def extract_stored(store: PartialStore, rounds: DataFrame, as_of: str, t: Thresholds = Thresholds()) -> Aggregates:
    """The same aggregates from stored daily partials; of ``rounds`` only the days not yet held are read."""
    store.advance(rounds, (date.fromisoformat(as_of[:10]) - timedelta(days=1)).isoformat())
    p = store.asof(rounds, as_of)
    p = replace(p, cells=materialise(p.cells, "partial_cells"))
    cells = materialise(partials.player_cell(p), "player_cell")
    return Aggregates(
        cells,
        materialise(partials.player_timing(p, t), "player_timing"),
        materialise(partials.cell_constants(p), "cell_constants"),
        materialise(features.cell_operator_from_player_cell(cells), "cell_operator"),
        materialise(partials.game_day(p), "game_day"),
        p.wins,
    )


def _metrics(a: Aggregates, catalog: DataFrame, t: Thresholds, x: Exclusions, segments: bool = False) -> DataFrame:
    return materialise(metrics.build_metrics(
        a.gated(t), a.player_timing, a.cell_constants, a.cell_operator, catalog, t, exclusions=x, segments=segments),
        "metrics")


def calibrate(
    rounds: DataFrame, catalog: DataFrame, train_end: str, validation_end: str, path: str,
    t: Thresholds = Thresholds(), exclusions: Exclusions = DEFAULT_EXCLUSIONS,
) -> str:
    """Fit at ``train_end``, freeze, validate at ``validation_end``; returns the verdict."""
    frozen = calibration.fit(_metrics(extract(rounds, train_end, t, for_metrics=True), catalog, t, exclusions), t)
    later = _metrics(extract(rounds, validation_end, t, for_metrics=True), catalog, t, exclusions, segments=True)
    checked = materialise(calibration.validate(later, frozen, t), "validation")
    calibration.write_frozen(frozen, checked, path, train_as_of=train_end, validated_as_of=validation_end)
    return calibration.verdict(checked).first()["verdict"]


def attach_evidence(signals: DataFrame, rounds: DataFrame) -> DataFrame:
    """Top-win evidence, read only for the player-cells that have a signal."""
    cells = signals.where("grain = 'player_cell'").select(*PLAYER_CELL).distinct()
    wins = top_rounds(join_keys(rounds, cells, PLAYER_CELL, "left_semi"), PLAYER_CELL)
    keyed = join_keys(signals, wins, PLAYER_CELL).withColumn("evidence", F.when(
        F.col("grain") == "player_cell", F.coalesce("evidence", F.split("top_win_seq_ids", r"\|"))
    ).otherwise(F.col("evidence")))
    return keyed.select(*signals.columns)


@dataclass
class Scan:
    signals: DataFrame
    cases: DataFrame
    proposals: DataFrame
    members: DataFrame
    population: int
    ml_verdict: str


def scan(
    rounds: DataFrame, catalog: DataFrame, frozen: DataFrame, as_of: str, t: Thresholds = Thresholds(), *,
    persistence_mid: str | None = None, exclusions: Exclusions = DEFAULT_EXCLUSIONS, discover: bool = True,
    partial_store: PartialStore | None = None,
) -> Scan:
    """Layers 1 to 3, fusion and the recency window at one boundary.

    With a ``partial_store`` the days that are over come from its tables.
    """
    def aggregates(boundary: str, **options) -> Aggregates:
        if partial_store is None:
            return extract(rounds, boundary, t, **options)
        return extract_stored(partial_store, rounds, boundary, t)

    a = aggregates(as_of)
    pc = a.gated(t)
    halves = {}
    if persistence_mid is not None:
        mid = aggregates(persistence_mid, for_metrics=True)  # a half is told by sums
        halves = dict(half_player_cell=mid.gated(t), half_player_timing=mid.player_timing)
    found = layer1.layer1_signals(
        _metrics(a, catalog, t, exclusions), frozen, pc, a.player_timing, a.cell_constants, catalog, t,
        ungated_player_cell=a.player_cell, exclusions=exclusions, **halves,
    ).unionByName(layer2.layer2_signals(a.game_day, catalog, t))
    rule_signals = materialise(attach_evidence(materialise(found, "rule_signals"), a.wins), "signals")
    groups = materialise(cohorts.detect_cohorts(pc, a.player_timing, a.cell_constants, catalog, t), "cohorts")
    proposed = cohorts.proposals(groups, t)
    members = materialise(cohorts.membership(proposed, pc), "members")
    every, verdict = rule_signals, "SKIPPED"
    if discover:
        flagged = rule_signals.where("parent IS NOT NULL AND uid IS NOT NULL").select(*PLAYER)
        extra, verdict = anomaly.discover(pc, a.player_timing, flagged, t)
        every = rule_signals.unionByName(extra)
    population = pc.select(*PLAYER).distinct().count()
    cases = fusion.fuse(every, t, cohort_members=members, population=population)
    cases = fusion.recent_cases(fusion.with_last_active(cases, a.player_cell), as_of, t.detection_window_days)
    return Scan(every, materialise(cases, "cases"), proposed, members, population, verdict)


def replay(
    spark: SparkSession, rounds: DataFrame, catalog: DataFrame, frozen: DataFrame, ticks: list[str], store: GateStore,
    t: Thresholds = Thresholds(), **options,
) -> dict[str, int]:
    """Scan and gate at each boundary in order; returns alerts per tick.

    Given ``partial_store``, each tick reads only the rounds of days since the last.
    """
    out = {}
    for tick in ticks:
        cases = scan(rounds, catalog, frozen, tick, t, **options).cases
        out[tick] = store.ingest(tick, cases).count()
    return out
