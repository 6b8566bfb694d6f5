"""Daily partial tables that add up to the aggregates of any replay boundary.

Rounds of a day are read once, when the day is over. What does not add up by
itself is kept as what a day brings that earlier days had not: stakes and round
ids seen for the first time, and gaps to the last round before the day. Days are
therefore added in order, and a corrected day takes back the days after it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyscope.functions.columns import join_keys, trimmed_rounds
from tallyscope.operators import features as ft
from tallyscope.operators import timing as tm
from tallyscope.settings import CELL, PLAYER, PLAYER_CELL, Thresholds
from tallyscope.sources.archive import rounds_asof
from tallyscope.sources.durable import materialise
from tallyscope.sources.snapshots import Snapshots, Version

DAY = "event_date"
_LAST = ["game_time", "serial", "game_id"]


@dataclass
class Partials:
    """Partial tables of some days, each with ``event_date``; None for one that was not asked for."""

    cells: DataFrame | None = None  # sums and moments of (player, cell, day), with stakes and ids new on that day if these are held
    stakes: DataFrame | None = None  # (player, cell, stake) on the first day it is seen
    ids: DataFrame | None = None  # (player, cell, round id) on the first day it is seen
    cube: DataFrame | None = None  # timing counts of (player, hour, segment, gap class); needs last
    peaks: DataFrame | None = None  # minute peaks of (player, day)
    last: DataFrame | None = None  # last round of (player, day)
    wins: DataFrame | None = None  # the biggest wins of (player, cell, day)

    def held(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if getattr(self, f.name) is not None}

    def union(self, other: "Partials") -> "Partials":
        return Partials(**{name: df.unionByName(getattr(other, name)) for name, df in self.held().items()})

    def before(self, day) -> "Partials":
        return Partials(**{name: df.where(F.col(DAY) < F.lit(day).cast("date")) for name, df in self.held().items()})


#: All partial tables, and those that the aggregates below read.
TABLES = tuple(f.name for f in fields(Partials))
OF_PLAYER_CELL, OF_TIMING, OF_CELLS, OF_WINS = ("cells", "stakes", "ids"), ("cube", "peaks", "last"), ("cells",), ("wins",)


def _unseen(found: DataFrame, known: DataFrame | None, keys: list[str], value: str) -> DataFrame:
    """First days of values that earlier days do not hold."""
    first = found.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(DAY).alias(DAY))
    return first if known is None else join_keys(first, known.select(*keys, value), [*keys, value], "left_anti").select(*keys, value, DAY)


def partials_of(
    rounds: DataFrame, t: Thresholds = Thresholds(), known: Partials | None = None, tables: tuple[str, ...] = TABLES,
) -> Partials:
    """Partial tables of rounds, all of days after those of ``known``; only those named are made."""
    if "cube" in tables and "last" not in tables:
        raise ValueError("the first gap of a day in cube needs last")
    dated = rounds.where(F.col("game_time").isNotNull()).withColumn(DAY, F.to_date("game_time"))
    keys = [*PLAYER_CELL, DAY]
    p = Partials()
    if "stakes" in tables:
        stakes = _unseen(dated.select(*keys, F.col("bet").alias("stake")), known and known.stakes, PLAYER_CELL, "stake")
        p.stakes = materialise(stakes, "stakes")
    if "ids" in tables:
        p.ids = materialise(_unseen(dated.select(*keys, "game_seq_id"), known and known.ids, PLAYER_CELL, "game_seq_id"), "ids")
    if "cells" in tables:
        p.cells = dated.groupBy(*keys).agg(
            *ft._round_sums(t), *ft.part_moments(), F.max("report_date").alias("report_date"), F.max("win").alias("max_win"))
        for new, name in ((p.stakes, "new_stakes"), (p.ids, "new_ids")):
            if new is not None:
                counted = new.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
                p.cells = join_keys(p.cells, counted, keys).withColumn(name, F.coalesce(name, F.lit(0)))
    if "cube" in tables:
        earlier = known and known.last.groupBy(*PLAYER).agg(F.max(F.struct(*_LAST)).alias("_l")).select(*PLAYER, "_l.*")
        p.cube = tm.timing_cube(dated, t, earlier).withColumn(DAY, F.to_date("hour_utc"))
    if "peaks" in tables:
        peaks = dated.groupBy(*PLAYER, DAY, F.date_trunc("MINUTE", "game_time").alias("_minute")).agg(F.count(F.lit(1)).alias("_n"))
        p.peaks = peaks.groupBy(*PLAYER, DAY).agg(
            F.max("_n").alias("max_rounds_per_minute"), F.count_if(F.col("_n") >= t.physical_rpm).alias("superhuman_minutes"))
    if "last" in tables:
        p.last = dated.groupBy(*PLAYER, DAY).agg(F.max(F.struct(*_LAST)).alias("_l")).select(*PLAYER, DAY, "_l.*")
    if "wins" in tables:
        p.wins = trimmed_rounds(dated, keys)
    return p


# aggregates of a boundary


def player_cell(p: Partials) -> DataFrame:
    """As :func:`features.player_cell_features`, without evidence or floor."""
    return p.cells.groupBy(*PLAYER_CELL).agg(
        *ft._merge_sums(),
        F.sum("new_stakes").alias("bet_levels"), F.count(F.lit(1)).alias("active_days"),
        (F.sum("rounds") - F.sum("new_ids")).alias("dup_seq_rounds"),
    )


def player_timing(p: Partials, t: Thresholds = Thresholds(), *, min_rounds: int | None = None) -> DataFrame:
    peaks = p.peaks.groupBy(*PLAYER).agg(
        F.max("max_rounds_per_minute").alias("max_rounds_per_minute"), F.sum("superhuman_minutes").alias("superhuman_minutes"))
    return tm.timing_of(p.cube.drop(DAY), peaks, t, min_rounds=min_rounds)


def cell_constants(p: Partials) -> DataFrame:
    return ft.pool_cells(p.cells)


def game_day(p: Partials) -> DataFrame:
    players = p.cells.groupBy(*CELL, DAY, *PLAYER).agg(
        *[F.sum(c).alias(c) for c in [*ft._CELL_MERGE, "beta_rounds"]],
        F.max("report_date").alias("report_date"), F.max("max_win").alias("max_win"))
    return players.groupBy(*CELL, DAY).agg(
        F.max("report_date").alias("report_date_utc8"), F.count(F.lit(1)).alias("n_players"),
        *[F.sum(c).alias(c) for c in [*ft._CELL_MERGE, "beta_rounds"]], F.max("max_win").alias("max_round_win"))


# the store


class PartialStore:
    """Partial tables of all days that are over, under one folder; every added run of days is one version.

    ``tables`` are those that the store's readers need; a store keeps the ones it began with.
    """

    def __init__(self, spark: SparkSession, path: str, t: Thresholds = Thresholds(), tables: tuple[str, ...] = TABLES) -> None:
        self.spark, self.t, self.names = spark, t, tables
        self.table = Snapshots(spark, path, DAY)

    def through(self, version: Version | None = None) -> str | None:
        """The last day held."""
        return (version or self.table.version()).notes.get("through")

    def _held(self, version: Version) -> Partials | None:
        if not version.notes.get("through"):
            return None
        if set(version.notes["schemas"]) != set(self.names):
            raise ValueError(f"the store holds {sorted(version.notes['schemas'])}")
        return Partials(**{
            name: self.table.read(name, StructType.fromJson(version.notes["schemas"][name]), version) for name in self.names})

    def advance(self, rounds: DataFrame, through: str) -> bool:
        """Add the days up to ``through`` that are not held, reading rounds of these days only; False if none is missing."""
        base = self.table.version()
        done = self.through(base)
        if done is not None and done >= through:
            return False
        fresh = _of_days(rounds, done, through)
        if len(self.names) > 1:  # the source is read and parsed once, not for every table
            fresh = materialise(fresh, "fresh")
        new = partials_of(fresh, self.t, self._held(base), self.names)
        entries, schemas = list(base.entries), {}
        for name, df in new.held().items():
            schemas[name] = df.schema.jsonValue()
            entries += self.table.stage(df.hint("rebalance", DAY), name)
        self.table.commit(base, entries, {"through": through, "schemas": schemas})
        return True

    def take_back(self, day: str) -> None:
        """Forget a corrected day and all after it, as they count what it did not have."""
        base = self.table.version()
        done = self.through(base)
        if done is None or done < day:
            return
        kept = [e for e in base.entries if e["part"] < day]
        before = (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat()
        self.table.commit(base, kept, {**base.notes, "through": before})

    def asof(self, rounds: DataFrame, as_of: str) -> Partials:
        """Partials of all rounds visible at ``as_of``; only rounds of days that are not held whole are read."""
        held, day = self._held(self.table.version()), as_of[:10]
        if held is None:
            return partials_of(rounds_asof(rounds, as_of), self.t, tables=self.names)
        done = min(self.through(), (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat())
        held = held.before((dt.date.fromisoformat(done) + dt.timedelta(days=1)).isoformat())
        return held.union(partials_of(rounds_asof(_of_days(rounds, done, day), as_of), self.t, held, self.names))


def _of_days(rounds: DataFrame, after: str | None, through: str) -> DataFrame:
    """Rounds of the days after ``after`` up to ``through``; a dated archive reads no other day."""
    day = F.col(DAY) if DAY in rounds.columns else F.to_date("game_time")
    wanted = day <= F.lit(through).cast("date")
    return rounds.where(wanted if after is None else wanted & (day > F.lit(after).cast("date"))).drop(DAY)
