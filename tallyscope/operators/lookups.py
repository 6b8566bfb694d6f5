"""Reference-data joins: certified return, certified cap and approved exclusions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEM = r"^(\d+)[a-z]?$"


def _stem(game_id: str) -> Column:
    text = F.regexp_extract(game_id, _STEM, 1)
    return F.when(text != "", text)


def with_certified(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add ``rtp_cert``, ``rtp_source``, ``cap_cert`` and ``cap_source``.

    The exact (game, play type) row wins, then the game's untyped row, then, for
    an unknown play type only, the base row. The cap falls back to the largest
    cap of the game. A sheet id without its type letter still matches.
    """
    # the first row of a stem is by its line in the sheet; rows without a line go by id
    line = F.col("line") if "line" in catalog.columns else F.lit(0)
    cat = catalog.select(F.trim("game_id").alias("_gid"), "play_type", "rtp", "max_multiplier", line.alias("_line"))
    games = cat.groupBy("_gid").agg(
        F.max(F.when(F.col("play_type").isNull(), F.col("rtp"))).alias("_rtp_untyped"),
        F.max(F.when(F.col("play_type") == 0, F.col("rtp"))).alias("_rtp_base"),
        F.max("max_multiplier").alias("_cap_game"),
    )
    stems = (
        cat.select(_stem("_gid").alias("_stem"), "_gid", F.struct("_line", "_gid").alias("_o"))
        .where(F.col("_stem").isNotNull())
        .groupBy("_stem").agg(F.min_by("_gid", "_o").alias("_stem_gid"))
    )
    typed = cat.where(F.col("play_type").isNotNull()).groupBy("_gid", F.col("play_type").alias("_pt")).agg(
        F.max("rtp").alias("_rtp_exact"), F.max("max_multiplier").alias("_cap_exact"))
    known = games.select(F.col("_gid").alias("_known"))
    out = (
        df.withColumn("_live", F.trim("game_id"))
        .join(known, F.col("_live") == F.col("_known"), "left")
        .withColumn("_live_stem", _stem("_live"))
        .join(stems, F.col("_live_stem") == F.col("_stem"), "left")
        .withColumn("_res", F.coalesce("_known", "_stem_gid"))
        .join(games, F.col("_res") == F.col("_gid"), "left").drop("_gid")
        .join(typed, (F.col("_res") == F.col("_gid")) & (F.col("play_type") == F.col("_pt")), "left")
    )
    base_ok = F.col("play_type").isNull()
    fallback = F.coalesce("_rtp_untyped", F.when(base_ok, F.col("_rtp_base")))
    return (
        out.withColumn("rtp_cert", F.coalesce("_rtp_exact", fallback))
        .withColumn("rtp_source", F.when(F.col("_rtp_exact").isNotNull(), "certified")
                    .when(fallback.isNotNull(), "certified_game_level").otherwise("none"))
        .withColumn("cap_cert", F.coalesce("_cap_exact", "_cap_game"))
        .withColumn("cap_source", F.when(F.col("_cap_exact").isNotNull(), "certified")
                    .when(F.col("_cap_game").isNotNull(), "certified_game_level").otherwise("none"))
        .drop("_live", "_known", "_live_stem", "_stem", "_stem_gid", "_res", "_rtp_untyped", "_rtp_base",
              "_cap_game", "_gid", "_pt", "_rtp_exact", "_cap_exact")
    )


@dataclass(frozen=True)
class Exclusions:
    """The human-approved exclusion list; proposals never enter it."""

    fleets: tuple[tuple[str | None, str | None], ...] = ()
    accounts: tuple[tuple[str, str], ...] = ()
    parents: tuple[str, ...] = ()
    games: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        for parent, pattern in self.fleets:
            if parent is None and not pattern:
                raise ValueError("a fleet entry needs a parent or a uid pattern")


# Games of the catalogue that are not slots.
DEFAULT_EXCLUSIONS = Exclusions(games=("1002s", "1003m", "6801r", "6901g"))


def exclusion_reason(df: DataFrame, x: Exclusions) -> Column:
    """First matching reason in order fleet, account, parent, game; else NULL."""
    has = set(df.columns)
    never = F.lit(False)
    fleet, account, parent, game = never, never, never, never
    for fleet_parent, pattern in x.fleets:
        hit = F.lit(True)
        if fleet_parent is not None and "parent" in has:
            hit = hit & (F.col("parent") == fleet_parent)
        if pattern and "uid" in has:
            hit = hit & F.col("uid").rlike(f"^(?:{pattern})")
        fleet = fleet | F.coalesce(hit, never)
    if x.accounts and {"parent", "uid"} <= has:
        # one set lookup, however long the list
        key = F.concat(F.col("parent"), F.lit("\x01"), F.col("uid"))
        account = F.coalesce(key.isin([f"{p}\x01{u}" for p, u in x.accounts]), never)
    if x.parents and "parent" in has:
        parent = F.coalesce(F.col("parent").isin(*x.parents), never)
    if x.games and "game_id" in has:
        game = F.coalesce(F.col("game_id").isin(*x.games), never)
    return (
        F.when(fleet, "fleet").when(account, "account").when(parent, "scope_parent").when(game, "scope_game")
    )


def apply_exclusions(df: DataFrame, x: Exclusions = DEFAULT_EXCLUSIONS) -> DataFrame:
    return df.where(exclusion_reason(df, x).isNull())


def exclusion_counts(df: DataFrame, x: Exclusions = DEFAULT_EXCLUSIONS) -> DataFrame:
    """Rows kept and dropped per reason."""
    return df.groupBy(F.coalesce(exclusion_reason(df, x), F.lit("kept")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
