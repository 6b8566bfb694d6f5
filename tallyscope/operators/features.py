"""Sufficient statistics of rounds per player, peer cell and day.

Sums are reduced map-side by key before they are shuffled; distinct stakes and
days are counted on narrow pairs, made distinct map-side. Duplicate settlements
need the round id, so they use a two-column branch whose shuffle is keyed by the
round id itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.columns import (
    breaks_identity, identity_gap, join_keys, log_multiple, multiple, ratio, top_rounds,
)
from tallyscope.settings import CELL, FEATURE_BUY_TYPES, PLAYER, PLAYER_CELL, Thresholds
from tallyscope.sources.durable import materialise

ADDITIVE = [
    "rounds", "turnover", "total_win", "n_win", "n_trigger", "dup_seq_rounds", "sum_bet",
    "sumsq_bet", "sum_bet_trigger", "sumsq_valid_bet", "sum_log_mult", "sumsq_log_mult",
    "balance_violations",
]


def _long(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("bigint")


def _flag(condition: Column) -> Column:
    return F.count_if(condition)


def _round_sums(t: Thresholds) -> list[Column]:
    lm = log_multiple()
    return [
        F.count(F.lit(1)).alias("rounds"),
        F.sum("valid_bet").alias("turnover"),
        F.sum("win").alias("total_win"),
        _flag(F.col("win") > 0).alias("n_win"),
        _flag(F.col("triggered")).alias("n_trigger"),
        F.sum("bet").alias("sum_bet"),
        F.sum(F.col("bet") * F.col("bet")).alias("sumsq_bet"),
        F.sum(F.when(F.col("triggered"), F.col("bet")).otherwise(0.0)).alias("sum_bet_trigger"),
        F.sum(F.col("valid_bet") * F.col("valid_bet")).alias("sumsq_valid_bet"),
        F.sum(F.coalesce(lm, F.lit(0.0))).alias("sum_log_mult"),
        F.sum(F.coalesce(lm * lm, F.lit(0.0))).alias("sumsq_log_mult"),
        F.max(multiple()).alias("max_multiple"),
        _flag(breaks_identity(t)).alias("balance_violations"),
        F.min("game_time").alias("first_round_utc"),
        F.max("game_time").alias("last_round_utc"),
    ]


_SUMS = [c for c in ADDITIVE if c != "dup_seq_rounds"]


def _merge_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in _SUMS] + [
        F.max("max_multiple").alias("max_multiple"),
        F.min("first_round_utc").alias("first_round_utc"),
        F.max("last_round_utc").alias("last_round_utc"),
    ]


def duplicate_rounds(rounds: DataFrame, keys: list[str]) -> DataFrame:
    """COUNT(*) - COUNT(DISTINCT game_seq_id) per group, only where positive."""
    per_id = rounds.groupBy(*keys, "game_seq_id").agg(F.count(F.lit(1)).alias("_n"))
    extra = F.when(F.col("game_seq_id").isNull(), F.col("_n")).otherwise(F.col("_n") - 1)
    return (
        per_id.select(*keys, extra.alias("_extra")).where("_extra > 0")
        .groupBy(*keys).agg(F.sum("_extra").alias("dup_seq_rounds"))
    )


def _with_duplicates(stats: DataFrame, rounds: DataFrame, keys: list[str]) -> DataFrame:
    dup = duplicate_rounds(rounds, keys)
    return join_keys(stats, dup, keys).withColumn("dup_seq_rounds", _long(F.col("dup_seq_rounds")))


def _levels(rounds: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct stakes and days per group: narrow pairs are made distinct, then counted in one pass."""
    day, stake = F.to_date("game_time"), F.col("bet")
    pairs = rounds.select(*keys, F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), stake.alias("stake"), F.lit(None).cast("date").alias("day")),
        F.struct(F.lit(1).alias("kind"), F.lit(None).cast("double").alias("stake"), day.alias("day")),
    )).alias("_p")).select(*keys, "_p.*").distinct()
    return pairs.groupBy(*keys).agg(F.count("stake").alias("bet_levels"), F.count("day").alias("active_days"))


def cell_parts(rounds: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Sums and moments per player and peer cell, in one pass; player cells, cells and operators are made of them."""
    return rounds.groupBy(*PLAYER_CELL).agg(*_round_sums(t), *part_moments())


def with_levels(stats: DataFrame, rounds: DataFrame) -> DataFrame:
    """Sums per player cell with what does not add up: stake levels, days and rounds settled twice."""
    return _with_duplicates(join_keys(stats, _levels(rounds, PLAYER_CELL), PLAYER_CELL), rounds, PLAYER_CELL)


def player_cell_features(
    rounds: DataFrame, t: Thresholds = Thresholds(), *, min_rounds: int | None = None,
    evidence: bool = True,
) -> DataFrame:
    """One row per player and peer cell with 18 statistics and top-win evidence."""
    floor = t.min_rounds if min_rounds is None else min_rounds
    stats = rounds.groupBy(*PLAYER_CELL).agg(*_round_sums(t)).where(F.col("rounds") >= floor)
    out = with_levels(stats, rounds)
    if evidence:
        out = join_keys(out, top_rounds(rounds, PLAYER_CELL), PLAYER_CELL)
    return out


def player_cell_daily(
    rounds: DataFrame, t: Thresholds = Thresholds(), *, evidence: bool = True
) -> DataFrame:
    """Additive player-cell statistics per UTC day, without a volume floor."""
    keys = PLAYER_CELL + ["event_date"]
    dated = rounds.withColumn("event_date", F.to_date("game_time"))
    stakes = dated.select(*keys, "bet").distinct().groupBy(*keys).agg(F.count("bet").alias("bet_levels_day"))
    stats = join_keys(dated.groupBy(*keys).agg(*_round_sums(t)), stakes, keys)
    out = _with_duplicates(stats, dated, keys)
    if evidence:
        out = join_keys(out, top_rounds(dated, keys), keys)
    return out


def part_moments() -> list[Column]:
    """Counts, means and variances of multiples in a part of a cell; parts are pooled by :func:`pool_cells`."""
    m, lm = multiple(), log_multiple()
    return [
        F.count(m).alias("_mn"), F.avg(m).alias("_mm"), F.var_pop(m).alias("_mv"),
        F.count(lm).alias("_ln"), F.avg(lm).alias("_lm"), F.var_pop(lm).alias("_lv"),
        _flag(F.col("sm_v") == "feature_beta").alias("beta_rounds"),
    ]


MOMENTS = ("_mn", "_mm", "_mv", "_ln", "_lm", "_lv", "beta_rounds")


def pool_cells(parts: DataFrame) -> DataFrame:
    """Population constants of every peer cell from stored parts of it, at least one for each of its players.

    Deviations are taken around the cell's own mean, so nothing cancels.
    """
    means = parts.groupBy(*CELL).agg(*[
        (F.sum(F.col(n) * F.col(mean)) / F.sum(n)).alias(f"_c{mean}") for n, mean in (("_mn", "_mm"), ("_ln", "_lm"))])
    parts = join_keys(parts, means, CELL)

    def squares(n: str, mean: str, var: str) -> Column:
        return F.sum(F.col(n) * (F.col(var) + F.pow(F.col(mean) - F.col(f"_c{mean}"), 2)))

    def spread(n: str, ss: str) -> Column:
        return F.when(F.sum(n) > 1, F.sqrt(F.sum(ss) / (F.sum(n) - 1)))

    per_player = parts.groupBy(*CELL, *PLAYER).agg(
        *[F.sum(c).alias(c) for c in ("rounds", "turnover", "total_win", "n_win", "n_trigger", "beta_rounds", "_mn", "_ln")],
        squares("_mn", "_mm", "_mv").alias("_ms"), squares("_ln", "_lm", "_lv").alias("_ls"),
        F.max("_c_mm").alias("_c_mm"), F.max("_c_lm").alias("_c_lm"), F.max("max_multiple").alias("max_multiple"),
        F.min("first_round_utc").alias("first_round_utc"), F.max("last_round_utc").alias("last_round_utc"),
    )
    return per_player.groupBy(*CELL).agg(
        F.sum("rounds").alias("rounds"),
        F.count(F.lit(1)).alias("n_players"),
        F.sum("turnover").alias("turnover"),
        ratio(F.sum("total_win"), F.nullif(F.sum("turnover"), F.lit(0.0))).alias("rtp_emp"),
        spread("_mn", "_ms").alias("sigma_spin"),
        ratio(F.sum("n_win"), F.sum("rounds")).alias("p_hit"),
        ratio(F.sum("n_trigger"), F.sum("rounds")).alias("p_trigger"),
        F.sum("beta_rounds").alias("beta_rounds"),
        F.max("_c_lm").alias("mean_log_mult"),
        spread("_ln", "_ls").alias("sd_log_mult"),
        F.max("max_multiple").alias("max_multiple_observed"),
        F.min("first_round_utc").alias("first_round_utc"),
        F.max("last_round_utc").alias("last_round_utc"),
    )


def cell_constants(rounds: DataFrame) -> DataFrame:
    """Population constants of every peer cell.

    Moments are kept per (cell, player), stored once, and pooled, so a cell
    holding most rounds is reduced before it is gathered.
    """
    parts = rounds.groupBy(*CELL, *PLAYER).agg(
        F.count(F.lit(1)).alias("rounds"), F.sum("valid_bet").alias("turnover"), F.sum("win").alias("total_win"),
        _flag(F.col("win") > 0).alias("n_win"), _flag(F.col("triggered")).alias("n_trigger"),
        F.max(multiple()).alias("max_multiple"), *part_moments(),
        F.min("game_time").alias("first_round_utc"), F.max("game_time").alias("last_round_utc"),
    )
    return pool_cells(materialise(parts, "cell_players"))


def _cell_sums(prefix: str = "") -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rounds"),
        F.sum("valid_bet").alias("turnover"),
        F.sum("win").alias("total_win"),
        _flag(F.col("win") > 0).alias("n_win"),
        _flag(F.col("triggered")).alias("n_trigger"),
        F.sum(F.col("valid_bet") * F.col("valid_bet")).alias("sumsq_valid_bet"),
    ]


_CELL_MERGE = ["rounds", "turnover", "total_win", "n_win", "n_trigger", "sumsq_valid_bet"]


def cell_operator_constants(rounds: DataFrame) -> DataFrame:
    """Sums per peer cell and operator, for leave-operator-out baselines."""
    keys = CELL + ["parent"]
    per_player = rounds.groupBy(*keys, "uid").agg(*_cell_sums())
    return per_player.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _CELL_MERGE], F.count("uid").alias("n_players")
    )


def game_day_series(rounds: DataFrame) -> DataFrame:
    """Daily series per peer cell on the UTC event date."""
    keys = CELL + ["event_date"]
    per_player = rounds.groupBy(*CELL, F.to_date("game_time").alias("event_date"), *PLAYER).agg(
        *_cell_sums(),
        F.max("report_date").alias("report_date_utc8"),
        _flag(F.col("sm_v") == "feature_beta").alias("beta_rounds"),
        F.max("win").alias("max_round_win"),
    )
    return per_player.groupBy(*keys).agg(
        F.max("report_date_utc8").alias("report_date_utc8"),
        F.count(F.lit(1)).alias("n_players"),
        *[F.sum(c).alias(c) for c in _CELL_MERGE],
        F.sum("beta_rounds").alias("beta_rounds"),
        F.max("max_round_win").alias("max_round_win"),
    )


def cohort_game_profile(rounds: DataFrame, parent_like: str) -> DataFrame:
    """Per operator, game and play type: coverage, money and builds."""
    keys = ["parent", "game_id", "play_type", "currency"]
    fine = (
        rounds.where(F.col("parent").like(parent_like))
        .groupBy(*keys, "uid", "sm_tag", F.to_date("game_time").alias("_day"))
        .agg(
            F.count(F.lit(1)).alias("rounds"), F.sum("valid_bet").alias("turnover"),
            F.sum("win").alias("total_win"),
            F.sum(F.col("valid_bet") * F.col("valid_bet")).alias("sumsq_valid_bet"),
            F.min("game_time").alias("first_round_utc"), F.max("game_time").alias("last_round_utc"),
        )
    )
    return fine.groupBy(*keys).agg(
        F.sum("rounds").alias("rounds"),
        F.count_distinct("uid").alias("players"),
        F.count_distinct("_day").alias("active_days"),
        F.sum("turnover").alias("turnover"), F.sum("total_win").alias("total_win"),
        ratio(F.sum("total_win"), F.nullif(F.sum("turnover"), F.lit(0.0))).alias("rtp"),
        F.sum("sumsq_valid_bet").alias("sumsq_valid_bet"),
        F.count_distinct("sm_tag").alias("builds"),
        F.min("first_round_utc").alias("first_round_utc"),
        F.max("last_round_utc").alias("last_round_utc"),
    )


# --- drill-downs: every case at once, or one case after a filter -------------


def one_case(rounds: DataFrame, parent: str, uid: str, game_id: str | None = None) -> DataFrame:
    out = rounds.where((F.col("parent") == parent) & (F.col("uid") == uid))
    return out.where(F.col("game_id") == game_id) if game_id is not None else out


def case_daily(rounds: DataFrame) -> DataFrame:
    """Base-play totals per case (player, game) and day."""
    trig = F.col("triggered")
    return (
        rounds.where("play_type = 0")
        .groupBy("parent", "uid", "game_id", F.to_date("game_time").alias("event_date"))
        .agg(
            F.count(F.lit(1)).alias("rounds"), F.sum("valid_bet").alias("turnover"),
            F.sum("win").alias("total_win"), _flag(trig).alias("n_trigger"),
            F.avg(F.when(trig, F.col("bet"))).alias("avg_bet_trigger"),
            F.avg(F.when(~trig, F.col("bet"))).alias("avg_bet_no_trigger"),
            F.max(multiple()).alias("max_multiple"),
        )
    )


def case_bet_split(rounds: DataFrame) -> DataFrame:
    """Stake by trigger histogram per case, base play."""
    return (
        rounds.where("play_type = 0")
        .groupBy("parent", "uid", "game_id", "bet", "triggered")
        .agg(
            F.count(F.lit(1)).alias("rounds"), F.sum("win").alias("total_win"),
            F.sum("valid_bet").alias("turnover"),
        )
    )


def case_per_second(rounds: DataFrame) -> DataFrame:
    """Totals per player and active second."""
    return rounds.groupBy("parent", "uid", F.col("game_time").alias("sec_utc")).agg(
        F.count(F.lit(1)).alias("rounds"), F.sum("valid_bet").alias("turnover"),
        F.sum("win").alias("total_win"), _flag(F.col("triggered")).alias("n_trigger"),
        F.max(multiple()).alias("max_multiple"),
    )


def case_identity_breaks(rounds: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Only the rounds whose balance identity fails, with the gap."""
    return rounds.where(breaks_identity(t)).select(
        "parent", "uid", "game_seq_id", "game_time", "game_id", "play_type", "bet", "valid_bet",
        "win", "before_balance", "after_balance", identity_gap().alias("identity_gap"),
    )


# --- roll-ups of the daily table ---------------------------------------------


def rollup_daily(daily: DataFrame, through=None) -> DataFrame:
    """Cumulative player-cell totals from daily rows up to and including a day.

    Duplicate rounds and stake levels are per-day figures here: a round repeated
    on two days is not seen, and stake levels is the largest day.
    """
    if through is not None:
        daily = daily.where(F.col("event_date") <= F.lit(through).cast("date"))
    latest = F.max_by("top_win_seq_ids", F.struct("total_win", "event_date"))
    return daily.groupBy(*PLAYER_CELL).agg(
        *[F.sum(c).alias(c) for c in ADDITIVE],
        F.max("max_multiple").alias("max_multiple"),
        F.max("bet_levels_day").alias("bet_levels"),
        F.count(F.lit(1)).alias("active_days"),
        F.min("first_round_utc").alias("first_round_utc"),
        F.max("last_round_utc").alias("last_round_utc"),
        latest.alias("top_win_seq_ids"),
    )


def rollup_asof(baseline: DataFrame, increment: DataFrame) -> DataFrame:
    """Baseline totals full-outer-joined with a later increment."""
    b, i = baseline.alias("b"), increment.alias("i")
    same = F.lit(True)
    for k in PLAYER_CELL:
        same = same & F.col(f"b.{k}").eqNullSafe(F.col(f"i.{k}"))
    joined = b.join(i, same, "full")

    def both(c: str, f) -> Column:
        return f(F.col(f"b.{c}"), F.col(f"i.{c}")).alias(c)

    add = lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0))
    return joined.select(
        *[both(k, F.coalesce) for k in PLAYER_CELL],
        *[both(c, add) for c in ADDITIVE],
        both("active_days", add),
        both("max_multiple", F.greatest),
        both("bet_levels", F.greatest),
        both("first_round_utc", F.least),
        both("last_round_utc", F.greatest),
        both("top_win_seq_ids", lambda x, y: F.coalesce(y, x, F.lit(""))),
    )


def cell_operator_from_player_cell(player_cell: DataFrame) -> DataFrame:
    per_player = player_cell.groupBy(*CELL, "parent", "uid").agg(
        *[F.sum(c).alias(c) for c in _CELL_MERGE]
    )
    return per_player.groupBy(*CELL, "parent").agg(
        *[F.sum(c).alias(c) for c in _CELL_MERGE], F.count("uid").alias("n_players")
    )


def cell_day_from_daily(daily: DataFrame) -> DataFrame:
    return daily.groupBy(*CELL, "event_date").agg(
        *[F.sum(c).alias(c) for c in ("rounds", "total_win", "turnover", "n_trigger", "sumsq_valid_bet")]
    )


def per_player_buys(player_cell: DataFrame) -> DataFrame:
    """Totals per player and the share of turnover spent on feature purchases."""
    buy = F.col("play_type").isin(*FEATURE_BUY_TYPES)
    return player_cell.groupBy(*PLAYER).agg(
        F.sum("rounds").alias("rounds"),
        F.sum("turnover").alias("turnover"),
        F.sum(F.when(buy, F.col("turnover")).otherwise(0.0)).alias("buy_turnover"),
    ).withColumn("buy_share", ratio("buy_turnover", F.nullif(F.col("turnover"), F.lit(0.0))))


def subtract_half(end: DataFrame, mid: DataFrame, keys: list[str], additive: list[str]) -> DataFrame:
    """Second-half totals: cumulative(end) - cumulative(mid) of additive columns."""
    cols = [c for c in additive if c in end.columns and c in mid.columns]
    m = mid.select(*keys, *[F.col(c).alias(f"_mid_{c}") for c in cols])
    return join_keys(end.select(*keys, *cols), m, keys).select(
        *keys, *[(F.col(c) - F.coalesce(F.col(f"_mid_{c}"), F.lit(0))).alias(c) for c in cols]
    )


def widened_baseline(player_cell: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Baseline per cell, widened when thin: drop the build tag, then the currency.

    The level used is reported; ratios only survive the currency step, and the
    play type is never dropped.
    """
    def sums(keys: list[str], tag: str) -> DataFrame:
        return player_cell.groupBy(*keys).agg(
            F.sum("rounds").alias(f"_r{tag}"), F.sum("n_win").alias(f"_h{tag}"),
            F.sum("n_trigger").alias(f"_t{tag}"),
            F.sum("total_win").alias(f"_w{tag}"), F.sum("turnover").alias(f"_b{tag}"),
        )

    levels = [("0", CELL, "cell"), ("1", CELL[:3], "no_sm_tag"), ("2", CELL[:2], "no_currency_ratios_only")]
    out = sums(CELL, "0")
    for tag, keys, _ in levels[1:]:
        out = out.join(sums(keys, tag), keys, "left")
    def pick(num: str, den: str) -> Column:
        e = F.when(F.col("_r0") >= t.min_rounds, ratio(f"_{num}0", f"_{den}0"))
        e = e.when(F.col("_r1") >= t.min_rounds, ratio(f"_{num}1", f"_{den}1"))
        return e.when(F.col("_r2") >= t.min_rounds, ratio(f"_{num}2", f"_{den}2"))

    level = (
        F.when(F.col("_r0") >= t.min_rounds, "cell").when(F.col("_r1") >= t.min_rounds, "no_sm_tag")
        .when(F.col("_r2") >= t.min_rounds, "no_currency_ratios_only").otherwise("none")
    )
    return out.select(
        *CELL, level.alias("baseline_level"), pick("h", "r").alias("p_hit"),
        pick("t", "r").alias("p_trigger"), pick("w", "b").alias("rtp"),
    )
