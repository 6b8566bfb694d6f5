"""Behavioural rules per player, the distribution test, and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.columns import ratio, top_rounds
from tallyscope.functions.normal import normal_sf
from tallyscope.functions.ranks import bh_select, quantile_values, robust_bounds
from tallyscope.operators.timing import is_hot_session, number_sessions, sequence_rounds
from tallyscope.settings import FEATURE_BUY_TYPES, PLAYER, Thresholds

# Measure -> floor of its threshold.
FLOORS = {"buy_share": 0.03, "trigger_share": 0.05, "dup_share": 0.05, "same_second_share": 0.20}
MIN_WINS = 30


def repeated_outcomes(rounds: DataFrame, code: str | None = None) -> DataFrame:
    """Winning rounds per player that repeat an identical outcome."""
    keys = [*PLAYER, "win", "bet"] + ([code] if code else [])
    per = rounds.where("win > 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return per.groupBy(*PLAYER).agg(F.sum("_n").alias("dup_rounds"))


def player_behaviour(rounds: DataFrame, t: Thresholds = Thresholds(), code: str | None = None) -> DataFrame:
    """How a player plays: routing, triggers, gaps, sessions, repetition."""
    seq = sequence_rounds(
        rounds, t.session_idle_s, carry=("bet", "valid_bet", "win", "play_type", "triggered", "report_date"))
    g = F.col("gap_s")
    played = F.when(g.between(0, t.gap_cap_s), g)
    # (player, hour, segment, stake, game, business day) is small next to the rounds.
    seg = seq.groupBy(*PLAYER, "hour_utc", "segment_start", "continues", "bet", "game_id", "report_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("valid_bet").alias("stake"), F.sum("win").alias("won"),
        F.count_if(F.col("play_type").isin(*FEATURE_BUY_TYPES)).alias("buys"), F.count_if("triggered").alias("triggers"),
        F.count(played).alias("g_n"), F.sum(played).alias("g_s"), F.sum(played * played).alias("g_q"),
        F.count_if(g == 0).alias("same"), F.count("gap_s").alias("gaps"),
        F.min("game_time").alias("first_round"), F.max("game_time").alias("last_round"))
    stats = seg.groupBy(*PLAYER).agg(
        F.sum("n").alias("rounds"), F.sum("buys").alias("buys"), F.sum("triggers").alias("triggers"),
        F.count_distinct("bet").alias("bet_levels"), F.count_distinct("game_id").alias("games"),
        F.count_distinct("report_date").alias("days"),
        F.sum("g_n").alias("_gn"), F.sum("g_s").alias("_gs"), F.sum("g_q").alias("_gq"),
        F.sum("same").alias("_same"), F.sum("gaps").alias("_gaps"),
        F.min("first_round").alias("first_round"), F.max("last_round").alias("last_round"))
    parts = seg.groupBy(*PLAYER, "hour_utc", "segment_start", "continues").agg(
        F.sum("n").alias("n"), F.sum("stake").alias("stake"), F.sum("won").alias("won"))
    sessions = number_sessions(parts).groupBy(*PLAYER, "session_no").agg(
        F.sum("n").alias("n"), F.sum("stake").alias("stake"), F.sum("won").alias("won"))
    hot = sessions.groupBy(*PLAYER).agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if(is_hot_session(t)).alias("hot_small"))
    mean = ratio("_gs", F.nullif("_gn", F.lit(0)))
    var = (F.col("_gq") - F.col("_gn") * F.col("gap_mean") ** 2) / (F.col("_gn") - 1)
    return (
        stats.where(F.col("rounds") >= t.min_rounds)
        .withColumn("gap_mean", mean)
        .withColumn("gap_sd", F.when(F.col("_gn") > 1, F.sqrt(F.greatest(var, F.lit(0.0)))))
        .withColumn("same_second_share", F.coalesce(ratio("_same", F.nullif("_gaps", F.lit(0))), F.lit(0.0)))
        .drop("_gn", "_gs", "_gq", "_same", "_gaps")
        .join(hot, PLAYER, "left").join(repeated_outcomes(rounds, code), PLAYER, "left")
        .na.fill({"dup_rounds": 0, "hot_small": 0})
        .withColumn("buy_share", ratio("buys", "rounds")).withColumn("trigger_share", ratio("triggers", "rounds"))
        .withColumn("dup_share", ratio("dup_rounds", "rounds"))
    )


def with_top_wins(players: DataFrame, rounds: DataFrame) -> DataFrame:
    return players.join(top_rounds(rounds, PLAYER, k=10), PLAYER, "left")


def behaviour_thresholds(players: DataFrame, n_mad: float = 12.0) -> dict[str, tuple[float, str]]:
    """Robust threshold per measure, never below its floor.

    A collapsed MAD uses the nonzero part when it has 20 players, else the
    99.9 % quantile.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).cast("double").alias("v")) for k in FLOORS])
    long = players.select(F.explode(pairs).alias("m")).select(F.col("m.k").alias("k"), F.col("m.v").alias("v"))
    rows = {r["k"]: r for r in robust_bounds(long, ["k"], "v", n_mad, 1, quantile=0.999).collect()}
    upper = {}
    for k in FLOORS:
        r = rows.get(k)
        if r is not None and r["branch"] != "median+N*MAD":
            _, (med,) = quantile_values(long.where(F.col("k") == k), "v", [0.5])
            upper[k] = long.where((F.col("k") == k) & (F.col("v") > med)).count()
    out = {}
    for k, floor in FLOORS.items():
        r = rows.get(k)
        if r is None:
            continue
        if k in upper and upper[k] < 20:
            thr, how = r["quantile"], "MAD=0 -> p99.9"
        elif r["bound"] is None:  # the upper part is one repeated value
            _, (thr,) = quantile_values(long.where(F.col("k") == k), "v", [1.0])
            how = "MAD=0 -> constant upper part"
        else:
            thr, how = r["bound"], r["branch"]
        out[k] = (max(floor, thr), how)
    return out


def behaviour_rules(players: DataFrame, thresholds: dict[str, tuple[float, str]]) -> DataFrame:
    """Rules that fired per player."""
    c = F.col
    thr = {k: F.lit(float(v[0])) for k, v in thresholds.items()}
    busy = c("rounds") >= 500
    fired = F.array_compact(F.array(
        F.when(c("buy_share") >= thr["buy_share"], "BEH_1"),
        F.when(c("trigger_share") >= thr["trigger_share"], "BEH_2"),
        F.when((c("gap_sd") <= 1.0) & busy, "BEH_3"),
        F.when((c("same_second_share") >= thr["same_second_share"]) & busy, "BEH_3b"),
        F.when((c("dup_share") >= thr["dup_share"]) & (c("dup_rounds") >= 20), "BEH_4"),
        F.when(c("hot_small") >= 3, "BEH_5"),
    ))
    return players.withColumn("rules", fired).withColumn("n_rules", F.size("rules")).where("n_rules > 0")


# --- win-size distribution against the stated outcome table ---------------------


def band_moments(bands: DataFrame) -> DataFrame:
    """E[log x] and Var[log x] per outcome table over its winning bands.

    Bands (table_id, lo, hi, weight) are log-uniform, so both are exact.
    """
    a, b = F.ln("lo"), F.ln("hi")
    m = (a + b) / 2
    second = m * m + (b - a) * (b - a) / 12
    w = F.col("weight")
    g = bands.where("hi > 0 AND lo > 0").groupBy("table_id").agg(
        (F.sum(w * m) / F.sum(w)).alias("mean_log"), (F.sum(w * second) / F.sum(w)).alias("_second"))
    return g.select("table_id", "mean_log", (F.col("_second") - F.col("mean_log") ** 2).alias("var_log"))


def distribution_test(
    outcomes: DataFrame, moments: DataFrame, q: float = 0.05, min_wins: int = MIN_WINS, min_shift: float = 1.10
) -> DataFrame:
    """Per player z of the mean log win multiple; inflation only.

    ``outcomes`` are winning rounds (parent, uid, table_id, outcome_x).
    """
    per = outcomes.where("outcome_x > 0").groupBy(*PLAYER, "table_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.ln("outcome_x")).alias("_s"))
    g = per.join(moments, "table_id").groupBy(*PLAYER).agg(
        F.sum("_n").alias("n_wins"), F.sum("_s").alias("_s"), F.sum(F.col("_n") * F.col("mean_log")).alias("_e"),
        F.sum(F.col("_n") * F.col("var_log")).alias("_v"))
    tested = g.where((F.col("n_wins") >= min_wins) & (F.col("_v") > 0)).select(
        *PLAYER, "n_wins", ((F.col("_s") - F.col("_e")) / F.sqrt("_v")).alias("z"),
        F.exp((F.col("_s") - F.col("_e")) / F.col("n_wins")).alias("shift"))
    out = bh_select(tested, [], "z", q).withColumn("p_value", normal_sf("z"))
    return out.withColumn("selected", F.col("selected") & (F.col("z") > 0) & (F.col("shift") >= min_shift))


def rtp_screen(daily: DataFrame, min_rounds: int = 200, min_rtp: float = 1.05) -> DataFrame:
    """Players whose return over the daily totals is high enough to test.

    Totals count at four decimals, those of money in the source, so that the
    order in which days were added decides neither the return nor the screen.
    """
    g = daily.groupBy(*PLAYER).agg(
        F.sum("rounds").alias("rounds"), F.sum("turnover").alias("turnover"), F.sum("total_win").alias("total_win"),
        F.count_distinct("event_date").alias("days"), F.count_distinct("game_id").alias("games"))
    g = g.where((F.col("rounds") >= min_rounds) & (F.col("turnover") > 0)).withColumn(
        "rtp", ratio(F.round("total_win", 4), F.round("turnover", 4)))
    return g.where(F.col("rtp") >= min_rtp)


# --- fusing directions and scoring against labels ----------------------------------


def fuse_directions(**directions: DataFrame) -> DataFrame:
    """Players flagged by any direction; two or more corroborate."""
    frames = [d.select(*PLAYER, F.lit(name).alias("direction")) for name, d in directions.items()]
    every = frames[0]
    for f in frames[1:]:
        every = every.unionByName(f)
    return every.groupBy(*PLAYER).agg(
        F.array_sort(F.collect_set("direction")).alias("directions")).withColumn(
        "n_directions", F.size("directions")).withColumn("corroborated", F.col("n_directions") >= 2)


def score(flagged: DataFrame, labels: DataFrame, population: DataFrame) -> DataFrame:
    """Recall, precision and false positives against (parent, uid, case_type, is_decoy)."""
    f = flagged.select(*PLAYER).distinct().withColumn("_f", F.lit(True))
    every = population.select(*PLAYER).distinct().join(labels, PLAYER, "full").join(f, PLAYER, "left")
    real = F.col("case_type").isNotNull() & ~F.coalesce("is_decoy", F.lit(False))
    decoy = F.coalesce("is_decoy", F.lit(False))
    hit = F.coalesce("_f", F.lit(False))
    honest = ~real & ~decoy
    return every.agg(
        F.count_if(real).alias("labelled"), F.count_if(real & hit).alias("true_positives"),
        F.count_if(honest & hit).alias("false_positives"), F.count_if(decoy & hit).alias("decoys_flagged"),
        F.count_if(honest).alias("honest"),
    ).withColumns({
        "recall": ratio("true_positives", F.nullif("labelled", F.lit(0))),
        "precision": ratio("true_positives", F.nullif(F.col("true_positives") + F.col("false_positives"), F.lit(0))),
        "false_positive_rate": ratio("false_positives", F.nullif("honest", F.lit(0))),
    })


def score_by_type(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    f = flagged.select(*PLAYER).distinct().withColumn("_f", F.lit(True))
    return labels.where(~F.col("is_decoy")).join(f, PLAYER, "left").groupBy("case_type").agg(
        F.count("_f").alias("hit"), F.count(F.lit(1)).alias("total"))
