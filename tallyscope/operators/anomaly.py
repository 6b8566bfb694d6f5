"""Unsupervised discovery: isolation forest over per-player features.

Trees see at most a few hundred sampled rows each and grow in parallel; the
grown trees have a size fixed by (trees, sample) and score all players in
Arrow batches. Output is "unusual", never "risky".
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.columns import join_keys, ratio
from tallyscope.functions.ranks import quantile_values, volume_group
from tallyscope.functions.signals import signals
from tallyscope.functions.tasks import depth_norm, grow_tree
from tallyscope.settings import CELL, FEATURE_BUY_TYPES, PLAYER, Thresholds
from tallyscope.sources.durable import materialise

FEATURES = [
    "buy_share_turnover", "trigger_rate", "hit_rate", "rtp", "same_second_share", "modal_share",
    "hours_of_day_covered", "log_rounds", "bet_levels", "balance_violations",
]
_CONTEXT = ["game_id", "currency"]


def player_features(player_cell: DataFrame, timing: DataFrame) -> DataFrame:
    """Ten behavioural features per player; the first cell in key order, nulls last, names its context."""
    buy = F.col("play_type").isin(*FEATURE_BUY_TYPES)
    zero = F.lit(0.0)
    cell = F.struct(*[x for c in CELL for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))])
    f = player_cell.groupBy(*PLAYER).agg(
        F.sum("rounds").alias("rounds"), F.sum("turnover").alias("turnover"), F.sum("total_win").alias("_win"),
        F.sum("n_win").alias("_hits"), F.sum("n_trigger").alias("_triggers"),
        F.max("bet_levels").cast("double").alias("bet_levels"),
        F.sum("balance_violations").cast("double").alias("balance_violations"),
        F.sum(F.when(buy, F.col("turnover")).otherwise(0.0)).alias("_buy"),
        F.min(cell).alias("_cell"),
    )
    t = timing.select(*PLAYER, "n_gaps", "same_second_gaps", "modal_share", "hours_of_day_covered")
    f = f.join(t, PLAYER, "left")
    return f.select(
        *PLAYER, "rounds", "_cell.game_id", "_cell.currency", "_cell.sm_tag",
        ratio("_buy", F.nullif("turnover", zero)).alias("buy_share_turnover"),
        ratio("_triggers", "rounds").alias("trigger_rate"), ratio("_hits", "rounds").alias("hit_rate"),
        ratio("_win", F.nullif("turnover", zero)).alias("rtp"),
        F.coalesce(ratio("same_second_gaps", F.nullif("n_gaps", F.lit(0))), zero).alias("same_second_share"),
        F.coalesce("modal_share", zero).alias("modal_share"),
        F.coalesce(F.col("hours_of_day_covered").cast("double"), zero).alias("hours_of_day_covered"),
        F.log10(F.greatest(F.col("rounds"), F.lit(1)).cast("double")).alias("log_rounds"),
        "bet_levels", "balance_violations",
    )


def normalised(features: DataFrame) -> DataFrame:
    """z scores within (game, currency), null a value like any other; zero spread or a missing value gives 0."""
    features = materialise(features, "raw_features")
    moments = features.groupBy(*_CONTEXT).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in FEATURES], *[F.stddev_samp(c).alias(f"_s_{c}") for c in FEATURES])
    j = join_keys(features, moments, _CONTEXT)
    z = lambda c: F.coalesce(
        ratio(F.col(c) - F.col(f"_m_{c}"), F.nullif(F.col(f"_s_{c}"), F.lit(0.0))), F.lit(0.0))
    return j.select(*PLAYER, "rounds", *_CONTEXT, "sm_tag", *[z(c).alias(c) for c in FEATURES])


def forest_scores(z: DataFrame, t: Thresholds, n_players: int) -> DataFrame:
    """Add ``score`` in (0, 1]; higher is more isolated."""
    spark = z.sparkSession
    sample = min(t.forest_sample, n_players)
    # Each tree draws about twice its sample by hash, then keeps the lowest ranks.
    keep = min(1.0, 2.0 * sample / max(n_players, 1))
    space = 1 << 31
    draws = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(t.forest_trees - 1)),
            lambda k: F.struct(k.alias("tree"), F.pmod(
                F.xxhash64(F.lit(t.forest_seed), k, F.col("parent"), F.col("uid")), F.lit(space)).alias("rank"))),
        lambda d: d["rank"] < int(keep * space),
    )
    drawn = z.select(*FEATURES, F.explode(draws).alias("_d")).select("_d.tree", "_d.rank", *FEATURES)
    limit = int(np.ceil(np.log2(max(sample, 2))))
    seed, feats = t.forest_seed, list(FEATURES)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rank", *feats]).head(sample)
        tree = int(pdf["tree"].iloc[0])
        nodes = grow_tree(pdf[feats].to_numpy(float), np.random.default_rng([seed, tree]), limit)
        out = pd.DataFrame(nodes, columns=["axis", "cut", "left", "right", "depth"])
        out.insert(0, "tree", tree)
        out.insert(1, "node", range(len(out)))
        return out

    nodes = drawn.groupBy("tree").applyInPandas(
        grow, "tree int, node int, axis int, cut double, left int, right int, depth double").toPandas()
    trees = [
        tuple(g.sort_values("node")[c].to_numpy() for c in ("axis", "cut", "left", "right", "depth"))
        for _, g in nodes.groupby("tree")
    ]
    model = spark.sparkContext.broadcast((trees, depth_norm(sample)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grown, norm = model.value
        for pdf in batches:
            x = pdf[feats].to_numpy(float)
            total = np.zeros(len(x))
            rows = np.arange(len(x))
            for axis, cut, left, right, depth in grown:
                at = np.zeros(len(x), dtype=int)
                while True:
                    inner = axis[at] >= 0
                    if not inner.any():
                        break
                    r, a = rows[inner], at[inner]
                    go_left = x[r, axis[a]] <= cut[a]
                    at[inner] = np.where(go_left, left[a], right[a])
                total += depth[at]
            pdf["score"] = np.power(2.0, -total / max(len(grown), 1) / max(norm, 1e-9))
            yield pdf

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in z.schema.fields) + ", score double"
    return z.mapInPandas(score, ddl)


def flagged(scored: DataFrame, contamination: float) -> DataFrame:
    """Mark the players above the (1 - contamination) quantile of the score."""
    _, (cut,) = quantile_values(scored, "score", [1.0 - contamination])
    return scored.withColumn("flag", F.col("score") > F.lit(cut))


def segment_gate(flags: DataFrame, t: Thresholds, contamination: float) -> DataFrame:
    """Flag rate per segment; ``concentrated`` rejects the whole model output."""
    keys = ("game_id", "currency", "sm_tag", "parent", "volume_group")
    pairs = F.array(F.struct(F.lit("overall").alias("k"), F.lit("all").alias("v")),
                    *[F.struct(F.lit(k).alias("k"), F.col(k).cast("string").alias("v")) for k in keys])
    rates = (
        volume_group(flags).select("flag", F.explode(pairs).alias("s")).where("s.v IS NOT NULL")
        .groupBy(F.col("s.k").alias("segment_key"), F.col("s.v").alias("segment_value"))
        .agg(F.count(F.lit(1)).alias("players"), F.avg(F.col("flag").cast("double")).alias("rate"))
    )
    overall = rates.where("segment_key = 'overall'").select(F.col("rate").alias("overall_rate"))
    limit = 10.0 * F.greatest(F.col("overall_rate"), F.lit(contamination))
    return rates.join(F.broadcast(overall), F.lit(True), "left").withColumn(
        "concentrated", (F.col("segment_key") != "overall") & (F.col("players") >= t.min_segment)
        & (F.col("overall_rate") > 0) & (F.col("rate") > limit))


def discovery_signals(flags: DataFrame, rule_flagged: DataFrame) -> DataFrame:
    """Signals only for flagged players that no rule touched."""
    fresh = flags.where("flag").join(rule_flagged.select(*PLAYER).distinct(), PLAYER, "left_anti")
    return signals(
        fresh, signal_id="L3-ML_DISCOVERY", family="ML_DISCOVERY", layer=3, grain="player",
        game_id=None, sm_tag=None, metric="isolation_score", value=F.col("score"),
        threshold_method="ISOLATION_FOREST", baseline_source="none",
        description=F.lit("unusual by an unsupervised model; unusual does not mean risky"))


def discover(
    player_cell: DataFrame, timing: DataFrame, rule_flagged: DataFrame, t: Thresholds = Thresholds(),
    contamination: float | None = None,
) -> tuple[DataFrame, str]:
    """(signals, verdict). A failed segment gate emits nothing (FAIL), nor do fewer than
    ``forest_min_players`` players, on whom the gate means nothing (NOT_EVALUATED)."""
    from tallyscope.schema import SIGNAL

    rate = t.forest_contamination if contamination is None else contamination
    spark = player_cell.sparkSession
    z = materialise(normalised(player_features(player_cell, timing)), "features")
    n = z.count()
    if n < t.forest_min_players:
        return spark.createDataFrame([], SIGNAL), "NOT_EVALUATED"
    flags = flagged(materialise(forest_scores(z, t, n), "scores"), rate)
    if segment_gate(flags, t, rate).where("concentrated").limit(1).count():
        return spark.createDataFrame([], SIGNAL), "FAIL"
    return discovery_signals(flags, rule_flagged), "PASS"
