"""Per-player timing: gaps, sessions, cadence, duty cycle and rate peaks.

A window over all rounds of one player would put a hot account in one task, so
rounds are windowed per (player, hour) and the hour boundaries are stitched
from one summary row per (player, hour). Later steps see at most a few dozen
rows per player and hour. Where the rounds of each player are known, only busy
players are taken so; the others have one window each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.functions.columns import join_keys, ratio
from tallyscope.settings import PLAYER, Thresholds
from tallyscope.sources.durable import materialise


def sequence_rounds(
    rounds: DataFrame, idle_s: int, *, keys: list[str] = PLAYER, carry: tuple[str, ...] = (), bucket: str = "HOUR"
) -> DataFrame:
    """Rounds with the gap to the previous round, game change and hour segment.

    Order is (game_time, serial) within the keys. A segment is the part of a
    session inside one hour; ``continues`` is true when it carries on a session
    of an earlier hour. ``bucket`` may be MINUTE when one account is so busy that
    an hour of it is too much for a task.
    """
    cols = list(dict.fromkeys([*keys, "game_time", "serial", "game_id", *carry]))
    part = [*keys, "hour_utc"]
    base = rounds.select(
        *cols, F.date_trunc(bucket, "game_time").cast("timestamp_ntz").alias("hour_utc")
    )
    summary = base.groupBy(*part).agg(F.max(F.struct("game_time", "serial", "game_id")).alias("_last"))
    by_player = Window.partitionBy(*keys).orderBy("hour_utc")
    edges = summary.select(*part, F.lag("_last").over(by_player).alias("_before"))
    in_hour = Window.partitionBy(*part).orderBy("game_time", "serial")
    previous = F.lag(F.struct("game_time", "serial", "game_id")).over(in_hour)
    seq = (
        base.withColumn("_in", previous)
        .join(edges, part, "left")
        .withColumn("_prev", F.coalesce("_in", "_before"))
        .withColumn("gap_s", F.timestamp_diff("SECOND", F.col("_prev.game_time"), F.col("game_time")))
        .withColumn("game_changed", F.col("game_id") != F.col("_prev.game_id"))
        .withColumn("_breaks", F.col("gap_s").isNull() | (F.col("gap_s") > idle_s))
    )
    opener = F.when(
        F.col("_in").isNull() | F.col("_breaks"),
        F.struct(F.col("game_time").alias("at"), (~F.col("_breaks")).alias("continues")),
    )
    running = in_hour.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        seq.withColumn("_seg", F.last(opener, ignorenulls=True).over(running))
        .withColumn("segment_start", F.col("_seg.at"))
        .withColumn("continues", F.col("_seg.continues"))
        .drop("_in", "_before", "_prev", "_breaks", "_seg")
    )


def number_sessions(segments: DataFrame, keys: list[str] = PLAYER) -> DataFrame:
    """Add ``session_no`` to segment rows: 1, 2, ... per player in time order."""
    w = Window.partitionBy(*keys).orderBy("segment_start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return segments.withColumn("session_no", F.sum(F.when(F.col("continues"), 0).otherwise(1)).over(w))


def sessionise(rounds: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Row-level sessions: each round with its gap and session number."""
    seq = sequence_rounds(rounds, t.session_idle_s, bucket=t.sequence_bucket)
    segments = number_sessions(seq.select(*PLAYER, "segment_start", "continues").distinct())
    return seq.join(segments.drop("continues"), [*PLAYER, "segment_start"]).drop(
        "hour_utc", "segment_start", "continues"
    )


def session_totals(rounds: DataFrame, t: Thresholds = Thresholds(), keys: list[str] = PLAYER) -> DataFrame:
    """One row per synthetic session: rounds, stake and winnings."""
    seq = sequence_rounds(rounds, t.session_idle_s, keys=keys, carry=("valid_bet", "win"), bucket=t.sequence_bucket)
    segments = seq.groupBy(*keys, "hour_utc", "segment_start", "continues").agg(
        F.count(F.lit(1)).alias("n"), F.sum("valid_bet").alias("stake"), F.sum("win").alias("won")
    )
    return number_sessions(segments, keys).groupBy(*keys, "session_no").agg(
        F.min("segment_start").alias("session_start"), F.sum("n").alias("n"),
        F.sum("stake").alias("stake"), F.sum("won").alias("won"),
    )


def is_hot_session(t: Thresholds, n="n", stake="stake", won="won") -> Column:
    return (
        (F.col(n) < t.hot_session_rounds) & (F.col(stake) > 0)
        & (F.col(won) > t.hot_session_ratio * F.col(stake))
    )


def modal_gaps(rounds: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Most frequent whole-second gap in [1, 30] per player; ties take the smallest."""
    seq = sequence_rounds(rounds, t.session_idle_s)
    counts = (
        seq.where(F.col("gap_s").between(1, t.modal_gap_max_s))
        .groupBy(*PLAYER, "gap_s").agg(F.count(F.lit(1)).alias("_n"))
    )
    best = F.max(F.struct(F.col("_n"), (-F.col("gap_s")).alias("_neg")))
    return counts.groupBy(*PLAYER).agg(best.alias("_b")).select(
        *PLAYER, (-F.col("_b._neg")).alias("modal_gap_s"), F.col("_b._n").alias("modal_count")
    )


def minute_peaks(rounds: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Highest number of rounds in a minute and minutes at superhuman rate."""
    minute = F.date_trunc("MINUTE", "game_time").alias("_minute")
    per_minute = rounds.groupBy(*PLAYER, minute).agg(F.count(F.lit(1)).alias("_n"))
    return per_minute.groupBy(*PLAYER).agg(
        F.max("_n").alias("max_rounds_per_minute"),
        F.count_if(F.col("_n") >= t.physical_rpm).alias("superhuman_minutes"),
    )


_CUBE = ["n", "stake", "won", "n_gaps", "same_second_gaps", "concurrent_rounds"]


def timing_cube(rounds: DataFrame, t: Thresholds = Thresholds(), earlier: DataFrame | None = None) -> DataFrame:
    """Counts per (player, hour, segment, gap class), reduced where the rounds already sit.

    Rows of different rounds add up. ``earlier`` holds the last round (PLAYER,
    game_time, serial, game_id) of players before these rounds; it gives the
    first gap and is not counted.
    """
    gap = F.col("gap_s")
    in_range = gap.between(1, t.modal_gap_max_s)
    rounds = rounds.select(*PLAYER, "game_time", "serial", "game_id", "valid_bet", "win", F.lit(True).alias("_own"))
    if earlier is not None:
        rounds = rounds.unionByName(earlier.select(
            *PLAYER, "game_time", "serial", "game_id", F.lit(None).cast("double").alias("valid_bet"),
            F.lit(None).cast("double").alias("win"), F.lit(False).alias("_own")))
    seq = sequence_rounds(rounds, t.session_idle_s, carry=("valid_bet", "win", "_own"), bucket=t.sequence_bucket)
    return seq.where("_own").groupBy(
        *PLAYER, "hour_utc", "segment_start", "continues",
        F.when(in_range, gap.cast("int")).otherwise(F.lit(0)).alias("gap_class"),
    ).agg(
        F.count(F.lit(1)).alias("n"), F.sum("valid_bet").alias("stake"), F.sum("win").alias("won"),
        F.count("gap_s").alias("n_gaps"),
        F.count_if(gap == 0).alias("same_second_gaps"),
        F.count_if((gap <= 0) & F.col("game_changed")).alias("concurrent_rounds"),
        F.max(F.when(gap <= t.gap_cap_s, gap)).alias("max_played_gap_s"),
        F.max("gap_s").alias("max_idle_s"),
    )


def player_timing(
    rounds: DataFrame, t: Thresholds = Thresholds(), *, min_rounds: int | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """One row of timing statistics per player.

    ``counted`` may hold the ``rounds`` of each player, in one row or several,
    as a stored table: players of at most ``whole_player_rounds`` are then taken
    whole, the others by hours.
    """
    if counted is None:
        return timing_of(timing_cube(rounds, t), minute_peaks(rounds, t), t, min_rounds=min_rounds)
    totals = counted.groupBy(*PLAYER).agg(F.sum("rounds").alias("_n"))
    busy = materialise(totals.where(F.col("_n") > t.whole_player_rounds).select(*PLAYER), "busy")
    if busy.isEmpty():  # the usual case
        return whole_timing(rounds, t, min_rounds=min_rounds)
    hours = player_timing(join_keys(rounds, busy, PLAYER, "left_semi"), t, min_rounds=min_rounds)
    return whole_timing(join_keys(rounds, busy, PLAYER, "left_anti"), t, min_rounds=min_rounds).unionByName(hours)


def whole_timing(rounds: DataFrame, t: Thresholds = Thresholds(), *, min_rounds: int | None = None) -> DataFrame:
    """The statistics of :func:`player_timing` with all rounds of a player in one window: one shuffle, by player."""
    floor = t.min_rounds if min_rounds is None else min_rounds
    in_order = Window.partitionBy(*PLAYER).orderBy("game_time", "serial")
    running = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    time, before, gap = F.col("game_time"), F.col("_before"), F.col("gap_s")
    first = F.col("_row") == 1

    def changes(unit) -> Column:
        return first | ~unit(time).eqNullSafe(unit(before))

    seq = (
        rounds.select(*PLAYER, "game_time", "serial", "game_id", "valid_bet", "win")
        .withColumns({"_row": F.row_number().over(in_order), "_before": F.lag("game_time").over(in_order),
                      "_game": F.lag("game_id").over(in_order)})
        .withColumn("gap_s", F.timestamp_diff("SECOND", before, time))
        .withColumn("opens", first | (gap.isNull() & time.isNotNull()) | F.coalesce(gap > t.session_idle_s, F.lit(False)))
        .withColumn("_minute", F.when(changes(lambda x: F.date_trunc("MINUTE", x)), F.col("_row")))
        .withColumn("new_day", changes(F.to_date) & time.isNotNull())
        .withColumns({"session_no": F.sum(F.col("opens").cast("int")).over(running),
                      "_minute": F.last("_minute", ignorenulls=True).over(running)})
        .select(
            *PLAYER, "session_no", "gap_s", "opens", "new_day", "valid_bet", "win", F.hour(time).alias("hour"),
            ((gap <= 0) & (F.col("game_id") != F.col("_game"))).alias("concurrent"),
            (F.col("_row") - F.col("_minute") + 1).alias("in_minute"))
    )
    session = Window.partitionBy(*PLAYER, "session_no")
    seq = seq.withColumns({"session_n": F.count(F.lit(1)).over(session), "session_stake": F.sum("valid_bet").over(session),
                           "session_won": F.sum("win").over(session)})
    in_range = gap.between(1, t.modal_gap_max_s)
    # few rows a player: the hours of the day times the gaps in range
    classes = seq.groupBy(*PLAYER, "hour", F.when(in_range, gap.cast("int")).otherwise(F.lit(0)).alias("gap_class")).agg(
        F.count(F.lit(1)).alias("n"), F.count("gap_s").alias("n_gaps"),
        F.count_if(gap == 0).alias("same_second_gaps"), F.count_if("concurrent").alias("concurrent_rounds"),
        F.max(F.when(gap <= t.gap_cap_s, gap)).alias("max_played_gap_s"), F.max("gap_s").alias("max_idle_s"),
        F.count_if("new_day").alias("active_days"),
        F.count_if(F.col("opens") & is_hot_session(t, "session_n", "session_stake", "session_won"))
        .alias("hot_small_sessions"),
        F.count_if("opens").alias("sessions"), F.max("in_minute").cast("bigint").alias("max_rounds_per_minute"),
        F.count_if(F.col("in_minute") == max(t.physical_rpm, 1)).alias("superhuman_minutes"),
    )
    classed = F.col("gap_class") > 0
    each = classes.groupBy(*PLAYER, "gap_class").agg(
        *[F.sum(c).alias(c) for c in ("n", "n_gaps", "same_second_gaps", "concurrent_rounds", "active_days",
                                      "hot_small_sessions", "sessions", "superhuman_minutes")],
        *[F.max(c).alias(c) for c in ("max_played_gap_s", "max_idle_s", "max_rounds_per_minute")],
        *[F.sum(F.when(F.col("hour") == h, F.col("n"))).alias(f"_h{h}") for h in range(24)],
    )
    stats = each.groupBy(*PLAYER).agg(
        F.sum("n").alias("rounds"), F.sum("n_gaps").alias("n_gaps"), F.sum("same_second_gaps").alias("same_second_gaps"),
        F.coalesce(F.sum(F.when(classed, F.col("n"))), F.lit(0)).alias("in_range_gaps"),
        F.max(F.when(classed, F.struct(F.col("n"), (-F.col("gap_class")).alias("neg")))).alias("_modal"),
        F.sum("concurrent_rounds").alias("concurrent_rounds"), F.max("max_played_gap_s").alias("max_played_gap_s"),
        F.max("max_idle_s").alias("max_idle_s"),
        F.array(*[F.coalesce(F.sum(f"_h{h}"), F.lit(0)) for h in range(24)]).alias("hour_profile"),
        F.sum("active_days").alias("active_days"), F.sum("hot_small_sessions").alias("hot_small_sessions"),
        F.sum("sessions").alias("sessions"), F.max("max_rounds_per_minute").alias("max_rounds_per_minute"),
        F.sum("superhuman_minutes").alias("superhuman_minutes"),
    ).where(F.col("rounds") >= floor)
    peaks = ["max_rounds_per_minute", "superhuman_minutes"]
    out = _with_modal(stats)
    return out.select(*[c for c in out.columns if c not in peaks], *peaks)


#: What metrics and halves of a window read of :func:`player_timing`; of these, counts add up.
PACE = ("rounds", "n_gaps", "same_second_gaps", "in_range_gaps", "modal_share", "concurrent_rounds", "max_rounds_per_minute")
_PACE_COUNTS = ("rounds", "n_gaps", "same_second_gaps", "in_range_gaps", "concurrent_rounds")


def player_pace(
    rounds: DataFrame, t: Thresholds = Thresholds(), *, min_rounds: int | None = None, counted: DataFrame, until: str | None = None,
) -> DataFrame:
    """The columns ``PACE`` of :func:`player_timing`, without stakes, sessions and hours.

    Rounds are shuffled once, by player, with their time, serial and game alone.
    ``counted`` is as there. ``until`` adds ``half_`` columns, the counts of rounds
    up to that time: these come first in the order, so their gaps are those of the whole.
    """
    floor = t.min_rounds if min_rounds is None else min_rounds
    totals = counted.groupBy(*PLAYER).agg(F.sum("rounds").alias("_n"))
    busy = materialise(totals.where(F.col("_n") > t.whole_player_rounds).select(*PLAYER), "busy")
    if busy.isEmpty():  # the usual case
        return _whole_pace(rounds, t, floor, until)
    rare = _whole_pace(join_keys(rounds, busy, PLAYER, "left_anti"), t, floor, until)
    many = join_keys(rounds, busy, PLAYER, "left_semi")
    often = player_timing(many, t, min_rounds=floor).select(*PLAYER, *PACE)
    if until is not None:
        half = player_timing(many.where(F.col("game_time") <= F.lit(until).cast("timestamp_ntz")), t, min_rounds=1)
        half = half.select(*PLAYER, *[F.col(c).alias(f"half_{c}") for c in _PACE_COUNTS])
        often = join_keys(often, half, PLAYER).fillna(0, [f"half_{c}" for c in _PACE_COUNTS])
    return rare.unionByName(often)


def _whole_pace(rounds: DataFrame, t: Thresholds, floor: int, until: str | None) -> DataFrame:
    in_order = Window.partitionBy(*PLAYER).orderBy("game_time", "serial")
    running = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    time, before, gap = F.col("game_time"), F.col("_before"), F.col("gap_s")
    minute = lambda x: F.date_trunc("MINUTE", x)
    early = F.lit(False) if until is None else F.coalesce(time <= F.lit(until).cast("timestamp_ntz"), F.lit(False))
    seq = (
        rounds.select(*PLAYER, "game_time", "serial", "game_id")
        .withColumns({"_row": F.row_number().over(in_order), "_before": F.lag("game_time").over(in_order),
                      "_game": F.lag("game_id").over(in_order)})
        .withColumn("gap_s", F.timestamp_diff("SECOND", before, time))
        .withColumn("_minute", F.when((F.col("_row") == 1) | ~minute(time).eqNullSafe(minute(before)), F.col("_row")))
        .withColumn("_minute", F.last("_minute", ignorenulls=True).over(running))
        .select(*PLAYER, gap, early.alias("early"), ((gap <= 0) & (F.col("game_id") != F.col("_game"))).alias("concurrent"),
                (F.col("_row") - F.col("_minute") + 1).alias("in_minute"))
    )
    in_range = F.when(gap.between(1, t.modal_gap_max_s), gap.cast("int")).otherwise(F.lit(0))
    each = seq.groupBy(*PLAYER, in_range.alias("gap_class"), "early").agg(
        F.count(F.lit(1)).alias("rounds"), F.count("gap_s").alias("n_gaps"), F.count_if(gap == 0).alias("same_second_gaps"),
        F.count_if("concurrent").alias("concurrent_rounds"), F.max("in_minute").cast("bigint").alias("max_rounds_per_minute"),
    ).withColumn("in_range_gaps", F.when(F.col("gap_class") > 0, F.col("rounds")).otherwise(F.lit(0).cast("bigint")))
    halves = [] if until is None else [
        F.coalesce(F.sum(F.when(F.col("early"), F.col(c))), F.lit(0)).alias(f"half_{c}") for c in _PACE_COUNTS]
    most = F.max("max_rounds_per_minute").alias("max_rounds_per_minute")
    classes = each.groupBy(*PLAYER, "gap_class").agg(*[F.sum(c).alias(c) for c in _PACE_COUNTS], *halves, most)
    modal = F.max(F.when(F.col("gap_class") > 0, F.col("rounds")))
    return classes.groupBy(*PLAYER).agg(
        *[F.sum(c).alias(c) for c in _PACE_COUNTS], modal.alias("_modal"), most,
        *([] if until is None else [F.sum(f"half_{c}").alias(f"half_{c}") for c in _PACE_COUNTS]),
    ).where(F.col("rounds") >= floor).select(
        *PLAYER, *[F.col(c) if c != "modal_share" else ratio("_modal", F.nullif(F.col("in_range_gaps"), F.lit(0))).alias(c) for c in PACE],
        *([] if until is None else [f"half_{c}" for c in _PACE_COUNTS]))


def half_pace(pace: DataFrame, floor: int) -> DataFrame:
    """Counts of the earlier half from the ``half_`` columns of :func:`player_pace`."""
    return pace.where(F.col("half_rounds") >= floor).select(*PLAYER, *[F.col(f"half_{c}").alias(c) for c in _PACE_COUNTS])


def _with_modal(stats: DataFrame) -> DataFrame:
    return (
        stats.withColumn("modal_gap_s", -F.col("_modal.neg"))
        .withColumn("modal_share", ratio(F.col("_modal.n"), F.nullif(F.col("in_range_gaps"), F.lit(0))))
        .withColumn("hours_of_day_covered",
                    F.size(F.filter("hour_profile", lambda x: x > 0)).cast("bigint"))
        .drop("_modal")
    )


def timing_of(
    cube: DataFrame, peaks: DataFrame, t: Thresholds = Thresholds(), *, min_rounds: int | None = None
) -> DataFrame:
    """Timing statistics per player from counts of :func:`timing_cube` and peaks of :func:`minute_peaks`."""
    floor = t.min_rounds if min_rounds is None else min_rounds
    sums = _CUBE
    segment = [F.col(c) for c in (*PLAYER, "hour_utc", "segment_start", "continues")]
    by_gap = [F.col(c) for c in (*PLAYER, "gap_class")]
    views = cube.groupingSets([segment, by_gap], *segment, F.col("gap_class")).agg(
        F.grouping("gap_class").alias("is_segment"),
        *[F.sum(c).alias(c) for c in sums],
        F.max("max_played_gap_s").alias("max_played_gap_s"),
        F.max("max_idle_s").alias("max_idle_s"),
    )
    seg = F.col("is_segment") == 1
    in_order = Window.partitionBy(*PLAYER).orderBy(F.asc_nulls_first("segment_start")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    whole = Window.partitionBy(*PLAYER, "session_no")
    opens = seg & ~F.coalesce(F.col("continues"), F.lit(True))
    numbered = views.withColumn("session_no", F.sum(opens.cast("int")).over(in_order))
    for c in ("n", "stake", "won"):
        numbered = numbered.withColumn(f"session_{c}", F.sum(F.when(seg, F.col(c))).over(whole))
    hour = F.hour("hour_utc")
    modal = F.max(
        F.when(~seg & (F.col("gap_class") > 0), F.struct(F.col("n"), (-F.col("gap_class")).alias("neg")))
    )
    total = lambda c: F.sum(F.when(seg, F.col(c)))
    stats = numbered.groupBy(*PLAYER).agg(
        total("n").alias("rounds"), total("n_gaps").alias("n_gaps"),
        total("same_second_gaps").alias("same_second_gaps"),
        F.coalesce(F.sum(F.when(~seg & (F.col("gap_class") > 0), F.col("n"))), F.lit(0)).alias("in_range_gaps"),
        modal.alias("_modal"),
        total("concurrent_rounds").alias("concurrent_rounds"),
        F.max("max_played_gap_s").alias("max_played_gap_s"),
        F.max("max_idle_s").alias("max_idle_s"),
        F.array(*[F.coalesce(F.sum(F.when(seg & (hour == h), F.col("n"))), F.lit(0)) for h in range(24)])
        .alias("hour_profile"),
        F.size(F.collect_set(F.to_date("hour_utc"))).cast("bigint").alias("active_days"),
        F.count_if(opens & is_hot_session(t, "session_n", "session_stake", "session_won"))
        .alias("hot_small_sessions"),
        F.count_if(opens).alias("sessions"),
    ).where(F.col("rounds") >= floor)
    return _with_modal(stats).join(peaks, PLAYER, "left")
