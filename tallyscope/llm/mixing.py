"""Mixing sources to target weights along a curriculum whose weights change with time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.llm.orders import copies, running
from tallyscope.sources.durable import materialise

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
#: For each weight, what its share is multiplied by at equally spaced times from 0 to 1, linear between them.
SCHEDULE = ((0.5, 1.0, 1.5), (1.0, 1.0, 1.0), (1.5, 1.0, 0.5))
WORD = r"[^\x20\x09-\x0D]+"


def integral(knots: tuple[float, ...]) -> list[float]:
    """What a schedule has demanded at each of its knots, of one in all."""
    out = [0.0]
    for a, b in zip(knots, knots[1:]):
        out.append(out[-1] + (a + b) / 2)
    return [x / out[-1] for x in out]


def _time(demand: Column, knots: tuple[float, ...]) -> Column:
    """Time at which a schedule has demanded this part of its whole: the inverse of its integral."""
    done, step = integral(knots), 1.0 / (len(knots) - 1)
    scale = sum((a + b) / 2 * step for a, b in zip(knots, knots[1:]))
    out = None
    for k in reversed(range(len(knots) - 1)):
        rate, slope = knots[k] / scale, (knots[k + 1] - knots[k]) / scale / step
        rest = demand - F.lit(done[k])
        inside = F.when(rest <= 0, F.lit(0.0)).otherwise(rest * 2.0 / (F.sqrt(rest * (2.0 * slope) + rate * rate) + rate))
        here = inside + k * step
        out = here if out is None else F.when(demand < done[k + 1], here).otherwise(out)
    return F.least(out, F.lit(1.0))


def time_of(demand: Column, schedule: Column, schedules=SCHEDULE) -> Column:
    """As :func:`_time`, with the schedule chosen by its number."""
    out = F.lit(None).cast("double")
    for i, knots in enumerate(schedules):
        out = F.when(schedule == i, _time(demand, knots)).otherwise(out)
    return out


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Sources (``unknown``, ``source``, ``words``) with ``schedule``, the number of their weight, and ``target``.

    The level is raised from what weights alone give: sources above ``most``
    times their size stop there, and the rest shares what is left, until no
    further source is above. Each step is one sum over the sources; the level
    only rises, by at least the share of a source, and few steps are needed.
    """
    ordered = running(sizes.withColumn("all", F.lit(0)).withColumn("one", F.lit(1)), ["all"], ["unknown", "source"], "one")
    place = F.col("before") % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int")).cast("double")
    ordered = materialise(ordered.select("unknown", "source", "words", place.cast("int").alias("schedule"), weight.alias("weight")), "sources")
    whole = ordered.agg(F.sum("words"), F.sum("weight")).first()
    words, rest, shared = whole[0] or 0, whole[0] or 0, whole[1] or 1.0
    while True:
        share = F.col("weight") * float(rest) / float(shared)
        full = share > F.col("words") * most
        step = ordered.agg(F.sum(F.when(full, F.col("words") * most).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        now = words - (step[0] or 0), step[1] or shared
        if now == (rest, shared):
            break
        rest, shared = now
    return ordered.withColumn("target", F.when(full, (F.col("words") * most).cast("double")).otherwise(share))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, schedules=SCHEDULE) -> DataFrame:
    """Every document with the words that the mix takes of it and the times at which it is played.

    A source's documents stand in the order of their digest, over and over, and
    the mix takes them up to the source's target: whole, but for the last, which
    is cut there. The words taken before a play, as a part of the target, are
    the demand met so far; the time at which the integral of the source's
    schedule reaches that demand is the play's time. ``plays`` lists (turn, at,
    words), and rows come in order of their first time, those not taken last.

    Sums within a source are taken by ranges of digests, so no task holds a
    source; equal rows are counted and placed as one. Null text: size 0, never
    taken. Null sources are one source, the last. Repeated rows are documents of
    their own. The same rows give the same result in any order. An empty table
    gives no rows. Other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    mark = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").isNull().alias("unknown"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), mark.alias("mark"),
    )
    counted = rows.groupBy("unknown", "source", "doc_id", "size", "mark").agg(F.count(F.lit(1)).alias("n"))
    counted = running(counted.withColumn("words", F.col("size") * F.col("n")), ["unknown", "source"], ["mark"], "words")
    counted = materialise(counted, "counted")
    shares = targets(counted.groupBy("unknown", "source").agg(F.sum("words").alias("words")), weights, most)
    placed = copies(counted.drop("words"), "n", "copy").join(shares.drop("words"), ["unknown", "source"])
    budget = F.floor(F.col("target") + 0.5)

    def play(turn):
        start = turn * F.col("total") + F.col("before") + F.col("copy") * F.col("size")
        at = time_of(F.try_divide(start.cast("double"), F.col("target")), F.col("schedule"), schedules)
        return F.struct(turn.cast("int").alias("turn"), at.alias("at"), F.least(F.col("size"), budget - start).alias("words"))

    plays = F.filter(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(most - 1).cast("long")), play), lambda p: p["words"] > 0)
    out = placed.withColumn("plays", plays).select(
        "doc_id", "size", F.col("total").alias("source_size"), "target",
        F.aggregate("plays", F.lit(0).cast("long"), lambda a, p: a + p["words"]).alias("taken"),
        F.when(~F.col("unknown"), F.col("source")).alias("source"), F.size("plays").alias("n_plays"),
        F.try_element_at(F.col("plays.at"), F.lit(1)).alias("first_at"),
        "plays", "mark",
    )
    return out.orderBy(F.col("first_at").asc_nulls_last(), "mark").drop("mark")


def curriculum(docs: DataFrame, **options) -> DataFrame:
    """The training run itself: one row a play, in order of its time."""
    plays = mix(docs, **options).select("doc_id", "source", F.explode("plays").alias("play")).select("doc_id", "source", "play.*")
    return plays.orderBy("at", "source", "turn", "doc_id")
