"""Exact order statistics and Benjamini-Hochberg selection without one-task sorts.

Both collapse ties first (one row per distinct value), spread the distinct
values over bins, and order only inside a bin; bin offsets come from a small
table of bin totals. No group is ever collected or sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.functions.columns import join_keys
from tallyscope.functions.normal import normal_sf
from tallyscope.sources.durable import materialise

_BINS = 64
_ONE = "_one"


def value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return (
        df.select(*groups, v.alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy(*groups, "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )


def order_stats(
    df: DataFrame,
    groups: list[str],
    value: str,
    picks: dict[str, float | Column],
) -> DataFrame:
    """Per group: ``n`` and, for every pick, the linearly interpolated quantile.

    A pick is a probability, or a zero-based position given as a Column over ``n``.
    """
    keys = list(groups) or [_ONE]
    if not groups:
        df = df.withColumn(_ONE, F.lit(1))
    return _counted_stats(materialise(value_counts(df, keys, value), "values"), keys, picks).select(*groups, "n", *picks)


def _counted_stats(vc: DataFrame, keys: list[str], picks: dict[str, float | Column]) -> DataFrame:
    """``order_stats`` over stored distinct values ``_v`` with multiplicity ``_c``."""
    cuts = F.array(*[F.lit(i / _BINS) for i in range(1, _BINS)])
    # stored: a sketch depends on the order in which its parts arrive, and both readers below need the same edges
    edges = materialise(vc.groupBy(*keys).agg(
        F.percentile_approx("_v", cuts, 1000).alias("_edges"), F.sum("_c").alias("n")
    ), "edges")
    binned = join_keys(vc, edges, keys, "inner").withColumn(
        "_bin", F.size(F.filter("_edges", lambda e: e < F.col("_v")))
    ).drop("_edges")
    w_bins = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        binned.groupBy(*keys, "_bin")
        .agg(F.sum("_c").alias("_bc"), F.max("n").alias("n"))
        .withColumn("_start", F.coalesce(F.sum("_bc").over(w_bins), F.lit(0)))
    )
    pos = {}
    for name, p in picks.items():
        at = p if isinstance(p, Column) else F.lit(float(p)) * (F.col("n") - 1)
        pos[name] = (F.floor(at), F.ceil(at), at - F.floor(at))
    wanted = F.lit(False)
    for lo, hi, _ in pos.values():
        for at in (lo, hi):
            wanted = wanted | ((F.col("_start") <= at) & (at < F.col("_start") + F.col("_bc")))
    w_in = Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        join_keys(binned.drop("n"), totals.where(wanted).select(*keys, "_bin", "_start", "n"), keys + ["_bin"], "inner")
        .withColumn("_s", F.col("_start") + F.coalesce(F.sum("_c").over(w_in), F.lit(0)))
    )
    aggs = [F.max("n").alias("n")]
    for name, (lo, hi, _) in pos.items():
        for tag, at in (("lo", lo), ("hi", hi)):
            inside = (F.col("_s") <= at) & (at < F.col("_s") + F.col("_c"))
            aggs.append(F.max(F.when(inside, F.col("_v"))).alias(f"_{name}_{tag}"))
    out = ranked.groupBy(*keys).agg(*aggs)
    for name, (_, _, frac) in pos.items():
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out = out.withColumn(name, lo + (hi - lo) * frac)
    return out


def quantile_values(df: DataFrame, value: str, probs: list[float]) -> tuple[int, list[float | None]]:
    """Whole-table quantiles as driver scalars."""
    row = order_stats(df, [], value, {f"q{i}": p for i, p in enumerate(probs)}).first()
    if row is None:
        return 0, [None] * len(probs)
    return row["n"], [row[f"q{i}"] for i in range(len(probs))]


def robust_bounds(
    df: DataFrame, groups: list[str], value: str, n_mad: float, min_members: int,
    quantile: float | None = None,
) -> DataFrame:
    """Per group: (n, bound, branch) of the median + N*MAD rule.

    MAD = 0 falls back to the values above the median, then to their population
    standard deviation, then to no bound. ``quantile`` adds that quantile of the
    values. All steps are joins of per-group frames over distinct values with
    counts; nothing reaches the driver.
    """
    keys = list(groups) or [_ONE]
    if not groups:
        df = df.withColumn(_ONE, F.lit(1))
    vc = materialise(value_counts(df, keys, value), "values")
    picks: dict[str, float | Column] = {"med": 0.5}
    if quantile is not None:
        picks["quantile"] = quantile

    def spread(counted: DataFrame, centre: DataFrame, name: str) -> DataFrame:
        """Median distance from each group's centre ``_m``."""
        away = join_keys(counted, centre, keys, "inner").select(*keys, F.abs(F.col("_v") - F.col("_m")).alias("_v"), "_c")
        away = materialise(away.groupBy(*keys, "_v").agg(F.sum("_c").alias("_c")), "distances")
        return _counted_stats(away, keys, {name: 0.5}).drop("n")

    base = materialise(_counted_stats(vc, keys, picks), "medians")
    mad = spread(vc, base.select(*keys, F.col("med").alias("_m")), "mad")
    base = materialise(join_keys(base, mad, keys), "bounds")
    flat = base.where((F.col("mad") == 0) & (F.col("n") >= min_members)).select(*keys, F.col("med").alias("_m"))
    if flat.isEmpty():  # the usual case: no group needs the values above its median
        none = [F.lit(None).cast(k).alias(c) for c, k in (("nz_n", "bigint"), ("nz_med", "double"), ("nz_mad", "double"), ("nz_sd", "double"))]
        return _bounded(base.select("*", *none), groups, n_mad, min_members, quantile)
    upper = materialise(join_keys(vc, flat, keys, "inner").where("_v > _m").drop("_m"), "upper")
    nz = materialise(_counted_stats(upper, keys, {"nz_med": 0.5}).withColumnRenamed("n", "nz_n"), "upper_medians")
    nz_mad = spread(upper, nz.select(*keys, F.col("nz_med").alias("_m")), "nz_mad")
    mean = upper.groupBy(*keys).agg((F.sum(F.col("_c") * F.col("_v")) / F.sum("_c")).alias("_m"))
    nz_sd = join_keys(upper, mean, keys, "inner").groupBy(*keys).agg(
        F.sqrt(F.sum(F.col("_c") * (F.col("_v") - F.col("_m")) ** 2) / F.sum("_c")).alias("nz_sd"))
    out = join_keys(join_keys(join_keys(base, nz, keys), nz_mad, keys), nz_sd, keys)
    return _bounded(out, groups, n_mad, min_members, quantile)


def _bounded(out: DataFrame, groups: list[str], n_mad: float, min_members: int, quantile: float | None) -> DataFrame:
    """The rule of :func:`robust_bounds` over the statistics of each group."""
    few = F.col("n") < min_members
    usual = ~few & (F.col("mad") > 0)
    high = ~few & (F.col("nz_n") >= min_members)
    branch = (
        F.when(few, "insufficient_population").when(usual, "median+N*MAD")
        .when(high & (F.col("nz_mad") > 0), "MAD=0->nonzero median+N*MAD")
        .when(high & (F.col("nz_sd") > 0), "MAD=0->nonzero sd").otherwise("degenerate_disabled"))
    bound = (
        F.when(branch == "median+N*MAD", F.col("med") + n_mad * F.col("mad"))
        .when(branch == "MAD=0->nonzero median+N*MAD", F.col("nz_med") + n_mad * F.col("nz_mad"))
        .when(branch == "MAD=0->nonzero sd", F.col("nz_med") + n_mad * F.col("nz_sd")))
    extra = ["quantile"] if quantile is not None else []
    return out.select(*groups, "n", bound.alias("bound"), branch.alias("branch"), *extra)


def bh_cuts(df: DataFrame, family: list[str], z: str, q: Column | float) -> DataFrame:
    """Per family: (m, z_cut), the smallest z that Benjamini-Hochberg selects.

    Only p <= q can pass, so just that tail is ranked; equal z share the rank
    of the last of them, which is the textbook procedure under ties. A Column
    ``q`` may vary by family.
    """
    fam = list(family) or [_ONE]
    if not family:
        df = df.withColumn(_ONE, F.lit(1))
    q = q if isinstance(q, Column) else F.lit(float(q))
    base = df.select(*fam, F.col(z).cast("double").alias("_z"), q.alias("_q")).where(
        F.col("_z").isNotNull() & ~F.isnan("_z")
    )
    ties = base.groupBy(*fam, "_z").agg(F.count(F.lit(1)).alias("_c"), F.max("_q").alias("_q"))  # the tail is judged once a value
    sizes = ties.groupBy(*fam).agg(F.sum("_c").alias("m"), F.max("_q").alias("_q"))
    tail = (
        ties.where(normal_sf("_z") <= F.col("_q")).drop("_q")
        .withColumn("_bin", F.when(F.col("_z") < 40, F.floor(F.col("_z") * 64)).otherwise(
            64 * 40 + F.floor(F.log2(F.col("_z") / 40) * 64)))
    )
    above = Window.partitionBy(*fam).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    bins = (
        tail.groupBy(*fam, "_bin").agg(F.sum("_c").alias("_bc"))
        .withColumn("_above", F.coalesce(F.sum("_bc").over(above), F.lit(0)))
        .drop("_bc")
    )
    inside = Window.partitionBy(*fam, "_bin").orderBy(F.desc("_z")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = (
        tail.join(bins, fam + ["_bin"])
        .withColumn("_rank", F.col("_above") + F.sum("_c").over(inside))
        .join(sizes, fam)
        .where(normal_sf("_z") <= F.col("_q") * F.col("_rank") / F.col("m"))
    )
    cuts = ranked.groupBy(*fam).agg(F.min("_z").alias("z_cut"))
    return sizes.select(*fam, "m").join(cuts, fam, "left")


def bh_select(
    df: DataFrame, family: list[str], z: str, q: Column | float, out: str = "selected"
) -> DataFrame:
    """Mark the rows Benjamini-Hochberg selects within each family."""
    cuts = bh_cuts(df, family, z, q).drop("m")
    if family:
        joined = df.join(cuts, family, "left")
    else:
        joined = df.withColumn(_ONE, F.lit(1)).join(cuts, _ONE, "left").drop(_ONE)
    zc = F.col(z).cast("double")
    hit = ~F.isnan(zc) & (zc >= F.col("z_cut"))
    return joined.withColumn(out, F.coalesce(hit, F.lit(False))).drop("z_cut")


def volume_group(df: DataFrame, rounds: str = "rounds", by: list[str] | None = None) -> DataFrame:
    """Label rows low/mid/high by tertiles of ``rounds`` (right-closed).

    Collapsed edges give the single label ``all``.
    """
    by = list(by or [])
    edges = order_stats(
        df, by, rounds, {"_mn": 0.0, "_t1": 1 / 3, "_t2": 2 / 3, "_mx": 1.0}
    ).drop("n")
    if by:
        joined = df.join(edges, by, "left")
    else:
        joined = df.withColumn(_ONE, F.lit(1)).join(edges.withColumn(_ONE, F.lit(1)), _ONE, "left").drop(_ONE)
    r = F.col(rounds)
    distinct = (F.col("_mn") < F.col("_t1")) & (F.col("_t1") < F.col("_t2")) & (F.col("_t2") < F.col("_mx"))
    label = (
        F.when(~distinct, "all").when(r <= F.col("_t1"), "low")
        .when(r <= F.col("_t2"), "mid").otherwise("high")
    )
    return joined.withColumn("volume_group", label).drop("_mn", "_t1", "_t2", "_mx")
