"""Fit thresholds on one window, freeze them, and validate on a later window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tallyscope.functions.columns import ratio
from tallyscope.functions.ranks import bh_cuts, robust_bounds
from tallyscope.settings import METRIC_RULES, SEGMENT_KEYS, Thresholds
from tallyscope.sources.snapshots import Snapshots

FROZEN_DDL = (
    "metric string, rule string, kind string, enabled boolean, branch string, bound double, "
    "ceiling_bound double, fdr_q double, min_lift double, min_effect_rtp_points double, "
    "train_eligible bigint, train_fire_rate double, note string"
)


def _z_policy(t: Thresholds) -> dict[str, tuple[float, float | None, float | None]]:
    return {
        "trigger_rate_z": (t.rate_fdr_q, t.rate_min_lift, None),
        "hit_rate_z": (t.rate_fdr_q, t.rate_min_lift, None),
        "excess_turnover_z": (t.excess_fdr_q, None, t.excess_min_points),
    }


def fit(metrics: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Frozen parameters, one row per metric.

    The capacity ceiling may raise a robust bound, never lower it. Several passes
    read ``metrics``: pass a persisted or stored table.
    """
    spark = metrics.sparkSession
    robust = metrics.where("kind = 'ROBUST'")
    fitted_rows = robust_bounds(
        robust, ["metric"], "value", t.n_mad, t.mad_min_members, quantile=1 - t.alert_ceiling).collect()
    bounds = {r["metric"]: r for r in fitted_rows}
    policy = _z_policy(t)
    rows = []
    for metric, (rule, _, kind, _) in METRIC_RULES.items():
        if kind == "ROBUST":
            fitted = bounds.get(metric)
            bound = fitted["bound"] if fitted else None
            ceiling = fitted["quantile"] if fitted else None
            final, note = bound, ""
            if bound is not None and ceiling is not None and ceiling > bound:
                final = ceiling
                note = f"evidence bound {bound:.5g} raised to the capacity quantile {ceiling:.5g}"
            rows.append((metric, rule, kind, final is not None,
                         fitted["branch"] if fitted else "insufficient_population",
                         final, ceiling, None, None, None, 0, 0.0, note))
        else:
            q, lift, points = policy[metric]
            rows.append((metric, rule, kind, True, "analytic_null+BH_FDR", None, None, q, lift, points, 0, 0.0, ""))
    draft = spark.createDataFrame(rows, FROZEN_DDL)
    seen = {
        r["metric"]: r
        for r in evaluate(metrics, draft).groupBy("metric")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("fired").alias("k")).collect()
    }
    done = []
    for r in rows:
        s = seen.get(r[0])
        n, k = (s["n"], s["k"]) if s else (0, 0)
        done.append((*r[:10], n, k / n if n else 0.0, r[12]))
    return spark.createDataFrame(done, FROZEN_DDL)


def evaluate(metrics: DataFrame, frozen: DataFrame) -> DataFrame:
    """Metric rows with ``fired``: above the bound, or selected by FDR and gates.

    FDR runs over the whole tested family before the effect gates.
    """
    params = frozen.select("metric", "enabled", "bound", "fdr_q", "min_lift", "min_effect_rtp_points")
    m = metrics.join(F.broadcast(params), "metric")
    cuts = bh_cuts(m.where("kind = 'Z'"), ["metric"], "value", F.col("fdr_q")).drop("m")
    m = m.join(F.broadcast(cuts), "metric", "left")
    selected = F.col("value") >= F.col("z_cut")
    lift_ok = F.col("min_lift").isNull() | F.col("lift").isNull() | (F.col("lift") >= F.col("min_lift"))
    points_ok = F.col("min_effect_rtp_points").isNull() | (
        F.col("effect_rtp_points") >= F.col("min_effect_rtp_points"))
    fired = F.when(F.col("kind") == "ROBUST", F.col("value") > F.col("bound")).otherwise(
        selected & lift_ok & points_ok)
    return m.withColumn("fired", F.coalesce(F.col("enabled") & fired, F.lit(False))).drop("z_cut")


def segment_rates(evaluated: DataFrame) -> DataFrame:
    """Eligible and fired entities per metric and population segment.

    ``segment_key = 'overall'`` carries the whole population of a metric.
    """
    pairs = F.array(
        F.struct(F.lit("overall").alias("key"), F.lit("all").alias("val")),
        *[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("val")) for k in SEGMENT_KEYS],
    )
    return (
        evaluated.where("enabled").select("metric", "fired", F.explode(pairs).alias("s"))
        .where("s.val IS NOT NULL")
        .groupBy("metric", F.col("s.key").alias("segment_key"), F.col("s.val").alias("segment_value"))
        .agg(F.count(F.lit(1)).alias("eligible"), F.count_if("fired").alias("n_fired"))
        .withColumn("rate", ratio("n_fired", "eligible"))
    )


def validate(metrics: DataFrame, frozen: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Segment rates with a ``breach`` label; see :func:`verdict`."""
    rates = segment_rates(evaluate(metrics, frozen))
    overall = F.col("segment_key") == "overall"
    limit = F.greatest(F.lit(t.alert_ceiling * t.segment_factor), 1.0 / F.col("eligible"))
    breach = (
        F.when(overall & (F.col("rate") > t.saturation_abort), "saturation")
        .when(overall & (F.col("rate") > t.alert_ceiling), "ceiling")
        .when(~overall & (F.col("eligible") >= t.min_segment) & (F.col("rate") > limit), "segment")
    )
    return rates.withColumn("breach", breach)


def verdict(validation: DataFrame) -> DataFrame:
    """One row: FAIL on saturation, WARN on any other breach, else PASS."""
    return validation.agg(
        F.when(F.coalesce(F.max((F.col("breach") == "saturation").cast("int")), F.lit(0)) == 1, "FAIL")
        .when(F.count("breach") > 0, "WARN").otherwise("PASS").alias("verdict"),
        F.count("breach").alias("breaches"),
    )


def _tables(spark: SparkSession, path: str) -> Snapshots:
    return Snapshots(spark, path, "version", IntegerType())


def write_frozen(frozen: DataFrame, validation: DataFrame, path: str, *, train_as_of: str,
                 validated_as_of: str) -> int:
    """Add the parameters and the verdict they were accepted with as the next version; returns its number."""
    v = verdict(validation).select(F.col("verdict").alias("validation_verdict"))
    rows = frozen.join(F.broadcast(v), F.lit(True), "left").select(
        "*", F.lit(train_as_of).alias("train_as_of"), F.lit(validated_as_of).alias("validated_as_of"))
    tables = _tables(frozen.sparkSession, path)
    base = tables.version()
    number = base.notes.get("newest", 0) + 1
    entries = tables.stage(rows.withColumn("version", F.lit(number)).coalesce(1), "frozen")
    tables.commit(base, [*base.entries, *entries], {"newest": number, "schema": rows.schema.jsonValue()})
    return number


def load_frozen(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Read a version of the frozen parameters, by default the newest; invents no defaults where there is none."""
    tables = _tables(spark, path)
    held = tables.version()
    number = held.notes.get("newest") if version is None else version
    if str(number) not in {e["part"] for e in held.of("frozen")}:
        raise FileNotFoundError(f"no frozen parameters at {path}; run a calibration before scanning")
    schema = StructType.fromJson(held.notes["schema"])
    return tables.read("frozen", schema, held, {str(number)}).drop("version")
