"""Running totals in the order of a key, and copies of counted rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.sources.durable import materialise

COPY_BLOCK = 65536


def running(rows: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """Rows with ``before``, the sum of ``value`` over earlier rows of their group, and ``total``, the group's sum.

    No task holds a whole group: rows are dealt by range of (group, order), summed
    inside a range, and shifted by the sums of the ranges before, of which there
    are as many as partitions. ``group`` and ``order`` hold no nulls, and no two
    rows of a group are equal in ``order``.
    """
    ranged = rows.repartitionByRange(*group, *order).withColumn("range_", F.spark_partition_id())
    ranged = materialise(ranged, "ranged")
    sums = ranged.groupBy(*group, "range_").agg(F.sum(value).alias("sum_"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *group, "range_", F.coalesce(F.sum("sum_").over(earlier), F.lit(0)).alias("shift_"), F.sum("sum_").over(whole).alias("total")
    )
    inside = Window.partitionBy(*group, "range_").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(materialise(sums, "shifts"), [*group, "range_"]).select(
        *rows.columns, (F.col("shift_") + F.coalesce(F.sum(value).over(inside), F.lit(0))).alias("before"), "total"
    )


def copies(rows: DataFrame, n: str, place: str) -> DataFrame:
    """Each row ``n`` times, numbered from 0 in ``place``; arrays stay short however large ``n`` is."""
    last = F.floor((F.col(n) - 1) / COPY_BLOCK).cast("long")
    blocks = rows.withColumn("block_", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    end = F.least(F.col(n).cast("long"), (F.col("block_") + 1) * COPY_BLOCK) - 1
    return blocks.withColumn(place, F.explode(F.sequence(F.col("block_") * COPY_BLOCK, end))).drop("block_")
