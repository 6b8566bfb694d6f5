"""Intermediate tables in the shared folder the cluster provides."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_REMOVES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, as the cluster names it."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    return named


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a frame as a parquet table and read it back.

    The result has a one-step lineage, survives lost executors, and carries file
    sizes, so later joins broadcast it only when it is really small.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside remove their shuffle files then, not when the driver's memory is next cleaned."""
    before = spark.conf.get(_REMOVES, None)
    spark.conf.set(_REMOVES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVES)
        else:
            spark.conf.set(_REMOVES, before)
