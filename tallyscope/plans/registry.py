"""Named queries over the provided tables, each with its plain-SQL counterpart.

A column specification such as ``"parent turnover:f first_round_utc:t"`` is
rendered on both sides, so Spark and SQL present values in the same form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _parts(spec: str) -> list[tuple[str, str]]:
    out = []
    for token in spec.split():
        name, _, kind = token.partition(":")
        out.append((name, kind))
    return out


def present(df: DataFrame, spec: str) -> DataFrame:
    """Select the listed columns, with floats rounded and times as text."""
    cols = []
    for name, kind in _parts(spec):
        c = F.col(name)
        if kind == "f":
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif kind == "i":
            c = c.cast("bigint")
        elif kind == "t":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "d":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind == "a":
            c = F.array_join(F.array_sort(c.cast("array<string>")), ",")
        elif kind == "o":
            c = F.array_join(c.cast("array<string>"), ",")
        cols.append(c.alias(name))
    return df.select(*cols)


def shown(spec: str, inner: str, ctes: str = "") -> str:
    """SQL counterpart of :func:`present` around an inner SELECT."""
    cols = []
    for name, kind in _parts(spec):
        if kind == "f":
            e = f"round(CAST({name} AS DOUBLE), 6) + 0.0"
        elif kind == "i":
            e = f"CAST({name} AS BIGINT)"
        elif kind == "t":
            e = f"strftime({name}, '%Y-%m-%d %H:%M:%S')"
        elif kind == "d":
            e = f"strftime({name}, '%Y-%m-%d')"
        elif kind == "a":
            e = f"array_to_string(list_sort({name}), ',')"
        elif kind == "o":
            e = f"array_to_string({name}, ',')"
        else:
            e = name
        cols.append(f"{e} AS {name}")
    head = f"WITH {ctes} " if ctes else ""
    return f"{head}SELECT {', '.join(cols)} FROM ({inner}) shown_"


def register(
    name: str,
    build: Callable[[SparkSession, str], DataFrame],
    spec: str,
    inner: str | None = None,
    ctes: str = "",
) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(spark, sf_dir), spec)

    run.__name__ = name
    QUERIES[name] = run
    if inner is not None:
        ORACLES[name] = shown(spec, inner, ctes)
