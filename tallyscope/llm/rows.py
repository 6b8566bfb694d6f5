"""Helpers shared by the operators: arrow schemas, key segments, tiles, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.sources.durable import materialise


def texts_of(batch, column: str = "text") -> list[str]:
    """Texts of an arrow batch; a null text counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def segments(frames: Iterator[pd.DataFrame], keys: list[str], limit: int = 200_000) -> Iterator[pd.DataFrame]:
    """Regroup frames sorted by ``keys`` so that no key straddles two of them.

    A frame is handed on once it ends a key and holds at most about ``limit``
    rows more than its last key; the caller bounds the rows of one key.
    """
    held: list[pd.DataFrame] = []
    rows = 0
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        rows += len(frame)
        if rows < limit:
            continue
        whole = pd.concat(held, ignore_index=True) if len(held) > 1 else frame
        last = whole[keys].to_numpy()
        same = (last == last[-1]).all(axis=1)
        cut = len(whole) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield whole.iloc[:cut]
        held = [whole.iloc[cut:]]
        rows = len(whole) - cut
    if rows:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]


def starts_of(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """First row of each key in a frame sorted by the keys, and its length at the end."""
    change = np.zeros(len(frame), dtype=bool)
    change[:1] = True
    for k in keys:
        v = frame[k].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), len(frame))


def tiled(rows: DataFrame, keys: list[str], member: str, size: int, counted: DataFrame | None = None) -> DataFrame:
    """Rows with ``tile``, ``tile_lo`` and ``tile_hi``, so that a large key is many bounded groups.

    A key of n rows has ceil(n / size) tiles by the hash of ``member``; a row goes
    to each pair of tiles that its own belongs to. Two members of a key meet in
    exactly one group (keys, tile_lo, tile_hi), which holds about 2 * size rows.
    ``counted`` may give the keys of the rows alone, where that is cheaper. The
    table of large keys is stored, so Spark knows whether it is small.
    """
    hot = (rows if counted is None else counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_")).where(F.col("n_") > size)
    hot = materialise(hot.select(*keys, F.ceil(F.col("n_") / size).cast("int").alias("n_tiles")), "hot")
    n = F.coalesce(F.col("n_tiles"), F.lit(1))
    tile = F.pmod(F.xxhash64(F.lit("tile"), F.col(member)), n).cast("int")
    out = rows.join(hot, keys, "left").withColumn("n_tiles", n).withColumn("tile", tile)
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)))
    return out.select(
        *rows.columns, "tile", F.least("tile", "other").alias("tile_lo"), F.greatest("tile", "other").alias("tile_hi")
    )


def local_components(adjacent: np.ndarray) -> np.ndarray:
    """Seed (a member's row) of each row's component in a dense symmetric matrix."""
    n = len(adjacent)
    seed = np.full(n, -1)
    for i in range(n):
        if seed[i] >= 0:
            continue
        seed[i] = i
        front = np.array([i])
        while len(front):
            new = adjacent[front].any(axis=0) & (seed < 0)
            front = np.flatnonzero(new)
            seed[front] = i
    return seed


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of ``a`` and ``b`` in an array of roots, in place; the smaller root stays."""
    while True:
        one, other = label[a], label[b]
        if (one == other).all():
            return
        np.minimum.at(label, np.maximum(one, other), np.minimum(one, other))
        while (label[label] != label).any():
            label[:] = label[label]


def components(edges: DataFrame) -> DataFrame:
    """Smallest id reachable from each id that has a link: columns ``id``, ``component_id``.

    ``edges`` has long columns ``u`` and ``v`` in any direction, repeats allowed.
    Alternates the large-star and small-star steps; each step's table is stored
    in the shared folder, and nothing but its count and checksum goes to the driver.
    """
    def signature(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    def least(df: DataFrame) -> DataFrame:
        return materialise(df.groupBy("u").agg(F.min("v").alias("m")), "least")

    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now = materialise(now, "edges")
    mark = signature(now)
    while True:
        both = now.union(now.select("v", "u"))
        low = least(both).select("u", F.least("u", "m").alias("m"))
        large = materialise(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        low = least(large)
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
        now = materialise(small.distinct(), "edges")
        seen, mark = mark, signature(now)
        if seen == mark:
            break
    roots = now.select(F.col("v").alias("id")).distinct().withColumn("component_id", F.col("id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(roots)
