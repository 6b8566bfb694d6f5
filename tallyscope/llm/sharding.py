"""Sharding over fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyscope.sources.durable import materialise, shared_dir

N_SLOTS = 8192


@dataclass(frozen=True)
class SlotMap:
    """Shard of each virtual slot; a new version changes only the slots that moved."""

    version: int
    n_shards: int
    shard: tuple[int, ...]

    def moved_to(self, shard: np.ndarray, n_shards: int) -> "SlotMap":
        return SlotMap(self.version + 1, n_shards, tuple(int(x) for x in shard))


def first_map(n_shards: int, n_slots: int = N_SLOTS) -> SlotMap:
    """Version 0: equal runs of slots."""
    return SlotMap(0, n_shards, tuple(i * n_shards // n_slots for i in range(n_slots)))


def rebalance(current: SlotMap, slot_bytes: np.ndarray, max_edits: int | None = None) -> SlotMap:
    """Next version: slots move, or change places, between the fullest and the emptiest shard.

    Each edit takes the slot, or the pair of slots, whose difference comes closest
    to half of the gap, and edits go on while the gap between the two shrinks.
    ``max_edits`` (default: none) spreads a large change over several versions.
    """
    shard = np.array(current.shard)
    load = np.bincount(shard, weights=slot_bytes, minlength=current.n_shards)
    edits = 0
    while current.n_shards > 1 and (max_edits is None or edits < max_edits):
        top, low = int(load.argmax()), int(load.argmin())
        gap = load[top] - load[low]
        a = np.flatnonzero(shard == top)
        b = np.flatnonzero(shard == low)
        b = b[np.argsort(slot_bytes[b], kind="stable")]
        give = np.append(0.0, slot_bytes[b])  # what comes back; 0 is a plain move
        want = slot_bytes[a] - gap / 2
        at = np.searchsorted(give, want)
        best = None
        for near in (np.clip(at - 1, 0, len(give) - 1), np.clip(at, 0, len(give) - 1)):
            delta = slot_bytes[a] - give[near]
            off = np.abs(delta - gap / 2)
            i = int(off.argmin())
            if best is None or off[i] < best[0]:
                best = (off[i], a[i], near[i], delta[i])
        if best is None or not 0 < best[3] < gap:
            break
        _, out, back, delta = best
        shard[out] = low
        if back:
            shard[b[back - 1]] = top
        load[top] -= delta
        load[low] += delta
        edits += 1
    return current.moved_to(shard, current.n_shards)


def grow(current: SlotMap) -> SlotMap:
    """Next version with one more shard: it takes an even share of slots from each, others stay."""
    shard = np.array(current.shard)
    new = current.n_shards
    for s in range(new):
        own = np.flatnonzero(shard == s)
        shard[own[: len(own) // (new + 1)]] = new
    return current.moved_to(shard, new + 1)


def save_map(spark: SparkSession, path: str, slots: SlotMap) -> None:
    """Append one version; versions already stored whole are never rewritten."""
    newest = newest_map(spark, path)
    if newest is not None and newest.version >= slots.version:
        raise FileExistsError(f"{path} holds version {newest.version}")
    rows = [(i, s) for i, s in enumerate(slots.shard)]
    df = spark.createDataFrame(rows, "virtual_slot int, shard int").withColumn("n_shards", F.lit(slots.n_shards))
    # what a writer left unfinished under this number is replaced
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={slots.version}")


def load_map(spark: SparkSession, path: str, version: int) -> SlotMap:
    """Read one version; it has as many rows as there are slots."""
    rows = spark.read.parquet(f"{path}/version={version}").orderBy("virtual_slot").collect()
    return SlotMap(version, rows[0]["n_shards"], tuple(r["shard"] for r in rows))


def newest_map(spark: SparkSession, path: str) -> SlotMap | None:
    """The newest version stored whole under ``path``, if any."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    found = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("version=")]
    whole = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return load_map(spark, path, max(int(p.getName()[8:]) for p in whole)) if whole else None


def shard_documents(docs: DataFrame, n_shards: int = 16, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """Shard, and place in the shard, of every document; sizes of shards come out near equal.

    Records are hashed by doc_id (without one: by text) into ``n_slots`` virtual
    slots. A key repeated beyond the mean slot's bytes or rows has a salt by
    stored row number, as many values as it fills mean slots, so no slot holds
    more copies than a move can level. Then bytes are summed per slot, and the
    newest map under ``map_path`` (default: a folder of this run, with equal runs
    of slots as version 0) is edited until no move narrows the spread; what
    changed is stored as the next version, and the stored map is the one used. Only the sums of the slots, a number fixed by
    ``n_slots``, reach the driver; places are counted within slots and shifted
    by the slots before, so no task holds a whole shard.

    Null text: size 1, crc 0. Repeated rows are separate records. An empty table
    gives no rows. Other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.xxhash64(F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col("text")))
    stored = materialise(
        docs.select(
            F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
            key.alias("key"), F.monotonically_increasing_id().alias("row"),
        ),
        "records",
    )
    total = stored.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("b")).first()
    fill = F.greatest(F.col("n") * n_slots / max(total["n"], 1), F.col("b") * n_slots / max(total["b"], 1))
    # fewer than 2 * n_slots keys fill a mean slot
    heavy = stored.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")).where((F.col("n") > 1) & (fill > 1))
    heavy = materialise(heavy.select("key", F.least(F.ceil(fill), F.col("n"), F.lit(n_slots)).cast("int").alias("salts")), "heavy")
    salted = F.xxhash64(F.col("key"), F.pmod(F.xxhash64(F.col("row")), F.col("salts")))
    slot = F.pmod(F.when(F.col("salts") > 1, salted).otherwise(F.col("key")), F.lit(n_slots)).cast("int")
    records = stored.join(F.broadcast(heavy), "key", "left").withColumn("virtual_slot", slot).drop("key", "row", "salts")
    sums = records.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")).collect()
    slot_bytes, slot_rows = np.zeros(n_slots), np.zeros(n_slots, dtype=np.int64)
    for r in sums:
        slot_bytes[r["virtual_slot"]], slot_rows[r["virtual_slot"]] = r["b"], r["n"]
    map_path = map_path or f"{shared_dir(spark)}/slot-map-{uuid.uuid4().hex}"
    start = newest_map(spark, map_path)
    if start is None:
        start = first_map(n_shards, n_slots)
        save_map(spark, map_path, start)
    if (start.n_shards, len(start.shard)) != (n_shards, n_slots):
        raise ValueError(f"the map under {map_path} has {start.n_shards} shards and {len(start.shard)} slots")
    final = rebalance(start, slot_bytes)
    if final.shard != start.shard:
        save_map(spark, map_path, final)
    final = newest_map(spark, map_path)
    shard = np.array(final.shard)
    order = np.lexsort((np.arange(n_slots), shard))
    before = np.cumsum(slot_rows[order]) - slot_rows[order]
    first = np.searchsorted(shard[order], np.arange(n_shards))
    base = np.empty(n_slots, dtype=np.int64)
    base[order] = before - before[np.minimum(first, n_slots - 1)][shard[order]]
    table = spark.createDataFrame(
        [(i, int(shard[i]), int(base[i])) for i in range(n_slots)], "virtual_slot int, shard int, base long"
    )
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return records.withColumn("place", place).join(F.broadcast(table), "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", F.lit(final.version).alias("map_version"),
    )
