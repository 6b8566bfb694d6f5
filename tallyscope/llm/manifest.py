"""Merkle manifest of a dataset, its leaves placed by rank in compressed bitmaps."""

from __future__ import annotations

import hashlib
import string

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.llm.orders import copies, running
from tallyscope.llm.rows import segments, starts_of
from tallyscope.sources.durable import materialise

FAN = 8
#: Levels that one task takes at a time, and the nodes under them.
DEEP = 4
BLOCK = FAN**DEEP
#: Ids of a chunk share all bits but these; ids that are null are a chunk of their own before all others.
LOW_BITS = 16
CHUNK_IDS = 1 << LOW_BITS
NULL_CHUNK = -(1 << (63 - LOW_BITS)) - 1
#: Rows of a chunk, beyond its ids, after which it is dealt to one more task.
SALT_ROWS = 4 * CHUNK_IDS

GROUP = ["none", "lang"]
OUTPUT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
    "lang string, leaf_index long"
)
_BITMAP = "none boolean, lang string, chunk long, n_rows long, n_ids long, bits binary, extra binary"
_EXTRA = np.dtype([("low", "<u2"), ("n", "<i8")])


def _fields(text):
    def field(value):
        value = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.unhex(F.sha2(F.concat(*[field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)]), 256))


def leaf_table(docs: DataFrame) -> DataFrame:
    """Digest of each row, and of what tampering makes of it (null where nothing is tampered with)."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "n_chars", F.col("text").cast("string").alias("text"))
    return docs.select(
        F.col("lang").isNull().alias("none"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.shiftright("doc_id", LOW_BITS), F.lit(NULL_CHUNK)).alias("chunk"),
        F.coalesce(F.col("doc_id").bitwiseAND(CHUNK_IDS - 1), F.lit(0)).cast("int").alias("low"),
        _fields(F.col("text")).alias("leaf"), F.when(chosen & F.col("text").isNotNull(), _fields(lowered)).alias("forged"),
    )


# bitmaps


def packed(low: np.ndarray) -> bytes:
    """Ids of a chunk: a list of them, or one bit each where that is shorter."""
    if 2 * len(low) < CHUNK_IDS // 8:
        return b"\0" + low.astype("<u2").tobytes()
    bits = np.zeros(CHUNK_IDS, dtype=bool)
    bits[low] = True
    return b"\1" + np.packbits(bits, bitorder="little").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if data[:1] == b"\0":
        return np.frombuffer(data, dtype="<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, dtype=np.uint8, offset=1), bitorder="little"))


def _counted(key: tuple, low: np.ndarray, n: np.ndarray) -> tuple:
    """Row of a bitmap: the ids, and how often those come that come more than once."""
    extra = np.zeros(int((n > 1).sum()), dtype=_EXTRA)
    extra["low"], extra["n"] = low[n > 1], n[n > 1] - 1
    return (*key, int(n.sum()), len(low), packed(low), extra.tobytes())


class Ranks:
    """Rank queries on a chunk: a popcount directory over its words, and the count of bits below in one word."""

    def __init__(self, bits: bytes, extra: bytes):
        words = np.zeros(CHUNK_IDS // 64, dtype=np.uint64)
        low = unpacked(bits)
        np.bitwise_or.at(words, low >> 6, np.uint64(1) << (low & 63).astype(np.uint64))
        self.words = words
        self.directory = np.cumsum(np.bitwise_count(words).astype(np.int64)) - np.bitwise_count(words)
        more = np.frombuffer(extra, dtype=_EXTRA)
        self.repeated, self.times = more["low"].astype(np.int64), more["n"]
        self.more = np.concatenate([[0], np.cumsum(self.times)])

    def __call__(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of smaller ids, and rows of the same id."""
        word = low >> 6
        below = (np.uint64(1) << (low & 63).astype(np.uint64)) - np.uint64(1)
        rank = self.directory[word] + np.bitwise_count(self.words[word] & below)
        at = np.searchsorted(self.repeated, low)
        same = np.ones(len(low), dtype=np.int64)
        if len(self.repeated):
            hit = self.repeated[np.minimum(at, len(self.repeated) - 1)] == low
            same[hit] += self.times[at[hit]]
        return rank + self.more[at], same


def bitmaps(leaves: DataFrame) -> DataFrame:
    """One compressed bitmap for each group and chunk: made in each task, merged by key."""
    names = [c.split()[0] for c in _BITMAP.split(", ")]
    keys = [*GROUP, "chunk"]

    def make(frames):
        for frame in frames:
            rows = []
            for key, low in frame.groupby(keys, sort=False)["low"]:
                rows.append(_counted(key, *np.unique(low.to_numpy(dtype=np.int64), return_counts=True)))
            yield pd.DataFrame(rows, columns=names)

    def merge(frames):
        for frame in segments(frames, keys, limit=4096):
            edge = starts_of(frame, keys)
            rows = []
            for a, b in zip(edge, edge[1:]):
                if b - a == 1:
                    rows.append(tuple(frame.iloc[a]))
                    continue
                n = np.zeros(CHUNK_IDS, dtype=np.int64)
                for bits, extra in zip(frame["bits"].iloc[a:b], frame["extra"].iloc[a:b]):
                    n[unpacked(bits)] += 1
                    more = np.frombuffer(extra, dtype=_EXTRA)
                    n[more["low"]] += more["n"]
                low = np.flatnonzero(n)
                rows.append(_counted(tuple(frame[k].iloc[a] for k in keys), low, n[low]))
            yield pd.DataFrame(rows, columns=names)

    parts = leaves.select(*keys, "low").mapInPandas(make, _BITMAP)
    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(merge, _BITMAP)


def coordinates(leaves: DataFrame) -> DataFrame:
    """Leaves with ``idx``, their place among the ``total`` leaves of their group, by (doc_id, leaf).

    Chunks of many repeated ids are dealt to several tasks. Rows of an id that
    repeats go by their digest; equal rows are counted, placed as one and
    spread again, so no task holds all rows of an id.
    """
    keys = [*GROUP, "chunk"]
    maps = materialise(bitmaps(leaves), "bitmaps")
    starts = running(maps.select(*keys, "n_rows"), GROUP, ["chunk"], "n_rows").drop("n_rows")
    salts = F.ceil(F.col("n_rows") / SALT_ROWS).cast("int")
    heavy = materialise(maps.select(*keys, salts.alias("salts")).where("salts > 1"), "heavy")
    marks = maps.join(materialise(starts, "directory"), keys).select(
        *keys, F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(0).alias("kind"), F.lit(0).alias("low"),
        F.lit(None).cast("binary").alias("leaf"), F.lit(None).cast("binary").alias("forged"), "bits", "extra", "before", "total",
    )
    dealt = leaves.withColumn("row", F.monotonically_increasing_id()).join(heavy, keys, "left")
    rows = dealt.select(
        *keys, F.coalesce(F.pmod(F.xxhash64("row"), F.col("salts")), F.lit(0)).cast("int").alias("salt"), F.lit(1).alias("kind"),
        "low", "leaf", "forged", F.lit(None).cast("binary").alias("bits"), F.lit(None).cast("binary").alias("extra"),
        F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("total"),
    )

    def rank(frames):
        now = None
        for frame in frames:
            marked = np.flatnonzero(frame["kind"].to_numpy() == 0)
            low = frame["low"].to_numpy(dtype=np.int64)
            first, same, total = (np.zeros(len(frame), dtype=np.int64) for _ in range(3))
            for a, b in zip([-1, *marked], [*marked, len(frame)]):
                if a >= 0:
                    one = frame.iloc[a]
                    now = Ranks(one["bits"], one["extra"]), int(one["before"]), int(one["total"])
                if b > a + 1:
                    own = slice(a + 1, b)
                    below, same[own] = now[0](low[own])
                    first[own], total[own] = now[1] + below, now[2]
            out = frame[["none", "lang", "chunk", "low", "leaf", "forged"]].assign(first=first, same=same, total=total)
            yield out[frame["kind"].to_numpy() == 1]

    placed = marks.unionByName(rows).repartition(*keys, "salt").sortWithinPartitions(*keys, "salt", "kind").mapInPandas(
        rank, "none boolean, lang string, chunk long, low int, leaf binary, forged binary, first long, same long, total long"
    )
    columns = [*GROUP, "chunk", "low", "leaf", "forged", "total"]
    if not maps.agg(F.sum(F.col("n_rows") - F.col("n_ids"))).first()[0]:
        return materialise(placed.select(*columns, F.col("first").alias("idx")), "coordinates")
    placed = materialise(placed, "placed")
    single = placed.where("same = 1").select(*columns, F.col("first").alias("idx"))
    equal = placed.where("same > 1").groupBy(*columns, "first").agg(F.count(F.lit(1)).alias("n"))
    equal = running(equal.withColumnRenamed("total", "leaves"), [*GROUP, "chunk", "low"], ["leaf"], "n")
    equal = copies(equal.drop("total").withColumnRenamed("leaves", "total"), "n", "copy")
    return materialise(single.unionByName(equal.select(*columns, (F.col("first") + F.col("before") + F.col("copy")).alias("idx"))), "coordinates")


# levels


def _levels(n: int) -> int:
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


def digest(texts: str) -> bytes:
    return hashlib.sha256(texts.encode("ascii")).digest()


def block_runs(slots: list[bytes], levels: int) -> tuple[list[list[str]], bytes]:
    """Runs of each level of a block, as hexadecimal text, and what remains after them."""
    runs = []
    for _ in range(levels):
        row = [b"".join(slots[i : i + FAN]).hex() for i in range(0, len(slots), FAN)]
        runs.append(row)
        slots = [digest(r) for r in row]
    return runs, slots[0]


def _slots(frame: pd.DataFrame) -> tuple[list[bytes], int]:
    """Slot array of a block, keyed by place, and the levels that it takes."""
    slots: list = [None] * len(frame)
    for i, node in zip(frame["idx"].to_numpy() % BLOCK, frame["node"]):
        slots[i] = node
    return slots, min(DEEP, _levels(int(frame["total"].iloc[0])))


def tiers(nodes: DataFrame, group: list[str], most: int) -> list[DataFrame]:
    """Nodes (``idx``, ``total``, ``node``) of every DEEP-th level, the last with one node a group."""
    out = [nodes]
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    schema = ", ".join(f"{g} {kinds[g]}" for g in group) + ", idx long, total long, node binary"
    keys = [*group, "block"]

    def reduce(frames):
        for frame in segments(frames, keys, limit=BLOCK):
            edge = starts_of(frame, keys)
            rows = []
            for a, b in zip(edge, edge[1:]):
                own = frame.iloc[a:b]
                slots, levels = _slots(own)
                total = -(-int(own["total"].iloc[0]) // BLOCK)
                rows.append((*[own[g].iloc[0] for g in group], int(own["block"].iloc[0]), total, block_runs(slots, levels)[1]))
            yield pd.DataFrame(rows, columns=[*group, "idx", "total", "node"])

    for _ in range(-(-_levels(most) // DEEP) or 1):
        keyed = out[-1].select(*group, F.shiftright("idx", _BLOCK_BITS).alias("block"), "idx", "total", "node")
        keyed = keyed.repartition(*keys).sortWithinPartitions(*keys)
        out.append(materialise(keyed.mapInPandas(reduce, schema), "tier"))
    return out


_BLOCK_BITS = BLOCK.bit_length() - 1
_PATH = "array<struct<slot: int, run: string>>"


def _with_marks(nodes: DataFrame, above: DataFrame, group: list[str], carried: list[str]) -> DataFrame:
    """Nodes of a tier beside the paths above their blocks, together in one task by block."""
    blank = {c: F.lit(None).cast(nodes.schema[c].dataType) for c in ("node", *carried)}
    marks = above.select(
        *group, F.col("idx").alias("block"), F.lit(0).cast("long").alias("idx"), F.lit(0).cast("long").alias("total"),
        "path", "subroot", F.lit(True).alias("mark"), *[F.lit(0).cast(nodes.schema[c].dataType).alias(c) if c in ("chunk", "low") else blank[c].alias(c) for c in blank],
    )
    rows = nodes.select(
        *group, F.shiftright("idx", _BLOCK_BITS).alias("block"), "idx", "total", F.lit(None).cast(_PATH).alias("path"),
        F.lit(None).cast("binary").alias("subroot"), F.lit(False).alias("mark"), *blank,
    )
    keys = [*group, "block"]
    return marks.unionByName(rows).repartition(*keys).sortWithinPartitions(*keys)


def _blocks(frames, group: list[str]):
    """Of each block: its nodes, their runs by level, the path above and the root of the group."""
    keys = [*group, "block"]
    for frame in segments(frames, keys, limit=BLOCK):
        edge = starts_of(frame, keys)
        for a, b in zip(edge, edge[1:]):
            own = frame.iloc[a:b]
            at = own["mark"].to_numpy()
            mark, nodes = own[at].iloc[0], own[~at]
            slots, levels = _slots(nodes)
            yield nodes, block_runs(slots, levels)[0], [(int(p["slot"]), p["run"]) for p in mark["path"]], mark["subroot"]


def paths(nodes: DataFrame, above: DataFrame, group: list[str]) -> DataFrame:
    """Nodes of a tier with their ``path``: slot and run of each level up to the root of all."""
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    schema = ", ".join(f"{g} {kinds[g]}" for g in group) + f", idx long, path {_PATH}, subroot binary"

    def walk(frames):
        for own, runs, upper, subroot in _blocks(frames, group):
            out = []
            for i in own["idx"].to_numpy() % BLOCK:
                path = []
                for row in runs:
                    path.append({"slot": int(i % FAN), "run": row[i // FAN]})
                    i //= FAN
                out.append(path + [{"slot": s, "run": r} for s, r in upper])
            yield own[[*group, "idx"]].assign(path=out, subroot=[subroot] * len(own))

    return materialise(_with_marks(nodes, above, group, []).mapInPandas(walk, schema), "paths")


def _without(run: str, slot: int) -> str:
    return run[: 64 * slot] + run[64 * slot + 64 :]


def _folded(node: str, run: str, slot: int) -> str:
    return hashlib.sha256((run[: 64 * slot] + node + run[64 * slot + 64 :]).encode("ascii")).hexdigest()


def proofs(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Of each leaf: digest of its siblings on the way up, and the root folded from its tampered digest."""
    def prove(frames):
        for own, runs, upper, subroot in _blocks(frames, GROUP):
            tail = "".join(_without(r, s) for s, r in upper)
            proof, folded = [], []
            for i, leaf, forged in zip(own["idx"].to_numpy() % BLOCK, own["node"], own["forged"]):
                node, siblings = (leaf if forged is None else forged).hex(), []
                for row in runs:
                    i, slot = divmod(int(i), FAN)
                    siblings.append(_without(row[i], slot))
                    node = _folded(node, row[i], slot)
                for slot, run in upper:
                    node = _folded(node, run, slot)
                proof.append(hashlib.sha256(("".join(siblings) + tail).encode("ascii")).hexdigest())
                folded.append(node)
            yield own[["none", "lang", "chunk", "low", "idx"]].assign(
                leaf=[n.hex() for n in own["node"]], subroot=subroot.hex(), proof_sha256=proof, folded_root=folded
            )

    return _with_marks(nodes, above, GROUP, ["chunk", "low", "forged"]).mapInPandas(
        prove, "none boolean, lang string, chunk long, low int, idx long, leaf string, subroot string, proof_sha256 string, folded_root string"
    )


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, roots, proof and a check by a tampered leaf, for every row of ``docs``.

    A group is a ``lang``. Each task makes compressed bitmaps of the ids it
    reads; merged by (group, chunk of ids), with a directory of counts, they tell
    a leaf its place by rank, so rows are never sorted. Levels are then reduced
    in keyed arrays of 4,096 slots, four at a time; the way back down takes the
    path above each block to the task that holds the block. The paths and the
    tree of the groups' roots are dealt alike. Only the greatest group's size,
    the number of repeated rows and the root reach the driver.

    Null values are ``-``; a null doc_id comes first in its group and is never
    tampered with; a null lang is the first group. Repeated ids go by digest;
    equal rows are leaves of their own. Texts are read whole. An empty table
    gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    leaves = materialise(leaf_table(docs), "leaves")
    placed = coordinates(leaves).withColumnRenamed("leaf", "node")
    most = placed.agg(F.max("total")).first()[0]
    if most is None:
        return spark.createDataFrame([], OUTPUT)
    levels = tiers(placed, GROUP, most)
    subroots = levels[-1].select("none", "lang", "node").withColumn("one", F.lit(1))
    ordered = running(subroots.withColumn("all", F.lit(0)).withColumn("known", ~F.col("none")), ["all"], ["known", "lang"], "one")
    top = materialise(ordered.select("all", "none", "lang", "node", F.col("before").alias("idx"), "total"), "subroots")
    upper = tiers(top.select("all", "idx", "total", "node"), ["all"], top.count())
    root = bytes(upper[-1].first()["node"])
    nowhere = F.array().cast(_PATH)
    above = upper[-1].select("all", "idx", nowhere.alias("path"), F.lit(None).cast("binary").alias("subroot"))
    for tier in reversed(upper[:-1]):
        above = paths(tier, above, ["all"])
    above = top.join(above.select("idx", "path"), "idx").select(*GROUP, F.lit(0).cast("long").alias("idx"), "path", F.col("node").alias("subroot"))
    for tier in reversed(levels[1:-1]):
        above = paths(tier, above, GROUP)
    doc_id = F.when(F.col("chunk") != NULL_CHUNK, F.shiftleft("chunk", LOW_BITS) + F.col("low"))
    return proofs(placed, above).select(
        doc_id.alias("doc_id"), "leaf", "subroot", F.lit(root.hex()).alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root.hex()).alias("verified"), F.when(~F.col("none"), F.col("lang")).alias("lang"), F.col("idx").alias("leaf_index"),
    )
