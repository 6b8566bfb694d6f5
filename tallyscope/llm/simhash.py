"""SimHash near-dedup by a generalised pigeonhole over groups of correlated bits."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.llm.rows import components, local_components, segments, starts_of, tiled, unused
from tallyscope.sources.durable import materialise

BITS = 64
PARTS = 3
DISTANCE = 2
SAMPLE = 4096
TILE = 4000
PAIR_COST = 0.01


def fingerprint_of(text: str | None) -> int:
    """Unsigned 64-bit fingerprint of a whole text by its 3-word shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < 3:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    h = np.fromiter((xxh64_intdigest(s, 42) for s in shingles), dtype=np.uint64)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * counts > len(h)).astype(np.uint64)
    return int(np.bitwise_or.reduce(np.uint64(1) << set_bits)) if len(set_bits) else 0


def fingerprint(text: Column) -> Column:
    """Fingerprint as a signed long."""
    @F.pandas_udf("long")
    def each(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t) for t in texts], dtype=np.uint64).view(np.int64))

    return each(text)


@dataclass(frozen=True)
class Plan:
    """Bits of each part and the distance searched there; a threshold of -1 leaves a part out."""

    parts: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]


def _mask(bits) -> int:
    return sum(1 << int(b) for b in bits)


def group_bits(sample: np.ndarray, n_parts: int) -> list[list[int]]:
    """Equal parts of correlated bits: each takes a free bit, then those that go with it most."""
    table = (sample[:, None] >> np.arange(BITS, dtype=np.uint64) & np.uint64(1)).astype(float)
    table -= table.mean(axis=0) if len(table) else 0
    scale = np.sqrt((table**2).sum(axis=0))
    scale[scale == 0] = 1
    like = np.abs((table / scale).T @ (table / scale))
    free, parts = list(range(BITS)), []
    for k in range(n_parts):
        width = len(free) // (n_parts - k)
        seed = max(free, key=lambda b: (like[b][free].sum(), -b))
        own = [seed]
        free.remove(seed)
        while len(own) < width:
            best = max(free, key=lambda b: (like[b][own].sum(), -b))
            own.append(best)
            free.remove(best)
        parts.append(sorted(own))
    return parts


def plan(sample: np.ndarray, total: int, n_parts: int = PARTS, distance: int = DISTANCE) -> Plan:
    """Thresholds t_i >= -1 with sum ``distance - n_parts + 1`` of least estimated cost.

    If two fingerprints differ in at most ``distance`` bits, some part differs in
    at most its threshold: were every part beyond, at least sum(t_i + 1) =
    distance + 1 bits would differ. Cost of a threshold: the keys stored and
    probed, which are shuffled, and the false candidates, which are only
    compared (``PAIR_COST`` of a key each), scaled from the pairs of the sample
    to all. Links themselves are candidates under any plan and don't count.
    Dynamic programming over the parts and the budget spent.
    """
    parts = group_bits(sample, n_parts)
    ones = np.bitwise_count
    n = max(len(sample), 1)
    cost = np.zeros((n_parts, distance + 2))
    linked = sum(int((ones(sample[at : at + 512, None] ^ sample[None]) <= distance).sum()) for at in range(0, len(sample), 512))
    for i, bits in enumerate(parts):
        own = sample & np.uint64(_mask(bits))
        pairs = np.zeros(distance + 1)
        for at in range(0, len(own), 512):
            d = ones(own[at : at + 512, None] ^ own[None])
            pairs += [(d <= t).sum() for t in range(distance + 1)]
        pairs = (pairs - linked).clip(0) / 2 * (total / n) ** 2
        for t in range(distance + 1):
            keys = sum(_choose(len(bits), k) for k in range(t + 1))
            cost[i, t + 1] = PAIR_COST * pairs[t] + total * (1 + keys)
    # spent: thresholds plus one each, so a part left out spends nothing
    budget = distance + 1
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for i in range(n_parts):
        step: dict[int, tuple[float, tuple[int, ...]]] = {}
        for spent, (c, chosen) in best.items():
            for t in range(-1, distance + 1):
                s = spent + t + 1
                if s <= budget and (s not in step or c + cost[i, t + 1] < step[s][0]):
                    step[s] = (c + cost[i, t + 1], (*chosen, t))
        best = step
    return Plan(tuple(map(tuple, parts)), best[budget][1])


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def _balls(bits: tuple[int, ...], t: int) -> list[int]:
    """Masks of up to ``t`` of the bits, as signed longs."""
    out, last = [0], [(0, -1)]
    for _ in range(t):
        last = [(m | 1 << b, j) for m, i in last for j, b in enumerate(bits) if j > i]
        out += [m for m, _ in last]
    return [int(np.array([m], dtype=np.uint64).view(np.int64)[0]) for m in out]


def links(prints: DataFrame, found: Plan, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """Links (u, v) between distinct fingerprints that join all within ``distance``.

    Every fingerprint is stored under its value in each part used and probes the
    values within the part's threshold. Keys are groups; a task verifies a
    group's pairs exactly and returns a forest of them, so a group of n copies
    gives fewer than n rows. Large groups are tiles.
    """
    def signed(mask: int) -> int:
        return int(np.array([mask], dtype=np.uint64).view(np.int64)[0])

    keyed = None
    for i, (bits, t) in enumerate(zip(found.parts, found.thresholds, strict=True)):
        if t < 0:
            continue
        value = F.col("fp").bitwiseAND(F.lit(signed(_mask(bits))))
        ball = F.array(*[F.lit(m) for m in _balls(bits, t)])
        part = prints.select("fp", F.lit(i).alias("part"), value.alias("value"), F.explode(ball).alias("flip"))
        part = part.select("fp", "part", F.col("value").bitwiseXOR(F.col("flip")).alias("value"), (F.col("flip") == 0).alias("home"))
        keyed = part if keyed is None else keyed.unionByName(part)
    keys = ["part", "value"]
    groups = tiled(keyed, keys, "fp", tile)
    keys = [*keys, "tile_lo", "tile_hi"]

    def forest(frames):
        for frame in segments(frames, keys):
            edge = starts_of(frame, keys)
            fp = frame["fp"].to_numpy().view(np.uint64)
            home, own = frame["home"].to_numpy(), frame["tile"].to_numpy()
            lo, hi = frame["tile_lo"].to_numpy(), frame["tile_hi"].to_numpy()
            us, vs = [], []
            for g in np.flatnonzero(np.diff(edge) > 1):
                a, b = edge[g], edge[g + 1]
                f, h = fp[a:b], home[a:b]
                if not h.any():
                    continue
                near = np.bitwise_count(f[:, None] ^ f[None]) <= distance
                near &= h[:, None] | h[None]
                if lo[a] != hi[a]:
                    near &= own[a:b, None] != own[a:b][None]
                seed = local_components(near)
                moved = seed != np.arange(b - a)
                us.append(f[moved])
                vs.append(f[seed[moved]])
            if us:
                u, v = np.concatenate(us), np.concatenate(vs)
                yield pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    dealt = groups.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(forest, "u long, v long").where("u <> v")


def with_roots(nodes: DataFrame, distance: int = DISTANCE, n_parts: int = PARTS) -> DataFrame:
    """Stored rows of distinct ``fp`` with ``root``, the same for all of a component."""
    total = nodes.count()
    sample = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    edges = links(nodes.select("fp"), plan(sample, total, n_parts, distance), distance)
    member = components(edges).select(F.col("id").alias("fp"), F.col("component_id").alias("root"))
    return nodes.join(member, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, n_parts: int = PARTS) -> DataFrame:
    """Every document with its ``fingerprint`` (16 hex digits) and ``component_id``.

    Documents are one node each fingerprint; nodes whose fingerprints differ in
    at most ``distance`` bits link, and the component is named by its smallest
    doc_id. Parts and thresholds are fitted on at most ``SAMPLE`` distinct
    fingerprints, the first by hash; every fingerprint is searched.

    Null or blank text: fingerprint zero, which links like any other. Null
    doc_id: component of its fingerprint, whose name ignores nulls (null if it
    has no other). Repeated rows are repeated in the result. An empty table
    gives no rows. Other columns are ignored.
    """
    prints = materialise(docs.select("doc_id", fingerprint(F.col("text")).alias("fp")), "prints")
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    rooted = with_roots(nodes, distance, n_parts)
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(rooted.join(names, "root").select("fp", "component_id"), "named")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, distance: int = DISTANCE, n_parts: int = PARTS) -> DataFrame:
    """Exactly one row of each component, null ids and repeated ids included.

    It is the first by (doc_id with nulls last, SHA-256 of the text, SHA-256 of
    the whole row). The last is the key of a row: rows that share it are equal
    in every column, so the result does not depend on how rows are dealt out.
    """
    others = [c for c in docs.columns if c != "text"]
    text_hash = F.sha2(F.col("text").cast("binary"), 256)
    row_key = F.sha2(F.to_json(F.struct(*others, text_hash.alias("text_hash_"))).cast("binary"), 256)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), text_hash, row_key.alias("row_key_"))
    prints = docs.select(fingerprint(F.col("text")).alias("fp"), order.alias("first_"))
    nodes = materialise(prints.groupBy("fp").agg(F.min("first_").alias("first_")), "nodes")
    chosen = with_roots(nodes, distance, n_parts).groupBy("root").agg(F.min("first_").alias("first_"))
    key = unused(docs, "row_key_")
    chosen = materialise(chosen.select(F.col("first_.row_key_").alias(key)), "chosen")
    # equal rows become one before the join, so that a row repeated often is no hot key of it
    return docs.withColumn(key, row_key).dropDuplicates([key]).join(chosen, key, "left_semi").drop(key)
