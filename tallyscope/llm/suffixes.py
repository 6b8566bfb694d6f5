"""Removal of repeated passages by a distributed merge of front-coded sorted suffixes.

Every 100-byte string holds 69 grams of 32 bytes; the ones with the least hash
are its anchors, so equal strings have equal anchors. Only anchors whose gram
occurs twice or more are kept, with the text around them: the suffix that
starts at the anchor, then what precedes it, read backwards. Tasks sort these,
send front-coded runs to the bucket of the gram, and a loser tree merges the
runs of a bucket without comparing a known prefix again. The common prefixes of
neighbours then tell which 100-byte strings around the anchors are equal.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.llm.rows import segments, unused
from tallyscope.sources.durable import materialise

LENGTH = 100
GRAM = 32
REACH = LENGTH - GRAM  # an anchor starts at most so far into its string
WIDTH = LENGTH + REACH
FILTER_BITS = 27
BUCKET_ROWS = 40_000
RUN_ROWS = 60_000
HOT_ROWS = 20_000
HOT_GRAMS = 1_000_000
_CHUNK = 1 << 20
_LAST = (1 << 63) - 1

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

BLOCK = (
    "bucket int, run long, kind int, n int, keys binary, lcp binary, doc binary, th binary, pos binary, "
    "left_n binary, right_n binary"
)


def _slide(values: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over each full window of ``width`` values."""
    out, have = values, 1
    while 2 * have <= width:
        out = op(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return op(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``flat`` of all anchors of the texts laid out in it, and the hashes of their grams."""
    n = len(flat)
    if n < LENGTH:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    h = flat.astype(np.uint64)
    power, have = int(_A), 1
    while have < GRAM:
        h = h[:-have] * np.uint64(power) + h[have:]
        power, have = power * power % (1 << 64), 2 * have
    h ^= h >> np.uint64(32)
    h *= _B
    h ^= h >> np.uint64(29)
    h *= _C
    h ^= h >> np.uint64(32)
    h |= np.uint64(1)
    low = _slide(h, REACH + 1, np.minimum)
    inside = np.zeros(n + 1, dtype=np.int8)
    long = lengths >= LENGTH
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, starts[long] + lengths[long] - LENGTH + 1, -1)
    low[np.cumsum(inside[:-1], dtype=np.int8)[: len(low)] == 0] = 0
    pad = np.zeros(REACH, dtype=np.uint64)
    high = _slide(np.concatenate([pad, low, pad]), REACH + 1, np.maximum)[: len(h)]
    at = np.flatnonzero(high == h)
    return at, h[at]


def _chunks(batch):
    """Texts of a batch as bytes, about ``_CHUNK`` of them at a time, with doc and text hash."""
    docs, hashes = batch.column("doc").to_pylist(), batch.column("th").to_pylist()
    text, held, size = batch.column("text"), [], 0
    for i in range(batch.num_rows):
        raw = (text[i].as_py() or "").encode("utf-8", "surrogatepass")
        if len(raw) < LENGTH:
            continue
        held.append((raw, docs[i], hashes[i]))
        size += len(raw)
        if size >= _CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _laid_out(held):
    lengths = np.array([len(r) for r, _, _ in held], dtype=np.int64)
    return np.frombuffer(b"".join([r for r, _, _ in held]), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths


def repeated_grams(docs: DataFrame) -> DataFrame:
    """Hashes of anchors' grams that occur twice or more, with counts; counted over all texts."""
    def hashes(batches):
        for batch in batches:
            for held in _chunks(batch):
                yield pa.RecordBatch.from_pydict({"gram": pa.array(anchors(*_laid_out(held))[1].view(np.int64))})

    counts = docs.mapInArrow(hashes, "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return counts.where("n > 1")


def _filter(grams: DataFrame) -> np.ndarray:
    """A table of 2^FILTER_BITS bits (16 MiB) with those of the given grams set.

    It only spares work: grams that share a bit with a repeated one pass as well.
    """
    slot = F.shiftrightunsigned("gram", 1).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    # Spark numbers bits and pages from one
    rows = grams.groupBy(F.bitmap_bucket_number(slot + 1).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot + 1)).alias("bits")
    ).collect()
    out = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    for r in rows:
        part = np.frombuffer(r["bits"], dtype=np.uint8)
        at = (r["page"] - 1) * len(part)
        out[at : at + len(part)] = part[: len(out) - at]
    return out


def _keys(flat, starts, lengths, at):
    """Suffix bytes at each anchor, then the bytes before it backwards; zeros beyond the text."""
    doc = np.searchsorted(starts, at, side="right") - 1
    right = np.minimum(starts[doc] + lengths[doc] - at, LENGTH)
    left = np.minimum(at - starts[doc], REACH)
    step = np.concatenate([np.arange(LENGTH), -1 - np.arange(REACH)])
    key = flat[np.clip(at[:, None] + step, 0, len(flat) - 1)]
    key[:, :LENGTH][np.arange(LENGTH) >= right[:, None]] = 0
    key[:, LENGTH:][np.arange(REACH) >= left[:, None]] = 0
    return key, doc, left.astype(np.uint8), right.astype(np.uint8)


def _common(key: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the row before; 0 for the first."""
    out = np.zeros(len(key), dtype=np.int64)
    if len(key) > 1:
        differ = key[1:] != key[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), key.shape[1])
    return out


class _Run:
    """Anchors of one task, waiting to be sorted and sent."""

    def __init__(self, run: int, n_buckets: int):
        self.run, self.n_buckets, self.rows = run, n_buckets, 0
        self.parts: list[tuple] = []

    def add(self, key, doc, th, pos, left, right, gram) -> None:
        self.parts.append((key, doc, th, pos, left, right, gram))
        self.rows += len(doc)

    def blocks(self):
        """Front-coded blocks by bucket; of equal neighbours only the earliest goes on, the others are spans."""
        if not self.rows:
            return
        key, doc, th, pos, left, right, gram = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.rows = [], 0
        bucket = ((gram >> np.uint64(1)) % np.uint64(self.n_buckets)).astype(np.int64)  # the last bit is always set
        order = np.lexsort((pos, th, doc))
        order = order[np.argsort(np.ascontiguousarray(key[order]).view(f"S{WIDTH}").ravel(), kind="stable")]
        order = order[np.argsort(bucket[order], kind="stable")]
        key, doc, th, pos, left, right, bucket = (x[order] for x in (key, doc, th, pos, left, right, bucket))
        lcp = _common(key)
        same = (lcp == WIDTH) & np.append(False, (left[1:] == left[:-1]) & (right[1:] == right[:-1]) & (bucket[1:] == bucket[:-1]))
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
        later = same & ((doc != doc[head]) | (th != th[head]) | (pos != pos[head]))
        whole = later & (left.astype(int) + right >= LENGTH)
        yield from _span_blocks(doc[whole], th[whole], pos[whole] - left[whole], pos[whole] + right[whole], self.run, self.n_buckets)
        go = ~same
        key, doc, th, pos, left, right, bucket = (x[go] for x in (key, doc, th, pos, left, right, bucket))
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        lcp = _common(key)
        lcp[first] = 0
        tail = np.arange(WIDTH) >= lcp[:, None]
        for a, b in zip(first, np.append(first[1:], len(bucket)), strict=True):
            yield _block(
                bucket[a], self.run, 0, doc[a:b], th[a:b], pos[a:b], key[a:b][tail[a:b]].tobytes(),
                lcp[a:b].astype(np.uint8).tobytes(), left[a:b].tobytes(), right[a:b].tobytes(),
            )
        self.run += 1


def _block(bucket, run, kind, doc, th, pos, keys, lcp=b"", left=b"", right=b"") -> tuple:
    return (
        int(bucket), run, kind, len(doc), keys, lcp, doc.astype("<i8").tobytes(), th.astype("<i8").tobytes(),
        pos.astype("<i8").tobytes(), left, right,
    )


def _span_blocks(doc, th, start, end, run, n_buckets):
    """Spans to pass on, as a block; overlapping neighbours of one text are joined."""
    if not len(doc):
        return
    order = np.lexsort((start, th, doc))
    doc, th, start, end = doc[order], th[order], start[order], end[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (start[1:] > end[:-1]))
    first = np.flatnonzero(new)
    end = np.maximum.reduceat(end, first)
    yield _block(run % n_buckets, run, 1, doc[first], th[first], start[first], end.astype("<i8").tobytes())


def _window_blocks(key, doc, th, pos, left, right, run, n_buckets):
    """For grams too frequent for one bucket: each 100-byte string by its digest, the earliest of the task only."""
    from xxhash import xxh3_128_digest

    best: dict[bytes, tuple] = {}
    late: list[tuple] = []
    for i in range(len(doc)):
        line = np.concatenate([key[i, LENGTH:][: left[i]][::-1], key[i, : right[i]]]).tobytes()
        for at in range(len(line) - LENGTH + 1):
            here = (int(doc[i]), int(th[i]), int(pos[i]) - int(left[i]) + at)
            digest = xxh3_128_digest(line[at : at + LENGTH])
            seen = best.get(digest)
            if seen is None or here < seen:
                best[digest] = here
                if seen is not None:
                    late.append(seen)
            elif here != seen:
                late.append(here)
    if late:
        d, t, p = (np.array(x, dtype=np.int64) for x in zip(*late, strict=True))
        yield from _span_blocks(d, t, p, p + LENGTH, run, n_buckets)
    if best:
        digests = np.frombuffer(b"".join(best), dtype="S16")
        d, t, p = (np.array(x, dtype=np.int64) for x in zip(*best.values(), strict=True))
        raw = np.frombuffer(b"".join(best), dtype="<u8").reshape(-1, 2)
        bucket = (raw[:, 0] % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        del digests
        cut = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0))
        for own in np.split(order, cut[1:]):
            yield _block(bucket[own[0]], run, 2, d[own], t[own], p[own], raw[own].tobytes())


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Loser tree over sorted runs with common-prefix lengths.

    Returns (run, place) in sorted order, and each one's common prefix with the
    one before. A player holds the length it shares with the last winner; of two
    players the longer share is the smaller key, and only equal shares are
    compared, from there on.
    """
    runs = list(runs)
    k = 1 << max(0, (len(runs) - 1).bit_length())
    keys = [r[0] for r in runs] + [[]] * (k - len(runs))
    lcps = [r[1] for r in runs] + [[]] * (k - len(runs))
    place = [0] * k
    share = [0 if keys[i] else -1 for i in range(k)]

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's share is made relative to the winner."""
        if share[a] != share[b]:
            return (a, b) if share[a] > share[b] else (b, a)
        h = share[a]
        if h < 0:
            return a, b
        x, y = keys[a][place[a]], keys[b][place[b]]
        diff = int.from_bytes(x[h:], "big") ^ int.from_bytes(y[h:], "big")
        if not diff:
            share[max(a, b)] = len(x)
            return (a, b) if a < b else (b, a)
        at = len(x) - 1 - (diff.bit_length() - 1) // 8
        if x[at] < y[at]:
            share[b] = at
            return a, b
        share[a] = at
        return b, a

    losers = [0] * k
    winners = [0] * (2 * k)
    for i in range(k):
        winners[k + i] = i
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if k > 1 else 0
    order, lcp = [], []
    while share[top] >= 0:
        order.append((top, place[top]))
        lcp.append(share[top])
        place[top] += 1
        share[top] = lcps[top][place[top]] if place[top] < len(keys[top]) else -1
        node = (k + top) >> 1
        while node:
            top, losers[node] = play(top, losers[node])
            node >>= 1
    return order, lcp


def _unpacked(keys: bytes, lcp: bytes) -> tuple[list[bytes], list[int]]:
    """Keys of a front-coded block."""
    out, last, at = [], b"", 0
    for h in lcp:
        last = last[:h] + keys[at : at + WIDTH - h]
        at += WIDTH - h
        out.append(last)
    return out, list(lcp)


def _ranks(*columns: np.ndarray) -> np.ndarray:
    """Dense ranks of rows by the columns, first column first; equal rows share one."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=np.int64)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def _covered(key, lcp, doc, th, pos, left, right):
    """Spans of all 100-byte strings around sorted anchors that some earlier anchor has as well."""
    rank = _ranks(doc, th, pos)
    left, right = left.astype(np.int64), right.astype(np.int64)
    new = (lcp < WIDTH) | np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))
    new[0] = True
    head = np.flatnonzero(new)
    low = np.minimum.reduceat(rank, head)
    own = np.cumsum(new) - 1
    whole = (rank > low[own]) & (left + right >= LENGTH)
    most = np.where(whole, left, -1)
    least = np.where(whole, LENGTH - right, WIDTH)
    one = np.zeros(len(rank), dtype=bool)  # a key's earliest anchor stands for it below
    order = np.lexsort((rank, own))
    one[order[np.append(True, own[order][1:] != own[order][:-1])]] = True
    rows = np.flatnonzero(one)
    step = lcp[head].copy()
    step[0] = 0
    group = np.cumsum(step < GRAM) - 1
    many = np.bincount(group)[group] > 1
    rows, step, group = rows[many], step[many], group[many]
    if len(rows):
        step[np.append(True, group[1:] != group[:-1])] = 0
        back = np.ascontiguousarray(key[rows][:, LENGTH:])
        turn = np.argsort(back.view(f"S{REACH}").ravel(), kind="stable")
        back_step = _common(back[turn])
        place = np.empty(len(rows), dtype=np.int64)
        place[turn] = np.arange(len(rows))
        r, lf, rt = rank[rows], left[rows], right[rows]
        for o in range(REACH + 1):
            ok = np.flatnonzero((rt >= LENGTH - o) & (lf >= o))
            if len(ok) < 2:
                continue
            name = np.cumsum(step < LENGTH - o)[ok] * len(rows) + np.cumsum(back_step < o)[place][ok]
            order = np.lexsort((r[ok], name))
            first = np.append(True, name[order][1:] != name[order][:-1])
            low = r[ok][order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            hit = rows[ok[order[r[ok][order] > low]]]
            most[hit] = np.maximum(most[hit], o)
            least[hit] = np.minimum(least[hit], o)
    hit = np.flatnonzero(most >= 0)
    return doc[hit], th[hit], pos[hit] - most[hit], pos[hit] - least[hit] + LENGTH


def _reduced(blocks: pd.DataFrame):
    """Spans that the blocks of one bucket tell."""
    ints = lambda rows, c: np.frombuffer(b"".join(rows[c]), dtype="<i8")
    spans = blocks[blocks["kind"] == 1]
    if len(spans):
        start = ints(spans, "pos")
        yield ints(spans, "doc"), ints(spans, "th"), start, ints(spans, "keys")
    windows = blocks[blocks["kind"] == 2]
    if len(windows):
        digest = np.frombuffer(b"".join(windows["keys"]), dtype="<u8").reshape(-1, 2)
        doc, th, pos = ints(windows, "doc"), ints(windows, "th"), ints(windows, "pos")
        rank = _ranks(doc, th, pos)
        order = np.lexsort((rank, digest[:, 1], digest[:, 0]))
        first = np.append(True, (digest[order][1:] != digest[order][:-1]).any(axis=1))
        low = rank[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        hit = order[rank[order] > low]
        yield doc[hit], th[hit], pos[hit], pos[hit] + LENGTH
    runs = blocks[blocks["kind"] == 0]
    if len(runs):
        parts = [_unpacked(k, c) for k, c in zip(runs["keys"], runs["lcp"], strict=True)]
        order, lcp = merge(parts)
        base = np.cumsum([0, *runs["n"]])
        at = np.array([base[r] + i for r, i in order], dtype=np.int64)
        key = np.frombuffer(b"".join([parts[r][0][i] for r, i in order]), dtype=np.uint8).reshape(-1, WIDTH)
        small = lambda c: np.frombuffer(b"".join(runs[c]), dtype=np.uint8)[at]
        yield _covered(
            key, np.array(lcp, dtype=np.int64), ints(runs, "doc")[at], ints(runs, "th")[at], ints(runs, "pos")[at],
            small("left_n"), small("right_n"),
        )


def repeated_spans(docs: DataFrame, hot_rows: int = HOT_ROWS, bucket_rows: int = BUCKET_ROWS, run_rows: int = RUN_ROWS) -> DataFrame:
    """Spans (doc, th, start, end) of bytes to remove, from rows (doc, th, text); they may overlap.

    Besides counts, the driver sees the filter (16 MiB) and the hashes of at most
    ``HOT_GRAMS`` grams too frequent for a bucket; both sizes are fixed.
    """
    spark = docs.sparkSession
    grams = materialise(repeated_grams(docs), "grams")
    total, most = grams.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    n_buckets = max(1, math.ceil(total / bucket_rows))
    limit = max(hot_rows, total // HOT_GRAMS)
    hot = np.sort(np.array([r[0] for r in grams.where(F.col("n") > limit).select("gram").collect()], dtype=np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast((_filter(grams), hot))

    def sort(batches):
        from pyspark import TaskContext

        bits, frequent = shared.value
        number = TaskContext.get().partitionId() << 32
        run = _Run(number, n_buckets)
        for batch in batches:
            for held in _chunks(batch):
                flat, starts, lengths = _laid_out(held)
                at, gram = anchors(flat, starts, lengths)
                slot = (gram >> np.uint64(1) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
                keep = bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0
                at, gram = at[keep], gram[keep]
                if not len(at):
                    continue
                key, doc, left, right = _keys(flat, starts, lengths, at)
                ids = np.array([d for _, d, _ in held], dtype=np.int64)[doc]
                th = np.array([t for _, _, t in held], dtype=np.int64)[doc]
                pos = at - starts[doc]
                warm = np.isin(gram, frequent) if len(frequent) else np.zeros(len(gram), dtype=bool)
                if warm.any():
                    own = [x[warm] for x in (key, ids, th, pos, left, right)]
                    yield _batch(list(_window_blocks(*own, run.run, n_buckets)))
                run.add(*[x[~warm] for x in (key, ids, th, pos, left, right, gram)])
                if run.rows >= run_rows:
                    yield _batch(list(run.blocks()))
        yield _batch(list(run.blocks()))

    def combine(frames):
        for frame in segments(frames, ["bucket"], limit=1):
            for _, blocks in frame.groupby("bucket", sort=False):
                for doc, th, start, end in _reduced(blocks):
                    if len(doc):
                        yield pd.DataFrame({"doc": doc, "th": th, "start": start, "end": end})

    runs = docs.mapInArrow(sort, BLOCK).where("n > 0")
    dealt = runs.repartition(n_buckets, "bucket").sortWithinPartitions("bucket", "run")
    return dealt.mapInPandas(combine, "doc long, th long, start long, end long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 7]
    names = [c.split()[0] for c in BLOCK.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


CUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"


def _cut(text: str | None, spans) -> tuple:
    raw = (text or "").encode("utf-8", "surrogatepass")
    merged: list[list[int]] = []
    for s in sorted(spans, key=lambda x: x["start"]) if spans is not None else ():
        if merged and s["start"] <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], s["end"])
        else:
            merged.append([s["start"], s["end"]])
    kept, last = [], 0
    for a, b in merged:
        kept.append(raw[last:a])
        last = b
    left = b"".join([*kept, raw[last:]])
    return len(raw), len(raw) - len(left), len(merged), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore")


def _cut_column(text: Column, spans: Column) -> Column:
    @F.pandas_udf(CUT)
    def each(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = [_cut(t, s) for t, s in zip(texts, lists, strict=True)]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in CUT.split(", ")])

    # A filter on the result would be moved below it, and every text cut twice, by two workers a task.
    return each.asNondeterministic()(text, spans)


def without_repeats(docs: DataFrame, **sizes) -> DataFrame:
    """``docs`` with a struct ``cut``: n_bytes, n_removed, n_spans, kept_sha256, kept_text.

    A byte goes if some 100-byte string that covers it also starts earlier, in a
    document of smaller doc_id or earlier in its own. Strings are judged on the
    input, matches never cross documents. ``kept_text`` drops bytes of letters
    cut in two; the digest is of the exact bytes.

    Null or short text: nothing removed. Documents without doc_id come last.
    Rows that repeat id and text are one document and get one result; rows of one
    id with other texts are ordered by the hash of the text. An empty table gives
    no rows. Other columns are kept, but for one named ``cut``, which is replaced.
    """
    doc, th = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    spans = repeated_spans(docs.select(doc.alias("doc"), th.alias("th"), "text"), **sizes)
    each = spans.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    own = [unused(docs, n) for n in ("doc_", "th_", "spans_")]
    joined = docs.join(each.toDF(*own), (doc == F.col(own[0])) & (th == F.col(own[1])), "left")
    return joined.withColumn("cut", _cut_column(F.col("text"), F.col(own[2]))).drop(*own)
