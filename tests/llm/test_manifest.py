"""Merkle manifest against a plain version."""

import hashlib
import zlib

import numpy as np
import pytest

from tallyscope.llm import manifest
from tests.llm.conftest import DOCUMENT, documents


def h(texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row, text):
    def one(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return h(one(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))


def tree(leaves):
    """Runs of each level, from the leaves up, and the last node."""
    runs, now = [], leaves
    while len(now) > 1:
        runs.append([now[i : i + 8] for i in range(0, len(now), 8)])
        now = [h(r) for r in runs[-1]]
    return runs, now[0]


def way(runs, i):
    for level in runs:
        yield level[i // 8], i % 8
        i //= 8


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r["lang"] is not None, (r["lang"] or "").encode()), []).append((r["doc_id"], leaf_of(r, r["text"]), r))
    names = sorted(groups)
    built = {}
    for name in names:
        own = sorted(groups[name], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        built[name] = own, tree([x[1] for x in own])
    top, root = tree([built[n][1][1] for n in names])
    out = []
    for k, name in enumerate(names):
        own, (runs, subroot) = built[name]
        for i, (doc_id, leaf, r) in enumerate(own):
            node = leaf
            if doc_id is not None and r["text"] is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                node = leaf_of(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]))
            siblings = []
            for run, slot in [*way(runs, i), *way(top, k)]:
                siblings += run[:slot] + run[slot + 1 :]
                node = h([*run[:slot], node, *run[slot + 1 :]])
            out.append((doc_id, leaf, subroot, root, h(siblings), node, node == root))
    return out


def same(docs):
    got = [tuple(r)[:7] for r in manifest.manifest(docs).collect()]
    want = plain([r.asDict() for r in docs.select("doc_id", "text", "source", "lang", "n_chars").collect()])
    assert sorted(map(str, got)) == sorted(map(str, want))
    return got


def test_provided_documents(spark):
    got = same(documents(spark))
    assert not all(r[6] for r in got)


def test_nulls_ties_and_repeated_rows(odd):
    same(odd)


def test_empty(none):
    assert manifest.manifest(none).collect() == []


def test_one_row(spark):
    got = same(spark.createDataFrame([(5, "Text", "xx", "a", 4)], DOCUMENT))
    assert got[0][1] == got[0][2] == got[0][3]


def test_several_blocks_sparse_negative_and_repeated_ids(spark):
    rows = [(i * 7919 - 40_000_000, f"Text {i}", "en" if i % 11 else None, None, i) for i in range(10_000)]
    rows += [(7, f"T {i % 50}", "en", None, i % 90) for i in range(500)] + [(7, "T", "en", None, 0)] * 300
    rows += [(1 << 62, "Last", "en", None, 0), (-(1 << 62), "First", "en", None, 0), (None, "A", "en", None, 0)]
    same(spark.createDataFrame(rows, DOCUMENT).repartition(5))


def test_many_groups(spark):
    same(spark.createDataFrame([(i, "Text", f"l{i % 70}", None, 1) for i in range(200)], DOCUMENT))


def test_chunks_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(manifest, "SALT_ROWS", 64)
    same(spark.createDataFrame([(i % 300, f"Text {i % 700}", "en", None, 1) for i in range(2000)], DOCUMENT))


def test_clashing_columns_are_ignored(spark, odd):
    from pyspark.sql import functions as F

    extra = odd.select("*", *[F.lit(1).alias(c) for c in ("leaf", "chunk", "low", "none", "idx", "row", "total", "before")])
    assert sorted(map(str, manifest.manifest(extra).collect())) == sorted(map(str, manifest.manifest(odd).collect()))


@pytest.mark.parametrize("n", [1, 700, 4096, 30_000])
def test_ranks(n):
    rng = np.random.default_rng(n)
    low = np.sort(rng.choice(manifest.CHUNK_IDS, n, replace=False))
    times = rng.integers(1, 4, n)
    *_, bits, extra = manifest._counted((), low, times)
    rank, same = manifest.Ranks(bits, extra)(low)
    assert (rank == np.cumsum(times) - times).all() and (same == times).all()
