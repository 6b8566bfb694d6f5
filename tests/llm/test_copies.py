"""Vectors, SimHash and suffixes against brute force."""

import hashlib
import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tallyscope.llm import rows as helpers
from tallyscope.llm import simhash, suffixes, vectors
from tallyscope.llm.queries import QUERIES
from tests.llm.conftest import DOCUMENT, documents

SF = "/root/testdata/sf0.01"


def roots(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


# vectors


def brute_vectors(ids, x, cosine=0.95):
    order = np.argsort(ids, kind="stable")
    ids, x = np.array(ids)[order], [x[i] for i in order]
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in x]
    n = len(ids)
    links = np.zeros(n, dtype=int)
    pairs = []
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(x[i]) == len(x[j]):
                a, b = (np.array(v, dtype=np.float64) / max(map(abs, v)) for v in (x[i], x[j]))
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                    links[[i, j]] += 1
                    pairs.append((j, i))
    root = roots(n, pairs)
    return sorted((int(ids[i]), int(links[i]), int(ids[root[i]]), bool(ids[root[i]] == ids[i])) for i in range(n))


def test_op1_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = sorted(tuple(r) for r in QUERIES["op1_near_vectors"](spark, SF).collect())
    assert got == brute_vectors([r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_op1_dense_groups_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 12))
    x = [list(map(float, base[i % 6] + rng.normal(size=12) * 0.08 * (1 + i % 3))) for i in range(260)]
    x += [x[0], x[0], None, [], [0.0] * 12, [float("nan")] * 12, [None] * 12, [1.0, 2.0], [2.0, 4.0], [float("inf")] + [1.0] * 11, [1e-300] * 12, [1e300] * 12]
    table = spark.createDataFrame([(i, v, "c") for i, v in enumerate(x)], "vec_id long, embedding array<double>, id string")
    monkeypatch.setattr(vectors, "TILE", 16)
    monkeypatch.setattr(vectors, "_ROW_COST", 0)
    monkeypatch.setattr(vectors, "STRIP", 8)
    got = sorted(tuple(r) for r in vectors.near_links(table).collect())
    assert got == brute_vectors(list(range(len(x))), x)
    empty = spark.createDataFrame([], table.schema)
    assert vectors.near_links(empty).count() == 0
    again = spark.createDataFrame([(1, x[0]), (1, x[0]), (None, x[0]), (2, x[1])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, vectors.near_links(again).collect()), key=str) == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True), (None, 0, None, True)]


def test_pairs_at_the_threshold_in_many_dimensions(spark):
    rng = np.random.default_rng(5)
    n, dims = 120, 768
    base = vectors.unit(rng.normal(size=(n, dims)))
    away = rng.normal(size=(n, dims))
    away = vectors.unit(away - (away * base).sum(axis=1, keepdims=True) * base)
    cosine = 0.95 + np.where(np.arange(n) % 2, 1e-6, -1e-6)
    near = cosine[:, None] * base + np.sqrt(1 - cosine**2)[:, None] * away
    x = np.vstack([base, near])
    table = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_links(table).collect()}
    assert [got[i] for i in range(n)] == [i % 2 for i in range(n)] == [got[n + i] for i in range(n)]


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(2000, 2000)]
    random.Random(3).shuffle(pairs)
    got = dict(map(tuple, helpers.components(spark.createDataFrame(pairs, "u long, v long")).collect()))
    assert all(got[i] == 0 for i in range(301)) and all(got[1000 + i] == 1000 for i in range(400))
    assert len(got) == 701


# fingerprints


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_simhash(rows):
    prints = [plain_fingerprint(r["text"]) for r in rows]
    f = np.array(prints, dtype=np.uint64)
    pairs = []
    for i in range(len(f)):
        pairs += [(i, int(j)) for j in np.flatnonzero(np.bitwise_count(f[:i] ^ f[i]) <= 2)]
    root = roots(len(f), pairs)
    least = {}
    for i, r in enumerate(root):
        if rows[i]["doc_id"] is not None:
            least[r] = min(least.get(r, rows[i]["doc_id"]), rows[i]["doc_id"])
    return sorted(((r["doc_id"], f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, root)), key=str)


def test_op5_equals_brute_force(spark):
    rows = documents(spark, "0.01").collect()
    assert sorted((tuple(r) for r in QUERIES["op5_simhash"](spark, SF).collect()), key=str) == brute_simhash(rows)


def test_op5_odd_rows(spark, odd, none):
    assert sorted((tuple(r) for r in simhash.near_duplicates(odd).collect()), key=str) == brute_simhash(odd.collect())
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("tile", [7, 4000])
def test_links_of_dense_fingerprints(spark, tile):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    prints = {s ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for s in seeds for _ in range(40)}
    f = np.array(sorted(prints), dtype=np.uint64)
    df = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "fp long")
    for parts in (2, 3, 4):
        found = simhash.plan(f, len(f), parts)
        assert sum(found.thresholds) == 2 - parts + 1
        got = {int(r["id"]): int(r["component_id"]) for r in helpers.components(simhash.links(df, found, tile=tile)).collect()}
        pairs = [(i, int(j)) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[:i] ^ f[i]) <= 2)]
        root = roots(len(f), pairs)
        groups, want = {}, {}
        for i in range(len(f)):
            groups.setdefault(got.get(int(f.view(np.int64)[i]), i), set()).add(i)
            want.setdefault(root[i], set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


# suffixes


def brute_cut(rows):
    order = sorted({(2**63 - 1 if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in rows})
    seen, result = set(), {}
    for doc, text in order:
        raw = text.encode()
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - 99):
            s = raw[i : i + 100]
            if s in seen:
                gone[i : i + 100] = True
            seen.add(s)
        left = bytes(b for b, g in zip(raw, gone) if not g)
        edge = np.diff(np.concatenate([[0], gone.astype(int)]))
        result[doc, text] = (len(raw), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(left).hexdigest())
    return sorted(((r["doc_id"], *result[2**63 - 1 if r["doc_id"] is None else r["doc_id"], r["text"] or ""]) for r in rows), key=str)


def test_op10_equals_brute_force(spark):
    rows = documents(spark, "0.01").collect()
    assert sorted((tuple(r) for r in QUERIES["op10_suffix_dedup"](spark, SF).collect()), key=str) == brute_cut(rows)


def test_op10_odd_rows(spark, odd, none):
    out = suffixes.without_repeats(odd).select("doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", "cut.kept_sha256")
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute_cut(odd.collect())
    assert suffixes.without_repeats(none).count() == 0


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 3}, {"bucket_rows": 50, "run_rows": 64}])
def test_op10_mixed_passages(spark, sizes):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdé\x00") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 6))]
        text = " ".join(parts)
        a = rng.randrange(len(text) + 1)
        rows.append((i // 2 if i % 7 == 0 else i, text[a:] if i % 3 == 0 else text, None, None, None))
    rows += [(500, "ab" * 400, None, None, None), (501, "x" * 260, None, None, None), (502, "x" * 150, None, None, None)]
    df = spark.createDataFrame(rows, DOCUMENT)
    if len({r[0] for r in rows}) < len(rows):  # one id with two texts goes by hash; brute force goes by text
        df = df.dropDuplicates(["doc_id"])
    df = helpers.materialise(df)
    out = suffixes.without_repeats(df, **sizes).select("doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", "cut.kept_sha256")
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute_cut(df.collect())


def test_loser_tree_merges_with_common_prefixes():
    rng = random.Random(4)
    for n_runs in (1, 2, 3, 5, 9):
        runs = []
        for _ in range(n_runs):
            keys = sorted(bytes(rng.choice(b"ab") for _ in range(6)).ljust(8, b"\0") for _ in range(rng.randint(0, 30)))
            lcp = [0] + [next((i for i in range(8) if a[i] != b[i]), 8) for a, b in zip(keys, keys[1:])]
            runs.append((keys, lcp[: len(keys)]))
        order, lcp = suffixes.merge(runs)
        got = [runs[r][0][i] for r, i in order]
        assert got == sorted(k for r in runs for k in r[0])
        assert lcp == ([0] + [next((i for i in range(8) if a[i] != b[i]), 8) for a, b in zip(got, got[1:])])[: len(got)]
