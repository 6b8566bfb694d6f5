"""Mixing against a plain version."""

import hashlib
import math
import re
from collections import defaultdict

import pytest

from tallyscope.llm import mixing
from tests.llm.conftest import DOCUMENT, documents


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and weight[s] * rest / free > 3 * sizes[s]}
        if not more:
            return {s: float(3 * sizes[s]) if s in full else weight[s] * rest / free for s in names}, weight
        full |= more


def demanded(t, knots):
    """Integral of a schedule by small steps."""
    n, out = 4000, 0.0
    for k in range(n):
        x = t * (k + 0.5) / n * (len(knots) - 1)
        i = min(int(x), len(knots) - 2)
        out += (knots[i] + (knots[i + 1] - knots[i]) * (x - i)) * t / n
    return out


def plain(rows):
    groups = defaultdict(list)
    for doc_id, text, source in rows:
        mark = hashlib.md5(f"{'' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()
        groups[source].append((mark, doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    sizes = {s: sum(x[2] for x in g) for s, g in groups.items()}
    target, weight = plain_targets(sizes) if groups else ({}, {})
    out = []
    for s, group in groups.items():
        group.sort(key=lambda x: x[0])
        left = math.floor(target[s] + 0.5)
        taken, first = [0] * len(group), [None] * len(group)
        for _ in range(3):
            for i, (_, _, size) in enumerate(group):
                got = min(size, left)
                if got and first[i] is None:
                    first[i] = (math.floor(target[s] + 0.5) - left) / target[s]
                taken[i] += got
                left -= got
        assert left == 0
        out += [((d, n, sizes[s], round(target[s], 6), t), first[i], weight[s]) for i, ((_, d, n), t) in enumerate(zip(group, taken))]
    return out


def same(docs):
    got = docs.sparkSession.createDataFrame(mixing.mix(docs).collect(), "doc_id long, size long, source_size long, target double, taken long, source string, n_plays int, first_at double, plays array<struct<turn int, at double, words long>>").collect()
    want = plain([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    key = lambda x: str(x)
    assert sorted([(r[0], r[1], r[2], round(r[3], 6), r[4]) for r in got], key=key) == sorted([w[0] for w in want], key=key)
    for r in got:
        assert r["taken"] <= 3 * r["size"] and r["taken"] == sum(p["words"] for p in r["plays"])
    return got, want


def test_provided_documents(spark):
    got, want = same(documents(spark))
    shares = {(w[0][0]): (w[1], w[2]) for w in want}
    for r in got[:: max(1, len(got) // 12)]:
        part, weight = shares[r["doc_id"]]
        if part is None:
            assert r["first_at"] is None
        else:
            assert demanded(r["first_at"], mixing.SCHEDULE[mixing.WEIGHTS.index(weight)]) == pytest.approx(part, abs=1e-4)
    assert [r["first_at"] for r in got if r["first_at"] is not None] == sorted(r["first_at"] for r in got if r["first_at"] is not None)


def test_shares_follow_the_schedule(spark):
    docs = documents(spark, "0.01")
    run = mixing.curriculum(docs).collect()
    at = [r["at"] for r in run]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    mixed = mixing.mix(docs).collect()
    target, weight = plain_targets({r["source"]: r["source_size"] for r in mixed})
    longest = {s: max(r["size"] for r in mixed if r["source"] == s) for s in target}
    for w, knots in zip(mixing.WEIGHTS, mixing.SCHEDULE):
        whole = sum(t for s, t in target.items() if weight[s] == w)
        early = sum(r["words"] for r in run if weight[r["source"]] == w and r["at"] < 0.5)
        # a document counts where it starts, so a source is ahead by less than one document
        over = early - whole * mixing.integral(knots)[1]
        assert -len(target) <= over <= sum(longest[s] for s in target if weight[s] == w)


def test_nulls_ties_and_repeated_rows(odd):
    same(odd)


def test_empty(none):
    assert mixing.mix(none).collect() == []
    assert mixing.curriculum(none).collect() == []


def test_no_words_at_all(spark):
    got, _ = same(spark.createDataFrame([(1, None, "en", "a", 0), (2, " \t", "en", None, 0)], DOCUMENT))
    assert all(r["target"] == 0 and r["taken"] == 0 and r["first_at"] is None for r in got)


def test_targets_reshared_in_several_steps(spark):
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 9}" if i % 9 < 4 else "big", 0) for i in range(300)]
    rows += [(1000, "x y z", "en", "tiny", 0), (1001, "x", "en", "aa", 0), (1002, "long " * 5000, "en", None, 0)]
    same(spark.createDataFrame(rows, DOCUMENT).repartition(6))


def test_copies_of_one_row_are_spread(spark, monkeypatch):
    from tallyscope.llm import orders

    monkeypatch.setattr(orders, "COPY_BLOCK", 16)
    rows = [(5, "two words", "en", "a", 0)] * 200 + [(i, "one", "en", "b", 0) for i in range(50)]
    same(spark.createDataFrame(rows, DOCUMENT).repartition(3))


def test_reruns_agree_in_any_order(spark):
    docs = documents(spark)
    one = sorted(map(str, mixing.mix(docs).collect()))
    other = sorted(map(str, mixing.mix(docs.repartition(13).orderBy("n_chars")).collect()))
    assert one == other


def test_clashing_columns_are_ignored(odd):
    from pyspark.sql import functions as F

    extra = odd.select("*", *[F.lit(1).alias(c) for c in ("mark", "size", "words", "n", "before", "total", "target", "plays")])
    assert sorted(map(str, mixing.mix(extra).collect())) == sorted(map(str, mixing.mix(odd).collect()))


@pytest.mark.parametrize("knots", [(0.0, 1.0), (1.0, 0.0), (2.0, 0.5, 0.5, 3.0)])
def test_inverse(spark, knots):
    from pyspark.sql import functions as F

    got = spark.range(0, 101, 5).select((F.col("id") / 100.0).alias("d")).select("d", mixing._time(F.col("d"), knots).alias("t")).collect()
    whole = demanded(1.0, knots)
    for r in got:
        assert demanded(r["t"], knots) / whole == pytest.approx(r["d"], abs=1e-4)
