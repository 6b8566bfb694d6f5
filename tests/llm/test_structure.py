"""Structure repair against plain versions: a recursion over strings, and all edits of short conversations."""

import hashlib
import itertools
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest

from tallyscope.llm import structure

COLUMNS = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(BLANK)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def follow(state):
    return {"": "u", "s": "u", "u": "a", "a": "u"}[state]


def least(rows, fault):
    """(cost, audit) of the cheapest legal edits, by recursion from the end."""
    n = len(rows)

    @lru_cache(None)
    def best(i, state, inserts):
        options = [(0, "")] if i == n and state in ("", "a") else []
        if inserts < 2:
            c, a = best(i, follow(state), inserts + 1)
            options.append((c + 3, "I" + a))
        if i < n:
            extra = 3 * (fault[i] == "truncated")
            c, a = best(i + 1, state, 0)
            options.append((c + 4, "D" + a))
            if fault[i] not in ("blank", "duplicate"):
                first = rows[i][1][:1]
                if first == follow(state) or (state == "" and first == "s"):
                    c, a = best(i + 1, first, 0)
                    options.append((c + extra, "K" + a))
                c, a = best(i + 1, follow(state), 0)
                options.append((c + 3 + extra, "R" + a))
        return min(options, default=(1 << 40, ""))

    for i in range(n, -1, -1):
        for s in ("", "s", "u", "a"):
            best(i, s, 0)
    return best(0, "", 0)


def rendered(rows, audit):
    out, state, i = [], "", 0
    for e in audit:
        if e == "D":
            i += 1
            continue
        role, text = ("", "") if e == "I" else rows[i][1:]
        i += e != "I"
        if e == "K":
            state = role[0]
        else:
            state = follow(state)
            role = {"u": "user", "a": "assistant"}[state]
        out.append((role, text))
    return out


def plain(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    out = []
    for conv, own in convs.items():
        kept = plain_damage(own)
        fault = faults(kept)
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit = least(tuple(kept), tuple(fault))
        text = "\n".join(f"{r}:{t}" for r, t in rendered(kept, audit))
        out.append((conv, gaps, *(fault.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def same(df):
    got = [tuple(r) for r in structure.repair_structure(df).collect()]
    want = plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert sorted(map(str, got)) == sorted(map(str, want))
    return got


def some(seed, n_convs, longest):
    rng = np.random.default_rng(seed)
    rows = []
    for conv in range(n_convs):
        for turn in range(int(rng.integers(1, longest + 1))):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            text = rng.choice(["Yes.", "No!", "Why", " ", "", f"Text {turn}.", f"Cut {turn}", f"Fine {turn}?  \n"])
            rows.append((conv, None if rng.random() < 0.05 else turn * int(rng.integers(1, 3)), str(role), str(text)))
    return rows


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_provided_conversations(spark, sf):
    same(spark.read.parquet(f"/root/testdata/sf{sf}/conversations.parquet"))


def test_random_conversations(spark):
    same(spark.createDataFrame(some(1, 300, 12), COLUMNS).repartition(5))


def test_pieces_do_not_show(spark, monkeypatch):
    rows = some(2, 6, 90)
    monkeypatch.setattr(structure, "BLOCK_BITS", 2)
    same(spark.createDataFrame(rows, COLUMNS).repartition(3))


def test_one_long_conversation_and_partitions(spark):
    rows = [(7, *r[1:]) for r in some(3, 40, 60)] + some(4, 20, 5)
    df = spark.createDataFrame(rows, COLUMNS)
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in (1, 4, 16):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(str(tuple(r)) for r in structure.repair_structure(df).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
    assert found[0] == sorted(map(str, plain(rows)))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (1, 0, "user", None), (1, 0, None, "Text."),
        (2, None, "assistant", "B."), (2, None, "user", "A."), (3, 0, "user", "long words " * 40_000 + "."), (3, 1, "assistant", "end?\x00"),
        (4, 5, "user", ""), (5, -3, "system", "S."), (5, 9, "user", "Été! "),
    ] + [(6, 2, "user", "same.")] * 40 + [(8, 2, "user", "x" * 300 + c) for c in "abc"]
    got = structure.repair_structure(spark.createDataFrame(rows, COLUMNS)).collect()
    want = {str(w[0]): w for w in plain(rows)}
    for r in got:
        if r["conv_id"] != 8:  # turns alike in their first 256 characters go by a hash
            assert str(tuple(r)) == str(want[str(r["conv_id"])])
    assert len(got) == len(want)


def test_empty(spark):
    assert structure.repair_structure(spark.createDataFrame([], COLUMNS)).collect() == []


def test_clashing_columns_are_ignored(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(some(5, 10, 6), COLUMNS)
    extra = df.select("*", *[F.lit(1).alias(c) for c in ("none", "conv", "row", "kind", "mark", "rid", "cut", "block", "lead", "whole")])
    assert sorted(map(str, structure.repair_structure(extra).collect())) == sorted(map(str, structure.repair_structure(df).collect()))


def test_all_edits_of_short_conversations():
    rng = np.random.default_rng(6)
    price = {"D": 4, "I": 3, "K": 0, "R": 3}
    for _ in range(60):
        n = int(rng.integers(0, 4))
        initial, cut, gone = rng.integers(0, 4, n), rng.integers(0, 2, n), rng.random(n) < 0.2
        code = np.where(gone, 0, 1 + 2 * initial + cut).astype(np.uint8)
        found = []
        for length in range(n + 4):
            for audit in itertools.product("DIKR", repeat=length):
                if sum(e != "I" for e in audit) != n:
                    continue
                state, i, cost, right = "", 0, 0, True
                for e in audit:
                    cost += price[e]
                    if e == "I":
                        state = follow(state)
                        continue
                    if e != "D":
                        first = " sua"[initial[i]]
                        right &= not gone[i] and (e == "R" or first == follow(state) or (state == "" and first == "s"))
                        cost += 3 * int(cut[i])
                        state = follow(state) if e == "R" else first
                        if not right:
                            break
                    i += 1
                if right and state in ("", "a"):
                    found.append((cost, "".join(audit)))
        cost, audit = min(found)
        leave = structure.CLOSED
        matrix = structure.matrices([code])[0]
        assert int((matrix + leave).min(axis=1)[0]) == cost
        text, exits = structure.audits([code], leave[None])
        assert text[0][0] + structure.CLOSING[exits[0][0]] == audit


def test_ranks_choose_among_arcs_of_one_label():
    # two arcs of the same first letter differ only further on; ranks of longer audits are what tells nodes apart
    label = np.array([1, 2, 3, 0, 1])
    arcs = np.array([[1, 0, 0, 0], [0, 3, 0, 0], [0, 0, 3, 0], [0, 0, 0, 0], [2, 0, 0, 0]])
    good = np.zeros((5, 4), dtype=bool)
    for node, arc in ((0, 0), (1, 1), (2, 2), (4, 0)):
        good[node, arc] = True
    best, pointers = structure.ranked(label, arcs, good)
    assert list(best) == [1, 2, 3, 0, 1] and list(pointers[0]) == [1, 3, 3, 3, 2] and list(pointers[-1]) == [3] * 5
