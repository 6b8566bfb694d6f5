"""Repair of conversation structure: least cost by dynamic programming, least audit by doubled path ranks."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.llm.rows import segments, starts_of
from tallyscope.sources.durable import materialise

BLANKS = " \t\n\x0b\x0c\r"
#: Turns of a piece, the part of a conversation that one task ranks at a time.
BLOCK_BITS = 10

OTHER, SYSTEM, USER, ASSISTANT = range(4)
START = 0  # states: START, or the role seen last
NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LABELS = "DIKR"
DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
_FAR = 1 << 40

#: The user or assistant turn that may follow each state, and the turn that a role may open.
FOLLOWING = np.array([USER, USER, ASSISTANT, USER])
LEGAL = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: Edits that end a conversation legally, by state.
CLOSING = ("", "II", "I", "")

_TURNS = "none boolean, conv string, base long, codes binary, facts array<long>, matrix array<long>"
_ENDED = "none boolean, conv string, base long, codes binary, facts array<long>, cost long, leave array<long>"
_RANKED = "none boolean, conv string, base long, facts array<long>, cost long, audits array<string>, exits array<int>"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPAIRED = "none boolean, conv string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"


# costs: code 0 is a turn that has to go, code 1 + 2 * initial + cut any other


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cost of Keep by (code, state), the state after it, and cost of Rerole by code."""
    keep, to, rerole = np.full((9, 4), _FAR), np.zeros((9, 4), dtype=np.int64), np.full(9, _FAR)
    for initial in range(4):
        for cut in (0, 1):
            code = 1 + 2 * initial + cut
            rerole[code] = REROLE + CUT * cut
            for state in range(4):
                if (state, initial) in LEGAL:
                    keep[code, state], to[code, state] = CUT * cut, initial
    return keep, to, rerole


KEEP, KEPT, REROLED = _tables()


def _step() -> np.ndarray:
    """Least cost by (code, state before, state after), empty turns put in first included."""
    row = np.full((9, 4, 4), _FAR)
    for code in range(9):
        for x in range(4):
            row[code, x, x] = DELETE
            for y, cost in ((KEPT[code, x], KEEP[code, x]), (FOLLOWING[x], REROLED[code])):
                row[code, x, y] = min(row[code, x, y], cost)
    put = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for x in range(4):
        y, cost = x, 0
        for _ in range(2):
            y, cost = FOLLOWING[y], cost + INSERT
            put[x, y] = min(put[x, y], cost)
    return np.minimum((put[None, :, :, None] + row[:, None]).min(axis=2), _FAR)


STEP = _step()
CLOSED = np.array([INSERT * len(c) for c in CLOSING])


def matrices(codes: list[np.ndarray]) -> np.ndarray:
    """Least cost from each state to each other through the turns of each piece."""
    out = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, _FAR), (len(codes), 4, 4)).copy()
    size = np.array([len(c) for c in codes], dtype=np.int64)
    table = np.zeros((len(codes), int(size.max(initial=0))), dtype=np.int64)
    for i, c in enumerate(codes):
        table[i, : len(c)] = c
    for t in range(table.shape[1]):
        on = np.flatnonzero(size > t)
        out[on] = np.minimum((out[on][:, :, :, None] + STEP[table[on, t]][:, None]).min(axis=2), _FAR)
    return out


# ranks


def ranked(label: np.ndarray, arcs: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """First label on the least path of each node, and pointers along it that double in length.

    ``arcs`` are targets by (node, label) and ``good`` tells those on a path of
    least cost; nodes without any are ends and have label 0. Nodes are ranked by
    their least audits of 1, 2, 4 ... letters: a rank of twice the length orders
    pairs of a node's rank and the rank of the node that many letters on. With
    whole audits ranked, each node takes its arc of least (label, rank).
    """
    nodes = np.arange(len(label))
    at, rank = np.where(label > 0, arcs[nodes, label - 1], nodes), label.copy()
    while True:
        pair = rank.astype(np.int64) * (int(rank.max(initial=0)) + 1) + rank[at]
        rank = np.unique(pair, return_inverse=True)[1].reshape(-1)
        on = at[at]
        if (on == at).all():
            break
        at = on
    score = np.where(good, (np.arange(4)[None] + 1) * (int(rank.max(initial=0)) + 1) + rank[np.where(good, arcs, 0)], np.iinfo(np.int64).max)
    best = np.where(good.any(axis=1), score.argmin(axis=1) + 1, 0)
    pointers = [np.where(best > 0, arcs[nodes, best - 1], nodes)]
    while not (pointers[-1][pointers[-1]] == pointers[-1]).all():
        pointers.append(pointers[-1][pointers[-1]])
    return best, pointers


def audits(codes: list[np.ndarray], leave: np.ndarray) -> tuple[list[list[str]], np.ndarray]:
    """Least audit of each piece from each entry state, and the state it leaves; ``leave`` is the cost from there on."""
    size = np.array([len(c) for c in codes], dtype=np.int64)
    layer = np.concatenate([[0], np.cumsum(size + 1)])
    code = np.zeros(layer[-1], dtype=np.int64)
    for at, c in zip(layer, codes):
        code[at : at + len(c)] = c
    last = layer[1:] - 1
    cost = np.zeros((layer[-1], 4), dtype=np.int64)
    cost[last] = leave
    for t in range(1, int(size.max(initial=0)) + 1):
        at = last[size >= t] - t
        after, own = cost[at + 1], code[at]
        plain = np.minimum(DELETE + after, KEEP[own] + np.take_along_axis(after, KEPT[own], axis=1))
        plain = np.minimum(plain, REROLED[own][:, None] + after[:, FOLLOWING])
        cost[at] = np.minimum(plain, INSERT + np.minimum(plain, INSERT + plain[:, FOLLOWING])[:, FOLLOWING])
    inner = np.ones(layer[-1], dtype=bool)
    inner[last] = False
    node = np.arange(4 * layer[-1]).reshape(-1, 4)
    following = np.minimum(np.arange(layer[-1]) + 1, layer[-1] - 1)
    arcs = np.stack(
        [node[following], node[:, FOLLOWING], np.take_along_axis(node[following], KEPT[code], axis=1), node[following][:, FOLLOWING]], axis=2
    ).reshape(-1, 4)
    price = np.stack(
        [np.full(node.shape, DELETE), np.full(node.shape, INSERT), KEEP[code], np.broadcast_to(REROLED[code][:, None], node.shape)], axis=2
    ).reshape(-1, 4)
    whole = cost.reshape(-1)
    good = (price + whole[arcs] == whole[:, None]) & np.repeat(inner, 4)[:, None]
    label = np.where(good.any(axis=1), good.argmax(axis=1) + 1, 0)
    label, pointers = ranked(label, arcs, good)
    way = node[layer[:-1]].reshape(-1, 1)
    for p in pointers:
        way = np.hstack([way, p[way]])
    letters = np.frombuffer(("\0" + LABELS).encode(), dtype=np.uint8)[label[way]]
    text = [row.tobytes().rstrip(b"\0").decode("ascii") for row in letters]
    return [text[i : i + 4] for i in range(0, len(text), 4)], (pointers[-1][way[:, -1]] % 4).reshape(-1, 4)


# jobs


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns after the damage that their keys decide; nulls of ids, roles and texts read as one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind <> 0").withColumn("time", F.explode(times)).drop("kind")


def _sorted_turns(conversations: DataFrame) -> DataFrame:
    """Turns in order, numbered by ``rid``, of any conversation in as many tasks as its size asks for."""
    rows = damaged(conversations).withColumn("lead", F.left("text", F.lit(256))).withColumn("whole", F.xxhash64("text"))
    order = ["none", "conv", "known", "turn", "role", "lead", "whole"]
    rows = rows.repartitionByRange(*order, F.xxhash64("row", "time")).sortWithinPartitions(*order)
    body = F.rtrim("text", F.lit(BLANKS))
    initial = F.lit(OTHER)
    for letter, number in INITIALS.items():
        initial = F.when(F.left("role", F.lit(1)) == letter, number).otherwise(initial)
    return rows.select(
        "none", "conv", "known", "turn", "role", "text", F.monotonically_increasing_id().alias("rid"), initial.alias("initial"),
        (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("cut"), F.md5("text").alias("mark"),
    )


def _pieces(frames):
    """Codes, counts and cost tables of the pieces of each block of turns; a mark before a turn says that its text is new."""
    keys = ["block", "none", "conv"]
    for frame in segments(frames, ["block"], limit=8 << BLOCK_BITS):
        mark, rid = frame["mark"].to_numpy(), frame["rid"].to_numpy()
        new = np.zeros(len(frame), dtype=bool)
        new[1:] = mark[:-1] & (rid[1:] == rid[:-1])
        own, new = frame[~mark].reset_index(drop=True), new[~mark]
        blank, initial, known, turn = (own[c].to_numpy() for c in ("blank", "initial", "known", "turn"))
        twice = ~blank & ~new
        cut = ~blank & ~twice & own["cut"].to_numpy()
        code = np.where(blank | twice, 0, 1 + 2 * initial + cut).astype(np.uint8)
        edge = starts_of(own, keys)
        first = np.zeros(len(own), dtype=bool)
        first[edge[:-1]] = True
        before = np.roll(initial, 1)
        legal = ((before == SYSTEM) & (initial == USER)) | ((before == USER) & (initial == ASSISTANT)) | ((before == ASSISTANT) & (initial == USER))
        fresh = known & (first | ~np.roll(known, 1) | (np.roll(turn, 1) != turn))
        codes = [code[a:b] for a, b in zip(edge, edge[1:])]
        facts = [
            [
                int(blank[a:b].sum()), int(twice[a:b].sum()), int(cut[a:b].sum()), int((~legal[a + 1 : b]).sum()), int(initial[a]), int(initial[b - 1]),
                int(fresh[a:b].sum()), int(turn[a:b][known[a:b]].min(initial=np.iinfo(np.int64).max)), int(turn[a:b][known[a:b]].max(initial=np.iinfo(np.int64).min)),
            ]
            for a, b in zip(edge, edge[1:])
        ]
        yield pd.DataFrame(
            {
                "none": own["none"].to_numpy()[edge[:-1]], "conv": own["conv"].to_numpy()[edge[:-1]], "base": own["rid"].to_numpy()[edge[:-1]],
                "codes": [c.tobytes() for c in codes], "facts": facts, "matrix": list(matrices(codes).reshape(-1, 16)),
            }
        )


def _ends(frames):
    """Pieces of each conversation from its last: the cost from the end of each on, and of all from its start."""
    now, cost = None, CLOSED
    for frame in frames:
        leave, whole = [], []
        for none, conv, matrix in zip(frame["none"], frame["conv"], frame["matrix"]):
            if (none, conv) != now:
                now, cost = (none, conv), CLOSED
            leave.append(cost)
            cost = (np.asarray(matrix).reshape(4, 4) + cost).min(axis=1)
            whole.append(int(cost[START]))
        yield frame[["none", "conv", "base", "codes", "facts"]].assign(cost=whole, leave=leave)


def _ranked_pieces(frames):
    for frame in frames:
        size = frame["codes"].map(len).to_numpy()
        frame = frame.iloc[np.argsort(size, kind="stable")]
        size = np.sort(size)
        at = 0
        while at < len(frame):
            end = at + 1
            while end < len(frame) and (end + 1 - at) * (size[end] + 1) <= 1 << 14:
                end += 1
            part = frame.iloc[at:end]
            text, exits = audits([np.frombuffer(c, dtype=np.uint8) for c in part["codes"]], np.stack(list(part["leave"])))
            yield part[["none", "conv", "base", "facts", "cost"]].assign(audits=text, exits=list(exits.astype(np.int32)))
            at = end


class _Repair:
    """A conversation as it streams by: its counts, its audit, and the digest of what stays."""

    def __init__(self, none: bool, conv: str):
        self.key, self.state, self.script, self.at = (none, conv), START, "", 0
        self.counts, self.last, self.cost, self.audit = np.zeros(5, dtype=np.int64), None, 0, []
        self.low, self.high = None, None
        self.hash, self.any, self.leave = hashlib.sha256(), False, START

    def begin(self, facts, cost, audits, exits) -> None:
        blank, twice, cut, illegal, first, last, fresh, low, high = (int(f) for f in facts)
        if self.last is None:
            self.cost = int(cost)
        elif (self.last, first) not in LEGAL or self.last == START:
            illegal += 1
        if fresh:
            if self.low is None:
                self.low = low
            fresh -= self.high == low
            self.high = high
        self.counts += (fresh, blank, twice, cut, illegal)
        self.last = last
        self.script, self.at = audits[self.leave], 0
        self.leave = int(exits[self.leave])
        self.audit.append(self.script)

    def put(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def insert(self) -> None:
        self.state = int(FOLLOWING[self.state])
        self.put(NAMES[self.state], "")

    def turn(self, role: str, text: str) -> None:
        while self.script[self.at] == "I":
            self.insert()
            self.at += 1
        edit = self.script[self.at]
        self.at += 1
        if edit == "K":
            self.state = INITIALS[role[0]]
            self.put(role, text)
        elif edit == "R":
            self.state = int(FOLLOWING[self.state])
            self.put(NAMES[self.state], text)

    def row(self) -> tuple:
        closing = CLOSING[self.state]
        for _ in closing:
            self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - int(self.counts[0])
        return (*self.key, gaps, *(int(c) for c in self.counts[1:]), self.cost, "".join(self.audit) + closing, self.hash.hexdigest())


def _repaired(frames):
    names = [c.split()[0] for c in _REPAIRED.split(", ")]
    now = None
    for frame in frames:
        out = []
        for none, conv, kind, role, text, facts, cost, scripts, exits in zip(
            *[frame[c] for c in ("none", "conv", "kind", "role", "text", "facts", "cost", "audits", "exits")]
        ):
            if kind == 0:
                if now is not None:
                    out.append(now.row())
                now = _Repair(none, conv)
            elif kind == 1:
                now.begin(facts, cost, scripts, exits)
            else:
                now.turn(role, text)
        yield pd.DataFrame(out, columns=names)
    if now is not None:
        yield pd.DataFrame([now.row()], columns=names)


def repair_structure(conversations: DataFrame) -> DataFrame:
    """Faults, cost, least audit and digest of the repaired text of every conversation, after damage.

    Turns are put in order by range, so a conversation of any length is many
    pieces. Each piece is summed up in a 4 x 4 table of costs; the tables of a
    conversation are joined from its end, which gives each piece the costs that
    follow it. Pieces then rank the nodes of their least-cost arcs (place and
    state) by audits of doubling length and follow doubled pointers to the least
    audit from each state they may be entered in. Last, the turns of each
    conversation stream through a task, beside these audits, to be digested:
    one digest over a text has to run in one place, but holds a turn at a time.

    Null conv_id: one conversation. Null role or text: one space. Null turns come
    first and are left out of gaps; turns of equal number go by role, the first
    256 characters of their text and a hash of it. Repeated rows are turns of
    their own. Conversations that lose every turn have zeros. An empty table
    gives no rows. Other columns are ignored.
    """
    kind = conversations.schema["conv_id"].dataType
    turns = materialise(_sorted_turns(conversations), "turns")
    block = F.shiftright("rid", BLOCK_BITS)
    new = turns.where(~F.col("blank")).groupBy("none", "conv", "role", "mark").agg(F.min("rid").alias("rid"))
    rows = turns.select(block.alias("block"), "rid", F.lit(False).alias("mark"), "none", "conv", "initial", "blank", "cut", "known", "turn")
    marks = new.select(
        block.alias("block"), "rid", F.lit(True).alias("mark"), "none", "conv", F.lit(0).alias("initial"), F.lit(False).alias("blank"),
        F.lit(False).alias("cut"), F.lit(False).alias("known"), F.lit(0).cast("long").alias("turn"),
    )
    dealt = rows.unionByName(marks).repartition("block").sortWithinPartitions("block", "rid", F.col("mark").desc())
    pieces = dealt.mapInPandas(_pieces, _TURNS)
    conv = ["none", "conv"]
    ended = pieces.repartition(*conv).sortWithinPartitions(*conv, F.col("base").desc()).mapInPandas(_ends, _ENDED)
    scripts = ended.repartition("base").mapInPandas(_ranked_pieces, _RANKED)
    parts = {
        "kind": "int", "rid": "long", "role": "string", "text": "string", "facts": "array<long>", "cost": "long", "audits": "array<string>", "exits": "array<int>",
    }

    def part(df, number, rid, *own):
        given = {"kind": F.lit(number), "rid": rid} | {c: F.col(c) for c in own}
        return df.select(*conv, *[given.get(c, F.lit(0 if c == "cost" else None)).cast(t).alias(c) for c, t in parts.items()])

    every = conversations.select(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")).distinct()
    stream = part(every, 0, F.lit(-1)).unionByName(part(scripts, 1, F.col("base"), "facts", "cost", "audits", "exits"))
    stream = stream.unionByName(part(turns, 2, F.col("rid"), "role", "text"))
    out = stream.repartition(*conv).sortWithinPartitions(*conv, "rid", "kind").mapInPandas(_repaired, _REPAIRED)
    return out.select(F.when(~F.col("none"), F.col("conv").cast(kind)).alias("conv_id"), *_COUNTS, "audit", "repaired_sha256")
