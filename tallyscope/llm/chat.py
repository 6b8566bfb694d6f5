"""Chat formatting with minimum-cost repair of roles."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.llm.rows import segments, starts_of
from tallyscope.sources.durable import materialise

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
ALIASES = {"system": SYSTEM, "user": USER, "human": USER, "prompter": USER, "assistant": ASSISTANT, "bot": ASSISTANT, "gpt": ASSISTANT, "model": ASSISTANT}

#: The legal-turn automaton: an optional system turn, then user and assistant in turns, ending on the assistant.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
END = {START: 0, ASSISTANT: 0, USER: 3, SYSTEM: 6}  # empty turns that have to be added at the end

MERGE, RELABEL, NAME, INSERT = 1, 5, 1, 3
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
_FAR = 1 << 40

TURN = "conv_id long, part int, place long, turn long, role string, text string, summary array<long>, roles binary"
_PART = "conv long, none boolean, part int, place long, shift long, summary array<long>, enter array<long>"
_ENDS = "conv long, none boolean, part int, shift long, enter array<long>, leave int, last boolean"
PIECE = "conv_id long, place long, turn long, action string, cost int, role string, text string, rendered string"


def known_role(role: str | None) -> int:
    """Role by name or alias, case and blanks aside; START for none of them."""
    return ALIASES.get((role or "").strip().lower(), START)


@lru_cache(maxsize=8)
def moves(role: int) -> dict[tuple[int, int], tuple[int, str, tuple[int, ...]]]:
    """(state before, state after) -> cost, action, empty turns put in before; for a turn of this role.

    A turn may open a turn of its own or another role, do so after one empty
    turn, or join the turn before. Of equal costs the first of these is taken.
    """
    out: dict[tuple[int, int], tuple[int, str, tuple[int, ...]]] = {}

    def offer(s: int, t: int, cost: int, action: str, empty: tuple[int, ...] = ()) -> None:
        other = 0 if role == t else NAME if role == START else RELABEL
        if (s, t) not in out or cost + other < out[s, t][0]:
            out[s, t] = (cost + other, action if not other else f"{action}+relabel", empty)

    for s, following in NEXT.items():
        for t in following:
            offer(s, t, 0, "keep")
            for u in NEXT[t]:
                offer(s, u, INSERT, "insert", (t,))
        if s != START:
            offer(s, s, MERGE, "merge")
    return out


@lru_cache(maxsize=8)
def _matrix(role: int) -> np.ndarray:
    m = np.full((4, 4), _FAR, dtype=np.int64)
    for (s, t), (cost, _, _) in moves(role).items():
        m[s, t] = cost
    return m


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least cost from each state to each other through both."""
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), _FAR)


def summary(roles: list[int]) -> np.ndarray:
    """Costs from each state before the turns to each state after them."""
    out = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for r in roles:
        out = product(out, _matrix(r))
    return out


def _onward(cost: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least cost of each state after a step, and the least state before it that has it."""
    total = cost[:, None] + m
    return np.minimum(total.min(axis=0), _FAR), total.argmin(axis=0)


def final_state(cost: np.ndarray) -> int:
    """State to end in: the least of those that are cheapest with their closing cost."""
    return int(np.argmin(cost + np.array([END[s] for s in range(4)])))


FIRST = np.where(np.arange(4) == START, 0, _FAR)


def entries(steps: list[np.ndarray], enter: np.ndarray) -> np.ndarray:
    """State before the steps on the way to each state after them."""
    cost, entry = enter, np.arange(4)
    for m in steps:
        cost, back = _onward(cost, m)
        entry = entry[back]
    return entry


def path(steps: list[np.ndarray], enter: np.ndarray = FIRST, leave: int | None = None) -> list[int]:
    """States before and after each step on the cheapest way, given the cost of being in each at first.

    Of ways of equal cost it is the one whose last state is least, then the one
    before, and so on; the costs of the states a part is entered in are all that
    this takes, so it does not matter how a conversation is cut into parts.
    """
    cost, back = enter, []
    for m in steps:
        cost, b = _onward(cost, m)
        back.append(b)
    out = [final_state(cost) if leave is None else leave]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


def _plain(text: str | None) -> str:
    """Text whose own marks cannot open or close a turn."""
    return (text or "").replace("<|im_", "<|_im_")


def _closing(state: int) -> list[int]:
    """Empty turns that end a conversation legally."""
    return {USER: [ASSISTANT], SYSTEM: [USER, ASSISTANT]}.get(state, [])


def repair(conversations: DataFrame) -> DataFrame:
    """Pieces of every conversation, legal and rendered; ``rendered`` in order of ``place`` is its whole string.

    One row a turn kept, relabelled or merged, one an empty turn put in, and one
    that closes the conversation (``end``), each with its cost. The plan is a cheapest one through
    the legal-turn automaton; of plans of equal cost the one with the least last
    state is taken, then the least before it, and so on. Turns are dealt by range
    of (conv_id, turn), so a conversation of any length is many parts; each part
    is summed up in a 4 x 4 table of costs. The tables of a conversation give the
    costs of the states each part is entered in; with these a part tells which it
    was entered in for each state it is left in, and from the end of the
    conversation the states between its parts are known. Parts do not show in the
    result.

    Null or unknown role: a cheap relabel. Null text: empty. Null turn: first.
    Null conv_id: one conversation. Turns with equal numbers go by role and
    text; repeated rows are turns of their own. An empty table gives no rows.
    Other columns are ignored.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    order = ["conv_id", "turn", "role", "text_key", "text"]
    n_parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.withColumn("text_key", F.xxhash64("text")).withColumn("salt", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(n_parts, *order[:4], "salt").sortWithinPartitions(*order)

    def number(frames):
        from pyspark import TaskContext

        part, place = TaskContext.get().partitionId(), 0
        last, total, first, seen = None, None, 0, bytearray()

        def closed():
            return pd.DataFrame(
                {"conv_id": [None if last == "null" else last], "part": part, "place": first, "turn": None, "role": None, "text": None,
                 "summary": [total.ravel()], "roles": [bytes(seen)]}
            )

        for frame in frames:
            ids = [("null" if pd.isna(c) else int(c)) for c in frame["conv_id"]]
            cut = [0, *[i for i in range(1, len(ids)) if ids[i] != ids[i - 1]], len(ids)]
            for a, b in zip(cut, cut[1:]):
                if a == b:
                    continue
                if last is not None and ids[a] != last:
                    yield closed()
                    total = None
                if total is None:
                    first, seen = place + a, bytearray()
                last = ids[a]
                known = [known_role(r) for r in frame["role"].iloc[a:b]]
                seen += bytes(known)
                step = summary(known)
                total = step if total is None else product(total, step)
            out = frame[["conv_id", "turn", "role", "text"]].copy()
            out["part"], out["place"], out["summary"], out["roles"] = part, np.arange(place, place + len(out)), None, None
            place += len(out)
            yield out[["conv_id", "part", "place", "turn", "role", "text", "summary", "roles"]]
        if last is not None:
            yield closed()

    rows = materialise(dealt.select("conv_id", "turn", "role", "text").mapInPandas(number, TURN), "turns")
    # a null conversation is one as well: its flag is part of the key
    rows = rows.withColumn("none", F.col("conv_id").isNull()).withColumn("conv", F.coalesce("conv_id", F.lit(0)))
    parts = rows.where("summary is not null").select("conv", "none", "part", "place", "summary", "roles")
    conv, keys = ["conv", "none"], ["conv", "none", "part"]

    def forward(frames):
        now, cost, before = None, FIRST, 0
        for frame in frames:
            enter, shift = [], []
            for key, place, m, roles in zip(zip(frame["conv"], frame["none"]), frame["place"], frame["summary"], frame["roles"]):
                if key != now:
                    now, cost, before = key, FIRST, 0
                enter.append(cost)
                shift.append(before - place)
                cost, before = _onward(cost, np.asarray(m).reshape(4, 4))[0], before + len(roles)
            yield frame.assign(enter=enter, shift=shift)[[c.split()[0] for c in _PART.split(", ")] + ["roles"]]

    def entered(frames):
        for frame in frames:
            yield frame.drop(columns="roles").assign(entry=[
                entries([_matrix(r) for r in roles], np.asarray(enter)) for roles, enter in zip(frame["roles"], frame["enter"])])

    def backward(frames):
        now, state = None, START
        for frame in frames:
            leave, last = [], []
            for key, enter, m, entry in zip(zip(frame["conv"], frame["none"]), frame["enter"], frame["summary"], frame["entry"]):
                last.append(key != now)
                if key != now:
                    now, state = key, final_state(_onward(np.asarray(enter), np.asarray(m).reshape(4, 4))[0])
                leave.append(state)
                state = int(entry[state])
            yield frame.assign(leave=leave, last=last)[[c.split()[0] for c in _ENDS.split(", ")]]

    known = parts.repartition(*conv).sortWithinPartitions(*keys).mapInPandas(forward, _PART + ", roles binary")
    known = known.repartition(*keys).mapInPandas(entered, _PART + ", entry array<int>")
    known = known.repartition(*conv).sortWithinPartitions(*conv, F.col("part").desc()).mapInPandas(backward, _ENDS)
    joined = rows.where("summary is null").drop("summary", "roles").join(materialise(known, "ends"), keys)

    def render(frames):
        for frame in segments(frames, keys, limit=20_000):
            edge = starts_of(frame, keys)
            out: list[tuple] = []
            for a, b in zip(edge, edge[1:]):
                group = frame.iloc[a:b]
                out.extend(_pieces(group))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PIECE.split(", ")])

    return joined.repartition(*keys).sortWithinPartitions(*keys, "place").mapInPandas(render, PIECE)


def _pieces(group: pd.DataFrame) -> list[tuple]:
    conv = None if group["none"].iloc[0] else int(group["conv"].iloc[0])
    roles = [known_role(r) for r in group["role"]]
    state, *states = path([_matrix(r) for r in roles], np.asarray(group["enter"].iloc[0]), int(group["leave"].iloc[0]))
    shift = int(group["shift"].iloc[0])
    out = []
    span = 4  # room for empty turns between the places of turns
    for place, turn, text, r, t in zip(group["place"], group["turn"], group["text"], roles, states, strict=True):
        cost, action, empty = moves(r)[state, t]
        turn = None if pd.isna(turn) else int(turn)
        at = (int(place) + shift) * span
        for e in empty:
            out.append((conv, at, turn, "empty", INSERT, ROLES[e], "", (CLOSE if state != START else "") + f"{OPEN}{ROLES[e]}\n"))
            state, at = e, at + 1
        body = _plain(text)
        if action.startswith("merge"):
            lead = "\n"
        else:
            lead = (CLOSE if state != START else "") + f"{OPEN}{ROLES[t]}\n"
        out.append((conv, at, turn, action, cost - INSERT * len(empty), ROLES[t], body, lead + body))
        state = t
    if group["last"].iloc[0]:
        at += 1
        for e in _closing(state):
            out.append((conv, at, None, "empty", INSERT, ROLES[e], "", f"{CLOSE}{OPEN}{ROLES[e]}\n"))
            at += 1
        out.append((conv, at, None, "end", 0, None, "", CLOSE))
    return out
