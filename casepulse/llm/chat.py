"""Repair of the roles in conversations at least cost, and their rendering.

A legal conversation may begin with a system message; then user and assistant take turns, the
user first. The turns of a conversation are read in order, and each one begins a message, is
merged into the one before, or follows an empty message put in between; where its role does not
fit it is relabelled. Dynamic programming over the automaton of the last message's role finds
a cheapest way. Of equally cheap ways it takes the first, seen from the end of the part of the
conversation that lies in a partition.

A turn maps the costs of the four states before it to those after it, a product with a 4 x 4
matrix in which sums are minima and products are sums. Such products can be taken in pieces. So
turns are dealt out by range, sorted, and a conversation of any length may lie across partitions:
each partition gives the matrices of the conversations that it shares, at most two, these are
chained, and each partition then finds its own part of the cheapest way between the states that
the chain prescribes.

Turns are ordered by number (null first), role and text. Roles are compared without case and
surrounding blanks and by their usual other names; unknown and null roles cost little to
relabel. Null text is empty. Repeated rows are turns of their own; rows without a conversation
id form one conversation. Markers inside texts are broken up. Columns other than the four are
not looked at. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casepulse.llm.store import cut

ROLES = ("system", "user", "assistant")
SYSTEM, USER, ASSISTANT, START = range(4)
# Other names of the roles.
NAMES = {
    "system": SYSTEM,
    "developer": SYSTEM,
    "user": USER,
    "human": USER,
    "prompter": USER,
    "assistant": ASSISTANT,
    "gpt": ASSISTANT,
    "bot": ASSISTANT,
    "model": ASSISTANT,
    "ai": ASSISTANT,
    "chatbot": ASSISTANT,
}
#: What may follow each state, and where a conversation may end.
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = (USER, ASSISTANT)
#: Costs: another role than the turn's, one for an unknown role, a system turn or a turn made system, merging, an empty message.
RELABEL, UNKNOWN, SYSTEM_RELABEL, MERGE, INSERT = 2.0, 0.5, 3.0, 1.0, 1.5
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
FAR = np.inf


@dataclass(frozen=True)
class Step:
    """How a turn gets from one state to the next: ``action`` and the empty message before it, if any."""

    cost: float
    action: str
    inserted: int | None = None


def _relabel(role: int | None, to: int) -> float:
    if role == to:
        return 0.0
    if role is None:
        return UNKNOWN + (SYSTEM_RELABEL if to == SYSTEM else 0.0)
    return SYSTEM_RELABEL if SYSTEM in (role, to) else RELABEL


def _steps(role: int | None) -> dict[tuple[int, int], Step]:
    """The cheapest step of a turn between each two states that it can join."""
    best: dict[tuple[int, int], Step] = {}

    def offer(before: int, after: int, step: Step) -> None:
        if (before, after) not in best or step.cost < best[before, after].cost:
            best[before, after] = step

    for before, nexts in FOLLOWS.items():
        for to in nexts:
            cost = _relabel(role, to)
            offer(before, to, Step(cost, "keep" if cost == 0 else "relabel"))
        if before != START:
            offer(before, before, Step(MERGE + _relabel(role, before), "merge"))
        for between in nexts:
            for to in FOLLOWS[between]:
                offer(before, to, Step(INSERT + _relabel(role, to), "insert", between))
    return best


STEPS = {role: _steps(role) for role in (None, SYSTEM, USER, ASSISTANT)}
MATRICES = {
    role: np.asarray([[steps[a, b].cost if (a, b) in steps else FAR for b in range(4)] for a in range(4)])
    for role, steps in STEPS.items()
}
NEUTRAL = np.where(np.eye(4, dtype=bool), 0.0, FAR)


def role_of(name: str | None) -> int | None:
    return NAMES.get(name.strip().lower()) if name is not None else None


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The product of two matrices of least costs."""
    return (left[:, :, None] + right[None, :, :]).min(axis=1)


def cheapest(roles: list[int | None], before: int, after: int | None) -> list[int]:
    """The states after each turn on the cheapest way from a state to another, or to any final one."""
    costs, back = [FAR] * 4, []
    costs[before] = 0.0
    for role in roles:
        following, origin = [FAR] * 4, [0] * 4
        for (a, b), step in STEPS[role].items():
            cost = costs[a] + step.cost
            if cost < following[b]:
                following[b], origin[b] = cost, a
        costs = following
        back.append(origin)
    state = min(FINAL, key=lambda s: costs[s]) if after is None else after
    if after is None and costs[state] == FAR:
        state = int(np.argmin(costs))
    states = []
    for origin in reversed(back):
        states.append(state)
        state = origin[state]
    return states[::-1]


def clean(text: str | None) -> str:
    return (text or "").replace(OPEN, "< |im_start|>").replace(CLOSE, "< |im_end|>")


def segment(before: int, after: int, step: Step, text: str | None, last: bool) -> str:
    """What a turn adds to the rendered conversation; joined in order, segments are the whole."""
    if step.action == "merge":
        out = "\n" + clean(text)
    else:
        out = "" if before == START else f"{CLOSE}\n"
        if step.inserted is not None:
            out += f"{OPEN}{ROLES[step.inserted]}\n{CLOSE}\n"
        out += f"{OPEN}{ROLES[after]}\n{clean(text)}"
    return out + (f"{CLOSE}\n" if last else "")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, bool, list[list]]]:
    """Turns of one conversation in a row, in parts of at most a batch: its id, whether it begins here, columns."""
    before: object = None
    begun = False
    for batch in batches:
        columns = batch.to_pydict()
        ids = columns["conv_id"]
        edges = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]] + [len(ids)]
        for a, b in zip(edges, edges[1:], strict=False):
            yield ids[a], not begun or ids[a] != before, [columns[k][a:b] for k in ("turn", "role", "text")]
            before, begun = ids[a], True


def _summaries(turns: DataFrame, kind: str) -> DataFrame:
    """For the first and last conversation of each partition: its matrix and number of turns there."""

    id_type = _arrow_type(turns, "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[list] = []
        for conv, new, (_, roles, _) in _groups(batches):
            if new:
                held = held[:1] + [[conv, NEUTRAL]]
            for role in roles:
                held[-1][1] = chain(held[-1][1], MATRICES[role_of(role)])
        for place, (conv, matrix) in enumerate(held):
            costs = pa.array([matrix.ravel().tolist()], pa.list_(pa.float64()))
            columns = [pa.array([part]), pa.array([place]), pa.array([conv], id_type), costs]
            yield pa.record_batch(columns, ["part", "place", "conv_id", "matrix"])

    schema = f"part bigint, place bigint, conv_id {kind}, matrix array<double>"
    return turns.select("conv_id", "turn", "role", "text").mapInArrow(run, schema)


def _arrow_type(frame: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(frame.schema[column].dataType)


def _ways(summaries: list) -> dict[tuple[int, int], tuple[int, int | None]]:
    """State before and after each shared part, by partition and place; no state after it where it ends there.

    There are at most two parts for each partition, however long conversations are.
    """
    ways: dict[tuple[int, int], tuple[int, int | None]] = {}
    runs: list[list] = []
    for row in sorted(summaries, key=lambda r: (r["part"], r["place"])):
        joins = runs and runs[-1][-1]["conv_id"] == row["conv_id"] and runs[-1][-1]["part"] < row["part"]
        if joins:
            runs[-1].append(row)
        else:
            runs.append([row])
    for parts in runs:
        matrices = [np.asarray(p["matrix"]).reshape(4, 4) for p in parts]
        forward = [np.where(np.arange(4) == START, 0.0, FAR)]
        for m in matrices:
            forward.append((forward[-1][:, None] + m).min(axis=0))
        state = min(FINAL, key=lambda s: forward[-1][s])
        if forward[-1][state] == FAR:
            state = int(np.argmin(forward[-1]))
        for i in range(len(parts) - 1, -1, -1):
            before = int(np.argmin(forward[i] + matrices[i][:, state]))
            last = i == len(parts) - 1
            ways[parts[i]["part"], parts[i]["place"]] = (before, None if last and i == 0 else state if not last else ~state)
            state = before
    return ways


def repair(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row for each turn: ``conv_id``, ``turn``, ``role``, ``new_role``, ``action``, ``inserted``, ``rendered``.

    ``action`` is keep, relabel, merge or insert; ``inserted`` the role of an empty message put
    before the turn. The segments in ``rendered``, joined in the order of the turns, are the
    repaired conversation.
    """
    names = {"conv_id": conv_id, "turn": turn, "role": role, "text": text}
    chosen = turns.select(*(F.col(v).alias(k) for k, v in names.items()))
    order = ["conv_id", "turn", "role", "text", "tie"]
    spread = chosen.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order)
    dealt = cut(spread.sortWithinPartitions(*order).drop("tie"))  # the same partitions for both passes
    conv_kind, turn_kind = (dealt.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    ways = _ways(_summaries(dealt, conv_kind).collect())
    shared = dealt.sparkSession.sparkContext.broadcast(ways)
    kinds = [_arrow_type(dealt, "conv_id"), _arrow_type(dealt, "turn"), *[pa.string()] * 5]
    columns = ["conv_id", "turn", "role", "new_role", "action", "inserted", "rendered"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known = TaskContext.get().partitionId(), shared.value
        held: list = []
        place = 0
        for conv, new, more in _groups(batches):
            if new and held:
                yield made(held, known.get((part, 0)) if place == 0 else None)
                place += 1
                held = []
            if not held:
                held = [conv, *map(list, more)]
            else:  # a long conversation comes in many batches: added to, never copied
                for whole, part_ in zip(held[1:], more, strict=True):
                    whole.extend(part_)
        if held:
            yield made(held, known.get((part, min(place, 1))))

    def made(held: list, way: tuple[int, int | None] | None) -> pa.RecordBatch:
        conv, numbers, names_, texts = held
        before, after = way or (START, None)
        ends = after is None or after < 0
        after = ~after if after is not None and after < 0 else after
        roles = [role_of(x) for x in names_]
        states = cheapest(roles, before, after)
        rows: list[list] = [[], [], [], []]
        for i, (state, known_role) in enumerate(zip(states, roles, strict=True)):
            step = STEPS[known_role][before, state]
            inserted = None if step.inserted is None else ROLES[step.inserted]
            rendered = segment(before, state, step, texts[i], ends and i == len(states) - 1)
            for column, x in zip(rows, (ROLES[state], step.action, inserted, rendered), strict=True):
                column.append(x)
            before = state
        values = [[conv] * len(states), numbers, names_, *rows]
        return pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], columns)

    schema = f"conv_id {conv_kind}, turn {turn_kind}, role string, new_role string, action string, inserted string, rendered string"
    return dealt.mapInArrow(run, schema)
