"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in alternation, the last by the assistant.
Each given turn is kept, given another role, or merged into the turn before it; empty turns
may be inserted before it and at the end. Dynamic programming over the automaton of legal turns finds the cheapest repair.

A conversation may hold a large share of all rows, so none is taken as a whole. Rows are sorted by range over
conversation and turn and cut into chunks of ``CHUNK`` rows. What a chunk's part of a conversation costs from any state to any
state is a 4 x 4 matrix; these products, one for each chunk that a conversation spans, are chained
to the states at which the chunks meet, and each chunk is then repaired on its own.

The result has one row for each given turn with its piece of the rendered conversation; the pieces of a
conversation joined in order of ``chunk`` and ``place`` are its rendering.

Defined results: roles are compared in lower case without outer white space, with common aliases; a null or unknown role has no
legal turn of its own and must be relabelled or merged. Null and empty texts are empty turns. Null turn numbers come first; ties
of conv_id and turn are ordered by a hash of role and text, and repeated rows are all kept as turns. Rows of null conv_id form one
conversation. Texts of any length are carried whole. Other columns, whatever their names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import session

CHUNK = 4096
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = (None, "system", "user", "assistant")
ALIASES = {"system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER, "assistant": ASSISTANT, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Costs of the repairs. A turn of unknown role is relabelled at the lower cost.
INSERT, RELABEL, NAME, MERGE = 3, 2, 1, 1
NEVER = 1 << 40


def _insertions() -> list[list[tuple[int, ...] | None]]:
    """The shortest sequence of inserted roles that leads from a state to another."""
    out: list[list[tuple[int, ...] | None]] = [[None] * 4 for _ in range(4)]
    for state in range(4):
        out[state][state] = ()
        queue = [state]
        for at in queue:
            for role in LEGAL[at]:
                if out[state][role] is None:
                    out[state][role] = (*out[state][at], role)
                    queue.append(role)
    return out


INSERTED = _insertions()


def _steps(role: int | None) -> list[list[tuple[int, str, tuple[int, ...]] | None]]:
    """The cheapest (cost, action, insertions before it) from each state to each, for a turn of ``role``."""
    out: list[list] = [[None] * 4 for _ in range(4)]
    for state in range(4):
        for via in range(4):
            path = INSERTED[state][via]
            if path is None:
                continue
            choices = [(to, 0 if to == role else NAME if role is None else RELABEL, "keep" if to == role else "relabel") for to in LEGAL[via]]
            if via != START and not path:  # nothing is merged into a turn that was inserted for it
                choices.append((via, MERGE + (0 if via == role else NAME if role is None else RELABEL), "merge"))
            for to, cost, action in choices:
                offer = (cost + INSERT * len(path), action, path)
                if out[state][to] is None or offer < out[state][to]:
                    out[state][to] = offer
    return out


STEPS = {role: _steps(role) for role in (None, SYSTEM, USER, ASSISTANT)}
MATRICES = {role: np.array([[NEVER if x is None else x[0] for x in row] for row in steps], np.int64) for role, steps in STEPS.items()}
#: What is inserted at the end of a conversation, by state.
ENDS = [INSERTED[state][ASSISTANT] for state in range(4)]
END_COSTS = np.array([INSERT * len(x) for x in ENDS], np.int64)


def role_of(name: str | None) -> int | None:
    return ALIASES.get((name or "").strip().lower())


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cheapest costs through both."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


def whole(roles: list[int | None]) -> np.ndarray:
    """Cheapest costs from each state to each over a run of turns."""
    out = np.where(np.eye(4, dtype=bool), 0, NEVER).astype(np.int64)
    for role in roles:
        out = product(out, MATRICES[role])
    return out


def repair(roles: list[int | None], entry: int = START, leave: int | None = None) -> tuple[list[tuple[str, int, tuple[int, ...]]], tuple[int, ...]]:
    """(action, role, insertions before) of each turn, and the insertions at the end.

    ``leave``: the state to end in; None ends the conversation there.
    """
    costs = np.full(4, NEVER, np.int64)
    costs[entry] = 0
    back = []
    for role in roles:
        grid = costs[:, None] + MATRICES[role]
        back.append(grid.argmin(axis=0))
        costs = np.minimum(grid.min(axis=0), NEVER)
    state = int((costs + END_COSTS).argmin()) if leave is None else leave
    tail = ENDS[state] if leave is None else ()
    out = []
    for role, step in zip(reversed(roles), reversed(back)):
        before = int(step[state])
        _, action, path = STEPS[role][before][state]
        out.append((action, state, path))
        state = before
    return out[::-1], tail


def _turn(role: int, text: str) -> str:
    return f"<|im_start|>{ROLES[role]}\n{text}"


CLOSE = "<|im_end|>\n"


def rendered(texts: list[str], moves: list[tuple[str, int, tuple[int, ...]]], tail: tuple[int, ...], open_before: bool, last: bool) -> list[str]:
    """The piece of each turn; a turn is closed by what follows it, or by the end of the conversation."""
    out = []
    for text, (action, role, path) in zip(texts, moves):
        if action == "merge":
            out.append("\n\n" + text if text else "")
            continue
        piece = CLOSE if open_before else ""
        piece += "".join(_turn(x, "") + CLOSE for x in path)
        out.append(piece + _turn(role, text))
        open_before = True
    if last and out:
        out[-1] += CLOSE + "".join(_turn(x, "") + CLOSE for x in tail)
    return out


def _runs(convs: list) -> list[tuple[int, int]]:
    cuts = [i for i in range(len(convs)) if i == 0 or convs[i] != convs[i - 1]] + [len(convs)]
    return list(zip(cuts, cuts[1:]))


SORTED = "chunk long, place int, conv_id long, turn long, role string, text string"


def _chunker(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Numbers the rows of each task in chunks of ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, place = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - place)
                yield pa.RecordBatch.from_arrays([pa.repeat(chunk, part.num_rows), pa.array(np.arange(place, place + part.num_rows, dtype=np.int32)), *part.columns], names=["chunk", "place", *batch.schema.names])
                at, place = at + part.num_rows, place + part.num_rows
                if place == size:
                    chunk, place = chunk + 1, 0

    return run


def _edges(table: pa.Table) -> pa.Table:
    """The first and the last conversation of a chunk with their matrices."""
    table = table.sort_by("place")
    convs, roles = table.column("conv_id").to_pylist(), [role_of(x) for x in table.column("role").to_pylist()]
    runs = _runs(convs)
    chunk = table.column("chunk")[0].as_py()
    own = sorted({0, len(runs) - 1})
    return pa.table(
        {
            "conv_id": pa.array([convs[runs[i][0]] for i in own], pa.int64()),
            "chunk": pa.array([chunk] * len(own), pa.int64()),
            "costs": pa.array([whole(roles[slice(*runs[i])]).reshape(-1).tolist() for i in own], pa.list_(pa.int64())),
        }
    )


def _chained(table: pa.Table) -> pa.Table:
    """The states in which each chunk's part of one conversation begins and ends on the cheapest way."""
    table = table.sort_by("chunk")
    grids = [np.array(x, np.int64).reshape(4, 4) for x in table.column("costs").to_pylist()]
    costs = np.full(4, NEVER, np.int64)
    costs[START] = 0
    back = []
    for grid in grids:
        ways = costs[:, None] + grid
        back.append(ways.argmin(axis=0))
        costs = np.minimum(ways.min(axis=0), NEVER)
    state = int((costs + END_COSTS).argmin())
    entries, leaves = [], []
    for i in range(len(grids) - 1, -1, -1):
        leaves.append(state if i < len(grids) - 1 else None)
        state = int(back[i][state])
        entries.append(state)
    return pa.table({"chunk": table.column("chunk"), "conv_id": table.column("conv_id"), "entry": pa.array(entries[::-1], pa.int32()), "leave": pa.array(leaves[::-1], pa.int32())})


REPAIRED = "conv_id long, chunk long, place int, turn long, given string, action string, role string, inserted array<string>, piece string"


def _repaired(table: pa.Table, states: pa.Table) -> pa.Table:
    if not table.num_rows:
        return pa.table({c: pa.array([], t) for c, t in _REPAIRED})
    table = table.sort_by("place")
    meets = {r["conv_id"]: (r["entry"], r["leave"]) for r in states.to_pylist()}
    convs, given, texts = (table.column(c).to_pylist() for c in ("conv_id", "role", "text"))
    actions, roles, inserted, pieces = [], [], [], []
    for a, b in _runs(convs):
        entry, leave = meets.get(convs[a], (START, None))
        moves, tail = repair([role_of(x) for x in given[a:b]], entry, leave)
        pieces += rendered([x or "" for x in texts[a:b]], moves, tail, entry != START, leave is None)
        for i, (action, role, path) in enumerate(moves):
            actions.append(action)
            roles.append(ROLES[role])
            inserted.append([ROLES[x] for x in path] + ([ROLES[x] for x in tail] if i == b - a - 1 else []))
    return pa.table(
        {
            "conv_id": table.column("conv_id"), "chunk": table.column("chunk"), "place": table.column("place"), "turn": table.column("turn"), "given": table.column("role"),
            "action": pa.array(actions, pa.string()), "role": pa.array(roles, pa.string()), "inserted": pa.array(inserted, pa.list_(pa.string())), "piece": pa.array(pieces, pa.string()),
        }
    )


_REPAIRED = [
    ("conv_id", pa.int64()), ("chunk", pa.int64()), ("place", pa.int32()), ("turn", pa.int64()), ("given", pa.string()),
    ("action", pa.string()), ("role", pa.string()), ("inserted", pa.list_(pa.string())), ("piece", pa.string()),
]


def formatted(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row for each row of ``turns``: conv_id, chunk, place, turn, given, action, role, inserted, piece.

    Order within a conversation is by (chunk, place). ``inserted``: the roles of empty turns before this one, for a
    conversation's last row also of those after it.
    """
    spark = turns.sparkSession
    session.workers_see(spark)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    by_range = rows.repartitionByRange("conv_id", "turn", F.xxhash64("role", "text")).sortWithinPartitions("conv_id", "turn", F.xxhash64("role", "text"), "role", "text")
    # the ranges rest on a sample, so what they have dealt out is written before it is used twice
    table = session.written(by_range.select(*order).mapInArrow(_chunker(chunk), SORTED), "turns")
    edges = table.select("chunk", "place", "conv_id", "role").groupBy("chunk").applyInArrow(_edges, "conv_id long, chunk long, costs array<long>")
    states = edges.groupBy("conv_id").applyInArrow(_chained, "chunk long, conv_id long, entry int, leave int")
    return table.groupBy("chunk").cogroup(states.groupBy("chunk")).applyInArrow(_repaired, REPAIRED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired turns of the whole of ``conversations``."""
    return formatted(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
