"""Chat formatting: the cheapest repair of a conversation's roles, then its rendering.

A legal conversation is one that this automaton accepts: an optional system message, then user and
assistant in turn, from user to assistant. A turn is kept, relabelled, or merged into the message before it, and empty
messages may be put in between; each has a cost, and dynamic programming over the automaton's states
finds the repair of least cost, and among those one with the fewest insertions.

The costs of a run of turns are a matrix, from each state before it to each state after it, and matrices of
neighbouring runs combine, so a conversation need not be in one task. Turns are sorted by range partitioning, which cuts a very
long conversation anywhere; each task makes blocks of at most ``BLOCK`` turns. A conversation that lies in one block is repaired
at once. For the others the matrices alone come together, in levels: at most ``FAN`` neighbours are multiplied into one, until a
conversation has one matrix. The states before and after that are known, and are walked back down the same levels, to
say in which state each block begins and ends; then all blocks are repaired on their own. So no task has more than
``FAN`` matrices of a conversation at once, however long it is.

A turn is rendered as a piece, and a conversation is its pieces in order of ``position``; a piece of an insertion
has no text of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitmetrics.llm.rows import importable, map_rows
from splitmetrics.sources.workspace import stage

#: Turns of a block.
BLOCK = 256
#: Matrices that are multiplied into one.
FAN = 256

# The states, each named after the role of the last message, and what may follow.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
ACCEPTED = ASSISTANT
STATES = (START, SYSTEM, USER, ASSISTANT)
ROLE_STATES = {role: state for state, role in ROLES.items()}

# What a repair costs. A role that is none of the three has to become one.
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 1, 4, 1, 2

_NONE = (1 << 40, 0)
Cost = tuple[int, int]


def _insertions() -> dict[tuple[int, int], tuple[int, ...]]:
    """Between two states the messages of the shortest way there."""
    ways = {(s, s): () for s in STATES}
    for _ in STATES:
        for (a, b), way in list(ways.items()):
            for c in FOLLOWS[b]:
                if (a, c) not in ways:
                    ways[a, c] = (*way, c)
    return ways


WAYS = _insertions()


def _steps(role: str | None) -> list[tuple[int, int, int, tuple[int, ...], str]]:
    """What a turn of this role can do: state before, state after, cost, insertions, and the action."""
    own = ROLE_STATES.get(role)
    steps = []
    for (before, at), way in WAYS.items():
        inserted = INSERT * len(way)
        for after in FOLLOWS[at]:
            relabel = 0 if after == own else RELABEL_UNKNOWN if own is None else RELABEL
            steps.append((before, after, inserted + relabel, way, "keep" if after == own else "relabel"))
        if not way and at != START:
            relabel = 0 if at == own else RELABEL_UNKNOWN if own is None else RELABEL
            steps.append((before, at, MERGE + relabel, way, "merge"))
    # Of steps between the same states only the cheapest counts.
    best = {}
    for step in steps:
        key = step[0], step[1]
        if key not in best or (step[2], len(step[3])) < (best[key][2], len(best[key][3])):
            best[key] = step
    return list(best.values())


STEPS = {role: _steps(role) for role in (*ROLE_STATES, None)}


def _known(role: str | None) -> str | None:
    role = (role or "").strip().lower()
    return role if role in ROLE_STATES else None


def _advance(costs: list[Cost], role: str | None) -> list[Cost]:
    after = [_NONE] * len(STATES)
    for before, to, cost, way, _ in STEPS[role]:
        total = (costs[before][0] + cost, costs[before][1] + len(way))
        if costs[before] < _NONE and total < after[to]:
            after[to] = total
    return after


def _from(state: int) -> list[Cost]:
    return [(0, 0) if s == state else _NONE for s in STATES]


def block_costs(roles: list[str | None]) -> list[list[Cost]]:
    """The matrix of a run: least cost and insertions from each state before to each state after."""
    rows = []
    for state in STATES:
        costs = _from(state)
        for role in roles:
            costs = _advance(costs, role)
        rows.append(costs)
    return rows


def closing(costs: list[Cost]) -> tuple[Cost, int]:
    """The least cost with the insertions at the end, and the state before these."""
    return min(
        ((c[0] + INSERT * len(WAYS[s, ACCEPTED]), c[1] + len(WAYS[s, ACCEPTED])), s)
        for s, c in enumerate(costs)
        if (s, ACCEPTED) in WAYS and c < _NONE
    )


def _through(reached: list[Cost], rows: list[list[Cost]]) -> list[Cost]:
    """The costs after a run, from those before it and the run's matrix."""
    now = [
        min((before[0] + rows[s][to][0], before[1] + rows[s][to][1]) for s, before in enumerate(reached))
        for to in STATES
    ]
    return [min(c, _NONE) for c in now]


def product(blocks: list[list[list[Cost]]]) -> list[list[Cost]]:
    """The matrix of neighbouring runs."""
    return reduce(lambda rows, block: [_through(row, block) for row in rows], blocks)


def walk(blocks: list[list[list[Cost]]], entry: int, end: int) -> list[tuple[int, int, int]]:
    """For each of neighbouring runs its states before and after on a cheapest way, and the insertions before it."""
    reached = [_from(entry)]
    for rows in blocks:
        reached.append(_through(reached[-1], rows))
    out, state = [], end
    for k in range(len(blocks) - 1, -1, -1):
        goal = reached[k + 1][state]
        before = next(
            s
            for s, cost in enumerate(reached[k])
            if (cost[0] + blocks[k][s][state][0], cost[1] + blocks[k][s][state][1]) == goal
        )
        out.append((before, state, reached[k][before][1]))
        state = before
    return out[::-1]


def chain(blocks: list[list[list[Cost]]]) -> tuple[list[tuple[int, int, int]], int]:
    """For each block of a whole conversation its states before and after, and the insertions before it.

    Also the cost of the conversation.
    """
    total, state = closing(product(blocks)[START])
    return walk(blocks, START, state), total[0]


def repair(roles: list[str | None], entry: int, end: int) -> list[tuple[str, tuple[int, ...], int]]:
    """For each turn the action, the insertions before it, and the state after it."""
    costs = [_from(entry)]
    for role in roles:
        costs.append(_advance(costs[-1], role))
    out = []
    for k in range(len(roles) - 1, -1, -1):
        for before, to, cost, way, action in STEPS[roles[k]]:
            total = (costs[k][before][0] + cost, costs[k][before][1] + len(way))
            if to == end and costs[k][before] < _NONE and total == costs[k + 1][end]:
                out.append((action, way, end))
                end = before
                break
    return out[::-1]


# How a message is written: its head, the text, its end. "<|" in a text is written "< |".
def _head(state: int, first: bool) -> str:
    return ("" if first else "<|end|>\n") + f"<|{ROLES[state]}|>\n"


def _plain(text: str | None) -> str:
    return (text or "").replace("<|", "< |")


_TURN = "struct<turn:long,role:string,text:string>"
_BLOCK = (
    f"conv_id long, part int, block int, turns array<{_TURN}>, alone boolean, costs array<long>"
)
_PIECES = (
    "conv_id long, position long, turn long, role_before string, role string, action string, piece string"
)


def _blocks(conversations: DataFrame) -> DataFrame:
    """Blocks of turns in order; ``alone`` where a block is surely all of its conversation."""
    order = ("conv_id", "turn", "role", "text")
    turns = conversations.select(*order)
    spread = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = turns.repartitionByRange(spread, *order).sortWithinPartitions(*order)

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        held, first = None, True
        for conv_id, group in groupby(rows, key=lambda row: row[0]):
            if held is not None:  # the last conversation may go on in the next partition
                yield held
            block, turns, held = 0, [], None
            for _, turn, role, text in group:
                if len(turns) == BLOCK:
                    yield _block(conv_id, part, block, turns, False)
                    block, turns = block + 1, []
                turns.append({"turn": turn, "role": role, "text": text})
            held = _block(conv_id, part, block, turns, not first and not block)
            first = False
        if held is not None:
            yield (*held[:4], False, held[5] or _flat(held[3]))

    return map_rows(ranged, cut, _BLOCK)


def _flat(turns: list[dict]) -> list[int]:
    rows = block_costs([_known(t["role"]) for t in turns])
    return [number for row in rows for cost in row for number in cost]


def _block(conv_id, part: int, block: int, turns: list[dict], alone: bool) -> tuple:
    return conv_id, part, block, turns, alone, None if alone else _flat(turns)


def _matrix(flat) -> list[list[Cost]]:
    size = len(STATES)
    pairs = [(int(flat[k]), int(flat[k + 1])) for k in range(0, 2 * size * size, 2)]
    return [pairs[size * a : size * (a + 1)] for a in range(size)]


_NODE = "conv_id long, part int, block int, turns long, costs array<long>"
_PLACE = "conv_id long, part int, block int, entry int, exit int, position long, last boolean"
_PARENT = ["conv_id", "up_part", "up_block"]


def _multiplied(group: pd.DataFrame) -> pd.DataFrame:
    """The node above a few neighbouring ones."""
    group = group.sort_values(["part", "block"])
    rows = product([_matrix(flat) for flat in group["costs"]])
    out = group[_PARENT].head(1).set_axis(["conv_id", "part", "block"], axis=1)
    out["conv_id"] = out["conv_id"].astype("Int64")
    out["turns"] = group["turns"].sum()
    out["costs"] = [[number for row in rows for cost in row for number in cost]]
    return out


def _walked(group: pd.DataFrame) -> pd.DataFrame:
    """The places of neighbouring nodes, from that of the node above them."""
    group = group.sort_values(["part", "block"])
    above = group.iloc[0]
    places = walk([_matrix(flat) for flat in group["costs"]], int(above["entry"]), int(above["exit"]))
    group["entry"] = [p[0] for p in places]
    group["exit"] = [p[1] for p in places]
    # A piece for each turn and insertion before.
    group["position"] += group["turns"].cumsum() - group["turns"] + [p[2] for p in places]
    group["last"] &= [False] * (len(group) - 1) + [True]
    group["conv_id"] = group["conv_id"].astype("Int64")
    return group[["conv_id", "part", "block", "entry", "exit", "position", "last"]]


def _top(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv_id, part, block, _, costs in rows:
        ((entry, end, _),), _ = chain([_matrix(costs)])
        yield conv_id, part, block, entry, end, 0, True


def _places(nodes: DataFrame) -> DataFrame:
    """The states before and after each block, its first position, and whether it ends its conversation."""
    levels, divided = [nodes], []
    for column, most in nodes.agg(F.max("block").alias("block"), F.max("part").alias("part")).first().asDict().items():
        left = most or 0
        while left:  # blocks of a partition first, then partitions
            left //= FAN
            other = "part" if column == "block" else "block"
            up = {f"up_{column}": F.expr(f"int({column} div {FAN})"), f"up_{other}": F.col(other)}
            divided.append(levels[-1].withColumns(up))
            levels.append(stage(divided[-1].groupBy(*_PARENT).applyInPandas(_multiplied, _NODE), "turn_levels"))
    places = map_rows(levels[-1], _top, _PLACE)
    for children in reversed(divided):
        found = children.alias("c").join(
            places.alias("p"),
            F.col("c.conv_id").eqNullSafe(F.col("p.conv_id"))
            & (F.col("c.up_part") == F.col("p.part"))
            & (F.col("c.up_block") == F.col("p.block")),
        )
        found = found.select("c.*", "p.entry", "p.exit", "p.position", "p.last")
        places = found.groupBy(*_PARENT).applyInPandas(_walked, _PLACE)
    return places


def _pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv_id, turns, entry, end, position, last in rows:
        roles = [_known(t["role"]) for t in turns]
        if entry is None:
            places, _ = chain([block_costs(roles)])
            entry, end, position, last = places[0][0], places[0][1], 0, True
        state = entry

        def inserted(way):
            nonlocal position, state
            for to in way:
                yield conv_id, position, None, None, ROLES[to], "insert", _head(to, state == START)
                position, state = position + 1, to

        for turn, (action, way, to) in zip(turns, repair(roles, entry, end), strict=True):
            yield from inserted(way)
            head = "\n\n" if action == "merge" else _head(to, state == START)
            yield conv_id, position, turn["turn"], turn["role"], ROLES[to], action, head + _plain(turn["text"])
            position, state = position + 1, to
        if last:
            yield from inserted(WAYS[state, ACCEPTED])
            yield conv_id, position, None, None, None, "end", "<|end|>\n"


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The pieces of every repaired conversation.

    Columns: conv_id, position (gapless from 0), turn and role_before (null for insertions), role (after the repair), action
    (keep, relabel, merge, insert, end) and piece. Turns lie in the order of turn, role and text, nulls first.
    A role that is none of the three, or null, is unknown; a null text is empty. Repeated rows are turns of their
    own, and all rows with a null conv_id are one conversation. An empty table gives an empty result.
    """
    importable(conversations.sparkSession)
    blocks = stage(_blocks(conversations), "turn_blocks")
    turns = F.size("turns").cast("long").alias("turns")
    places = _places(blocks.where("not alone").select("conv_id", "part", "block", turns, "costs"))
    rest = blocks.where("not alone").alias("b").join(
        places.alias("p"),
        F.col("b.conv_id").eqNullSafe(F.col("p.conv_id"))
        & (F.col("b.part") == F.col("p.part"))
        & (F.col("b.block") == F.col("p.block")),
    )
    rest = rest.select("b.conv_id", "b.turns", "p.entry", "p.exit", "p.position", "p.last")
    whole = blocks.where("alone").selectExpr(
        "conv_id", "turns", "int(null) entry", "int(null) exit", "bigint(null) position", "boolean(null) last"
    )
    return map_rows(whole.union(rest), _pieces, _PIECES)
