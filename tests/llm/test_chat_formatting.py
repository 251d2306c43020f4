import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from splitmetrics.llm import chat_formatting as chat

ROLES = ["system", "user", "assistant", None]
LEGAL = re.compile(r"s?(ua)+")


def brute_cost(roles):
    """The least cost over all label sequences, merges and insertions, by trying message lists."""
    best = None
    for actions in itertools.product("sua", repeat=len(roles)):
        for merged in itertools.product((False, True), repeat=len(roles)):
            cost, messages = 0, []
            for role, label, merge in zip(roles, actions, merged):
                own = {"system": "s", "user": "u", "assistant": "a"}.get(role)
                cost += 0 if own == label else chat.RELABEL if own else chat.RELABEL_UNKNOWN
                if merge:
                    if not messages or messages[-1] != label:
                        cost = None
                        break
                    cost += chat.MERGE
                else:
                    messages.append(label)
            if cost is None:
                continue
            need = insertions("".join(messages))
            if need is not None and (best is None or cost + need * chat.INSERT < best):
                best = cost + need * chat.INSERT
    return best


def insertions(messages):
    """The fewest letters to put into ``messages`` to make it legal."""
    for extra in range(0, len(messages) + 3):
        for word in legal(len(messages) + extra):
            at = iter(word)
            if all(m in at for m in messages):
                return extra
    return None


def legal(size):
    return [w for w in ("ua" * (size // 2) if size % 2 == 0 else "s" + "ua" * (size // 2),) if LEGAL.fullmatch(w)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(ROLES), min_size=1, max_size=4))
def test_cost_is_the_least(roles):
    _, total = chat.chain([chat.block_costs(roles)])
    assert total == brute_cost(roles)


def render_by_hand(roles, entry=chat.START):
    blocks, _ = chat.chain([chat.block_costs(roles)])
    return chat.repair(roles, blocks[0][0], blocks[0][1])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(ROLES), min_size=1, max_size=30), st.integers(1, 7))
def test_blocks_cost_what_the_whole_costs(roles, size):
    parts = [roles[k : k + size] for k in range(0, len(roles), size)]
    places, total = chat.chain([chat.block_costs(p) for p in parts])
    assert total == chat.chain([chat.block_costs(roles)])[1]
    state, cost = chat.START, 0
    for part, (entry, end, _) in zip(parts, places):
        assert entry == state
        for role, (action, way, to) in zip(part, chat.repair(part, entry, end)):
            own = chat.ROLE_STATES.get(role)
            cost += chat.INSERT * len(way) + (0 if own == to else chat.RELABEL if own else chat.RELABEL_UNKNOWN)
            for step in way:
                assert step in chat.FOLLOWS[state]
                state = step
            if action == "merge":
                assert to == state != chat.START
                cost += chat.MERGE
            else:
                assert to in chat.FOLLOWS[state] and (action == "keep") == (own == to)
            state = to
        assert state == end
    cost += chat.INSERT * len(chat.WAYS[state, chat.ACCEPTED])
    assert cost == total


SCHEMA = "conv_id long, turn long, role string, text string, part string, block string, piece string"


def rendered(frame):
    rows = chat.format_conversations(frame).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (str(r["conv_id"]), r["position"])):
        out.setdefault(r["conv_id"], []).append(r)
    for pieces in out.values():
        assert [p["position"] for p in pieces] == list(range(len(pieces)))
    return {k: "".join(p["piece"] for p in pieces) for k, pieces in out.items()}


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def test_rendering(spark):
    rows = [
        (1, 0, "user", "hello"), (1, 1, "assistant", "hi <|end|>"),
        (2, 0, "assistant", "first"), (2, 1, "user", "a"), (2, 2, "user", "b"), (2, 3, "User ", None),
        (3, 0, "system", "s"), (3, 1, "bot", "x"), (3, 2, "assistant", "y"),
        (None, 1, None, "n"), (None, None, "user", "m"),
    ]
    found = rendered(table(spark, rows))
    assert found[1] == "<|user|>\nhello<|end|>\n<|assistant|>\nhi < |end|><|end|>\n"
    assert found[2] == "<|user|>\n<|end|>\n<|assistant|>\nfirst<|end|>\n<|user|>\na\n\nb\n\n<|end|>\n<|assistant|>\n<|end|>\n"
    assert found[3] == "<|system|>\ns<|end|>\n<|user|>\nx<|end|>\n<|assistant|>\ny<|end|>\n"
    assert found[None] == "<|user|>\nm<|end|>\n<|assistant|>\nn<|end|>\n"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ROLES), min_size=1, max_size=4), min_size=1, max_size=12), st.integers(2, 5))
def test_levels_say_what_one_chain_says(parts, fan):
    blocks = [chat.block_costs(p) for p in parts]
    _, total = chat.chain(blocks)
    runs = [blocks[k : k + fan] for k in range(0, len(blocks), fan)]
    above, cost = chat.chain([chat.product(r) for r in runs])
    assert cost == total
    places = [p for run, (entry, end, _) in zip(runs, above) for p in chat.walk(run, entry, end)]
    reached = (0, 0)
    for block, (entry, end, _) in zip(blocks, places):
        reached = (reached[0] + block[entry][end][0], reached[1] + block[entry][end][1])
    assert [p[0] for p in places] == [chat.START, *(p[1] for p in places[:-1])]
    assert reached[0] + chat.INSERT * len(chat.WAYS[places[-1][1], chat.ACCEPTED]) == total


@pytest.mark.parametrize(("block", "fan"), [(256, 256), (3, 256), (3, 3)])
def test_a_hot_conversation_is_cut_and_stays_whole(spark, monkeypatch, block, fan):
    monkeypatch.setattr(chat, "BLOCK", block)
    monkeypatch.setattr(chat, "FAN", fan)
    draw = random.Random(4)
    rows = [(7, k, draw.choice([*ROLES, "tool"]), f"t{k}") for k in range(500)]
    rows += [(100 + c, k, draw.choice(ROLES), f"c{c} {k}") for c in range(60) for k in range(draw.randint(1, 9))]
    rows += [rows[5]] * 3
    found = chat.format_conversations(table(spark, rows)).collect()
    by = {}
    for r in sorted(found, key=lambda r: (r["conv_id"], r["position"])):
        by.setdefault(r["conv_id"], []).append(r)
    for conv_id, pieces in by.items():
        own = sorted((r for r in rows if r[0] == conv_id), key=lambda r: (r[1], r[2] or "", r[3]))
        assert [p["position"] for p in pieces] == list(range(len(pieces)))
        assert [p["turn"] for p in pieces if p["action"] not in ("insert", "end")] == [r[1] for r in own]
        messages = "".join(p["role"][0] for p in pieces if p["action"] not in ("merge", "end"))
        assert LEGAL.fullmatch(messages) and pieces[-1]["action"] == "end"
        cost = sum({"merge": chat.MERGE, "insert": chat.INSERT}.get(p["action"], 0) for p in pieces)
        for p in pieces:
            if p["action"] in ("keep", "relabel", "merge"):
                known = p["role_before"] in chat.ROLE_STATES
                cost += 0 if p["role"] == p["role_before"] else chat.RELABEL if known else chat.RELABEL_UNKNOWN
        assert cost == chat.chain([chat.block_costs([chat._known(r[2]) for r in own])])[1]


def test_empty_table(spark):
    assert chat.format_conversations(table(spark, [(1, 1, "user", "x")]).limit(0)).count() == 0
