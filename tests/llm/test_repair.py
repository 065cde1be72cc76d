"""Conversation repair against brute force; odd input."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from millrace.llm import queries, repair

WORD = re.compile(r"[^\x20\x09-\x0D]")
COLUMNS = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        found = WORD.findall(text)
        out.append(
            "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else None
        )
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, messages) by trying every edit, from the end."""
    kinds = faults(rows)
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    full = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(k, state, inserted):
        found = [(0, "", ())] if k == len(rows) and state in ("", "a") else []

        def add(letter, cost, message, rest):
            if rest:
                found.append((cost + rest[0], letter + rest[1], (message, *rest[2]) if message else rest[2]))

        if inserted < 3:
            for c in "ua":
                if c in step[state]:
                    add("I", 2, f"{full[c]}:", best(k, step[state][c], inserted + 1))
        if k < len(rows):
            role, text = rows[k]
            add("D", 3, None, best(k + 1, state, 0))
            if kinds[k] not in ("blank", "duplicate"):
                cut = kinds[k] == "truncated"
                after = state if role[:1] == "" else step[state].get(role[0])
                if after is not None:
                    add("K", cut, f"{role}:{text}", best(k + 1, after, 0))
                for c in "ua":
                    if c in step[state]:
                        add("R", 2 + cut, f"{full[c]}:{text}", best(k + 1, step[state][c], 0))
        return min(found, key=lambda f: f[:2], default=None)

    return best(0, "", 0)


def expected(table):
    """Rows of the query by the words of its contract."""
    given = {}
    for conv_id, turn, role, text in table:
        own = given.setdefault(conv_id, [])
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        what = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        row = (turn is not None, turn or 0, "user" if what == 4 else role, text)
        own += [] if what == 0 else [row, row] if what == 3 else [row]
    out = []
    for conv_id, own in given.items():
        own.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        turns = {r[1] for r in own if r[0]}
        rows = [r[2:] for r in own]
        kinds, roles = faults(rows), [r[0][:1] for r in rows]
        cost, audit, messages = cheapest(tuple(rows))
        out.append((
            conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(kinds.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit,
            hashlib.sha256("\n".join(messages).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def table(seed, n=80, longest=14):
    draw = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Yes.", "No!", "Why?", "well", "", None, " \t", "é 東. ", "so.\n", "end", "x"]
    rows = []
    for conv_id in [None, *range(n)]:
        turns = draw.sample(range(-2, 40), draw.randrange(longest))
        usual = draw.random() < 0.5
        for i, turn in enumerate(turns):
            role = ["user", "assistant"][i % 2] if usual and draw.random() < 0.8 else draw.choice(roles)
            rows.append((conv_id, draw.choice([turn, turn, turn, None]), role, f"{draw.choice(texts)}" if draw.random() < 0.7 else draw.choice(texts)))
        if rows and draw.random() < 0.3:
            rows.append(rows[-1])
    draw.shuffle(rows)
    return rows


def test_query_is_brute_force(spark, tmp_path):
    rows = table(1)
    docs = spark.createDataFrame([(*r, 1, "e") for r in rows], f"{COLUMNS}, place int, edit string").repartition(3)
    docs.write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, queries.op11_conversation_repair(spark, str(tmp_path)).collect()), key=repr)
    assert got == expected(rows)


@pytest.mark.parametrize("most", [1, 4])
def test_segments_of_long_conversations(spark, most):
    rows = table(most + 5, 25, 30)
    found = repair.report(repair.edits(repair.damaged(spark.createDataFrame(rows, COLUMNS)), most=most)).collect()
    want = {r[0]: r for r in expected(rows)}
    assert {r.conv_id for r in found} == {k for k, r in want.items() if r[7] or r[6]}
    for r in found:
        assert tuple(r) == want[r.conv_id]


def test_segments_in_memory_are_the_whole():
    draw = random.Random(3)
    for _ in range(300):
        rows = [
            {"turn": 0, "role": draw.choice(["user", "assistant", "system", "x", ""]), "text": f"{i}.", "fault": draw.choice([None, None, "truncated", "blank"])}
            for i in range(draw.randrange(1, 20))
        ]
        whole = "".join(e["edit"] for e in repair._edits(rows, 0, repair._ENDS, True)[0])
        size = draw.randrange(1, 6)
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        left = repair.border_prices([repair.segment_costs(p) for p in parts])
        state, pieces = 0, ""
        for part, prices in zip(parts, left):
            found, state = repair._edits(part, state, repair._leave(prices), False)
            pieces += "".join(e["edit"] for e in found)
        pieces += "".join(e["edit"] for e in repair._edits([], state, repair._ENDS, True)[0])
        assert pieces == whole


def test_prices_are_a_dual_solution():
    messages = [(c, k % 3 == 0) for k, c in enumerate("uuasuaaauu" * 6)]
    arcs, prices = repair.message_lattice(messages, repair._ENDS, True)
    cost = repair.auction(arcs, prices, 0)
    assert all(prices[i] <= c + prices[to] for i, own in enumerate(arcs) for _, c, to in own)
    walk, node, paid = repair.least_walk(arcs, prices, 0), 0, 0
    for letter, to in walk:
        paid += min(c for x, c, t in arcs[node] if (x, t) == (letter, to))
        node = to
    assert paid == cost and node == len(arcs) - 1


def test_long_user_monologue_and_empty_table(spark):
    rows = [{"turn": i, "role": "user", "text": f"{i}.", "fault": None} for i in range(256)]
    assert "".join(e["edit"] for e in repair._edits(rows, 0, repair._ENDS, True)[0]) == "KR" * 128
    empty = spark.createDataFrame([], COLUMNS)
    assert repair.report(repair.edits(empty)).count() == 0
    odd = spark.createDataFrame([("c", "assistant", "Hi.", 2, 0)], "`x.y` string, r string, `a-b` string, t int, conv_id int")
    got = [tuple(r) for r in repair.edits(odd, ("x.y", "t", "r", "a-b")).select("conv_id", "edit", "new_role", "text").collect()]
    assert got == [("c", "I", "user", ""), ("c", "K", "assistant", "Hi.")]
