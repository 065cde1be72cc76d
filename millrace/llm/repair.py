"""Repair of conversation structure at least cost, by the auction algorithm for shortest paths.

Messages may be kept, given another role, deleted or inserted so that the initials of the roles read ``(s?(ua)+)?``. States of
that pattern (nothing yet, after system, after user, after assistant) times places between messages are the nodes of a lattice,
edits its arcs with whole costs. *Auction:* a path grows from the start along the arc of the least cost plus price; where a
node's price is below that, it is raised and the path gives the node up. When the path is at the end, the prices are a dual
solution: every arc of every cheapest path is tight (price = cost + next price). The tight arcs are walked by letters in ASCII
order, without those that lead nowhere, so the first walk that arrives is the least audit. A state and a letter say what comes
next: an audit stands for one repair.

A conversation of up to ``most`` messages is solved in the task that has it. A longer one is dealt by place into segments of
that many: each segment tells the costs between its states (auctions), a lattice of segments gives the prices at their borders
(auction), each segment then finds its least audit from each state; the chain of these picks one. Audits of segments end with a
message each, so none is the beginning of another and the chain is the least audit as a whole. Only numbers of segments meet
in one group, the messages of a long conversation never do.

Nulls and odd input: a null role or text is one space; null ids are one conversation; null turns come first and count for no
gap; messages of one turn stand in the order of role and text; the initial of an empty role is empty, so that keeping such a
message changes no state; repeated rows are duplicates; an empty table gives an empty one; further columns do not matter.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast, stage
from .text import WORD, name

# Costs of the edits by their initial, and of a message left without its end.
COSTS = {"D": 3, "I": 2, "K": 0, "R": 2}
CUT = 1
# Messages solved at once (a matter of time and memory, not of results); a power of two.
MOST = 256
NOTHING, SYSTEM, USER, PAIRED = range(4)
# The state after a message of the one role that may follow besides a first system message.
_NEXT = {NOTHING: USER, SYSTEM: USER, USER: PAIRED, PAIRED: USER}
_ROLE = {USER: "user", PAIRED: "assistant"}
_INFINITE = float("inf")
_ENDS = {NOTHING: 0, PAIRED: 0}


def _kept(state: int, initial: str) -> int | None:
    """The state after a message that is kept; None where it may not follow."""
    if initial == "":
        return state
    if initial == "s" and state == NOTHING:
        return SYSTEM
    return _NEXT[state] if initial == {USER: "u", PAIRED: "a"}[_NEXT[state]] else None


def message_lattice(messages: list[tuple[str, bool]], leave: dict[int, int], last: bool) -> tuple[list[list], list]:
    """Arcs (letter, cost, node) of each node in ASCII order, and prices to begin with. ``messages`` are (initial, cut off) of
    those that may stay, ``leave`` what it costs to end in a state, ``last`` says whether insertions may follow the last one.
    Node 4 * k + state is before message k; the node after all others is the end."""
    end = 4 * len(messages) + 4
    arcs, prices, price = [], [], min(leave.values(), default=0) + CUT * sum(cut for _, cut in messages)
    for k in range(len(messages) + 1):
        initial, cut = messages[k] if k < len(messages) else ("", False)
        for state in range(4):
            own = []
            to = 4 * k + 4
            if k < len(messages):
                own.append(("D", COSTS["D"], to + state))
            if k < len(messages) or last:
                own.append(("I", COSTS["I"], 4 * k + _NEXT[state]))
            if k < len(messages):
                stays = _kept(state, initial)
                if stays is not None:
                    own.append(("K", COSTS["K"] + CUT * cut, to + stays))
                own.append(("R", COSTS["R"] + CUT * cut, to + _NEXT[state]))
            elif state in leave:
                own.insert(0, ("", leave[state], end))
            arcs.append(own)
        prices += [price] * 4
        price -= CUT * cut
    return [*arcs, []], [*prices, 0]


def auction(arcs: list[list], prices: list, start: int) -> int:
    """Raise ``prices`` until a path of tight arcs leads from ``start`` to the last node; returns its cost. The prices given
    are no higher than the cost of any arc plus the price behind it; the end must be within reach."""
    end, path = len(arcs) - 1, [start]
    while path[-1] != end:
        node = path[-1]
        best, to = _INFINITE, node
        for _, cost, other in arcs[node]:
            if cost + prices[other] < best:
                best, to = cost + prices[other], other
        if prices[node] < best:
            prices[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)
    return prices[start]


def least_walk(arcs: list[list], prices: list, start: int) -> list[tuple[str, int]]:
    """(letter, node) steps of the walk over tight arcs to the last node whose letters come first."""
    end, dead = len(arcs) - 1, set()
    steps, open_ = [], [(start, iter(arcs[start]))]
    while open_:
        node, left = open_[-1]
        for letter, cost, to in left:
            if to not in dead and prices[node] == cost + prices[to]:
                steps.append((letter, to))
                if to == end:
                    return steps
                open_.append((to, iter(arcs[to])))
                break
        else:
            dead.add(node)
            open_.pop()
            steps and steps.pop()
    raise ValueError("the end is out of reach")


def _within_reach(arcs: list[list], start: int) -> set[int]:
    seen, open_ = {start}, [start]
    while open_:
        for _, _, to in arcs[open_.pop()]:
            if to not in seen:
                seen.add(to)
                open_.append(to)
    return seen


def _may_stay(rows: list[dict]) -> list[tuple[str, bool]]:
    return [(r["role"][:1], r["fault"] == "truncated") for r in rows if r["fault"] not in ("blank", "duplicate")]


def _edits(rows: list[dict], entry: int, leave: dict[int, int], last: bool) -> tuple[list[dict], int]:
    """The edits of the least audit in order, and the state they end in."""
    arcs, prices = message_lattice(_may_stay(rows), leave, last)
    auction(arcs, prices, entry)
    out, at, state = [], 0, entry

    def must_go():
        nonlocal at
        while at < len(rows) and rows[at]["fault"] in ("blank", "duplicate"):
            out.append({**rows[at], "edit": "D", "new_role": None})
            at += 1

    for letter, node in least_walk(arcs, prices, entry):
        must_go()
        if node == len(arcs) - 1:
            break
        state = node % 4
        if letter == "I":
            out.append({"turn": None, "role": None, "text": "", "fault": None, "edit": "I", "new_role": _ROLE[state]})
        else:
            role = {"D": None, "K": rows[at]["role"], "R": _ROLE.get(state)}[letter]
            out.append({**rows[at], "edit": letter, "new_role": role})
            at += 1
    return out, state


# --- segments of long conversations -----------------------------------------------------------------------------


def segment_costs(rows: list[dict]) -> list[int | None]:
    """Least cost from each state before a segment to each after it (4 * from + to); None where there is no way."""
    messages, costs = _may_stay(rows), [None] * 16
    for to in range(4):
        arcs, prices = message_lattice(messages, {to: 0}, False)
        for entry in range(4):
            if len(arcs) - 1 in _within_reach(arcs, entry):
                costs[4 * entry + to] = auction(arcs, prices, entry)
    return costs


def border_prices(segments: list[list[int | None]]) -> list[list[int | None]]:
    """What is left to pay after each segment in each state that a cheapest repair passes; None for other states."""
    end = 4 * len(segments) + 4
    least = [min(c for c in costs if c is not None) for costs in segments]
    arcs, prices, price = [], [], sum(least)
    for k, costs in enumerate(segments):
        for state in range(4):
            arcs.append([("", costs[4 * state + to], 4 * k + 4 + to) for to in range(4) if costs[4 * state + to] is not None])
        prices += [price] * 4
        price -= least[k]
    tail, tail_prices = message_lattice([], _ENDS, True)
    for own in tail:
        arcs.append([(letter, cost, end - 4 + to) for letter, cost, to in own])
    prices += tail_prices
    auction(arcs, prices, NOTHING)
    tight = [[to for _, cost, to in own if prices[i] == cost + prices[to]] for i, own in enumerate(arcs)]
    forward, open_ = {NOTHING}, [NOTHING]
    while open_:
        for to in tight[open_.pop()]:
            if to not in forward:
                forward.add(to)
                open_.append(to)
    good = {end}
    for i in range(end - 1, -1, -1):  # twice over the last layer: insertions lead up and down in it
        if any(to in good for to in tight[i]):
            good.add(i)
        if i == end - 4:
            good.update(j for _ in range(3) for j in range(end - 4, end) if any(to in good for to in tight[j]))
    passed = forward & good
    return [[prices[i] if i in passed else None for i in range(4 * k + 4, 4 * k + 8)] for k in range(len(segments))]


def _rows_of(table: pa.Table) -> list[dict]:
    return table.sort_by("seq").to_pylist()


def _tell_costs(table: pa.Table) -> pa.Table:
    rows = _rows_of(table)
    costs = pa.array([segment_costs(rows)], pa.list_(pa.int64()))
    return pa.table([table["conv_id"][:1], table["segment"][:1], costs], ["conv_id", "segment", "costs"])


def _tell_prices(table: pa.Table) -> pa.Table:
    table = table.sort_by("segment")
    left = pa.array(border_prices(table["costs"].to_pylist()), pa.list_(pa.int64()))
    return pa.table([table["conv_id"], table["segment"], left], ["conv_id", "segment", "left"])


def _leave(left: list[int | None]) -> dict[int, int]:
    return {state: price for state, price in enumerate(left) if price is not None}


def _tell_exits(table: pa.Table) -> pa.Table:
    """The state after the least audit of a segment, for each state before it."""
    rows = _rows_of(table)
    leave = _leave(rows[0]["left"])
    arcs, _ = message_lattice(_may_stay(rows), leave, False)
    exits = [_edits(rows, s, leave, False)[1] if len(arcs) - 1 in _within_reach(arcs, s) else None for s in range(4)]
    left, exits = pa.array([rows[0]["left"]], pa.list_(pa.int64())), pa.array([exits], pa.list_(pa.int64()))
    return pa.table([table["conv_id"][:1], table["segment"][:1], left, exits], ["conv_id", "segment", "left", "exits"])


def _chain(table: pa.Table) -> pa.Table:
    table = table.sort_by("segment")
    state, entries = NOTHING, []
    for exits in table["exits"].to_pylist():
        entries.append(state)
        state = exits[state]
    after = [None] * (len(entries) - 1) + [state]  # the state that the conversation's last segment leaves
    return pa.table(
        [table["conv_id"], table["segment"], table["left"], pa.array(entries, pa.int64()), pa.array(after, pa.int64())],
        ["conv_id", "segment", "left", "entry", "after"],
    )


_FIELDS = ["place", "edit", "turn", "role", "new_role", "text", "fault"]


def _edit_rows(conv_id, edits: list[dict], first: int, schema: pa.Schema) -> pa.Table:
    rows = [{"conv_id": conv_id, "place": first + i, **{f: e[f] for f in _FIELDS[1:]}} for i, e in enumerate(edits)]
    return pa.Table.from_pylist(rows, schema)


def _segment_editor(most: int, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        rows = _rows_of(table)
        own = rows[0]
        edits, _ = _edits(rows, own["entry"], _leave(own["left"]), False)
        if own["after"] is not None:
            edits += _edits([], own["after"], _ENDS, True)[0]
        return _edit_rows(own["conv_id"], edits, own["segment"] * 4 * most, schema)

    return run


def _conversations(batches):
    """(id, rows) of a stream in which the rows of a conversation stand together."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for conv_id, own in groupby(rows, lambda r: r["conv_id"]):
        yield conv_id, own


def _short_editor(schema: pa.Schema):
    def run(batches):
        for conv_id, own in _conversations(batches):
            rows, seen = list(own), set()
            for r in rows:
                if r["fault"] != "blank" and (r["role"], r["text"]) in seen:
                    r["fault"] = "duplicate"
                seen.add((r["role"], r["text"]))
            yield from _edit_rows(conv_id, _edits(rows, NOTHING, _ENDS, True)[0], 0, schema).to_batches()

    return run


def _messages(rows: DataFrame, columns: tuple[str, str, str, str]) -> DataFrame:
    conv_id, turn, role, text = map(name, columns)
    text = F.coalesce(text, F.lit(" "))
    fault = F.when(~text.rlike(WORD), "blank").when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")
    return rows.select(
        conv_id.alias("conv_id"), turn.cast("long").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"),
        text.alias("text"), fault.alias("fault"),
    )


def _order() -> list[Column]:
    return [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _of(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    keys = keys.select(F.col("conv_id").alias("conv_id_"))
    return rows.join(checked_broadcast(keys), F.col("conv_id").eqNullSafe(F.col("conv_id_")), how)


def _in_segments(rows: DataFrame, most: int) -> DataFrame:
    """Messages of long conversations with their duplicates marked, in order of seq and cut into segments."""
    rows = stage(rows.withColumn("id", F.monotonically_increasing_id()), "long")
    same = F.sha2(F.to_json(F.struct("role", "text")), 256)
    firsts = rows.groupBy("conv_id", same.alias("same")).agg(F.min(F.struct("turn", "id")).alias("first"))
    firsts = firsts.select(F.col("first.id").alias("id"), F.lit(True).alias("is_first"))
    again = F.col("is_first").isNull() & (F.coalesce("fault", F.lit("")) != "blank")
    rows = rows.join(firsts, "id", "left").withColumn("fault", F.when(again, "duplicate").otherwise(F.col("fault")))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.drop("is_first").repartitionByRange(n, *_order(), "id").sortWithinPartitions(*_order(), "id")
    seq = F.monotonically_increasing_id()
    return stage(rows.drop("id").withColumn("seq", seq).withColumn("segment", F.floor(F.col("seq") / most)), "segments")


def _edit_long(rows: DataFrame, most: int, schema: str, arrow: pa.Schema, key: str) -> DataFrame:
    rows = _in_segments(rows, most)
    by = ["conv_id", "segment"]

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({c: f"{c}_" for c in by})
        same = F.col("conv_id").eqNullSafe(F.col("conv_id_")) & (F.col("segment") == F.col("segment_"))
        return left.join(right, same).drop("conv_id_", "segment_")

    narrow = rows.select(*by, "seq", F.substring("role", 1, 1).alias("role"), "fault")
    narrow = narrow.withColumns({"turn": F.lit(None).cast("long"), "text": F.lit("")})
    costs = narrow.groupBy(*by).applyInArrow(_tell_costs, f"{key}, segment long, costs array<long>")
    left = stage(costs.groupBy("conv_id").applyInArrow(_tell_prices, f"{key}, segment long, left array<long>"), "prices")
    exits = met(narrow, left).groupBy(*by).applyInArrow(
        _tell_exits, f"{key}, segment long, left array<long>, exits array<long>"
    )
    chain = exits.groupBy("conv_id").applyInArrow(_chain, f"{key}, segment long, left array<long>, entry long, after long")
    edits = met(rows, stage(chain, "chain")).groupBy(*by).applyInArrow(_segment_editor(most, arrow), schema)
    return edits.repartition("conv_id").sortWithinPartitions("conv_id", "place")


def edits(
    rows: DataFrame, columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"), most: int = MOST
) -> DataFrame:
    """The cheapest edits of every conversation, one row each: conv_id, place (their order), edit (D, I, K or R), turn, role,
    new_role (null where deleted), text, fault (the first of blank, duplicate, truncated). Blank and duplicate messages are
    always deleted. A conversation's rows stand together and in order in one partition."""
    from pyspark.sql.pandas.types import to_arrow_schema

    key = f"conv_id {dict(rows.dtypes)[columns[0]]}"
    schema = f"{key}, place long, edit string, turn long, role string, new_role string, text string, fault string"
    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)
    rows = _messages(rows, columns)
    long = stage(rows.groupBy("conv_id").count().where(F.col("count") > most).select("conv_id"), "long_ids")
    short = rows if long.isEmpty() else _of(rows, long, "left_anti")
    short = short.repartition("conv_id").sortWithinPartitions(*_order())
    done = short.mapInArrow(_short_editor(arrow), schema)
    if long.isEmpty():
        return done
    return done.unionByName(_edit_long(_of(rows, long, "left_semi"), most, schema, arrow, key))


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _reporter(schema: pa.Schema):
    def run(batches):
        for conv_id, own in _conversations(batches):
            counts, letters, digest = dict.fromkeys(_REPORT, 0), [], hashlib.sha256()
            turns, before, filled = [], None, False
            for r in own:
                letters.append(r["edit"])
                counts["cost"] += COSTS[r["edit"]] + CUT * (r["fault"] == "truncated" and r["edit"] != "D")
                if r["edit"] != "I":
                    if r["fault"]:
                        counts[r["fault"]] += 1
                    initial = r["role"][:1]
                    counts["illegal"] += before is not None and before + initial not in ("su", "ua", "au")
                    before = initial
                    if r["turn"] is not None and (not turns or turns[1] != r["turn"]):
                        turns = [turns[0] if turns else r["turn"], r["turn"], turns[2] + 1 if turns else 1]
                if r["new_role"] is not None:
                    digest.update(f"{chr(10) if filled else ''}{r['new_role']}:{r['text']}".encode())
                    filled = True
            counts["gaps"] = min(turns[1] - turns[0] + 1 - turns[2], (1 << 63) - 1) if turns else 0
            values = [conv_id, *counts.values(), "".join(letters), digest.hexdigest()]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    return run


def report(edits: DataFrame) -> DataFrame:
    """One row per conversation from its edits as ``edits`` gives them: gaps in the turns, messages by first fault, pairs of
    neighbours that may not follow each other, the cost, the edits' letters, and a SHA-256 of the repaired ``role:text`` lines.
    A hash can only be made in order: a task streams through a conversation without holding it, but for its letters."""
    from pyspark.sql.pandas.types import to_arrow_schema

    key = f"conv_id {dict(edits.dtypes)['conv_id']}"
    schema = f"{key}, {', '.join(f'{c} long' for c in _REPORT)}, audit string, repaired_sha256 string"
    arrow = to_arrow_schema(edits.sparkSession.createDataFrame([], schema).schema)
    return edits.mapInArrow(_reporter(arrow), schema)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted damage by the CRC of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes
    its ``[.!?]``, 3 repeats it, 4 makes its role user. Nulls are one space."""
    given = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    what = F.crc32(F.concat(given["conv_id"], F.lit(":"), given["turn"]).cast("binary")) % 20
    text = F.when(what == 1, "").when(what == 2, F.regexp_replace(given["text"], "[.!?]", "")).otherwise(given["text"])
    return rows.where(what != 0).select(
        "conv_id", "turn", F.when(what == 4, "user").otherwise(given["role"]).alias("role"), text.alias("text"),
        F.explode(F.when(what == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
