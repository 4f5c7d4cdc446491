"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in alternation,
the last one by the assistant. Every given turn is consumed by one action: it starts a turn under its own
role, starts a turn under another role (relabel), or is appended to the open turn (merge, and relabel if the
roles differ). Empty turns can be inserted before it and at the end. Dynamic programming over the states of
the automaton (nothing yet, system, user, assistant) finds the cheapest sequence of actions; between equally
cheap ones the lower action code decides, from the last turn backwards.

A conversation can be as long as it likes. Its turns get exact positions without one task for each
conversation, and are cut into blocks of ``BLOCK``. A block is summed up as a (min, +) matrix over the
states; matrices are multiplied in a tree of ``BLOCK`` branches to give each block its costs on entry, and the
states in which blocks are left follow in the same way from the end. Then blocks are traced by themselves.

The result is a row for each given turn with the piece of rendered text it makes; a conversation is its pieces in
order of position. Roles are trimmed and lower-cased and known aliases replaced; a null or unknown role costs
a relabel wherever it goes. Null text: empty. Turns are ordered by (turn, role, text), null turns last. Null
conv_id: a conversation of its own. Repeated rows: each is a turn. Empty table: no rows. Extra columns: ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.functions.ranking import ranked
from wattlane.session import materialize

ROLES = ("system", "user", "assistant")
# Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant", "developer": "system"}
STATES = 4  # nothing yet, then the role of the open turn
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
FINAL = 3
BLOCK = 1024
FAR = 1 << 40


@dataclass(frozen=True)
class Costs:
    relabel: int = 2
    merge: int = 1
    insert: int = 3


@dataclass(frozen=True)
class Action:
    """Code, cost by role of the given turn (0: unknown), and what happens."""

    code: int
    source: int
    target: int
    inserted: tuple[int, ...]
    merged: bool

    def cost(self, role: int, costs: Costs) -> int:
        own = 0 if role == self.target else costs.relabel
        return own + costs.merge * self.merged + costs.insert * len(self.inserted)


def _paths(state: int, most: int = 2) -> list[tuple[int, ...]]:
    """Empty turns that can follow a state, shortest first."""
    found = [()]
    for path in found:
        if len(path) < most:
            found += [(*path, q) for q in NEXT[path[-1] if path else state]]
    return found


def _actions() -> list[Action]:
    out: list[Action] = []
    for source in range(STATES):
        if source:
            out.append(Action(0, source, source, (), True))
        for path in _paths(source):
            out += [Action(0, source, q, path, False) for q in NEXT[path[-1] if path else source]]
    kinds = sorted({(len(a.inserted), a.merged, a.inserted, a.target, a.source) for a in out})
    order = {k: i for i, k in enumerate(kinds)}
    return [
        Action(order[len(a.inserted), a.merged, a.inserted, a.target, a.source], a.source, a.target, a.inserted, a.merged) for a in out
    ]


ACTIONS = sorted(_actions(), key=lambda a: a.code)
# Cheapest way to a legal end from each state: empty turns to add.
ENDINGS = {0: (), 1: (2, 3), 2: (3,), 3: ()}


def step_matrices(costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """(role, from, to) least cost of consuming a turn, and the code of the action."""
    cost, code = np.full((4, STATES, STATES), FAR), np.zeros((4, STATES, STATES), dtype=np.int64)
    for role, a in product(range(4), ACTIONS):
        value = a.cost(role, costs)
        if value < cost[role, a.source, a.target]:
            cost[role, a.source, a.target], code[role, a.source, a.target] = value, a.code
    return cost, code


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def role_number(role: Column) -> Column:
    """1 to 3 for the known roles, 0 otherwise."""
    name = F.lower(F.trim(F.coalesce(role.cast("string"), F.lit(""))))
    out = F.lit(0)
    for known, number in [*((r, i + 1) for i, r in enumerate(ROLES)), *((a, ROLES.index(r) + 1) for a, r in ALIASES.items())]:
        out = F.when(name == known, number).otherwise(out)
    return out


def _entry_costs(summaries: DataFrame, width: int) -> DataFrame:
    """(conv, block, entry): costs of the states before each block, from matrices (conv, block, m)."""
    top = summaries.agg(F.max("block")).first()[0]
    if top is not None and top >= width:
        placed = summaries.withColumn("parent", F.floor(F.col("block") / width))

        def compose(key, table):
            table = table.sort_by("block")
            total = None
            for m in table.column("m").to_pylist():
                m = np.array(m).reshape(STATES, STATES)
                total = m if total is None else _times(total, m)
            return pa.table({"conv": [key[0].as_py()], "block": [key[1].as_py()], "m": pa.array([total.ravel().tolist()], pa.list_(pa.int64()))})

        parents = materialize(placed.groupBy("conv", "parent").applyInArrow(compose, "conv string, block long, m array<long>"), "chat-blocks")
        entry = _entry_costs(parents, width).select("conv", F.col("block").alias("parent"), "entry")
        groups = placed.join(entry, ["conv", "parent"]).groupBy("conv", "parent")
    else:
        start = F.array(*[F.lit(0 if s == 0 else FAR).cast("long") for s in range(STATES)])
        groups = summaries.withColumn("entry", start).withColumn("parent", F.lit(0)).groupBy("conv", "parent")

    def fold(key, table):
        table = table.sort_by("block")
        now = np.array(table.column("entry")[0].as_py())[None, :]
        entries = []
        for m in table.column("m").to_pylist():
            entries.append(now[0].tolist())
            now = _times(now, np.array(m).reshape(STATES, STATES))
        kept = table.select(["conv", "block"])
        return kept.append_column("entry", pa.array(entries, pa.list_(pa.int64())))

    return materialize(groups.applyInArrow(fold, "conv string, block long, entry array<long>"), "chat-entries")


def _exit_states(maps: DataFrame, width: int) -> DataFrame:
    """(conv, block, leave): state after each block, from maps (conv, block, back) of leaving to entering states.

    ``last`` holds, on the last block of a conversation, the state in which it ends.
    """
    top = maps.agg(F.max("block")).first()[0]
    if top is not None and top >= width:
        placed = maps.withColumn("parent", F.floor(F.col("block") / width))

        def compose(key, table):
            table = table.sort_by([("block", "descending")])
            back, last = np.arange(STATES), table.column("last")[0].as_py()
            for m in table.column("back").to_pylist():
                back = np.array(m)[back]
            columns = {"conv": [key[0].as_py()], "block": [key[1].as_py()], "back": pa.array([back.tolist()], pa.list_(pa.int64()))}
            return pa.table(columns | {"last": pa.array([last], pa.int64())})

        kind = "conv string, block long, back array<long>, last long"
        parents = materialize(placed.groupBy("conv", "parent").applyInArrow(compose, kind), "chat-blocks")
        leave = _exit_states(parents, width).select("conv", F.col("block").alias("parent"), "leave")
        groups = placed.join(leave, ["conv", "parent"]).groupBy("conv", "parent")
    else:
        groups = maps.withColumn("leave", F.lit(None).cast("long")).withColumn("parent", F.lit(0)).groupBy("conv", "parent")

    def fold(key, table):
        table = table.sort_by([("block", "descending")])
        now = table.column("leave")[0].as_py()
        if now is None:
            now = table.column("last")[0].as_py()
        states = []
        for m in table.column("back").to_pylist():
            states.append(now)
            now = m[now]
        return table.select(["conv", "block"]).append_column("leave", pa.array(states, pa.int64()))

    return materialize(groups.applyInArrow(fold, "conv string, block long, leave long"), "chat-exits")


def _forward(roles: np.ndarray, entry: np.ndarray, cost: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs after the turns, and for each turn and state the (code, state before) that is best."""
    now = entry
    back = np.zeros((len(roles), STATES, 2), dtype=np.int64)
    for i, role in enumerate(roles):
        through = now[:, None] + cost[role]
        key = through * 1000 + code[role]
        source = key.argmin(axis=0)
        back[i, :, 0], back[i, :, 1] = code[role][source, np.arange(STATES)], source
        now = np.minimum(through[source, np.arange(STATES)], FAR)
    return now, back


def repair(conversations: DataFrame, costs: Costs = Costs(), block: int = BLOCK) -> DataFrame:
    """conv_id, position, turn, role (repaired), action, fragment and cost of every given turn.

    ``action`` is keep, relabel, merge or merge+relabel, after ``insert `` once for each empty turn put before it;
    the last turn's ends with `` +insert`` for each one put after it. ``fragment`` is its piece of rendered text.
    """
    step_cost, step_code = step_matrices(costs)
    by_code = {a.code: a for a in ACTIONS}
    ending = np.array([costs.insert * len(ENDINGS[s]) for s in range(STATES)])
    ending[0] = FAR
    name = F.coalesce(F.concat(F.lit("i"), F.col("conv_id").cast("string")), F.lit("null"))
    turns = conversations.select(
        name.alias("conv"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    placed = ranked(turns, [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")], ["conv"], rank="position")
    placed = placed.withColumn("number", role_number(F.col("role"))).withColumn("block", F.floor((F.col("position") - 1) / block))
    placed = materialize(placed, "chat-turns")
    size = placed.groupBy("conv").agg(F.max("block").alias("final"))
    light = placed.select("conv", "block", "position", "number")

    def sum_up(key, table):
        total = np.where(np.eye(STATES, dtype=bool), 0, FAR)
        for role in table.sort_by("position").column("number").to_pylist():
            total = _times(total, step_cost[role])
        return pa.table({"conv": [key[0].as_py()], "block": [key[1].as_py()], "m": pa.array([total.ravel().tolist()], pa.list_(pa.int64()))})

    summaries = materialize(light.groupBy("conv", "block").applyInArrow(sum_up, "conv string, block long, m array<long>"), "chat-blocks")
    entry = _entry_costs(summaries, block)

    def back_map(key, table):
        table = table.sort_by("position")
        after, back = _forward(table.column("number").to_numpy(), np.array(table.column("entry")[0].as_py()), step_cost, step_code)
        to = []
        for state in range(STATES):
            for i in range(len(back) - 1, -1, -1):
                state = int(back[i, state, 1])
            to.append(state)
        last = int((after + ending).argmin())
        columns = {"conv": [key[0].as_py()], "block": [key[1].as_py()], "back": pa.array([to], pa.list_(pa.int64()))}
        return pa.table(columns | {"last": pa.array([last], pa.int64())})

    kind = "conv string, block long, back array<long>, last long"
    maps = materialize(light.join(entry, ["conv", "block"]).groupBy("conv", "block").applyInArrow(back_map, kind), "chat-maps")
    leave = _exit_states(maps, block)
    bounds = entry.join(leave, ["conv", "block"]).join(size, "conv")

    def trace(key, table):
        table = table.sort_by("position")
        roles = table.column("number").to_numpy()
        _, back = _forward(roles, np.array(table.column("entry")[0].as_py()), step_cost, step_code)
        state = table.column("leave")[0].as_py()
        ends = ENDINGS[state] if key[1].as_py() == table.column("final")[0].as_py() else ()
        chosen: list[Action] = []
        for i in range(len(back) - 1, -1, -1):
            chosen.append(by_code[int(back[i, state, 0])])
            state = int(back[i, state, 1])
        chosen.reverse()
        role, action, fragment, cost = [], [], [], []
        for i, (a, own, text) in enumerate(zip(chosen, roles.tolist(), table.column("text").to_pylist())):
            tail = ends if i == len(chosen) - 1 else ()
            kind = ("merge" if own == a.target else "merge+relabel") if a.merged else "keep" if own == a.target else "relabel"
            role.append(ROLES[a.target - 1])
            action.append("insert " * len(a.inserted) + kind + " +insert" * len(tail))
            head = "" if a.merged else f"<|{ROLES[a.target - 1]}|>\n"
            fragment.append("".join(f"<|{ROLES[q - 1]}|>\n\n" for q in a.inserted) + head + text + "\n" + "".join(f"<|{ROLES[q - 1]}|>\n\n" for q in tail))
            cost.append(a.cost(own, costs) + costs.insert * len(tail))
        kept = table.select(["conv_id", "position", "turn"])
        for label, values in (("role", role), ("action", action), ("fragment", fragment)):
            kept = kept.append_column(label, pa.array(values, pa.string()))
        return kept.append_column("cost", pa.array(cost, pa.int64()))

    whole = placed.select("conv", "block", "conv_id", "position", "turn", "number", "text").join(bounds, ["conv", "block"])
    return whole.groupBy("conv", "block").applyInArrow(
        trace, "conv_id long, position long, turn long, role string, action string, fragment string, cost long"
    )


def render(repaired: DataFrame) -> DataFrame:
    """(conv_id, text) of whole conversations, for those that fit a row."""
    pieces = F.array_sort(F.collect_list(F.struct("position", "fragment")))
    return repaired.groupBy("conv_id").agg(F.array_join(F.transform(pieces, lambda p: p["fragment"]), "").alias("text"))


def oracle_sql(costs: Costs = Costs()) -> str:
    """The same repair as a recursive query, a step for each turn, for moderate lengths."""
    cost, code = step_matrices(costs)
    names = [*((r, i + 1) for i, r in enumerate(ROLES)), *((a, ROLES.index(r) + 1) for a, r in ALIASES.items())]
    role = " ".join(f"WHEN '{n}' THEN {i}" for n, i in names)
    moves = ", ".join(
        f"({r},{s},{q},{cost[r, s, q]},{code[r, s, q]})" for r, s, q in product(range(4), range(STATES), range(STATES)) if cost[r, s, q] < FAR
    )
    acts = ", ".join(
        f"({a.code},{a.target},{len(a.inserted)},{str(a.merged).lower()},'{''.join(f'<|{ROLES[q - 1]}|>~~' for q in a.inserted)}')" for a in ACTIONS
    )
    ends = ", ".join(f"({s},{len(ENDINGS[s])},'{''.join(f'<|{ROLES[q - 1]}|>~~' for q in ENDINGS[s])}')" for s in range(1, STATES))
    named = " ".join(f"WHEN {i + 1} THEN '{r}'" for i, r in enumerate(ROLES))
    return f"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) AS position,
         count(*) OVER (PARTITION BY conv_id) AS n,
         CASE lower(trim(coalesce(role, ''))) {role} ELSE 0 END AS number
  FROM conversations),
moves(number, s, q, cost, code) AS (VALUES {moves}),
acts(code, target, inserted, merged, head) AS (VALUES {acts}),
ends(s, inserted, tail) AS (VALUES {ends}),
dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS position, 0 AS s, 0::BIGINT AS cost, []::INTEGER[] AS path FROM t
  UNION ALL
  SELECT conv_id, position, s, cost, path FROM (
    SELECT t.conv_id, t.position, m.q AS s, dp.cost + m.cost AS cost, list_append(dp.path, m.code) AS path,
           row_number() OVER (PARTITION BY t.conv_id, m.q ORDER BY dp.cost + m.cost, m.code) AS best
    FROM dp JOIN t ON t.conv_id IS NOT DISTINCT FROM dp.conv_id AND t.position = dp.position + 1
    JOIN moves m ON m.number = t.number AND m.s = dp.s) WHERE best = 1),
done AS (
  SELECT conv_id, path, e.inserted, e.tail FROM (
    SELECT dp.*, ends.inserted, ends.tail, row_number() OVER (PARTITION BY dp.conv_id ORDER BY dp.cost + {costs.insert} * ends.inserted, dp.s) AS best
    FROM dp JOIN ends ON ends.s = dp.s WHERE dp.position = (SELECT max(n) FROM t WHERE t.conv_id IS NOT DISTINCT FROM dp.conv_id)) e
  WHERE best = 1)
SELECT t.conv_id, t.position, t.turn, CASE a.target {named} END AS role,
       repeat('insert ', a.inserted) || CASE WHEN a.merged THEN CASE WHEN a.target = t.number THEN 'merge' ELSE 'merge+relabel' END
         WHEN a.target = t.number THEN 'keep' ELSE 'relabel' END
         || CASE WHEN t.position = t.n THEN repeat(' +insert', d.inserted) ELSE '' END AS action,
       replace(a.head || CASE WHEN a.merged THEN '' ELSE '<|' || CASE a.target {named} END || '|>~' END, '~', chr(10)) || t.text || chr(10)
         || CASE WHEN t.position = t.n THEN replace(d.tail, '~', chr(10)) ELSE '' END AS fragment,
       (CASE WHEN a.target = t.number THEN 0 ELSE {costs.relabel} END + CASE WHEN a.merged THEN {costs.merge} ELSE 0 END
         + {costs.insert} * a.inserted + CASE WHEN t.position = t.n THEN {costs.insert} * d.inserted ELSE 0 END)::BIGINT AS cost
FROM t JOIN done d ON d.conv_id IS NOT DISTINCT FROM t.conv_id JOIN acts a ON a.code = d.path[t.position]
"""
