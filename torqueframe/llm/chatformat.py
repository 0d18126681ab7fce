"""Chat formatting by minimum-cost role repair.

A conversation is legal if an automaton accepts its roles: an optional system
turn, then user and assistant turns in alternation, the user first, the
assistant last; tool turns stand between an assistant turn and the next. Each
turn is emitted under its own or another role (a relabel), as a new turn or as
part of the one before (a merge), and empty turns are inserted where needed.
Dynamic programming over the automaton chooses the repair of least cost.

One turn acts on the automaton's states as a (min, +) matrix, and matrices
multiply in any grouping. So a long conversation is cut into blocks: every
block is summed up by one matrix, the short rows of matrices are walked per
conversation for the state at each block's borders, and every block is then
traced back by itself. No task holds more than a block of turns, however long
a conversation is, and no turn is dropped.

Rendering gives one row per turn that is kept or inserted: ``head`` (if it
opens a turn), text and ``tail`` (if it closes one); in order they are the
rendered conversation. Roles are matched in lower case, without blanks around
them, after the aliases in ``ALIASES``; another or a null role can only be
relabelled. Null text is empty. Turns are ordered by (turn, role, text) with
nulls first; repeated rows are turns of their own. Rows of null conv_id are one
conversation. An empty table has no rows. Other columns are not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

ROLES = ("system", "user", "assistant", "tool")
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant",
           "ai": "assistant", "function": "tool", "instruction": "system"}
# states: what the last turn was
STATES = ("start", "system", "user", "assistant", "tool")
#: legal next role by state
NEXT = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", "tool"), "tool": ("assistant",)}
FINAL = ("start", "assistant")

COSTS = {"merge": 2, "relabel": 5, "insert": 3}
BLOCK = 1000  # turns a block holds at most
TURNS = 16_000  # turns of a task, about
_BIG = 1 << 40


def _inserts(costs: dict) -> dict[tuple[str, str], tuple[int, tuple[str, ...]]]:
    """Cheapest rows of inserted empty turns from state to state."""
    best = {(s, s): (0, ()) for s in STATES}
    for _ in STATES:
        for (a, b), (c, path) in list(best.items()):
            for role in NEXT[b]:
                new = (c + costs["insert"], (*path, role))
                if (a, role) not in best or new < best[a, role]:
                    best[a, role] = new
    return best


def _moves(costs: dict) -> dict[str | None, list[tuple[str, str, int, tuple[str, ...], bool, str]]]:
    """By input role: (from, to, cost, inserted, merged, role given), in a
    fixed order that settles ties."""
    reach = _inserts(costs)
    moves: dict = {}
    for role in (*ROLES, None):
        own = []
        for given in ROLES:
            price = 0 if given == role else costs["relabel"]
            for a in STATES:
                if a == given:
                    own.append((a, given, price + costs["merge"], (), True, given))
                for b in STATES:
                    if given in NEXT[b] and (a, b) in reach:
                        c, path = reach[a, b]
                        own.append((a, given, price + c, path, False, given))
        moves[role] = sorted(own, key=lambda m: (m[2], m[4], len(m[3]), STATES.index(m[0]), ROLES.index(m[5]), m[3]))
    return moves


class Repair:
    """The dynamic program; ``costs`` has merge, relabel and insert."""

    def __init__(self, costs: dict | None = None):
        self.costs = {**COSTS, **(costs or {})}
        self.moves = _moves(self.costs)
        self.reach = _inserts(self.costs)
        self.index = {s: i for i, s in enumerate(STATES)}

    def forward(self, roles: list, start: list[int]) -> tuple[list[int], list[list]]:
        """Least costs of the states after the turns, and the move into each."""
        cost, steps = start, []
        for role in roles:
            new, via = [_BIG] * len(STATES), [None] * len(STATES)
            for m in self.moves[role]:
                c = cost[self.index[m[0]]] + m[2]
                to = self.index[m[1]]
                if c < new[to]:
                    new[to], via[to] = c, m
            cost = new
            steps.append(via)
        return cost, steps

    def matrix(self, roles: list) -> list[list[int]]:
        """Least cost from each state to each over a block of turns."""
        rows = []
        for s in range(len(STATES)):
            start = [_BIG] * len(STATES)
            start[s] = 0
            rows.append([min(c, _BIG) for c in self.forward(roles, start)[0]])
        return rows

    def ending(self, state: int) -> tuple[int, tuple[str, ...]]:
        """Cheapest turns to insert after the last one."""
        return min((self.reach[STATES[state], f] for f in FINAL if (STATES[state], f) in self.reach),
                   key=lambda x: (x[0], x[1]))

    def borders(self, matrices: list) -> tuple[list[int], int]:
        """The state before each block and after the last, on a path of least cost, and that cost."""
        cost = [0 if s == "start" else _BIG for s in STATES]
        came = []
        for m in matrices:
            back = [min(range(len(STATES)), key=lambda a: (cost[a] + m[a][b], a)) for b in range(len(STATES))]
            cost = [min(_BIG, cost[a] + m[a][b]) for b, a in enumerate(back)]
            came.append(back)
        state = min(range(len(STATES)), key=lambda s: (cost[s] + self.ending(s)[0], s))
        total, path = cost[state] + self.ending(state)[0], [state]
        for back in reversed(came):
            path.append(back[path[-1]])
        return path[::-1], total

    def trace(self, roles: list, begin: int, end: int) -> list:
        """The move for each turn of a block between two border states."""
        start = [_BIG] * len(STATES)
        start[begin] = 0
        _, steps = self.forward(roles, start)
        out, state = [], end
        for via in reversed(steps):
            out.append(via[state])
            state = self.index[via[state][0]]
        return out[::-1]


def clean_role(role):
    r = F.lower(F.trim(role.cast("string")))
    alias = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    r = F.coalesce(F.element_at(alias, r), r)
    return F.when(r.isin(*ROLES), r)


def _numbered(conversations: DataFrame, conv_col, turn_col, role_col, text_col) -> DataFrame:
    """Rows with a conversation key that is never null and their place ``pos``
    in the conversation, which starts at 0.

    Ranges of the sort order are numbered by themselves and then shifted by the
    counts of the ranges before, so a long conversation is many tasks' work."""
    key = F.coalesce(F.concat(F.lit("#"), F.col(conv_col).cast("string")), F.lit(""))
    rows = conversations.select(
        key.alias("conv"), F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = ["conv", "turn", "role", F.xxhash64("text")]
    spread = rows.sparkSession.sparkContext.defaultParallelism * 4
    # equal rows are alike, so chance may deal them to several ranges
    held = written(rows.repartitionByRange(spread, *order, F.rand(7)).withColumn("range", F.spark_partition_id()),
                   "turns")
    counts = held.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("conv", "range", (F.sum("n").over(Window.partitionBy("conv").orderBy("range"))
                                             - F.col("n")).alias("before"))
    own = held.withColumn("at", F.row_number().over(Window.partitionBy("conv", "range").orderBy(*order[1:])) - 1)
    return own.join(before, ["conv", "range"]).withColumn("pos", (F.col("at") + F.col("before")).cast("long")).drop(
        "at", "before", "range")


def repair(conversations: DataFrame, costs: dict | None = None, head: str = "<|{role}|>\n", tail: str = "<|end|>\n",
           joiner: str = "\n", conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One row per turn kept or inserted: conv_id, pos, sub (inserted ones come
    before the turn at pos), turn, role, new_role, action (keep, relabel, merge,
    merge+relabel or insert), cost of the whole conversation's repair, head, text, tail."""
    plan = Repair(costs)
    turns = written(_numbered(conversations, conv_col, turn_col, role_col, text_col).withColumns({
        "legal": clean_role(F.col("role")), "block": F.floor(F.col("pos") / BLOCK)}), "numbered-turns")
    slim = turns.select("conv", "block", "pos", "legal")

    def roles_of(pdf: pd.DataFrame) -> list:
        return [r if isinstance(r, str) else None for r in pdf["legal"]]

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [(conv, block, [c for row in plan.matrix(roles_of(own)) for c in row])
               for (conv, block), own in pdf.sort_values("pos").groupby(["conv", "block"], sort=False)]
        return pd.DataFrame(out, columns=["conv", "block", "matrix"])

    def walked(pdf: pd.DataFrame) -> pd.DataFrame:
        out, n = [], len(STATES)
        for conv, own in pdf.sort_values("block").groupby("conv", sort=False):
            path, cost = plan.borders([[list(m[i * n:i * n + n]) for i in range(n)] for m in own["matrix"]])
            out += [(conv, block, path[k], path[k + 1], cost, k == len(own) - 1) for k, block in enumerate(own["block"])]
        return pd.DataFrame(out, columns=["conv", "block", "begin", "end", "cost", "last"])

    def traced(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (conv, _), own in pdf.sort_values("pos").groupby(["conv", "block"], sort=False):
            begin, end, cost, last = own[["begin", "end", "cost", "last"]].iloc[0]
            moves = plan.trace(roles_of(own), int(begin), int(end))
            for pos, (_, _, _, inserted, merged, given) in zip(own["pos"], moves):
                out += [(conv, pos, i - len(inserted), r, False, True, cost) for i, r in enumerate(inserted)]
                out.append((conv, pos, 0, given, merged, False, cost))
            if last:
                out += [(conv, own["pos"].iloc[-1], i + 1, r, False, True, cost)
                        for i, r in enumerate(plan.ending(int(end))[1])]
        return pd.DataFrame(out, columns=["conv", "pos", "sub", "new_role", "merged", "inserted", "cost"])

    # blocks of several conversations share a task; no block is split. The number of
    # partitions is given: AQE would melt them by bytes, but the work goes by turns
    tasks = max(1, -(-slim.count() // TURNS))
    # many small groups, so that the hash of their numbers fills the partitions evenly
    deal = lambda df, *by: df.withColumn("task", F.pmod(F.xxhash64(*by), F.lit(16 * tasks))).repartition(
        tasks, "task").groupBy("task")
    matrices = deal(slim, "conv", "block").applyInPandas(summed, "conv string, block long, matrix array<long>")
    borders = written(deal(matrices, "conv").applyInPandas(
        walked, "conv string, block long, begin int, end int, cost long, last boolean"), "borders")
    moves = written(deal(slim.join(borders, ["conv", "block"]), "conv", "block").applyInPandas(
        traced, "conv string, pos long, sub int, new_role string, merged boolean, inserted boolean, cost long"), "moves")
    # a turn is closed unless the next one is merged into it
    goes_on = moves.where("merged").select("conv", (F.col("pos") - 1).alias("pos"), F.lit(0).alias("sub"),
                                           F.lit(True).alias("goes_on"))
    rows = moves.join(goes_on, ["conv", "pos", "sub"], "left").join(turns.drop("block"), ["conv", "pos"])
    relabel = ~F.coalesce(F.col("legal") == F.col("new_role"), F.lit(False))
    action = F.when(F.col("inserted"), "insert").when(F.col("merged") & relabel, "merge+relabel").when(
        F.col("merged"), "merge").when(relabel, "relabel").otherwise("keep")
    opening = F.replace(F.lit(head), F.lit("{role}"), F.col("new_role"))
    return rows.select(
        "conv_id", "pos", "sub", F.when(~F.col("inserted"), F.col("turn")).alias("turn"),
        F.when(~F.col("inserted"), F.col("role")).alias("role"), "new_role", action.alias("action"), "cost",
        F.when(F.col("merged"), F.lit(joiner)).otherwise(opening).alias("head"),
        F.when(F.col("inserted"), F.lit("")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("goes_on"), F.lit("")).otherwise(F.lit(tail)).alias("tail"))
