"""Conversation structure repair (operator 13).

Rows of a conversation, in order of turn, become ``(s?(ua)+)?``: an optional
system row, then user and assistant in turns, or nothing. Keep, Rerole, Delete and
Insert have costs (``Costs``); of the cheapest edits the ASCII-least audit string
(their initials) counts.

Spark finds the faults and the first place of every (conversation, role, text) by a
grouped minimum, so repeats are known without a window over a conversation. Rows
and first places are then dealt out by conversation and sorted; a task reads them
once, in order, and holds only what is not settled yet (one digest covers a
conversation's whole repaired text, so it has to be read in sequence anyway).

``Audit`` is the persistent dynamic programme. Each of four states (nothing yet,
after s, after u, after a) has its cheapest edits as a node in a tree: an edit is a
node, its parent is the edit before, and states share their common prefixes. A node
knows its ancestors at distances 1, 2, 4, ... and a rolling hash of its string.
Edits of equal cost are compared by a search for their longest common prefix: the
hashes of ancestors at equal depth, halving the distance, and then the two edits
that follow. A string fixes the rows it has read and its state, and a state keeps
one node, so equal prefixes are one node: the prefix that the hashes found is
verified by that, and where two hashes were equal by chance the search is done again
by the nodes themselves. A state that can never win any more (another one reaches
all it can for less) goes. Where all living states have a common ancestor, the edits
before it are settled: they go into the digest, and the tree starts anew there.

Odd input: a null role or text is one space (such a text is blank). A null
conversation id is a conversation like others, a null turn comes first. Rows of one
turn stand in order of role and of the MD5 of their text; rows equal in all of these
are repeats of the first one. An empty role has no initial. A conversation without
rows (all dropped) has zeros, an empty audit and the digest of nothing; a table
without rows gives none. Long texts are read whole. Gaps beyond 64 bits stop at
their end. Other columns are pruned, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import map_arrow

SPACES = r"[\x20\x09-\x0D]"
NO_SPACE = r"[^\x20\x09-\x0D]"
ENDS = rf"[.!?]{SPACES}*\z"
SETTLE_ROWS, SETTLE_BYTES = 256, 4 << 20  # how much is read between looks for a common ancestor
MOST = 2**63 - 1

c = F.col


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5  # a row that ends in mid-sentence and stays


# ------------------------------------------------------------------ rows
def rows_of(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies) as they are: one copy of each."""
    filled = lambda x: F.coalesce(c(x).cast("string"), F.lit(" "))
    return df.select(c(conv_col).cast("long").alias("conv_id"), c(turn_col).cast("long").alias("turn"),
                     filled(role_col).alias("role"), filled(text_col).alias("text"), F.lit(1).alias("copies"))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows_of`` with faults by the checksum of ``conv_id:turn``: no copy (0), an
    empty text (1), no sentence ends (2), a second copy (3), role user (4)."""
    part = lambda x: F.coalesce(c(x).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(c("_f") == 1, "").when(c("_f") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(c("text"))
    copies = F.when(c("_f") == 0, 0).when(c("_f") == 3, 2).otherwise(1)
    role = F.when(c("_f") == 4, "user").otherwise(c("role"))
    return rows.withColumn("_f", fault).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def fault() -> Column:
    """A text's own fault: blank, or cut off in mid-sentence."""
    return F.when(~c("text").rlike(NO_SPACE), "blank").when(~c("text").rlike(ENDS), "truncated").otherwise("")


ORDER = ["conv_id", "turn", "role", "digest", "first"]


def in_order(rows: DataFrame) -> DataFrame:
    """All rows by conversation and turn, and before the first one of each
    (conversation, role, text) a mark without copies or text (``first`` 0)."""
    known = rows.withColumn("digest", F.unhex(F.md5("text")))
    null_turn = F.max(c("turn").isNull())
    firsts = known.filter("copies > 0").groupBy("conv_id", "role", "digest").agg(F.when(~null_turn, F.min("turn")).alias("turn"))
    marks = firsts.select("conv_id", "turn", "role", "digest", F.lit(0).alias("first"), F.lit("").alias("text"), F.lit(0).alias("copies"), F.lit("").alias("fault"))
    kept = F.when(c("copies") > 0, c("text")).otherwise("")
    own = known.select("conv_id", "turn", "role", "digest", F.lit(1).alias("first"), kept.alias("text"), "copies", fault().alias("fault"))
    return marks.unionByName(own).repartition("conv_id").sortWithinPartitions(*ORDER)


# ----------------------------------------------------------------- audit
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 60


class Audit:
    """The cheapest edits of one conversation, fed row by row. ``emit(edit, row,
    role, text)`` gets the settled edits in order; ``row`` is what was fed (None for
    an insert)."""

    MODULUS, BASE = (1 << 61) - 1, 911_382_323

    def __init__(self, emit, costs: Costs = Costs()):
        self.costs, self.emit = costs, emit
        self.audit = bytearray()
        self.state = START  # of what is settled
        self.rows: deque = deque()  # what is not settled: (row, role, text)
        self.bytes = 0
        self._plant()
        self.cost = [0, NEVER, NEVER, NEVER]
        self.node = [0, 0, 0, 0]
        ins, drop = costs.insert, costs.delete
        # what a state at most pays more than another one from there on
        self.more = {(ASSISTANT, START): drop, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): ins, (USER, ASSISTANT): ins,
                     (USER, SYSTEM): ins, (USER, START): ins + drop, (START, SYSTEM): 0, (START, ASSISTANT): 0,
                     (START, USER): ins, (SYSTEM, USER): ins, (SYSTEM, ASSISTANT): 2 * ins, (SYSTEM, START): max(2 * ins, drop)}

    def _plant(self) -> None:
        self.edit, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    # nodes
    def _grow(self, parent: int, edit: str) -> int:
        up, above, k = [], parent, 0
        while True:
            up.append(above)
            further = self.up[above]
            if k >= len(further):
                break
            above = further[k]
            k += 1
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * self.BASE + ord(edit)) % self.MODULUS)
        self.up.append(up)
        return len(self.edit) - 1

    def _lift(self, x: int, steps: int) -> int:
        k = 0
        while steps:
            if steps & 1:
                x = self.up[x][k]
            steps >>= 1
            k += 1
        return x

    def _parted(self, x: int, y: int, name) -> tuple[int, int]:
        """The first two nodes, at one depth, in which the strings of ``x`` and ``y``
        (nodes of one depth, not equal by ``name``) differ."""
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and name[self.up[x][k]] != name[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        return x, y

    def less(self, a: tuple[int, str], b: tuple[int, str]) -> bool:
        """Whether edits ``a`` (a node and one more edit, or none) come before ``b``."""
        (x, p), (y, q) = a, b
        m = min(self.depth[x], self.depth[y])
        u, v = self._lift(x, self.depth[x] - m), self._lift(y, self.depth[y] - m)
        if u == v:
            rest = lambda n, last: (self.edit[self._lift(n, self.depth[n] - m - 1)] if self.depth[n] > m else "") or last
            return rest(x, p) < rest(y, q)
        if self.hash[u] != self.hash[v]:
            s, t = self._parted(u, v, self.hash)
            if self.up[s][0] == self.up[t][0]:  # the prefix found is one node: verified
                return self.edit[s] < self.edit[t]
        s, t = self._parted(u, v, range(len(self.edit)))
        return self.edit[s] < self.edit[t]

    def _best(self, candidates) -> tuple[int, tuple[int, str]]:
        best, edits = NEVER, (0, "")
        for cost, node, edit in candidates:
            if cost < best or (cost == best < NEVER and self.less((node, edit), edits)):
                best, edits = cost, (node, edit)
        return best, edits

    def _take(self, choice: tuple[int, tuple[int, str]]) -> tuple[int, int]:
        cost, (node, edit) = choice
        return cost, (self._grow(node, edit) if edit and cost < NEVER else node)

    # steps
    def _inserts(self) -> None:
        cost, node, ins = self.cost, self.node, self.costs.insert
        if min(cost[START], cost[SYSTEM], cost[ASSISTANT]) + ins <= cost[USER]:
            before = [(cost[s] + ins, node[s], "I") for s in (START, SYSTEM, ASSISTANT) if cost[s] < NEVER]
            user = self._take(self._best([(cost[USER], node[USER], ""), *before]))
        else:
            user = cost[USER], node[USER]
        if user[0] + ins <= cost[ASSISTANT]:
            cost[ASSISTANT], node[ASSISTANT] = self._take(self._best([(cost[ASSISTANT], node[ASSISTANT], ""), (user[0] + ins, user[1], "I")]))
        cost[USER], node[USER] = user

    def feed(self, row, role: str, text: str, deleted: bool, truncated: bool) -> None:
        """One more row; ``deleted``: it has to go."""
        self._inserts()
        cost, node, k = self.cost, self.node, self.costs
        self.rows.append((row, role, text))
        self.bytes += len(text)
        options = [[(cost[s] + k.delete, node[s], "D")] if cost[s] < NEVER else [] for s in range(4)]
        if not deleted:
            stay, initial = k.truncated * truncated, role[:1]
            if initial == "s" and cost[START] < NEVER:
                options[SYSTEM].append((cost[START] + stay, node[START], "K"))
            for s in (START, SYSTEM, ASSISTANT):
                if cost[s] < NEVER:
                    options[USER].append((cost[s] + stay, node[s], "K") if initial == "u" else (cost[s] + stay + k.rerole, node[s], "R"))
            if cost[USER] < NEVER:
                options[ASSISTANT].append((cost[USER] + stay, node[USER], "K") if initial == "a" else (cost[USER] + stay + k.rerole, node[USER], "R"))
        chosen = [self._best(o) for o in options]
        costs = [x[0] for x in chosen]
        for s in range(4):
            if any(costs[t] + self.more[t, s] < costs[s] for t in range(4) if t != s and costs[t] < NEVER):
                chosen[s] = NEVER, (0, "")
        for s, choice in enumerate(chosen):
            cost[s], node[s] = self._take(choice)
        if len(self.rows) % SETTLE_ROWS == 0 or self.bytes > SETTLE_BYTES:
            self._settle()

    def finish(self) -> int:
        """The cost; all edits are settled then."""
        self._inserts()
        cost, (node, _) = self._best([(self.cost[s], self.node[s], "") for s in (START, ASSISTANT)])
        self._write(node)
        return cost

    # what is settled
    def _common(self, x: int, y: int) -> int:
        m = min(self.depth[x], self.depth[y])
        x, y = self._lift(x, self.depth[x] - m), self._lift(y, self.depth[y] - m)
        return x if x == y else self.up[self._parted(x, y, range(len(self.edit)))[0]][0]

    def _settle(self) -> None:
        living = [s for s in range(4) if self.cost[s] < NEVER]
        top = self.node[living[0]]
        for s in living[1:]:
            top = self._common(top, self.node[s])
        if 2 * self.depth[top] < max(self.depth[self.node[s]] for s in living):
            return  # little to win
        self._write(top)
        old_edit, old_up, moved = self.edit, self.up, {top: 0}
        self._plant()
        for s in living:
            way, x = [], self.node[s]
            while x not in moved:
                way.append(x)
                x = old_up[x][0]
            for x in reversed(way):
                moved[x] = self._grow(moved[old_up[x][0]], old_edit[x])
            self.node[s] = moved[self.node[s]]
        self.bytes = sum(len(r[2]) for r in self.rows)

    def _write(self, node: int) -> None:
        edits = []
        while node:
            edits.append(self.edit[node])
            node = self.up[node][0]
        for edit in reversed(edits):
            row, role, text = self.rows.popleft() if edit != "I" else (None, "", "")
            if edit in "IR":
                self.state = ASSISTANT if self.state == USER else USER
                role = NAMES[self.state]
            elif edit == "K":
                self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            self.emit(edit, row, role, text)
            self.audit += edit.encode()


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Conversation:
    """Figures and edits of one conversation, fed in order."""

    def __init__(self, conv_id, emit, costs: Costs):
        self.conv_id, self.sha, self.any = conv_id, hashlib.sha256(), False
        self.n = dict.fromkeys(FIGURES, 0)
        self.low = self.high = None
        self.turns, self.initial = 0, None
        self.more = emit
        self.audit = Audit(self._emit, costs)

    def _emit(self, edit: str, row, role: str, text: str) -> None:
        if edit != "D":
            self.sha.update(b"\n" * self.any)
            self.sha.update(f"{role}:".encode())
            self.sha.update(text.encode())
            self.any = True
        if self.more:
            self.more(self.conv_id, edit, row, role, text)

    def feed(self, turn, role: str, text: str, fault: str, first: bool) -> None:
        if turn is not None and turn != self.high:  # sorted, so each turn is seen once
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        fault = "blank" if fault == "blank" else "duplicate" if not first else fault
        if fault:
            self.n[fault] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.initial = initial
        self.audit.feed(turn, role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def finish(self) -> tuple:
        self.n["cost"] = self.audit.finish()
        if self.turns:
            self.n["gaps"] = min(self.high - self.low + 1 - self.turns, MOST)
        return (self.conv_id, *self.n.values(), self.audit.audit.decode(), self.sha.hexdigest())


def conversations(batches: Iterator[pa.RecordBatch], emit, costs: Costs) -> Iterator[tuple]:
    """The finished conversations of ``in_order`` rows, one after the other, and
    None after each batch."""
    now, mark = None, None
    for batch in batches:
        for conv, turn, role, digest, first, text, copies, fault in zip(*(batch.column(x).to_pylist() for x in [*ORDER, "text", "copies", "fault"]), strict=True):
            if now is None or now.conv_id != conv:
                if now is not None:
                    yield now.finish()
                now, mark = Conversation(conv, emit, costs), None
            if not first:
                mark = (turn, role, digest)
                continue
            for _ in range(copies):
                now.feed(turn, role, text, fault, mark == (turn, role, digest))
                mark = None
        yield None
    if now is not None:
        yield now.finish()


# --------------------------------------------------------------- results
def audits(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """A row for each conversation of ``rows_of`` (or ``damaged``) rows: conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    schema = f"conv_id long, {', '.join(f'{x} long' for x in FIGURES)}, audit string, repaired_sha256 string"
    types = pa.schema([("conv_id", pa.int64()), *[(x, pa.int64()) for x in FIGURES], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for row in conversations(batches, None, costs):
            out += [row] * (row is not None)
            if len(out) == 1000:
                yield _batch(out, types)
        if out:
            yield _batch(out, types)

    return map_arrow(in_order(rows), run, schema)


def _batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    """The rows as a batch; the list is empty after."""
    columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types.types, strict=True)]
    rows.clear()
    return pa.RecordBatch.from_arrays(columns, schema=types)


def repaired(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """The repaired conversations themselves: (conv_id, place from 1 on, turn it came
    from, role, text, edit); an inserted row has no turn."""
    types = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last = [], [None, 0]  # the conversation and the place of the last row

        def emit(conv, edit, turn, role, text):
            if edit != "D":
                last[:] = (conv,), last[1] + 1 if last[0] == (conv,) else 1
                out.append((conv, last[1], turn, role, text, edit))

        for _ in conversations(batches, emit, costs):  # also between the batches of a long one
            if len(out) >= 1000:
                yield _batch(out, types)
        if out:
            yield _batch(out, types)

    return map_arrow(in_order(rows), run, "conv_id long, place long, turn long, role string, text string, edit string")
