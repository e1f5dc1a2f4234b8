"""Repair of damaged conversations by a shortest path in the edit lattice.

A conversation is the sequence of its rows by turn.  A row's first fault
counts: blank, duplicate (role and text seen earlier) or truncated (its last
character is no ``[.!?]``).  Edits turn the roles' initials into
``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (2), Delete (3; the
only one for blank and duplicate rows) and Insert of an empty row (2); a
truncated row that stays adds 1.  Of the cheapest edit sequences the one with
the least initials (the audit, ASCII order) is taken.

Lattice: a node is (rows consumed, state), with the states nothing, s, u and
a written last.  Given a state every letter leads to one node, so an audit
is a path, and of two cheapest paths between the same nodes neither is a
prefix of the other: least parts join to least wholes.  ``cheapest`` runs
Dijkstra from both ends in turn, with a heap each, until the two heads
together pass the best crossing; every node that both sides have reached at
that cost is a crossing, and the least concatenated audit wins.

Long conversations are cut into blocks of ``BLOCK`` rows, whose lattices
meet in four states: a block is solved for each entry and exit state, and
``combine`` walks the blocks with four labels.  No task holds more than a
block's rows and one audit.

On Spark: rows get their place by one range sort (offsets from one total per
sorted partition), duplicates by a grouped least place, blocks are grouped
code strings; edits then go back to the rows in one shuffle by conversation,
where a task streams the rows in order.  The checksum of a conversation's
text reads it in order, hence in one task, row by row with constant memory.

Cases: a null role or text counts as one space; rows with a null turn come
first, ties go by role and text; a null conversation is one of its own;
roles with another initial are reroled or deleted; repeated rows are
duplicates; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

BLOCK = 256
#: Costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing written, s, u, a.  The next role, and the states before.
NEXT = (2, 2, 3, 2)
BEFORE = ((), (), (0, 1, 3), (2,))
ACCEPT = (0, 3)

Node = tuple[int, int]


def _kept_to(symbol: str, state: int) -> int | None:
    """State after keeping a row in ``state``; None if not allowed."""
    if symbol in "sS":
        return 1 if state == 0 else None
    if symbol in "uU":
        return 2 if state != 2 else None
    return 3 if symbol in "aA" and state == 2 else None


def _forward(codes: str, node: Node) -> Iterator[tuple[Node, int, str]]:
    i, state = node
    yield (i, NEXT[state]), INSERT, "I"
    if i < len(codes):
        c = codes[i]
        yield (i + 1, state), DELETE, "D"
        if c not in "bd":
            more = TRUNCATED if c.isupper() else 0
            yield (i + 1, NEXT[state]), REROLE + more, "R"
            if (to := _kept_to(c, state)) is not None:
                yield (i + 1, to), KEEP + more, "K"


def _reverse(codes: str, node: Node) -> Iterator[tuple[Node, int, str]]:
    i, state = node
    for p in BEFORE[state]:
        yield (i, p), INSERT, "I"
    if i:
        c = codes[i - 1]
        yield (i - 1, state), DELETE, "D"
        if c not in "bd":
            more = TRUNCATED if c.isupper() else 0
            for p in BEFORE[state]:
                yield (i - 1, p), REROLE + more, "R"
            for p in range(4):
                if _kept_to(c, p) == state:
                    yield (i - 1, p), KEEP + more, "K"


class _Side:
    """One direction of the search: labels (cost, audit) and their heap.

    Free edges only lead on by one row, so with equal costs the rows nearer
    to the side's own end come first and a label is final when it leaves."""

    def __init__(self, ends: list[Node], edges, ahead: int):
        self.label = {node: (0, "") for node in ends}
        self.heap = [(0, ahead * node[0], node) for node in ends]
        self.edges, self.ahead, self.done = edges, ahead, set()
        heapq.heapify(self.heap)

    def head(self) -> float:
        while self.heap and self.heap[0][2] in self.done:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def step(self, codes: str) -> Iterator[Node]:
        """Settle the head; the nodes whose label became smaller."""
        cost, _, node = heapq.heappop(self.heap)
        self.done.add(node)
        audit = self.label[node][1]
        for to, price, letter in self.edges(codes, node):
            new = (cost + price, audit + letter if self.ahead > 0 else letter + audit)
            old = self.label.get(to)
            if to not in self.done and (old is None or new < old):
                self.label[to] = new
                if old is None or new[0] < old[0]:
                    heapq.heappush(self.heap, (new[0], self.ahead * to[0], to))
                yield to


def cheapest(codes: str, entry: int = 0, exits: tuple[int, ...] = ACCEPT) -> tuple[int, str] | None:
    """Least cost and, among the cheapest, the least audit from ``entry``
    before the rows to one of ``exits`` behind them.

    ``codes`` has a letter per row: s, u, a or o (another role), in upper
    case if truncated; b or d for rows that must go."""
    front = _Side([(0, entry)], _forward, 1)
    back = _Side([(len(codes), x) for x in exits], _reverse, -1)
    best = 0 if (0, entry) in back.label else float("inf")
    while (a := front.head()) + (b := back.head()) <= best and min(a, b) < float("inf"):
        side, other = (front, back) if a <= b else (back, front)
        for node in side.step(codes):
            if node in other.label:
                best = min(best, side.label[node][0] + other.label[node][0])
    if best == float("inf"):
        return None
    crossings = front.label.keys() & back.label.keys()
    return best, min(front.label[v][1] + back.label[v][1] for v in crossings if front.label[v][0] + back.label[v][0] == best)


def segments(codes: str, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of a block for all states that can meet."""
    out = []
    for entry in (0,) if first else range(4):
        for leave in ACCEPT if last else range(4):
            if found := cheapest(codes, entry, (leave,)):
                out.append((entry, leave, *found))
    return out


def combine(blocks: Iterator[list[tuple[int, int, int, str]]]) -> list[int]:
    """States before, between and behind the blocks on the least cheapest
    path.  Labels lose what all four have in common as they grow."""
    labels, back = {0: (0, "")}, []
    for found in blocks:
        new, came = {}, [-1] * 4
        for entry, leave, cost, audit in found:
            if entry in labels:
                c, text = labels[entry]
                if leave not in new or (c + cost, text + audit) < new[leave]:
                    new[leave], came[leave] = (c + cost, text + audit), entry
        cut = len(os.path.commonprefix([x[1] for x in new.values()]))
        labels = {k: (c, text[cut:]) for k, (c, text) in new.items()}
        back.append(came)
    state = min((labels[x], x) for x in ACCEPT if x in labels)[1]
    path = [state]
    for came in reversed(back):
        state = came[state]
        path.append(state)
    return path[::-1]


SEGMENT = "entry int, exit int, cost long, audit string"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes, blocks, number = (batch.column(c).to_pylist() for c in ("codes", "blocks", "block"))
        at, out = [], []
        for i, (code, n, k) in enumerate(zip(codes, blocks, number, strict=True)):
            # a conversation of one block needs no states between
            found = [(0, -1, *cheapest(code))] if n == 1 else segments(code, k == 0, k == n - 1)
            at += [i] * len(found)
            out += found
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string()]
        keep = batch.select(["c", "block", "blocks"]).take(pa.array(at, pa.int64()))
        yield pa.RecordBatch.from_arrays([*keep.columns, *[pa.array(x, k) for x, k in zip(columns, kinds, strict=True)]], ["c", "block", "blocks", "entry", "exit", "cost", "audit"])


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the sorted segments of each conversation those on its path."""
    own, key, held = [], None, None

    def flush():
        path = combine(iter(own))
        n = len(own)
        rows = pa.array([0] * n, pa.int64())
        return pa.RecordBatch.from_arrays([held.take(rows), pa.array(range(n), pa.int64()), pa.array(path[:-1], pa.int32()), pa.array(path[1:], pa.int32())], ["c", "block", "entry", "exit"])

    for batch in batches:
        conversations = batch.column("c")
        for i, (c, block, *segment) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("c", "block", "entry", "exit", "cost", "audit")), strict=True)):
            if (c,) != key:
                if own:
                    yield flush()
                own, key, held = [], (c,), conversations.slice(i, 1)
            if block == len(own):
                own.append([])
            own[block].append(tuple(segment))
    if own:
        yield flush()


ROLES = {2: "user", 3: "assistant"}


class _Repair:
    """A conversation's sums and checksum while its rows stream by."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.last, self.state, self.todo, self.audit = None, 0, [], []
        self.sha, self.some = hashlib.sha256(), False

    def write(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.some else "") + role + ":" + text).encode())
        self.some = True

    def insert(self) -> None:
        while self.todo and self.todo[-1] == "I":
            self.todo.pop()
            self.state = NEXT[self.state]
            self.write(ROLES[self.state], "")

    def edits(self, cost: int, audit: str) -> None:
        self.cost += cost
        self.audit.append(audit)
        self.todo = list(reversed(audit))
        self.insert()

    def row(self, code: str, role: str, text: str) -> None:
        self.blank += code == "b"
        self.duplicate += code == "d"
        self.truncated += code.isupper()
        self.illegal += self.last is not None and self.last + role[:1] not in ("su", "ua", "au")
        self.last = role[:1]
        edit = self.todo.pop()
        if edit == "R":
            self.state = NEXT[self.state]
            self.write(ROLES[self.state], text)
        elif edit == "K":
            self.state = _kept_to(code, self.state)
            self.write(role, text)
        self.insert()

    def result(self) -> tuple:
        return self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


REPAIRED = "blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place; a block's edits precede it."""
    now, key, held = None, None, None
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    names = ["c", *(x.split()[0] for x in REPAIRED.split(", "))]

    def row(c, r):
        return pa.RecordBatch.from_arrays([c, *[pa.array([x], k) for x, k in zip(r.result(), kinds, strict=True)]], names)

    done = []
    for batch in batches:
        conversations = batch.column("c")
        for i, (c, place, cost, audit, code, role, text) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("c", "place", "cost", "audit", "code", "role", "text")), strict=True)):
            if (c,) != key:
                if now:
                    done.append(row(held, now))
                now, key, held = _Repair(), (c,), conversations.slice(i, 1)
            if place is None:
                now.edits(cost, audit)
            else:
                now.row(code, role, text)
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
            done = []
    if now:
        yield row(held, now)


def damage(conversations: DataFrame) -> DataFrame:
    """Faults by the checksum of conversation and turn modulo 20: 0 drops a
    row, 1 empties its text, 2 takes its end marks, 3 repeats it, 4 makes it
    a user's.  ``conv_id, turn, role, text``."""
    filled = lambda c: F.coalesce(conversations[c].cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = conversations.select(conversations["conv_id"].alias("conv_id"), conversations["turn"].alias("turn"), filled("role").alias("role"), filled("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def placed(rows: DataFrame) -> DataFrame:
    """``c, turn, role, text, at`` in order of conversation and turn, staged;
    ``at`` is the global place."""
    filled = lambda c: F.coalesce(rows[c], F.lit(" "))
    base = rows.select(rows["conv_id"].alias("c"), rows["turn"].cast("long").alias("turn"), filled("role").alias("role"), filled("text").alias("text"))
    # the last key parts equal rows
    order = ["c", "turn", "role", "text", "tie"]
    sorted_ = base.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    local = staged(sorted_.select("c", "turn", "role", "text", F.monotonically_increasing_id().alias("at")), "repair-rows")
    part = F.shiftright("at", 33)
    before, offsets = 0, []
    for t in local.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).orderBy("part").collect():
        offsets.append((t["part"], before - (t["part"] << 33)))
        before += t["rows"]
    side = F.broadcast(rows.sparkSession.createDataFrame(offsets, "p long, shift long"))
    return local.join(side, part == F.col("p")).select("c", "turn", "role", "text", (F.col("at") + F.col("shift")).alias("at"))


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, gaps`` and REPAIRED of every conversation in ``rows``."""
    kind = dict(rows.dtypes)["conv_id"]
    line = placed(rows)
    per = line.groupBy("c").agg(F.min("at").alias("lo"), F.count("*").alias("n"))
    turns = line.where("turn is not null").groupBy("c", "turn").agg(F.lit(1).alias("one")).groupBy("c").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    per = staged(per.join(turns.withColumnRenamed("c", "t"), F.col("c").eqNullSafe(F.col("t")), "left").select("c", "lo", "n", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps")), "repair-conversations")
    # a row is no duplicate if it has the least place of its role and text
    said = [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(7), "text", "role").alias("h2")]
    fresh = staged(line.select("c", "at", *said).groupBy("c", "h1", "h2").agg(F.min("at").alias("at")).select(F.col("at").alias("fresh")), "repair-fresh")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    initial = F.substring("role", 1, 1)
    plain = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = F.when(blank, "b").when(F.col("fresh").isNull(), "d").when(whole, plain).otherwise(F.upper(plain))
    bounds = per.select(F.col("c").alias("k"), "lo", "n")
    coded = line.select("c", "at", "role", "text").join(fresh, F.col("at") == F.col("fresh"), "left").select("c", "at", code.alias("code"))
    coded = staged(coded.join(bounds, F.col("c").eqNullSafe(F.col("k"))).select("c", "at", "code", (F.col("at") - F.col("lo")).alias("place"), F.ceil(F.col("n") / block).alias("blocks")), "repair-codes")
    # blocks of at most `block` codes
    cut = coded.groupBy("c", "blocks", F.floor(F.col("place") / block).alias("block")).agg(F.sort_array(F.collect_list(F.struct("place", "code"))).alias("rows"))
    codes = F.array_join(F.transform("rows", lambda r: r["code"]), "")
    solved = staged(cut.select("c", "block", "blocks", codes.alias("codes")).mapInArrow(_solve, f"c {kind}, block long, blocks long, {SEGMENT}"), "repair-segments")
    long = solved.where("blocks > 1").select("c", "block", "entry", "exit", "cost", "audit")
    path = long.repartition("c").sortWithinPartitions("c", "block").mapInArrow(_chosen, f"c {kind}, block long, entry int, exit int")
    path = staged(path, "repair-path").toDF("pc", "pb", "pe", "px")
    on = F.col("c").eqNullSafe(F.col("pc")) & (F.col("block") == F.col("pb")) & (F.col("entry") == F.col("pe")) & (F.col("exit") == F.col("px"))
    edits = solved.where("blocks = 1").select("c", "block", "cost", "audit").union(long.join(path, on).select("c", "block", "cost", "audit"))
    # edits before the rows of their block, conversation by conversation
    none = lambda kind: F.lit(None).cast(kind)
    first = edits.select("c", (F.col("block") * block).alias("nth"), none("long").alias("place"), "cost", "audit", none("string").alias("code"), none("string").alias("role"), none("string").alias("text"))
    marked = coded.select(F.col("at").alias("a"), "place", "code")
    body = line.select("c", "at", "role", "text").join(marked, F.col("at") == F.col("a"))
    body = body.select("c", F.col("place").alias("nth"), "place", none("long").alias("cost"), none("string").alias("audit"), "code", "role", "text")
    stream = first.union(body).repartition("c").sortWithinPartitions("c", "nth", F.col("place").asc_nulls_first())
    done = stream.mapInArrow(_apply, f"c {kind}, {REPAIRED}")
    gaps = per.select(F.col("c").alias("k"), "gaps")
    return done.join(gaps, F.col("c").eqNullSafe(F.col("k"))).select(F.col("c").alias("conv_id"), "gaps", *(x.split()[0] for x in REPAIRED.split(", ")))


def damage_and_repair(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every conversation's repair after ``damage``; one that lost all rows
    has zeros, an empty audit and the checksum of nothing."""
    rows = damage(conversations)
    found = staged(repair(rows, block), "repair-result")
    ids = conversations.select(conversations["conv_id"].alias("id")).distinct()
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    rest = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")]
    return ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(F.col("id").alias("conv_id"), *zero, *rest)
