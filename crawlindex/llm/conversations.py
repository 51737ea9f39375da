"""Conversation structure repair by a Viterbi search with survivor coalescence.

The cheapest edits that turn the roles of a conversation into s?(ua)+ or nothing
are found turn by turn. Each state of that grammar has one survivor, the best
edits so far that end in it. Survivors are leaves of a backpointer tree: a node
holds a run of edits and counts the references to it, from survivors and from
child nodes. Nodes without references go; once all survivors share an ancestor,
its edits are settled and leave the tree. So the tree has a few nodes however
long a conversation is, and holds just the edits that are still open. Survivors
of equal cost are compared by their whole open edits, which the tree tells from
the place where their paths part.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shipping import ship

# Costs of the edits, and of a truncated turn that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# States: nothing yet, after a system turn, after a user's, after an assistant's.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ENDS = (_START, _ASSISTANT)
# Role initial that leads from a state to the next.
_NEXT = {
    _START: {"s": _SYSTEM, "u": _USER},
    _SYSTEM: {"u": _USER},
    _USER: {"a": _ASSISTANT},
    _ASSISTANT: {"u": _USER},
}
# The turn that may be made in a state, by a new role or an empty insert.
_MADE = {
    _START: ("user", _USER),
    _SYSTEM: ("user", _USER),
    _USER: ("assistant", _ASSISTANT),
    _ASSISTANT: ("user", _USER),
}
# A survivor in state q is lost if one in state p is cheaper by more than
# _REACH[p][q]: p goes on as q would, with inserts to get into step and, where q
# may still keep a system turn, a deletion in its place.
_REACH = (
    (0, 0, INSERT, 2 * INSERT),
    (2 * INSERT + DELETE, 0, INSERT, 2 * INSERT),
    (INSERT + DELETE, INSERT, 0, INSERT),
    (DELETE, 0, INSERT, 0),
)
_DEEP = 12  # levels of the tree; more are joined
_LEGAL = frozenset(["su", "ua", "au"])
_RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long,"
    " cost long, audit string, roles string, repaired_sha256 string"
)


class _Node:
    """A run of edits and, for each but deletions, the role initial it gives."""

    __slots__ = ("parent", "edits", "roles", "refs", "depth")

    def __init__(self, parent: _Node | None):
        self.parent, self.refs = parent, 0
        self.edits, self.roles = bytearray(), bytearray()
        self.depth = 0 if parent is None else parent.depth + 1


class Survivors:
    """The best edits of a conversation that is read turn by turn.

    Each survivor has its cost, its node, and the running digest of the repaired
    rows, so that no text is held after its turn.
    """

    def __init__(self) -> None:
        root = _Node(None)
        root.refs = 1
        self._root = root
        self._settled, self._settled_roles = bytearray(), bytearray()
        # By state: (cost, node, digest or None for no rows yet) or None.
        self._best: list[tuple | None] = [(0, root, None), None, None, None]
        self._insert()

    # --- the tree ---

    def _less(self, a: _Node, x: bytes, b: _Node, y: bytes) -> bool:
        """Whether the edits at node a and then x sort before b's and then y."""
        if a is b:
            return x < y
        up_a, up_b, from_a, from_b = a, b, None, None
        while up_a is not up_b:
            if up_a.depth >= up_b.depth:
                from_a, up_a = up_a, up_a.parent
            else:
                from_b, up_b = up_b, up_b.parent
        rest_a = from_a.edits if from_a else x
        rest_b = from_b.edits if from_b else y
        return rest_a[:1] < rest_b[:1]

    def _release(self, node: _Node | None) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            node = node.parent

    def _settle(self) -> None:
        """Move what all survivors share out of the tree."""
        held = [s[1] for s in self._best if s]
        while True:
            root = self._root
            self._settled += root.edits
            self._settled_roles += root.roles
            root.edits, root.roles = bytearray(), bytearray()
            if root.refs > 1 or any(node is root for node in held):
                return
            node = held[0]
            while node.parent is not root:
                node = node.parent
            node.parent, self._root = None, node

    def _compact(self) -> None:
        """Join runs that nothing parts any more, so that paths stay short."""
        held = {id(s[1]) for s in self._best if s}
        children: dict[int, list[_Node]] = {}
        seen: set[int] = set()
        for survivor in self._best:
            node = survivor and survivor[1]
            while node is not None and id(node) not in seen:
                seen.add(id(node))
                if node.parent is not None:
                    children.setdefault(id(node.parent), []).append(node)
                node = node.parent
        at: dict[int, _Node] = {}  # where a node went
        todo = [self._root]
        while todo:
            node = todo.pop()
            below = children.get(id(node), [])
            while len(below) == 1 and id(node) not in held and node is not self._root:
                (child,) = below
                node.edits += child.edits
                node.roles += child.roles
                node.refs = child.refs
                below = children.get(id(child), [])
                if id(child) in held:
                    at[id(child)] = node
                    break
            for child in below:
                child.parent, child.depth = node, node.depth + 1
            todo += below
        self._best = [s and (s[0], at.get(id(s[1]), s[1]), s[2]) for s in self._best]

    def _extend(self, moves: list[tuple | None]) -> None:
        """Each state's new survivor (cost, node, edit, role, digest), as a child
        of its node, or in its place where nothing else needs that.

        Moves without an edit keep their node.
        """
        old = [s[1] for s in self._best if s]
        wanted: dict[int, int] = {}
        for move in moves:
            if move:
                wanted[id(move[1])] = wanted.get(id(move[1]), 0) + 1
        best: list[tuple | None] = []
        for move in moves:
            if move is None:
                best.append(None)
                continue
            cost, node, edit, role, digest = move
            if edit:
                # References: of the old survivor, and of children.
                alone = wanted[id(node)] == 1 and node.refs == sum(x is node for x in old)
                if not alone:
                    child = _Node(node)
                    node.refs += 1
                    node = child
                node.edits += edit
                node.roles += role
            node.refs += 1
            best.append((cost, node, digest))
        self._best = best
        for node in old:
            self._release(node)

    # --- the search ---

    def _candidate(self, moves: list, state: int, move: tuple) -> None:
        now = moves[state]
        if now is None or move[0] < now[0] or (
            move[0] == now[0] and self._less(move[1], move[2], now[1], now[2])
        ):
            moves[state] = move

    def _insert(self) -> None:
        """Empty turns wherever they make a state cheaper to reach."""
        while True:
            moves = [s and (s[0], s[1], b"", b"", s[2]) for s in self._best]
            for state, survivor in enumerate(self._best):
                if survivor is None:
                    continue
                cost, node, digest = survivor
                role, to = _MADE[state]
                self._candidate(moves, to, (cost + INSERT, node, b"I", role[:1].encode(), (digest, role)))
            if not any(move and move[2] for move in moves):
                return
            for state, move in enumerate(moves):
                if move and move[2]:
                    digest, role = move[4]
                    moves[state] = (*move[:4], _row(digest, role, b""))
            self._extend(moves)

    def turn(self, role: str, text: bytes, bad: bool, truncated: bool) -> None:
        """Read a turn; a bad one, blank or a duplicate, has to be deleted."""
        moves: list[tuple | None] = [None] * 4
        stays = TRUNCATED if truncated else 0
        for state, survivor in enumerate(self._best):
            if survivor is None:
                continue
            cost, node, digest = survivor
            self._candidate(moves, state, (cost + DELETE, node, b"D", b"", digest))
            if bad:
                continue
            to = _NEXT[state].get(role[:1])
            if to is not None:
                move = (cost + KEEP + stays, node, b"K", role[:1].encode(), (digest, role))
                self._candidate(moves, to, move)
            new, to = _MADE[state]
            move = (cost + REROLE + stays, node, b"R", new[:1].encode(), (digest, new))
            self._candidate(moves, to, move)
        for state, move in enumerate(moves):
            if move and move[2] != b"D":
                digest, kept = move[4]
                moves[state] = (*move[:4], _row(digest, kept, text))
        self._extend(moves)
        self._insert()
        costs = [s and s[0] for s in self._best]
        for q, survivor in enumerate(self._best):
            if survivor and any(
                c is not None and survivor[0] > c + _REACH[p][q] for p, c in enumerate(costs)
            ):
                self._best[q] = None
                self._release(survivor[1])
        self._settle()
        if any(s and s[1].depth - self._root.depth > _DEEP for s in self._best):
            self._compact()

    def open_edits(self) -> tuple[int, int]:
        """Nodes of the tree, and edits in them."""
        nodes: dict[int, _Node] = {}
        for survivor in self._best:
            node = survivor and survivor[1]
            while node is not None:
                nodes[id(node)] = node
                node = node.parent
        return len(nodes), sum(len(n.edits) for n in nodes.values())

    def result(self) -> tuple[int, str, str, str]:
        """(cost, audit, role initials, digest of the repaired rows)."""
        ends: list[tuple | None] = [None]
        for state in _ENDS:
            if self._best[state]:
                cost, node, digest = self._best[state]
                self._candidate(ends, 0, (cost, node, b"", b"", digest))
        cost, node, _, _, digest = ends[0]
        edits, roles = [], []
        while node is not None:
            edits.append(node.edits)
            roles.append(node.roles)
            node = node.parent
        audit = self._settled + b"".join(reversed(edits))
        initials = self._settled_roles + b"".join(reversed(roles))
        return cost, audit.decode(), initials.decode(), (digest or sha256()).hexdigest()


def _row(digest, role: str, text: bytes):
    """The digest of the rows so far and one more, `role:text`."""
    line = role.encode() + b":" + text
    if digest is None:
        return sha256(line)
    digest = digest.copy()
    digest.update(b"\n" + line)
    return digest


_END_MARKS = b".!?"
_WHITE = b" \t\n\x0b\x0c\r"


def _repaired(rows: Iterator[tuple]) -> tuple:
    """Result of one conversation, its rows (turn, role, text, first) in order.

    Rows whose role is null were dropped. `first` tells the first of the rows
    equal in role and text.
    """
    survivors = Survivors()
    least = most = last = before = None
    distinct = blank = duplicate = truncated = illegal = 0
    for turn, role, text, first in rows:
        if role is None:
            continue
        if turn is not None:
            if least is None:
                least = turn
            most = turn
            distinct += turn != last
            last = turn
        data = text.encode("utf-8", "surrogatepass")
        end = data.rstrip(_WHITE)[-1:]
        is_blank = not end
        is_copy = not is_blank and not first
        is_cut = not is_blank and not is_copy and end not in _END_MARKS
        blank, duplicate, truncated = blank + is_blank, duplicate + is_copy, truncated + is_cut
        if before is not None:
            illegal += before + role[:1] not in _LEGAL
        before = role[:1]
        survivors.turn(role, data, is_blank or is_copy, is_cut)
    gaps = 0 if least is None else most - least + 1 - distinct
    cost, audit, roles, digest = survivors.result()
    return gaps, blank, duplicate, truncated, illegal, cost, audit, roles, digest


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and then by turn."""
    names = [field.split()[0] for field in _RESULT.split(",")]
    kinds = [pa.string() if field.endswith("string") else pa.int64() for field in _RESULT.split(",")]

    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    out = []

    def packed():
        columns = zip(zip(*out, strict=True), kinds, strict=True)
        return pa.record_batch([pa.array(c, kind) for c, kind in columns], names)

    for conv_id, own in groupby(rows(), itemgetter(0)):
        out.append((conv_id, *_repaired(row[1:] for row in own)))
        if len(out) == 1024 or len(out[-1][7]) > 100_000:
            yield packed()
            out.clear()
    if out:
        yield packed()


# --- as Spark jobs ------------------------------------------------------------------


def _whole(conversations: DataFrame) -> DataFrame:
    """The columns in use; a null role or text is one space."""
    space = F.lit(" ")
    return conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )


def _order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]


def damaged(conversations: DataFrame) -> DataFrame:
    """`conversations` (conv_id, turn, role, text) with defects that their ids
    decide, by the CRC-32 of `conv_id:turn` modulo 20.

    0 drops the row: role and text become null, so that the conversation is
    still known. 1 empties the text, 2 takes out its marks . ! ?, 3 repeats the
    row, 4 makes the role user. Nulls count as one space, though a null conv_id
    or turn stays in its column.
    """
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    kind = F.crc32(key) % 20
    text = (
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    there = kind != 0
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        _whole(conversations)
        .withColumn("_copy", F.explode(copies))
        .select(
            "conv_id", "turn", F.when(there, role).alias("role"), F.when(there, text).alias("text")
        )
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, first), each conversation in order in a task;
    `first` tells the first of the rows equal in role and text.

    One shuffle: the window that finds the first of equal rows is met by the
    partitioning by conversation, and sorts with spilling as the order does.
    """
    equal = Window.partitionBy("conv_id", "role", F.xxhash64("text"), "text")
    first = F.row_number().over(equal.orderBy(F.asc_nulls_first("turn"))) == 1
    rows = rows.repartition("conv_id").withColumn("first", first)
    order = [F.asc_nulls_first("conv_id"), *_order(), F.desc("first")]
    return rows.sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "first")


def repairs(conversations: DataFrame, defects: bool = False) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, roles,
    repaired_sha256), one row for every conv_id, also a null one.

    Turns are read in order, nulls first; rows of one turn in the order of role
    and text. A null role or text is one space. A row's first fault counts:
    blank, a duplicate of an earlier row, or truncated. `gaps` is the number of
    turns missing between the first and the last, `illegal` that of neighbours
    whose role initials are not su, ua or au. `audit` has the initials of the
    cheapest edits (Keep, Rerole, Delete, Insert), the least string of them in
    ASCII; `roles` the initials of the repaired rows. A conversation without
    rows (all dropped) has zeros and empty strings.

    `defects` puts those of `damaged` in first. Other columns are left aside. A
    conversation of any length is read as a stream by one task, since a digest
    has to be; the task holds its open edits and the result, no texts.
    """
    ship(conversations.sparkSession)
    rows = damaged(conversations) if defects else _whole(conversations)
    return _in_order(rows).mapInArrow(_repair, _RESULT)


def repaired(conversations: DataFrame, defects: bool = False) -> DataFrame:
    """(conv_id, place, edit, turn, role, text): the rows of the repaired
    conversations in the order of `place`, from 0. `edit` is K, R or I; inserted
    rows have no turn and an empty text."""
    long = {"u": "user", "a": "assistant"}
    audits = repairs(conversations, defects).select("conv_id", "audit", "roles")
    edits = audits.select("conv_id", "roles", F.posexplode(F.split("audit", "(?!$)")).alias("at", "edit"))
    order = Window.partitionBy("conv_id").orderBy("at")
    edits = edits.where("edit <> ''").withColumns(
        {
            "place": F.sum(F.when(F.col("edit") == "D", 0).otherwise(1)).over(order) - 1,
            "row": F.sum(F.when(F.col("edit") == "I", 0).otherwise(1)).over(order),
        }
    )
    edits = edits.where("edit <> 'D'").withColumn("initial", F.expr("substring(roles, int(place) + 1, 1)"))
    edits = edits.withColumn("row", F.when(F.col("edit") != "I", F.col("row"))).drop("at", "roles")
    rows = damaged(conversations) if defects else _whole(conversations)
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy(*_order()))
    rows = rows.where("role is not null").withColumn("row", number)
    rows = rows.select(F.col("conv_id").alias("of"), "row", "turn", F.col("role").alias("was"), "text")
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (edits["row"] == rows["row"])
    role = F.col("was")
    for initial, name in long.items():
        made = (F.col("edit") != "K") & (F.col("initial") == initial)
        role = F.when(made, F.lit(name)).otherwise(role)
    return edits.join(rows, same, "left").select(
        "conv_id", "place", "edit", "turn", role.alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
