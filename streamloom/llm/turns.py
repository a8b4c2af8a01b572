"""Conversation structure repair by survivor-coalescence Viterbi.

The roles of a repaired conversation begin with at most one system turn and then alternate, user first and assistant last. The cheapest edits are
found over four states: nothing yet, system, user, assistant. Each state has one survivor, a leaf of a tree of backpointers whose nodes count
their references. When all survivors share an ancestor, the edits up to it are final: they are emitted, and their nodes and texts are forgotten.
So memory holds unresolved edits only, however long a conversation is; survivors of equal cost are told apart by their whole
unresolved edits. A survivor that costs so much that another can do all it can for less is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from streamloom.llm.common import BLANKS
from streamloom.shipping import ship_by_value

#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: For each state the roles that may follow, by initial, and the state they lead to.
FOLLOW = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
#: What it costs at most to go on from one state as from another: the survivor of the other, if it costs more than that, can't win any more. Without
#: this nothing and system, which few edits lead to, would keep their old edits unresolved for ever.
IMITATE = {"": {"s": 2 * INSERT, "u": INSERT + DELETE, "a": DELETE}, "s": {"u": INSERT, "a": 0}}
#: States in which a conversation may end, and what inserted or reroled turns are called.
ENDS, NAMES = ("", "a"), {"u": "user", "a": "assistant"}


class Node:
    """An edit in the tree of backpointers; ``refs`` counts its children, and the survivor that it is."""

    __slots__ = ("parent", "edit", "row", "refs")

    def __init__(self, parent: Node | None, edit: str, row):
        self.parent, self.edit, self.row, self.refs = parent, edit, row, 0
        if parent is not None:
            parent.refs += 1


def drop(node: Node | None) -> None:
    """Take a reference from a node, and forget it and the ancestors that nothing needs any more."""
    while node is not None:
        node.refs -= 1
        if node.refs:
            return
        node = node.parent


class Repair:
    """The cheapest edits of one conversation. ``push`` and ``finish`` give the edits that have become final, as (letter, row)."""

    def __init__(self):
        self.root = Node(None, "", None)
        self.root.refs = 1
        self.live: dict[str, tuple[int, Node]] = {"": (0, self.root)}
        self.cost = 0

    def edits_of(self, node: Node) -> str:
        """The unresolved edits up to a node."""
        letters = []
        while node is not self.root:
            letters.append(node.edit)
            node = node.parent
        return "".join(reversed(letters))

    def _offer(self, into: dict, state: str, cost: int, parent: Node, edit: str, row) -> bool:
        """Let an edit compete to be the survivor of a state; of equal costs the least sequence of edits wins."""
        held = into.get(state)
        if held is not None and (cost > held[0] or cost == held[0] and self.edits_of(parent) + edit >= self.edits_of(held[1])):
            return False
        node = Node(parent, edit, row)
        node.refs = 1
        into[state] = (cost, node)
        if held is not None:
            drop(held[1])
        return True

    def _insert(self) -> None:
        """Let turns be inserted where that is cheaper; it ends, as each costs something."""
        open_ = list(self.live)
        while open_:
            state = open_.pop()
            cost, node = self.live[state]
            for initial, next_ in FOLLOW[state].items():
                if initial in NAMES and self._offer(self.live, next_, cost + INSERT, node, "I", (NAMES[initial], "")):
                    open_.append(next_)

    def push(self, role: str, text: str, useless: bool, truncated: bool) -> list[tuple[str, tuple[str, str] | None]]:
        self._insert()
        after: dict[str, tuple[int, Node]] = {}
        for state, (cost, node) in self.live.items():
            self._offer(after, state, cost + DELETE, node, "D", None)
            if useless:
                continue
            cost += TRUNCATED if truncated else 0
            for initial, next_ in FOLLOW[state].items():
                if role[:1] == initial:
                    self._offer(after, next_, cost, node, "K", (role, text))
                if initial in NAMES:
                    self._offer(after, next_, cost + REROLE, node, "R", (NAMES[initial], text))
        before, self.live = self.live, after
        for _, node in before.values():
            drop(node)
        for state, others in IMITATE.items():
            if state in after and any(o in after and after[o][0] + extra < after[state][0] for o, extra in others.items()):
                drop(after.pop(state)[1])
        return self._resolved()

    def finish(self) -> list[tuple[str, tuple[str, str] | None]]:
        self._insert()
        ends = [(cost, self.edits_of(node), state) for state, (cost, node) in self.live.items() if state in ENDS]
        self.cost, _, best = min(ends)
        for state in list(self.live):
            if state != best:
                drop(self.live.pop(state)[1])
        return self._resolved()

    def _resolved(self) -> list[tuple[str, tuple[str, str] | None]]:
        """Move the root to the last ancestor that all survivors share, and give the edits on the way."""
        survivors = [node for _, node in self.live.values()]
        if self.root.refs > 1 or self.root in survivors:
            return []
        path, node = [], survivors[0]
        while node is not self.root:
            path.append(node)
            node = node.parent
        out = []
        while path and self.root.refs == 1 and self.root not in survivors:
            node = path.pop()
            out.append((node.edit, node.row))
            node.parent = None
            self.root, node.edit, node.row = node, "", None
        return out


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` and ``dropped`` of every turn after a fault that the checksum of ``conv:turn`` chooses.

    Of 20 checksums 0 drops the turn (it stays as a row with ``dropped``, so that no conversation is lost), 1 empties its text, 2 takes
    ``.``, ``!`` and ``?`` out of it, 3 repeats it, 4 makes its role user. NULL role, text, and in the checksum conversation and turn, count as one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.encode(F.concat_ws(":", space(conv), space(turn)), "UTF-8")) % 20
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), space(role).alias("role"), space(text).alias("text"), fault.alias("fault"))
    rows = rows.withColumn("text", F.when(F.col("fault") <= 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(False), F.lit(False))).otherwise(F.array(F.col("fault") == 0))).alias("dropped")
    return rows.select("conv", "turn", "role", "text", copies)


def ordered(turns: DataFrame) -> DataFrame:
    """Turns in the order of their conversations, with ``again``: role and text occurred earlier in it.

    One shuffle, by conversation; both sorts stay in its partitions and spill. Turns of equal number are ordered by role and text.
    """
    rows = turns.repartition("conv")
    earlier = F.row_number().over(Window.partitionBy("conv", "role", "text", "dropped").orderBy(F.col("turn").asc_nulls_first())) > 1
    return rows.withColumn("again", earlier).sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text", "again")


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """For each turn of ordered turns (conv, turn, role, text, fault or NULL, final edits); after each conversation (conv, its ``Repair``, final edits)."""
    conv, repair = None, None
    for batch in batches:
        for own, turn, role, text, dropped, again in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "dropped", "again"))):
            if repair is None or own != conv:
                if repair is not None:
                    yield conv, repair, repair.finish()
                conv, repair = own, Repair()
            if dropped:
                continue
            end = text.rstrip(BLANKS)[-1:]
            fault = "blank" if not end else "duplicate" if again else "truncated" if end not in ".!?" else None
            yield own, turn, role, text, fault, repair.push(role, text, fault in ("blank", "duplicate"), fault == "truncated")
    if repair is not None:
        yield conv, repair, repair.finish()


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def summaries(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (``conv``, ``turn``, ``role``, ``text``, ``dropped``): its faults, the cost, the edits and a digest of the repaired text.

    A turn's first fault counts: ``blank``, ``duplicate`` (role and text occurred earlier) or ``truncated`` (no ``.``, ``!`` or ``?`` at its end). ``gaps`` are
    turn numbers missing between the least and the largest, ``illegal`` neighbours whose roles do not follow each other. A conversation of which
    nothing is left has zeros, no edits and the digest of nothing. A role that is not system, user or assistant by its initial, the empty one too, is
    reroled or deleted. NULL conversations are one conversation. The text of a conversation is hashed in one stream, so one task reads it; it holds no more than unresolved edits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        import pyarrow as pa

        names = [part.split()[0] for part in f"conv x, {SUMMARY}".split(", ")]
        done: list[tuple] = []
        conv_as = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [conv_as, *["int64"] * 6, "string", "string"]
            return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names=names)

        def typed(batches):
            nonlocal conv_as
            for batch in batches:
                conv_as = batch.schema.field("conv").type
                yield batch

        def clean():
            return {"blank": 0, "duplicate": 0, "truncated": 0}, [], bytearray(), hashlib.sha256(), 0, ""

        faults, turns_seen, audit, digest, illegal, last = clean()
        n_rows = 0
        for step in walk(typed(batches)):
            for letter, row in step[-1]:
                audit += letter.encode()
                if row is not None:
                    digest.update((b"\n" if n_rows else b"") + f"{row[0]}:{row[1]}".encode())
                    n_rows += 1
            if len(step) == 6:
                _, turn, role, _, fault, _ = step
                if fault:
                    faults[fault] += 1
                if turns_seen or last:
                    illegal += last[:1] + role[:1] not in ("su", "ua", "au")
                last = role or " "
                if turn is not None:
                    turns_seen = [turns_seen[0], turn, turns_seen[2] + (turn != turns_seen[1])] if turns_seen else [turn, turn, 1]
                continue
            gaps = turns_seen[1] - turns_seen[0] + 1 - turns_seen[2] if turns_seen else 0
            done.append((step[0], gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, step[1].cost, audit.decode(), digest.hexdigest()))
            faults, turns_seen, audit, digest, illegal, last = clean()
            n_rows = 0
            if len(done) == 2000:
                yield batch_of(done)
                done = []
        if done:
            yield batch_of(done)

    rows = ordered(turns)
    return rows.mapInArrow(run, f"conv {rows.schema['conv'].dataType.simpleString()}, {SUMMARY}")


def repaired(turns: DataFrame) -> DataFrame:
    """``conv``, ``place`` (from 0), ``role`` and ``text`` of every turn of the repaired conversations, given out as their edits become final."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        out, conv_as, place, size = [], None, 0, 0

        def typed(batches):
            nonlocal conv_as
            for batch in batches:
                conv_as = batch.schema.field("conv").type
                yield batch

        for step in walk(typed(batches)):
            for _, row in step[-1]:
                if row is not None:
                    out.append((step[0], place, *row))
                    place, size = place + 1, size + len(row[1])
            if len(step) == 3:
                place = 0
            if len(out) >= 2000 or size >= 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*out), (conv_as, "int64", "string", "string"))], names=["conv", "place", "role", "text"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*out), (conv_as, "int64", "string", "string"))], names=["conv", "place", "role", "text"])

    rows = ordered(turns)
    return rows.mapInArrow(run, f"conv {rows.schema['conv'].dataType.simpleString()}, place long, role string, text string")


ship_by_value(__name__)
