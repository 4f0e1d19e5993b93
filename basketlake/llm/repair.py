"""Operator 13: conversation structure repair by depth-first branch and bound."""

from __future__ import annotations

import hashlib
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import stored, table

SPACES = " \t\n\x0b\x0c\r"
#: What edits cost, by their initials; a truncated row that stays costs TRUNCATED more.
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 4, 3, 0, 3, 3
#: What stands before the next row: nothing, the system's row, a user's or an assistant's; and what may follow it.
STATES = "^sua"
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEEDED = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
NAMES = {AFTER_U: "user", AFTER_A: "assistant"}
LEGAL = {"^s", "^u", "su", "ua", "au"}
OUT_ROWS = 2_000


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage by crc32("conv_id:turn") % 20; nulls count as one space there and in texts.

    0 drops the row, 1 empties its text, 2 removes its `[.!?]`, 3 repeats it, 4 makes it the user's.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return (
        rows.select(
            "conv_id", "turn", kind.alias("kind"), F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        )
        .where("kind != 0")
        .select("conv_id", "turn", "role", "text", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
        .drop("copy")
    )


def suffix_bounds(initials: list[str], faults: list[str]) -> list[tuple[float, ...]]:
    """For each place and state, what the rows from there on cost at least, by a recurrence from the end.

    Faults are `b`lank, `d`uplicate, `t`runcated or none. Costs only: which of equally cheap edits come first in ASCII
    order is left to the search. No bound is below the cost of the best edits, so the search meets few dead ends.
    """
    never = float("inf")
    late_of = [TRUNCATED if f == "t" else 0 for f in faults]
    stay = [0, never, never, 0]
    bounds = []
    for i in range(len(initials), -1, -1):
        if bounds:
            late, rest = late_of[i], bounds[-1]
            stay = [DELETE + rest[s] for s in range(4)]
            if faults[i] not in ("b", "d"):
                for s in range(4):
                    stay[s] = min(stay[s], REROLE + late + rest[NEEDED[s]])
                    if initials[i] and STATES[s] + initials[i] in LEGAL:
                        stay[s] = min(stay[s], KEEP + late + rest[STATES.index(initials[i])])
        user, assistant = min(stay[AFTER_U], INSERT + stay[AFTER_A]), min(stay[AFTER_A], INSERT + stay[AFTER_U])
        bounds.append((min(stay[START], INSERT + user), min(stay[AFTER_S], INSERT + user), user, assistant))
    return bounds[::-1]


class Node(NamedTuple):
    """Edits up to a row: their cost, the next row, what stands before it, the last edit, and the node before."""

    cost: int
    at: int
    state: int
    edit: str
    before: Node | None
    depth: int


def _audit_first(a: Node, b: Node) -> bool:
    """Whether the edits of a come before those of b in ASCII order; only what follows their last common node is read."""
    x, y = [], []
    while a is not b:
        deeper_a, deeper_b = a.depth >= b.depth, b.depth >= a.depth
        if deeper_a:
            x.append(a.edit)
            a = a.before
        if deeper_b:
            y.append(b.edit)
            b = b.before
    return x[::-1] < y[::-1]


def cheapest(initials: list[str], faults: list[str]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits after which role initials read `(s?(ua)+)?`; ties go to the ASCII-least audit.

    Depth-first branch and bound with an explicit stack. A branch ends where its cost and the bound of the rows left
    exceed the incumbent, or where an earlier prefix reached the same row and state with a lower (cost, audit). The
    child with the lowest bound is looked at first. When the stack is empty, the incumbent is proved to be the best.
    """
    n = len(initials)
    bounds = suffix_bounds(initials, faults)
    root = Node(0, 0, START, "", None, 0)
    incumbent: Node | None = root if not n else None
    best, stack = {(0, START): root}, [root]
    while stack:
        node = stack.pop()
        cost, at, state = node.cost, node.at, node.state
        if best[at, state] is not node:
            continue
        moves = [(INSERT, at, NEEDED[state], "I")]
        if at < n:
            moves.append((DELETE, at + 1, state, "D"))
            if faults[at] not in ("b", "d"):
                late = TRUNCATED if faults[at] == "t" else 0
                moves.append((REROLE + late, at + 1, NEEDED[state], "R"))
                if initials[at] and STATES[state] + initials[at] in LEGAL:
                    moves.append((KEEP + late, at + 1, STATES.index(initials[at]), "K"))
        children = []
        for price, to, then, edit in moves:
            total = cost + price
            bound = total + bounds[to][then]
            if incumbent and bound > incumbent.cost:
                continue
            child = Node(total, to, then, edit, node, node.depth + 1)
            old = best.get((to, then))
            if old and (old.cost < total or old.cost == total and not _audit_first(child, old)):
                continue
            best[to, then] = child
            if to == n and then in (START, AFTER_A):
                if not incumbent or total < incumbent.cost or total == incumbent.cost and _audit_first(child, incumbent):
                    incumbent = child
            children.append((bound, edit, child))
        stack.extend(c[2] for c in sorted(children, reverse=True, key=itemgetter(0, 1)))
    edits, node = [], incumbent
    while node.before:
        edits.append(node.edit)
        node = node.before
    return incumbent.cost, "".join(reversed(edits))


def replayed(audit: str, rows):
    """(role, text) of every row after the edits, one at a time; rows is an iterator of (role, text)."""
    state = START
    for edit in audit:
        role, text = next(rows) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit == "K":
            state = STATES.index(role[0])
        else:
            state = NEEDED[state]
            role = NAMES[state]
        yield role, text


def _fault(role: str, text: str, seen: set[bytes]) -> str:
    shown = text.rstrip(SPACES)
    if not shown:
        return "b"
    key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
    if key in seen:
        return "d"
    seen.add(key)
    return "" if shown[-1] in ".!?" else "t"


def _grouped(batches):
    """(conv_id, rows) of batches that are sorted by conversation, one row at a time."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    return groupby(rows, key=itemgetter(0))


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn_row", "turn", "role", "text")


def _rows(turns: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text"))
    return turns.select("conv_id", F.lit(1).alias("turn_row"), F.col("turn").cast("long").alias("turn"), role, text)


PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def plans(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation, and of those of ids.

    Rows are taken by turn (nulls first), then role and text. A row's first fault counts: blank, duplicate (role and
    text seen earlier) or truncated (no `.`, `!` or `?` at the end). gaps are turns missing between the first and the
    last, illegal are neighbours whose role initials are not su, ua or au. Null roles and texts count as one space; a
    null conv_id is a conversation of its own; conversations of ids without rows get zeros and an empty audit; an empty
    table gives no rows. Other columns are not read. Rows are sorted on disk and read one at a time; a task holds a
    digest and a few nodes for each row of one conversation, no texts.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {PLAN}"
    ids = turns.select("conv_id") if ids is None else ids.select("conv_id")
    blank = F.lit(None).cast("string")
    heads = ids.distinct().select("conv_id", F.lit(0).alias("turn_row"), F.lit(None).cast("long").alias("turn"), blank.alias("role"), blank.alias("text"))

    def plan(batches):
        out = []
        for conv_id, rows in _grouped(batches):
            initials, faults, seen, turns_seen = [], [], set(), []
            for _, turn_row, turn, role, text in rows:
                if turn_row:
                    initials.append(role[:1])
                    faults.append(_fault(role, text, seen))
                    if turn is not None:
                        turns_seen = [turns_seen[0], turn, turns_seen[2] + (turn != turns_seen[1])] if turns_seen else [turn, turn, 1]
            gaps = turns_seen[1] - turns_seen[0] + 1 - turns_seen[2] if turns_seen else 0
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
            cost, audit = cheapest(initials, faults)
            out.append((conv_id, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit))
            if len(out) >= OUT_ROWS:
                yield _batch(out, types)
                out = []
        yield _batch(out, types)

    types = _types(turns, PLAN)
    return _ordered(heads.unionByName(_rows(turns))).mapInArrow(plan, schema)


def _types(turns: DataFrame, columns: str) -> list[tuple[str, pa.DataType]]:
    from pyspark.sql.pandas.types import to_arrow_type

    named = [c.split() for c in columns.split(", ")]
    arrow = {"long": pa.int64(), "string": pa.string()}
    return [("conv_id", to_arrow_type(turns.schema["conv_id"].dataType)), *((name, arrow[kind]) for name, kind in named)]


def _batch(rows: list[tuple], types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, (_, t) in enumerate(types)], names=[n for n, _ in types])


def _with_audits(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """Every conversation's rows behind a row that holds its audit as text."""
    heads = audits.select("conv_id", F.lit(0).alias("turn_row"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    return _ordered(heads.unionByName(_rows(turns)))


def _repaired(batches):
    """(conv_id, iterator of its rows after repair), for conversations that have an audit."""
    for conv_id, rows in _grouped(batches):
        _, turn_row, _, _, audit = next(rows)
        if not turn_row:
            yield conv_id, replayed(audit, ((role, text) for _, _, _, role, text in rows))


def repaired_turns(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): every conversation of audits after its edits, turns counted from 0."""
    columns = "turn long, role string, text string"
    types = _types(turns, columns)

    def rows(batches):
        out, size = [], 0
        for conv_id, repaired in _repaired(batches):
            for turn, (role, text) in enumerate(repaired):
                out.append((conv_id, turn, role, text))
                size += len(text)
                if len(out) >= OUT_ROWS or size > 1 << 20:
                    yield _batch(out, types)
                    out, size = [], 0
        yield _batch(out, types)

    return _with_audits(turns, audits).mapInArrow(rows, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, {columns}")


def digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the digest of `role:text` of the rows after repair, joined by newlines."""
    types = _types(turns, "repaired_sha256 string")

    def hashed(batches):
        out = []
        for conv_id, repaired in _repaired(batches):
            digest = hashlib.sha256()
            for i, (role, text) in enumerate(repaired):
                digest.update(f"{chr(10) if i else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            out.append((conv_id, digest.hexdigest()))
            if len(out) >= OUT_ROWS:
                yield _batch(out, types)
                out = []
        yield _batch(out, types)

    return _with_audits(turns, audits).mapInArrow(hashed, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")


def repaired(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The plans of all conversations with the digests of what they make of them."""
    audits = stored(plans(turns, ids), "repair-plans")
    found = digests(turns, audits)
    same = audits["conv_id"].eqNullSafe(found["conv_id"])
    return audits.join(found, same).select(audits["*"], "repaired_sha256")


def op13(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repaired(damaged(rows), rows)
