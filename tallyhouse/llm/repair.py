"""Repair of conversation structure by weighted CYK interval parsing.

A good conversation's role initials are ``(s?(ua)+)?``. The repair grammar is in Chomsky normal form: a symbol
(p, q) derives the edits that take an automaton for that pattern from state p to state q, so its rules are
(p, q) -> (p, r) (r, q), and each row is a terminal: keep it (0), give it another role (2) or delete it (3); a kept
or re-roled row whose text is cut off adds 1. Insertions (2 each) are the closure over empty spans; it stands before every row
and behind the last. A cell of a span holds for every symbol the least (cost, audit), the audit being
the initials of the edits. Cells are combined bottom-up by span length, all spans of one length in one numpy step,
and conversations that have their whole span are taken out. Because the pattern is regular, every way of
cutting a span in two gives the same cell, so one cut per span is enough. The least audit of a span is made of least audits
of its parts: audits of equal cost over the same rows are never prefixes of each other.

Rows are dealt by range over (conversation, turn, role, text), so a very long conversation lies in many tasks. Each task
settles the conversations inside its range; of the first and the last one it passes on cells and rows, which
are combined by conversation and hashed in a stream. Equal rows of a turn are one row with a count until then.

Turns come in ascending order, nulls first; rows of one turn are ordered by role and text. Null roles and texts
are one space; a role without a letter that fits can only be changed or deleted. Rows of a null conversation id are one conversation.
``illegal`` and the faults are those before the repair. Numbers of turns are 64-bit; differences wrap around. Columns other than
the four are left out. No rows give no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallyhouse.llm.common import staged, whole_groups
from tallyhouse.operators.joins import join_by_key

STATES = 4  # nothing yet, s, u, a
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
NEVER = np.int64(1) << 60
BLANKS = " \t\n\x0b\x0c\r"
BLOCK = 1 << 15  # rows whose cells are made together

RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def _next_role(state: int) -> str:
    """The role that may be inserted or given in a state."""
    return "assistant" if state == 2 else "user"


@functools.cache
def closure() -> tuple[np.ndarray, np.ndarray]:
    """Cell of the empty span: the fewest insertions from state to state."""
    cost = np.full((1, STATES, STATES), NEVER)
    audit = np.zeros((1, STATES, STATES), "S2")
    for p in range(STATES):
        state, n = p, 0
        cost[0, p, p] = 0
        while n < 2:
            state = STEP[state, _next_role(state)[0]]
            n += 1
            if cost[0, p, state] > 2 * n:
                cost[0, p, state], audit[0, p, state] = 2 * n, b"I" * n
    return cost, audit


def combine(left, right):
    """Cells of spans that are cut in two: the least (cost, audit) over the state between."""
    cost = audit = None
    for r in range(STATES):
        c = left[0][:, :, r, None] + right[0][:, None, r, :]
        a = np.strings.add(left[1][:, :, r, None], right[1][:, None, r, :])
        if cost is None:
            cost, audit = c, a
            continue
        better = (c < cost) | ((c == cost) & (a < audit))
        cost, audit = np.where(better, c, cost), np.where(better, a, audit)
    never = cost >= NEVER
    cost[never], audit[never] = NEVER, b""
    width = max(1, int(np.strings.str_len(audit).max(initial=1)))
    return cost, audit.astype(f"S{width}")


@functools.cache
def row_cells() -> tuple[np.ndarray, np.ndarray]:
    """Cells of rows by kind: initial (s, u, a, other) * 4 + must go * 2 + cut off."""
    cost = np.full((16, STATES, STATES), NEVER)
    audit = np.zeros((16, STATES, STATES), "S1")
    for kind in range(16):
        initial, gone, cut = "sua?"[kind // 4], kind // 2 % 2, kind % 2
        for p in range(STATES):
            cost[kind, p, p], audit[kind, p, p] = 3, b"D"
            if gone:
                continue
            q = STEP[p, _next_role(p)[0]]
            cost[kind, p, q], audit[kind, p, q] = 2 + cut, b"R"
            if (p, initial) in STEP:
                q = STEP[p, initial]
                cost[kind, p, q], audit[kind, p, q] = cut, b"K"
    cost_e, audit_e = closure()
    return combine((np.repeat(cost_e, 16, 0), np.repeat(audit_e, 16, 0)), (cost, audit))


def whole_spans(cost: np.ndarray, audit: np.ndarray, owner: np.ndarray):
    """Combine cells that stand side by side and have one owner, until each owner has one cell.
    Returns owners, costs and audits (a list of arrays)."""
    owners, costs, audits = [], [], []
    while len(owner):
        new = np.r_[True, owner[1:] != owner[:-1]]
        first = np.flatnonzero(new)
        place = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
        last = np.r_[new[1:], True]
        done = new & last
        owners.append(owner[done])
        costs.append(cost[done])
        audits += list(audit[done])
        keep = ~done
        cost, audit, owner, place, last = cost[keep], audit[keep], owner[keep], place[keep], last[keep]
        low = np.flatnonzero(place % 2 == 0)
        paired = ~last[low]
        both = low[paired]
        c, a = combine((cost[both], audit[both]), (cost[both + 1], audit[both + 1]))
        alone = low[~paired]
        order = np.argsort(np.r_[both, alone])
        wide = np.promote_types(a.dtype, audit.dtype)
        cost = np.concatenate([c, cost[alone]])[order]
        audit = np.concatenate([a.astype(wide), audit[alone].astype(wide)])[order]
        owner = np.r_[owner[both], owner[alone]][order]
    if not owners:
        return np.zeros(0, np.int64), np.zeros((0, STATES, STATES), np.int64), []
    return np.concatenate(owners), np.concatenate(costs), audits


def _padded(audits: list[np.ndarray]) -> np.ndarray:
    width = max((a.dtype.itemsize for a in audits), default=1)
    return np.array([a.astype(f"S{width}") for a in audits]).reshape(-1, STATES, STATES)


def span_cells(kinds: np.ndarray, owner: np.ndarray, n: int):
    """The cell of each owner 0..n-1 from the kinds of its rows (owners ascending); those without rows
    get None."""
    cost_k, audit_k = row_cells()
    owners, costs, audits = [], [], []
    for low in range(0, len(kinds), BLOCK):
        part = slice(low, low + BLOCK)
        o, c, a = whole_spans(cost_k[kinds[part]], audit_k[kinds[part]], owner[part])
        order = np.argsort(o)
        owners.append(o[order])
        costs.append(c[order])
        audits += [a[i] for i in order]
    out = [None] * n
    if not owners:
        return out
    owner, cost = np.concatenate(owners), np.concatenate(costs)
    several = np.r_[False, owner[1:] == owner[:-1]]
    several |= np.r_[several[1:], False]
    for i in np.flatnonzero(~several):
        out[owner[i]] = cost[i], audits[i]
    at = np.flatnonzero(several)
    if len(at):
        o, c, a = whole_spans(cost[at], _padded([audits[i] for i in at]), owner[at])
        for i, who in enumerate(o):
            out[who] = c[i], a[i]
    return out


def least(cell) -> tuple[int, bytes]:
    """Cost and audit of the cheapest repair of a whole conversation: from the start to a final state, with the
    insertions behind the last row."""
    if cell is None:
        return 0, b""
    costs, audits = cell[0][0].tolist(), cell[1][0].tolist()
    cost_e, audit_e = (part[0].tolist() for part in closure())
    return min(
        (costs[r] + cost_e[r][q], audits[r] + audit_e[r][q]) for r in range(STATES) for q in FINAL
    )


class Repaired:
    """Hash of a repaired conversation, written row by row along its audit."""

    def __init__(self, audit: bytes):
        self.audit, self.at, self.state, self.first = audit, 0, 0, True
        self.hash = hashlib.sha256()

    def _write(self, role: str, text: str) -> None:
        if not self.first:
            self.hash.update(b"\n")
        self.first = False
        self.hash.update(f"{role}:{text}".encode())

    def insert(self) -> None:
        while self.audit[self.at : self.at + 1] == b"I":
            role = _next_role(self.state)
            self._write(role, "")
            self.state = STEP[self.state, role[0]]
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.insert()
        edit = self.audit[self.at : self.at + 1]
        self.at += 1
        if edit == b"D":
            return
        if edit == b"R":
            role = _next_role(self.state)
        self._write(role, text)
        self.state = STEP[self.state, role[0]]

    def digest(self) -> str:
        self.insert()
        return self.hash.hexdigest()


def _by_owner(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner[values], minlength=n).astype(np.int64)


class Rows:
    """Rows of whole groups, in order, as arrays; repeated rows stand one by one."""

    def __init__(self, table: pa.Table):
        copies = table.column("copies").to_numpy()
        place = _places(table)
        start = np.flatnonzero(np.diff(place, prepend=-1))
        self.n = len(start)
        self.group = table.column("group").take(pa.array(start)).to_pylist()
        self.conv_id = table.column("conv_id").take(pa.array(start))
        self.source = np.repeat(np.arange(len(copies)), copies)  # row of the table
        again = np.r_[False, self.source[1:] == self.source[:-1]]
        self.owner = place[self.source]
        self.blank = table.column("blank").to_numpy()[self.source]
        self.duplicate = (table.column("again").to_numpy()[self.source] | again) & ~self.blank
        cut = table.column("cut").to_numpy()[self.source]
        self.truncated = cut & ~self.blank & ~self.duplicate
        roles = table.column("role").combine_chunks().dictionary_encode()
        initial = np.array(["sua".find(r[:1]) if r else -1 for r in roles.dictionary.to_pylist()], np.int64)
        initial[initial < 0] = 3
        self.initial = initial[roles.indices.to_numpy()[self.source]]
        turns = table.column("turn")
        self.known = turns.is_valid().to_numpy()[self.source]
        self.turn = turns.fill_null(0).to_numpy()[self.source]

    def stats(self) -> dict[str, np.ndarray]:
        """Counts and edges of each group."""
        n, owner = self.n, self.owner
        out = {
            "blank": _by_owner(self.blank, owner, n),
            "duplicate": _by_owner(self.duplicate, owner, n),
            "truncated": _by_owner(self.truncated, owner, n),
        }
        same = owner[1:] == owner[:-1]
        x, y = self.initial[:-1], self.initial[1:]
        legal = ((x == 0) & (y == 1)) | ((x == 1) & (y == 2)) | ((x == 2) & (y == 1))
        out["illegal"] = _by_owner(same & ~legal, owner[1:], n)
        begin, end = np.searchsorted(owner, np.arange(n)), np.searchsorted(owner, np.arange(n), "right")
        some = end > begin
        for name, at in (("first", begin), ("last", end - 1)):
            out[name] = np.full(n, -1)
            out[name][some] = self.initial[at[some]]
        turn, who = self.turn[self.known], owner[self.known]
        begin, end = np.searchsorted(who, np.arange(n)), np.searchsorted(who, np.arange(n), "right")
        out["turns"] = np.zeros(n, np.int64)
        fresh = np.r_[True, (who[1:] != who[:-1]) | (turn[1:] != turn[:-1])][: len(who)]
        np.add.at(out["turns"], who[fresh], 1)
        for name, at in (("low", begin), ("high", end - 1)):
            out[name] = np.zeros(n, np.int64)
            out[name][end > begin] = turn[at[end > begin]]
        return out

    def cells(self):
        kinds = self.initial * 4 + (self.blank | self.duplicate) * 2 + self.truncated
        return span_cells(kinds.astype(np.int64), self.owner, self.n)


def _gaps(low, high, turns):
    with np.errstate(over="ignore"):
        return np.where(turns > 0, high - low + 1 - turns, 0)


_PASS = (
    f"kind int, group string, conv_id {{id}}, part int, at long, role string, text string, copies long, {RESULT}, "
    "first int, last int, turns long, low long, high long, costs array<long>, audits array<binary>"
)


def _settle(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0: conversations that are settled; of kind 1: what this range has of its first and its last
    conversation; of kind 2: the rows of these."""
    part = TaskContext.get().partitionId()

    def out(values: dict) -> pa.RecordBatch:
        n = len(next(iter(values.values())))
        return pa.RecordBatch.from_arrays(
            [
                values[f.name].cast(f.type)
                if isinstance(values.get(f.name), (pa.Array, pa.ChunkedArray))
                else pa.array(values[f.name], f.type)
                if f.name in values
                else pa.nulls(n, f.type)
                for f in schema
            ],
            schema=schema,
        )

    tables = whole_groups(batches, "group")
    table, ahead, begun, row_no = next(tables, None), None, False, 0
    while table is not None:
        ahead = next(tables, None)
        rows = Rows(table)
        stats, cells = rows.stats(), rows.cells()
        edge = np.zeros(rows.n, bool)
        edge[0] |= not begun
        edge[-1] |= ahead is None
        begun = True
        best = [least(cells[i]) if not edge[i] else (0, b"") for i in range(rows.n)]
        roles, texts = table.column("role").to_pylist(), table.column("text").to_pylist()
        bounds = np.searchsorted(rows.owner, np.arange(rows.n + 1))
        digests = []
        for i in range(rows.n):
            if edge[i]:
                digests.append(None)
                continue
            written = Repaired(best[i][1])
            for k in rows.source[bounds[i] : bounds[i + 1]]:
                written.row(roles[k], texts[k])
            digests.append(written.digest())
        for kind, chosen in ((0, np.flatnonzero(~edge)), (1, np.flatnonzero(edge))):
            if not len(chosen):
                continue
            values = {name: column[chosen] for name, column in stats.items()}
            values |= {
                "kind": np.full(len(chosen), kind),
                "group": [rows.group[i] for i in chosen],
                "conv_id": rows.conv_id.take(pa.array(chosen)).combine_chunks(),
                "part": np.full(len(chosen), part),
            }
            if kind == 0:
                values["gaps"] = _gaps(values["low"], values["high"], values["turns"])
                values["cost"] = [best[i][0] for i in chosen]
                values["audit"] = [best[i][1].decode() for i in chosen]
                values["repaired_sha256"] = [digests[i] for i in chosen]
            else:
                values["costs"] = [None if cells[i] is None else cells[i][0].ravel().tolist() for i in chosen]
                values["audits"] = [None if cells[i] is None else cells[i][1].ravel().tolist() for i in chosen]
            yield out(values)
        held = np.flatnonzero(edge[_places(table)] & (table.column("copies").to_numpy() > 0))
        for low in range(0, len(held), 4096):
            some = pa.array(held[low : low + 4096])
            values = {c: table.column(c).take(some).combine_chunks() for c in ("group", "role", "text", "copies")}
            values["kind"] = np.full(len(some), 2)
            values["part"] = np.full(len(some), part)
            values["at"] = row_no + held[low : low + 4096]
            yield out(values)
        row_no += table.num_rows
        table = ahead


def _places(table: pa.Table) -> np.ndarray:
    """Number of the group of each row of the table."""
    codes = table.column("group").combine_chunks().dictionary_encode().indices.to_numpy()
    return np.cumsum(np.r_[False, codes[1:] != codes[:-1]])


def _joined(pieces: pa.Table, schema: pa.Schema) -> pa.Table:
    """One conversation from its pieces in ascending ranges."""
    rows = sorted(pieces.to_pylist(), key=lambda r: r["part"])
    total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
    last = high = None
    low = 0
    for r in rows:
        for name in total:
            total[name] += r[name]
        if r["first"] >= 0:
            if last is not None:
                total["illegal"] += (last, r["first"]) not in ((0, 1), (1, 2), (2, 1))
            last = r["last"]
        if r["turns"]:
            low = r["low"] if high is None else low
            total["turns"] -= high == r["low"]
            high = r["high"]
    held = [r for r in rows if r["costs"] is not None]
    cell = None
    if held:
        shape = (STATES, STATES)
        cost = np.array([r["costs"] for r in held], np.int64).reshape(-1, *shape)
        audit = _padded([np.array(r["audits"]).reshape(shape) for r in held])
        _, c, a = whole_spans(cost, audit, np.zeros(len(held), np.int64))
        cell = c[0], a[0]
    cost, audit = least(cell)
    total["gaps"] = int(_gaps(*(np.array([v], np.int64) for v in (low, high or 0, total.pop("turns"))))[0])
    total |= {"cost": cost, "audit": audit.decode(), "group": rows[0]["group"], "conv_id": rows[0]["conv_id"]}
    return pa.Table.from_pylist([total], schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each conversation from its audit, followed by its rows in order."""
    group = written = None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"group": [group], "repaired_sha256": [written.digest()]})

    for batch in batches:
        for r in batch.to_pylist():
            if r["part"] < 0:
                if written is not None:
                    yield out()
                group, written = r["group"], Repaired(r["audit"].encode())
            else:
                for _ in range(r["copies"]):
                    written.row(r["role"], r["text"])
    if written is not None:
        yield out()


def repair(turns: DataFrame, *, copies: str | None = None) -> DataFrame:
    """One row (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation.
    ``copies`` names a column that says how often a row stands in its place; a conversation whose rows are all 0 has no
    rows, but is returned."""
    n = F.lit(1).cast("long") if copies is None else F.col(copies).cast("long")
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("group"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        n.alias("copies"),
    )
    # rows that are gone only name their conversation
    there = F.col("copies") > 0
    rows = rows.withColumns(
        {"turn": F.when(there, F.col("turn")), "role": F.when(there, F.col("role")).otherwise(""),
         "text": F.when(there, F.col("text")).otherwise("")}
    )
    saying = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    first = (
        rows.where(there)
        .groupBy("group", saying.alias("saying"))
        .agg(F.min(F.struct("turn")).alias("earliest"))
    )
    counted = rows.groupBy("group", "conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    tail = F.rtrim(F.col("text"), F.lit(BLANKS))
    known = join_by_key(counted.withColumn("saying", saying), first, ["group", "saying"], "left")
    tagged = staged(
        known.select(
            "group", "conv_id", "turn", "role", "text", "copies",
            (tail == "").alias("blank"),
            (~F.substring(tail, -1, 1).isin(".", "!", "?")).alias("cut"),
            F.coalesce(F.struct("turn") > F.col("earliest"), F.lit(False)).alias("again"),
        )
    )
    order = ["group", "turn", "role", "text"]
    dealt = tagged.repartitionByRange(*order).sortWithinPartitions(*order)
    columns = _PASS.format(id=kind)
    arrow = _arrow_schema(turns, columns)
    passed = staged(dealt.mapInArrow(lambda batches: _settle(batches, arrow), columns))
    settled = passed.where("kind = 0")
    joined_columns = f"group string, conv_id {kind}, " + RESULT.rsplit(",", 1)[0]
    joined_arrow = _arrow_schema(turns, joined_columns)
    edges = staged(
        passed.where("kind = 1")
        .groupBy("group")
        .applyInArrow(lambda table: _joined(table, joined_arrow), joined_columns)
    )
    stream = edges.select("group", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("at"), "audit")
    stream = stream.unionByName(
        passed.where("kind = 2").select("group", "part", "at", "role", "text", "copies"),
        allowMissingColumns=True,
    )
    hashes = (
        stream.repartition("group")
        .sortWithinPartitions("group", "part", "at")
        .mapInArrow(_hashed, "group string, repaired_sha256 string")
    )
    names = ["conv_id", *[c.split()[0] for c in RESULT.split(", ")]]
    return settled.select(*names).unionByName(edges.join(hashes, "group").select(*names))


def _arrow_schema(turns: DataFrame, columns: str) -> pa.Schema:
    return to_arrow_schema(turns.sparkSession.createDataFrame([], columns).schema)
