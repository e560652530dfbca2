"""Repair of conversations by weighted parsing of spans.

A repaired conversation has an optional system turn and then user and assistant in turns. A turn
can be kept, be given the other role, or be deleted; empty turns can be inserted anywhere. The
grammar is in Chomsky normal form over pairs of states: (p, q) derives a span when reading its
repaired turns leads from p to q, so (p, q) -> (p, r) (r, q), and a single turn has one terminal
rule for each edit. The cell of a span has for every pair the least (cost, audit), where the audit
is the initials of the edits; it is closed under insertion at both ends.

Cells are combined bottom up: spans of one turn, of two, of four, and so on. One split of a span
is enough, since every pair of states is a nonterminal and joining cells is associative. So the
cells of a very long conversation are made in many tasks and joined in a tree, FAN at a time.
Least audits join to least audits: two derivations of one span and pair at the same cost have
equal numbers of letters other than I, so neither audit begins the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veleta.llm.tables import in_arrow
from veleta.session import stabilise

FAN = 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# Where a state leads with the initial of the next role; "0" is the start.
STEPS = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
STATES, FINAL, LEGAL = "0sua", "0a", {"su", "ua", "au"}
NAMES = {"u": "user", "a": "assistant"}

Cell = dict[tuple[str, str], tuple[int, str]]


def join(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans as one."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            more = right.get((r, q))
            if more:
                new = cost + more[0], audit + more[1]
                if (p, q) not in out or new < out[p, q]:
                    out[p, q] = new
    return out


def _insertions() -> Cell:
    one: Cell = {(p, p): (0, "") for p in STATES}
    one |= {(p, q): (INSERT, "I") for (p, r), q in STEPS.items() if r in NAMES}
    return join(join(one, one), join(one, one))


EMPTY = _insertions()


@lru_cache(maxsize=None)  # four roles by three faults at most
def _turn(letter: str) -> Cell:
    """Cell of one turn. Its letter is x where it must go; else the initial of its role or o, in upper case where its text is cut off."""
    cell: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if letter != "x":
        extra = TRUNCATED if letter.isupper() else 0
        for (p, r), q in STEPS.items():
            if r == letter.lower():
                cell[p, q] = KEEP + extra, "K"
            elif r in NAMES:
                cell[p, q] = min(cell.get((p, q), (1 << 60, "")), (REROLE + extra, "R"))
    return join(join(EMPTY, cell), EMPTY)


def joined(cells: list[Cell]) -> Cell:
    """The cell of neighbouring spans, joined in pairs until one is left."""
    while len(cells) > 1:
        cells = [join(*cells[k : k + 2]) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
    return cells[0] if cells else EMPTY


@lru_cache(maxsize=50_000)
def _short(letters: str) -> Cell:
    return joined([_turn(c) for c in letters])


def span(letters: str) -> Cell:
    """The cell of turns given as letters; those of eight turns are remembered."""
    return joined([_short(letters[k : k + 8]) for k in range(0, len(letters), 8)])


def cheapest(cell: Cell) -> tuple[int, str]:
    """Least cost and audit of a whole conversation."""
    return min(cell["0", q] for q in FINAL if ("0", q) in cell)


def _text(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(" "))


def ordered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None) -> DataFrame:
    """conv_id, turn, role, text, copies and two hashes of conversation, role and text; NULL roles and texts are one space."""
    own = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        _text(role_col).alias("role"),
        _text(text_col).alias("text"),
        (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
    )
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit("\0"))
    return own.withColumns({"d1": F.xxhash64(name, "role", "text"), "d2": F.xxhash64(F.lit(1), "text", "role", name)})


# What counts as white space, and how a whole sentence ends.
SPACE, STOPS = "[\\x20\\x09-\\x0D]", "[.!?]"


def _letters(rows: DataFrame) -> DataFrame:
    """One row for equal turns, in place of their texts the first fault of the first of them."""
    text = F.col("text")
    light = rows.select(
        "conv_id", "turn", "role", "d1", "d2", "copies",
        (~text.rlike("[^\\x20\\x09-\\x0D]")).alias("blank"),
        (~text.rlike(f"(?s){STOPS}{SPACE}*\\z")).alias("cut_off"),
    )
    same = light.groupBy("conv_id", "turn", "role", "d1", "d2").agg(
        F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("cut_off").alias("cut_off")
    )
    same = stabilise(same, "turns")
    # NULL turns come first.
    first = same.groupBy("d1", "d2").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    seen = same.join(first, ["d1", "d2"])
    return seen.withColumn("again", ~F.col("turn").eqNullSafe(F.col("first.turn"))).drop("first")


COUNTS = ["n", "blank", "duplicate", "truncated", "illegal", "turns"]
FRAGMENT = (
    "whole boolean, part int, " + ", ".join(f"{c} long" for c in COUNTS)
    + ", least long, most long, first_turn long, last_turn long, first_role string, last_role string, pairs array<string>, costs array<long>, audits array<string>"
)
_TYPES = {"boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
_FIELDS = [tuple(p.split()) for p in FRAGMENT.split(", ")]


class Fragment:
    """What neighbouring turns of a conversation add up to; composes with what follows."""

    def __init__(self, conv, part: int):
        self.conv, self.part = conv, part
        self.sums = dict.fromkeys(COUNTS, 0)
        self.least = self.most = self.first_turn = self.last_turn = self.first_role = self.last_role = None
        self.cell, self.letters = EMPTY, []

    def add(self, turn, role: str, copies: int, blank: bool, cut_off: bool, again: bool) -> None:
        s, initial = self.sums, role[:1]
        s["illegal"] += copies - 1
        if s["n"]:
            s["illegal"] += self.last_role + initial not in LEGAL
        else:
            self.first_role, self.first_turn = initial, turn
        if turn is not None:
            s["turns"] += turn != self.last_turn
            self.least = turn if self.least is None else self.least
            self.most = turn
        self.last_role, self.last_turn = initial, turn
        s["n"] += copies
        if blank:
            s["blank"] += copies
            self.letters.append("x" * copies)
            return
        s["duplicate"] += copies - (not again)
        s["truncated"] += cut_off and not again
        kept = initial if initial and initial in "sua" else "o"
        self.letters.append(("x" if again else kept.upper() if cut_off else kept) + "x" * (copies - 1))

    def close(self) -> Fragment:
        if self.letters:
            self.cell = join(self.cell, span("".join(self.letters)))
            self.letters = []
        return self

    def then(self, other: Fragment) -> Fragment:
        out = Fragment(self.conv, self.part)
        out.sums = {c: self.sums[c] + other.sums[c] for c in COUNTS}
        out.sums["illegal"] += self.last_role + other.first_role not in LEGAL
        out.sums["turns"] -= self.last_turn is not None and self.last_turn == other.first_turn
        out.least = other.least if self.least is None else self.least
        out.most = self.most if other.most is None else other.most
        out.first_turn, out.first_role, out.last_turn, out.last_role = self.first_turn, self.first_role, other.last_turn, other.last_role
        out.cell = join(self.cell, other.cell)
        return out

    def row(self, whole: bool) -> dict:
        if whole:
            cells = {"0 ": cheapest(self.cell)}
        else:
            cells = {"".join(k): v for k, v in self.cell.items()}
        plain = {n: getattr(self, n) for n in ("part", "least", "most", "first_turn", "last_turn", "first_role", "last_role")}
        return plain | self.sums | {"whole": whole, "pairs": list(cells), "costs": [c for c, _ in cells.values()], "audits": [a for _, a in cells.values()]}

    @classmethod
    def read(cls, conv, row: dict) -> Fragment:
        out = cls(conv, row["part"])
        out.sums = {c: row[c] for c in COUNTS}
        for n in ("least", "most", "first_turn", "last_turn", "first_role", "last_role"):
            setattr(out, n, row[n])
        out.cell = {(p[0], p[1]): (c, a) for p, c, a in zip(row["pairs"], row["costs"], row["audits"])}
        return out


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    """Rows of a conversation's id and a fragment's columns."""
    arrays = [pa.array([r[0] for r in rows], kind)] + [pa.array([r[1][n] for r in rows], _TYPES[t]) for n, t in _FIELDS]
    return pa.RecordBatch.from_arrays(arrays, names=["conv_id"] + [n for n, _ in _FIELDS])


def _fragments(batches: Iterator[pa.RecordBatch]):
    """One fragment of every conversation in a task; the first and the last may have more in other tasks."""
    part, own, rows, kind, first = TaskContext.get().partitionId(), None, [], None, True
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, turn, role, copies, blank, cut_off, again in zip(*(c.to_pylist() for c in batch.columns)):
            if own is None or conv != own.conv:
                if own is not None:
                    rows.append((own.conv, own.close().row(whole=not first)))
                    first = False
                    if len(rows) >= 1000:
                        yield _batch(rows, kind)
                        rows = []
                own = Fragment(conv, part)
            own.add(turn, role, copies, blank, cut_off, again)
            if len(own.letters) >= 4096:
                own.close()
    if own is not None:
        rows.append((own.conv, own.close().row(whole=False)))
    if rows:
        yield _batch(rows, kind)


def _composed(last: bool):
    def rows(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                parts = sorted(r["parts"], key=lambda p: p["part"])
                whole = reduce(Fragment.then, [Fragment.read(r["conv_id"], p) for p in parts])
                out.append((whole.conv, whole.row(last)))
            if out:
                yield _batch(out, batch.schema.field("conv_id").type)

    return rows


def repair_plans(rows: DataFrame) -> DataFrame:
    """One row per conversation of `ordered_turns`: gaps, counts of first faults, illegal neighbours, cost and audit."""
    light = _letters(rows)
    order = ["conv_id", "turn", "role", "d1", "d2"]
    kind = dict(rows.dtypes)["conv_id"]
    schema = f"conv_id {kind}, {FRAGMENT}"
    dealt = light.repartitionByRange(*order).sortWithinPartitions(*order)
    made = stabilise(in_arrow(dealt.select("conv_id", "turn", "role", "copies", "blank", "cut_off", "again"), _fragments, schema), "fragments")
    done, open_ = made.filter("whole"), made.filter("NOT whole")
    last, width = open_.agg(F.max("part")).first()[0] or 0, 1
    columns = [n for n, _ in _FIELDS if n != "whole"]
    while width <= last or width == 1:
        width *= FAN
        near = open_.groupBy("conv_id", F.floor(F.col("part") / width).alias("near")).agg(F.collect_list(F.struct(*columns)).alias("parts"))
        open_ = stabilise(in_arrow(near.select("conv_id", "parts"), _composed(width > last), schema), "fragments")
    both = done.union(open_)
    return both.select(
        "conv_id",
        F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal",
        F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"),
    )


def _rewritten(digest: bool):
    """Rows of a conversation in order, its audit first: the repaired turns, or their digest."""

    def rows(batches):
        kind, conv, out = None, None, []
        audit, at, state, place, sums, begun = "", 0, "0", 0, None, False

        def batch():
            names = ["conv_id", "repaired_sha256"] if digest else ["conv_id", "place", "role", "text"]
            types = [kind, pa.string()] if digest else [kind, pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        def put(role, text):
            nonlocal place, state
            if digest:
                sums.update((("\n" if place else "") + f"{role}:{text}").encode())
            else:
                out.append((conv, place, role, text))
            place, state = place + 1, role[:1]

        def inserts():
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                put(NAMES["a" if state == "u" else "u"], "")
                at += 1

        def finish():
            inserts()
            if digest:
                out.append((conv, sums.hexdigest()))

        for b in batches:
            kind = b.schema.field("conv_id").type
            for own, head, role, text, copies in zip(*(c.to_pylist() for c in b.columns)):
                if head == 0:
                    if begun:
                        finish()
                    conv, audit, at, state, place, sums, begun = own, text, 0, "0", 0, sha256(), True
                    continue
                inserts()
                edit, at = audit[at], at + copies  # the copies behind the first are deleted
                if edit == "K":
                    put(role, text)
                elif edit == "R":
                    put(NAMES["a" if state == "u" else "u"], text)
            if len(out) > 1000:
                yield batch()
                out.clear()
        if begun:
            finish()
        if out:
            yield batch()

    return rows


def _rewrite(rows: DataFrame, plans: DataFrame, digest: bool) -> DataFrame:
    kind, order = dict(rows.dtypes)["conv_id"], ["conv_id", "head", "turn", "role", "d1", "d2"]
    body = rows.select("conv_id", F.lit(1).alias("head"), "turn", "role", "d1", "d2", "text", "copies")
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("d1", "long"), ("d2", "long"))]
    heads = plans.select("conv_id", F.lit(0).alias("head"), *empty, F.col("audit").alias("text"), F.lit(1).cast("long").alias("copies"))
    dealt = heads.union(body).repartition("conv_id").sortWithinPartitions(*order)
    more = "repaired_sha256 string" if digest else "place long, role string, text string"
    return in_arrow(dealt.select("conv_id", "head", "role", "text", "copies"), _rewritten(digest), f"conv_id {kind}, {more}")


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, place, role and text of the repaired conversations."""
    return _rewrite(rows, plans, digest=False)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of `ordered_turns`: the columns of `repair_plans` and repaired_sha256.

    Turns are taken in ascending order with NULL turns first; those of one turn by role and a hash
    of the text, so equal rows lie side by side. The first fault of a turn counts: blank (no
    character but ASCII white space), duplicate (role and text seen earlier in the conversation),
    truncated (the last such character is not one of `.!?`). Blank and duplicate turns must be
    deleted. The cheapest edits that leave an optional system turn and then pairs of user and
    assistant are found over the whole conversation, the least audit among equal costs. A role
    counts by its first letter.

    NULL roles and texts are one space; a NULL conversation is one of its own; repeated rows are
    duplicates. No rows give no conversations. Counts and parsing of a long conversation are spread
    over tasks; only its digest, which has to be taken in order, streams through one task.
    """
    plans = stabilise(repair_plans(rows), "plans")
    digests = _rewrite(rows, plans, digest=True)
    joined_ = plans.alias("p").join(digests.alias("d"), F.col("p.conv_id").eqNullSafe(F.col("d.conv_id")))
    return joined_.select("p.*", "d.repaired_sha256")
