"""Repair of conversations by weighted CYK interval parsing.

A repaired conversation is nothing, or `(s?(ua)+)`: a system row at most, then user and
assistant in turns.  The least edits are found by parsing over intervals of rows.

The grammar, in Chomsky normal form, has a nonterminal N(p,q) for each two states of
the language (nothing yet, after s, after u, after a): what leads from p to q.
N(p,q) -> N(p,r) N(r,q) joins neighbours; N(p,q) -> row is an edit of one row (Keep,
Rerole, Delete), with insertions before and after it by the closure of N(p,q) -> Insert.
A span's cell holds for each nonterminal the least (cost, audit), audit being the
edits' initials.  Cells are combined bottom-up by span length: 1, 2, 4, 8 rows and so on.
All split points of a span give the same cell, as N(p,q) is split by any state that is
passed on the way, so one split for each span is enough: n cells in all, in place of
n squared.  Least (cost, audit) of the parts give the least of the whole: of two
audits of one cell that cost the same neither is a prefix of the other, as they edit the
same rows and more insertions cost more.

On Spark, rows are dealt by ranges of (conversation, turn), so a conversation of any
length lies in many partitions; each run of at most `span` rows is a segment.
Segments' cells are computed once for each different string of row codes, and
combined 64 at a time in rounds of aggregation.  The audit is cut back into segments,
and joined with their rows.  No task holds a conversation's texts; what one row holds is a
conversation's audit, which is a value of the result.  Cells hold 16 audits, so a long
conversation needs 16 bytes for each of its rows in the last round.

Faults, the first of these for each row: blank (nothing but space and \\x09-\\x0D),
duplicate (same role and text as an earlier row of its conversation; told by 128 bits),
truncated (the last character but for those is none of `.!?`).

Edge cases: a null role or text is one space.  A null turn comes first; rows of one
turn are ordered by role, then text.  Rows without conversation are one
conversation (null).  A conversation without rows can be given in `every`: zeros and
an empty audit.  Roles are told by their first character; others than s, u and a (an empty
role as well) can't be kept.  Extra columns are ignored, whatever their names.  No
rows: no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, tidied

INITIALS = "sua"
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT = (0, "K"), (2, "R"), (3, "D"), (2, "I")
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}  # state and role's initial: next state
FINAL = (0, 3)
WAYS = 64  # so many cells are combined in one row of a round
BLANKS = r"\x20\x09-\x0D"
CELL = "cost array<long>, audit array<string>, illegal long, head string, tail string, n long"

_Cell = dict[tuple[int, int], tuple[int, str]]


def _least(cell: _Cell, key: tuple[int, int], found: tuple[int, str]) -> None:
    if key not in cell or found < cell[key]:
        cell[key] = found


def _joined(a: _Cell, b: _Cell) -> _Cell:
    """The cell of two neighbours: N(p,q) -> N(p,r) N(r,q)."""
    out: _Cell = {}
    for (p, r), (cost, audit) in a.items():
        for q in range(4):
            if (r, q) in b:
                more = b[r, q]
                _least(out, (p, q), (cost + more[0], audit + more[1]))
    return out


def _closure() -> _Cell:
    """Insertions alone, as many as lead anywhere new."""
    out: _Cell = {(p, p): (0, "") for p in range(4)}
    one = out | {(p, q): INSERT for (p, role), q in STEPS.items() if role != "s"}
    for _ in range(3):
        out = _joined(out, one)
    return out


CLOSURE = _closure()


@lru_cache(100)
def _row(code: str) -> _Cell:
    """One row.  code: its role's initial or `o`; upper case: truncated, `-` before it: blank or duplicate."""
    initial = code[-1].lower()
    extra = int(code[-1].isupper())
    edits: _Cell = {(p, p): DELETE for p in range(4)}
    for (p, role), q in STEPS.items() if code[0] != "-" else ():
        if role == initial:
            _least(edits, (p, q), (KEEP[0] + extra, KEEP[1]))
        if role != "s":
            _least(edits, (p, q), (REROLE[0] + extra, REROLE[1]))
    return _joined(_joined(CLOSURE, edits), CLOSURE)


def _codes(text: str) -> list[str]:
    out, k = [], 0
    while k < len(text):
        n = 2 if text[k] == "-" else 1
        out.append(text[k : k + n])
        k += n
    return out


def _combined(cells: list[_Cell]) -> _Cell:
    """Neighbours' cells, combined by span length."""
    while len(cells) > 1:
        cells = [_joined(*cells[k : k + 2]) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
    return cells[0]


def _stored(cell: _Cell) -> tuple[list, list]:
    keys = [(p, q) for p in range(4) for q in range(4)]
    return [cell[k][0] if k in cell else None for k in keys], [cell[k][1] if k in cell else None for k in keys]


def _loaded(cost: list, audit: list) -> _Cell:
    return {(k // 4, k % 4): (c, a) for k, (c, a) in enumerate(zip(cost, audit, strict=True)) if c is not None}


def _segment(codes: str) -> tuple:
    """The cell of a run of rows, as CELL has it; those of short runs are kept, as many are alike."""
    return _short(codes) if len(codes) < 40 else _parsed(codes)


def _parsed(codes: str) -> tuple:
    rows = _codes(codes)
    initials = [r[-1].lower() for r in rows]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    return (*_stored(_combined([_row(r) for r in rows])), illegal, initials[0], initials[-1], len(rows))


_short = lru_cache(20_000)(_parsed)


def _cells_batch(batches):
    for batch in batches:
        codes = batch.column(batch.num_columns - 1).to_pylist()
        yield _with_cells(batch.select(range(batch.num_columns - 1)), [_segment(c) for c in codes])


def _with_cells(keys: pa.RecordBatch, cells: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = [c.split()[0] for c in CELL.split(", ")]
    columns = [pa.array([c[k] for c in cells], t) for k, t in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([*keys.columns, *columns], names=[*keys.schema.names, *names])


def _round(batches):
    """Rows of neighbours' cells, each an array in order, to one cell each."""
    for batch in batches:
        out = []
        for cells in batch.column(batch.num_columns - 1).to_pylist():
            illegal = sum(c["illegal"] for c in cells) + sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(cells, cells[1:], strict=False))
            whole = _stored(_combined([_loaded(c["cost"], c["audit"]) for c in cells]))
            out.append((*whole, illegal, cells[0]["head"], cells[-1]["tail"], sum(c["n"] for c in cells)))
        yield _with_cells(batch.select(range(batch.num_columns - 1)), out)


@dataclass
class Repair:
    report: DataFrame  # conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit
    rows: DataFrame  # conv_id, place, edit, role, text: the repaired conversations; place: the edit's place in the audit


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    named = [F.col(f"`{c}`") for c in (conv, turn, role, text)]
    rows = rows.select(named[0].alias("conv_id"), named[1].cast("long").alias("turn"), F.coalesce(named[2], F.lit(" ")).alias("role"), F.coalesce(named[3], F.lit(" ")).alias("text"))
    last = F.regexp_extract("text", rf"([^{BLANKS}])[{BLANKS}]*\z", 1)
    rows = rows.withColumns({"same": F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")), "last": last})
    return rows.withColumns({"blank": F.col("last") == "", "cut": ~F.col("last").isin(".", "!", "?")}).drop("last")


def _numbered(span: int):
    """part, seg and idx of each row of a sorted partition: runs of a conversation, cut every `span` rows."""

    def run(batches):
        part, held, n = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            seg, idx = [], []
            for c in batch.column(0).to_pylist():
                if c != held:
                    held, n = c, 0
                seg.append(n // span)
                idx.append(n % span)
                n += 1
            columns = [*batch.columns, pa.array([part] * len(seg), pa.int32()), pa.array(seg, pa.int64()), pa.array(idx, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "seg", "idx"])

    return run


def _first_only(rows: DataFrame) -> DataFrame:
    """rows with again: does an equal row stand before it?  Only rows that occur more than once are looked up."""
    first = F.min(F.struct("turn", "copy"))["copy"].alias("first")  # a null turn is the least
    several = rows.groupBy("conv_id", "same").agg(F.count("*").alias("k"), first).where("k > 1")
    several = several.select(F.col("conv_id").alias("c"), F.concat("same", F.lit("")).alias("s"), "first")  # not the column it came from, so a hot one can be split
    found = rows.join(several, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left")
    return found.withColumn("again", F.coalesce(F.col("first") != F.col("copy"), F.lit(False))).drop("c", "s", "first")


def _whole_cells(segments: DataFrame) -> DataFrame:
    """One cell for each conversation, from those of its segments; rounds of at most 64 neighbours."""
    top = segments.agg(F.max("seg"), F.max("part")).first()
    whole = segments
    for level, most in (("seg", top[0] or 0), ("part", top[1] or 0)):
        left = most
        while left:
            keys = ["conv_id", *(["part"] if level == "seg" else []), "at"]
            dealt = whole.withColumn("at", F.floor(F.col(level) / WAYS).cast("long"))
            order = F.col(level).cast("long").alias("o")
            neighbours = dealt.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, "cost", "audit", "illegal", "head", "tail", "n"))).alias("cells"))  # at most 64
            one = F.size("cells") == 1
            kinds = {f.name: f.dataType.simpleString() for f in neighbours.schema.fields}
            many = neighbours.where(~one).mapInArrow(tidied(_round), ", ".join([f"{k} {kinds[k]}" for k in keys]) + ", " + CELL)
            alone = neighbours.where(one).select(*keys, *(F.col(f"cells.{c}")[0].alias(c) for c in ("cost", "audit", "illegal", "head", "tail", "n")))
            whole = many.unionByName(alone).withColumnRenamed("at", level)
            left //= WAYS
    return whole.drop("seg", "part")


def _edits(batches):
    """An audit and its segments to one row for each edit that leaves a row: part and seg, idx of the row (null: inserted), place, edit, role (null: the row's own)."""
    names = ["conv_id", "part", "seg", "idx", "place", "edit", "role"]
    for batch in batches:
        kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string()]

        def made(out: list[list], kinds=kinds) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=names)

        out: list[list] = [[] for _ in names]
        for conv, audit, segments in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            place = items = system = 0
            for k, s in enumerate(segments):
                codes, done = _codes(s["codes"]), 0
                while place < len(audit) and (done < len(codes) or k == len(segments) - 1):
                    edit, row = audit[place], None
                    if edit != "I":
                        row, done = done, done + 1
                    if edit != "D":
                        if edit == "K":
                            role = None
                            system |= not items and codes[row].lower() == "s"
                        else:
                            role = ("user", "assistant")[(items - system) % 2]
                        items += 1
                        for x, v in zip(out, (conv, s["part"], s["seg"], row, place, edit, role), strict=True):
                            x.append(v)
                    place += 1
                if len(out[0]) > 10_000:
                    yield made(out)
                    out = [[] for _ in names]
        yield made(out)


def _repaired(told: DataFrame, parsed: DataFrame, strings: DataFrame) -> DataFrame:
    """The edits that leave rows, with those rows' roles and texts."""
    runs = strings.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "seg", "codes"))).alias("segments"))  # about as long as the audit
    audits = parsed.alias("x").join(runs.alias("y"), F.col("x.conv_id").eqNullSafe(F.col("y.conv_id"))).select("x.conv_id", "audit", "segments")
    kind = told.schema["conv_id"].dataType.simpleString()
    edits = audits.mapInArrow(tidied(_edits), f"conv_id {kind}, part int, seg long, idx int, place long, edit string, role string")
    keys = ["part", "seg", "idx"]  # a part's segment has rows of several conversations
    same = F.col("e.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("e.part") == F.col("t.part")) & (F.col("e.seg") == F.col("t.seg")) & (F.col("e.idx") == F.col("t.idx"))
    found = edits.alias("e").join(told.select("conv_id", *keys, "role", "text").alias("t"), same, "left")
    return found.select(F.col("e.conv_id").alias("conv_id"), "place", "edit", F.coalesce(F.col("e.role"), F.col("t.role")).alias("role"), F.coalesce(F.col("t.text"), F.lit("")).alias("text"))


def digests(rows: DataFrame) -> DataFrame:
    """repaired_sha256 of each conversation with repaired rows: `role:text`, newline-joined.

    A SHA-256 is sequential, so one task reads a conversation's sorted rows, one
    batch after the other; it holds no more than a batch.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        held, state, arrow = None, None, None

        def told():
            return pa.RecordBatch.from_arrays([pa.array([held], arrow), pa.array([state.hexdigest()])], names=["conv_id", "repaired_sha256"])

        for batch in batches:
            arrow = batch.schema.field(0).type
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is not None and conv == held:
                    state.update(b"\n")
                else:
                    if state is not None:
                        yield told()
                    held, state = conv, hashlib.sha256()
                state.update(line.encode())
        if state is not None:
            yield told()

    lines = rows.select("conv_id", F.concat("role", F.lit(":"), "text").alias("line"), "place")
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(tidied(run), f"conv_id {kind}, repaired_sha256 string")


def repair(rows: DataFrame, *, every: DataFrame | None = None, span: int = 512, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """The faults of each conversation, its cheapest edits and its repaired rows; every: conversations to be reported even if they have no rows."""
    rows = _prepared(rows, conv, turn, role, text)
    # Equal rows are numbered by where they stand, so that exactly one of them is the first.
    rows = rows.withColumn("copy", F.monotonically_increasing_id())
    rows = materialize(rows, "rows")
    flagged = _first_only(rows)
    start = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role")]
    dealt = flagged.repartitionByRange(*start, F.substring("text", 1, 200)).sortWithinPartitions(*start, "text", "copy").drop("same", "copy")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields]
    told = materialize(dealt.mapInArrow(tidied(_numbered(span)), ", ".join([*fields, "part int", "seg long", "idx int"])), "ordered")

    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin(*INITIALS), initial).otherwise("o")
    gone = F.col("blank") | F.col("again")
    code = F.concat(F.when(gone, "-").otherwise(""), F.when(~gone & F.col("cut"), F.upper(initial)).otherwise(initial))
    codes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", code.alias("code")))), lambda x: x["code"]), "")  # at most `span`
    kind = rows.schema["conv_id"].dataType.simpleString()
    strings = materialize(told.groupBy("conv_id", "part", "seg").agg(codes.alias("codes")), "codes")
    segments = materialize(strings.mapInArrow(tidied(_cells_batch), f"conv_id {kind}, part int, seg long, {CELL}"), "segments")
    whole = _whole_cells(segments)
    ends = F.array(*(F.struct(F.col("cost")[q].alias("cost"), F.col("audit")[q].alias("audit")) for q in FINAL))
    best = F.array_min(F.filter(ends, lambda e: e["cost"].isNotNull()))
    parsed = materialize(whole.select("conv_id", "illegal", best["cost"].alias("cost"), best["audit"].alias("audit")), "parsed")

    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = told.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0).cast("long")).alias("gaps"),
        F.count_if("blank").alias("blank"),
        F.count_if(~F.col("blank") & F.col("again")).alias("duplicate"),
        F.count_if(~gone & F.col("cut")).alias("truncated"),
    )
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    report = counts.alias("x").join(parsed.alias("y"), F.col("x.conv_id").eqNullSafe(F.col("y.conv_id"))).select("x.conv_id", *names)
    if every is not None:
        ids = every.select(F.col(f"`{conv}`").alias("conv_id")).distinct()
        zeros = [F.coalesce(F.col(c), F.lit("") if c == "audit" else F.lit(0).cast("long")).alias(c) for c in names]
        report = ids.alias("x").join(report.alias("y"), F.col("x.conv_id").eqNullSafe(F.col("y.conv_id")), "left").select("x.conv_id", *zeros)
    return Repair(report, _repaired(told, parsed, strings))
