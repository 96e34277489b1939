"""Best-fit packing of token pieces into sequences, in bulk-synchronous sweeps.

Pieces are sorted by length, longest first, and free gaps by size.  A sweep takes
all pieces of one length, finds the successor of that length among the gaps (the
smallest that is large enough), and deals pieces to gaps by rank: the k-th piece
goes to the k-th gap, so no two want the same.  Gaps are then updated, and the
sweep repeats with the pieces that are left, and opens new sequences where no gap
is large enough.  The result is that of best fit decreasing.

Ranks come from the tasks: each counts its pieces of each length, prefix sums
over the tasks give each count its base, and no piece is moved for it.  Pieces of
equal length and gaps of equal size are alike, so a sweep moves ranges of ranks;
its state has an entry for each range, which the capacity bounds and not the
number of pieces.  That state is small enough for one place, so the sweeps run in the
driver, on at most `capacity` counts; no piece passes through it.  The sweeps yield a table of (length, ranks, sequence, offset)
ranges, and every piece looks its own place up.

Edge cases: a null or empty text is a document of the end id alone.  A null
document id is kept.  Repeated rows are packed each.  A text of more tokens than
fit is cut: the first piece takes the remainder, all others are full; a text is
encoded whole, for which a worker needs about 60 bytes for each of its own.  Extra
columns of the documents are left out, those of the pieces are kept, whatever their
names.  No documents: no pieces.  Lengths must be from 1 to the capacity.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, tidied
from .tokens import Encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, *, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, little-endian 32-bit) of all documents."""

    def run(batches):
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            for i, _, flat, counts in encoder.column(batch.column(1)):
                ends = np.cumsum(counts + 1)
                whole = np.full(len(flat) + len(counts), end_id, dtype="<u4")
                body = np.ones(len(whole), dtype=bool)
                body[ends - 1] = False
                whole[body] = flat
                n = counts + 1
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = n - (pieces - 1) * capacity
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[doc], capacity)
                begin = (ends - n)[doc] + start
                cuts = [whole[a : a + k] for a, k in zip(begin.tolist(), length.tolist(), strict=True)]
                columns = [batch.column(0).take(pa.array(doc + i)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
                if with_ids:
                    columns.append(pa.array([c.tobytes() for c in cuts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(tidied(run), PIECES + (", ids binary" if with_ids else ""))


def sweeps(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces, first sequence, offset), sorted by length and rank.

    The pieces of a row go, in order, to as many sequences in order, all at offset.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # size -> ranges of sequences (first, number)
    rows: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def fill(first: int, number: int, gap: int, length: int, rank: int, each: int) -> None:
        """`each` pieces go to each of `number` sequences; what is left is a gap again."""
        for k in range(each):
            rows.append((length, rank + k * number, number, first, capacity - gap + k * length))
        if left := gap - each * length:
            gaps.setdefault(left, []).append((first, number))

    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece has length {length}; it must be from 1 to {capacity}")
        rank, left = 0, counts[length]
        while left:
            gap = min((g for g in gaps if g >= length), default=None)
            if gap is None:
                gap, first, number = capacity, opened, -(-left // (capacity // length))
                opened += number
            else:
                first, number = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
            most = gap // length
            full = min(number, left // most)
            if full:
                fill(first, full, gap, length, rank, most)
                rank, left = rank + full * most, left - full * most
            if left and full < number:  # fewer than a sequence takes
                fill(first + full, 1, gap, length, rank, left)
                rank, left, full = rank + left, 0, full + 1
            if full < number:
                gaps.setdefault(gap, []).append((first + full, number - full))
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def best_fit(pieces: DataFrame, *, length_col: str = "length", capacity: int) -> DataFrame:
    """pieces with sequence_id and offset."""
    spark = pieces.sparkSession
    names, at = pieces.columns, pieces.columns.index(length_col)
    kinds = [f.dataType.simpleString() for f in pieces.schema.fields]
    plain = pieces.toDF(*(f"c{k}" for k in range(len(names))))  # no name is taken, and none has a dot
    fields, length = ", ".join(f"c{k} {t}" for k, t in enumerate(kinds)), F.col(f"c{at}")

    def rank(batches):
        seen = np.zeros(capacity + 2, dtype=np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            n = np.clip(np.asarray(batch.column(at), dtype=np.int64), 0, capacity + 1)
            order = np.argsort(n, kind="stable")
            ranks = np.empty(len(n), dtype=np.int64)
            ranks[order] = np.arange(len(n)) - np.searchsorted(n[order], n[order]) + seen[n[order]]
            seen += np.bincount(n, minlength=capacity + 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(n), task)), pa.array(ranks)], names=[*batch.schema.names, "task", "rank"])

    ranked = materialize(plain.mapInArrow(tidied(rank), fields + ", task long, rank long"), "pieces")
    by_task = ranked.groupBy("task", length.alias("length")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select(F.col("task").alias("t"), "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    plan = spark.sparkContext.broadcast(sweeps(counts, capacity))  # bounded by the capacity

    def place(batches):
        rows = plan.value
        key = rows[:, 0] << 48 | rows[:, 1]
        for batch in batches:
            n = np.asarray(batch.column(at), dtype=np.int64)
            r = np.asarray(batch.column(len(names)), dtype=np.int64)
            i = np.searchsorted(key, n << 48 | r, side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(rows[i, 3] + r - rows[i, 1]), pa.array(rows[i, 4])], names=[*batch.schema.names[: len(names)], "sequence_id", "offset"])

    together = ranked.join(bases, (F.col("task") == F.col("t")) & (length == F.col("length")))
    placed = together.select(*(f"c{k}" for k in range(len(names))), (F.col("rank") + F.col("base")).alias("whole_rank"))
    return placed.mapInArrow(tidied(place), fields + ", sequence_id long, offset long").toDF(*names, "sequence_id", "offset")
