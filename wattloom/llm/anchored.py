"""Repeated windows of a fixed size, found around sampled anchors.

A unit says what texts consist of (bytes or words); this module is the Spark side
that both share.

1. Of each window of `size` units the gram with the smallest hash is its anchor.
   Equal windows have equal anchors at the same place, so a repeated window shows
   as a repeated anchor.  Anchors that occur once are dropped.
2. An anchor's context, all that windows around it can reach, is hashed.
   Occurrences with one anchor and one context are a class: copies, however many,
   are one row from here on.  Those within one document are one row from the
   start, with all their places.
3. Classes that share an anchor with others are a group; one occurrence of each
   class is cut from its text, and the unit compares the contexts of a group.

Documents are told apart by their id, and the texts of one id by `row`, a hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, materialize, parts, tidied
from .kernels import signed

OCCURRENCES = "a long, c long, doc_id long, row int, at array<int>, left int, right int"
CONTEXTS = "key long, cls long, a long, c long, n long, doc long, row int, pos int, left int, content binary, k long"


@dataclass
class Anchors:
    """Tables of repeated anchors; each is written."""

    repeated: DataFrame  # occurrences: a, c, doc_id, row, at, left, right
    classes: DataFrame  # a, c, n (occurrences), first (doc_id, row, pos), last (the largest id), left, right
    shared: DataFrame  # a, k: anchors of k > 1 classes


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, row, text."""
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.hash(text).alias("row"), text.alias("text"))


def find(docs: DataFrame, unit, *, across: bool) -> Anchors:
    """The anchors that recur: anywhere, or with `across` in a second document.  docs: doc_id, row, text; no null id."""
    occurrences = docs.mapInArrow(tidied(unit.anchors), OCCURRENCES)
    if across:
        again = occurrences.groupBy("a").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    else:
        again = occurrences.groupBy("a").agg(F.sum(F.size("at")).alias("n")).where("n > 1")
    repeated = materialize(occurrences.join(again.select(apart("a").alias("a")), "a", "left_semi"), "anchors")
    first = F.min(F.struct("doc_id", "row", F.col("at")[0].alias("pos"))).alias("first")
    classes = materialize(repeated.groupBy("a", "c").agg(F.sum(F.size("at")).alias("n"), first, F.max("doc_id").alias("last"), F.min("left").alias("left"), F.min("right").alias("right")), "classes")
    return Anchors(repeated, classes, materialize(classes.groupBy("a").agg(F.count("*").alias("k")).where("k > 1"), "shared"))


def contexts(docs: DataFrame, found: Anchors, unit) -> DataFrame:
    """One context of each class that shares its anchor, cut from the text of its first occurrence."""
    classes = found.classes.join(found.shared, "a")
    each = F.struct("a", "c", "n", F.col("first.pos").alias("pos"), "left", "right", "k")
    wanted = classes.groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.row").alias("row")).agg(F.collect_list(each).alias("wanted"))  # as many as the text has anchors
    cut = docs.where("text is not null").join(wanted, ["doc_id", "row"]).select("doc_id", "row", "text", "wanted").mapInArrow(tidied(unit.contexts), CONTEXTS)
    return cut


def with_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with the list of their spans (null: none)."""
    lists = found.groupBy("doc_id", "row").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return docs.join(lists, ["doc_id", "row"], "left").select("doc_id", "text", "spans")


def occurrence_rows(ids: pa.Array, rows: pa.Array, doc: np.ndarray, pos: np.ndarray, a: np.ndarray, c: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """One row for each document, anchor and context, with its places in order."""
    order = np.lexsort((pos, c, a, doc))
    doc, pos, a, c = doc[order], pos[order], a[order], c[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    begin = np.flatnonzero(new)
    places = pa.ListArray.from_arrays(pa.array(np.append(begin, len(order)), pa.int32()), pa.array(pos, pa.int32()))
    one, own = order[begin], pa.array(doc[begin])
    columns = [pa.array(signed(a[begin])), pa.array(signed(c[begin])), ids.take(own), rows.take(own), places, pa.array(left[one], pa.int32()), pa.array(right[one], pa.int32())]
    return pa.RecordBatch.from_arrays(columns, names=["a", "c", "doc_id", "row", "at", "left", "right"])


def context_batches(batches, split, join):
    """What contexts() wants of each text; split: text -> sequence of units, join: a part of it -> content."""
    kinds = [pa.int64()] * 6 + [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
    names = [c.split()[0] for c in CONTEXTS.split(", ")]

    def made(out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=names)

    for whole in batches:
        for batch in parts(whole, 2):
            out: list[list] = [[] for _ in names]
            for doc, row, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                units = split(text)
                for w in wanted:
                    part = join(units[w["pos"] - w["left"] : w["pos"] + w["right"]])
                    for x, v in zip(out, (w["a"], w["c"], w["a"], w["c"], w["n"], doc, row, w["pos"], w["left"], part, w["k"]), strict=True):
                        x.append(v)
                if len(out[0]) >= 20_000:
                    yield made(out)
                    out = [[] for _ in names]
            yield made(out)


def merged(spans: list[tuple[int, int]], end: int) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans, up to end."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        b = min(b, end)
        if a >= b:
            continue
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out
