"""Line deduplication by winnowing.

A text's lines are hashed; of every window of three lines the smallest hash is a
fingerprint, so whatever repeats over at least three lines shares one at the same
place.  Fingerprints that stand in one place only are dropped.  The others are extended both
ways as far as a window reaches: each window that holds the fingerprint as its
minimum is keyed by 128 bits of all its lines, and joined with the first position
that has the key.  Matches that go on from one another in both places are put
together, which gives runs of any length with the place that they repeat
(`matches`).  Their lines are then deleted.

With `words`, fewer lines are a window too where they hold that many words, each
number of lines for itself: so a run counts from three lines or from `words` words
on, and a single long line is one.  Shorter runs of fewer lines are left.

Position order is (id, line number).  Lines are what stands between line feeds,
compared as they are.

Edge cases: a null or empty text has no lines; one of fewer lines than any window
keeps them all.  A text that loses all its lines is empty.  Runs that repeat
within one document lose the later copies, overlaps included.  Rows that share
an id have the same positions, so equal rows lose nothing because of each other,
and of a run in two different texts of one id the one at the larger line number
is later; each row is cut by what its own text holds.  A row whose id is null is not compared and
keeps its text.  Other columns, whatever their names, go through.  No documents:
no rows.  A worker needs about 60 bytes for each byte of its longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, apart, fresh, materialize, named, tidied
from .kernels import BYTE_VALUES, RangeHasher, U64, Words, mix, signed, text_blocks, window_minima

FINGERPRINTS = "f long, doc_id long, row int, line int, at int, n int, w long, v long"


def _lines(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines, and each document's first line."""
    feeds = np.flatnonzero(buf == 0x0A)
    some = np.diff(offs) > 0
    starts = np.sort(np.concatenate([offs[:-1][some], feeds + 1]))
    ends = np.sort(np.concatenate([feeds, offs[1:][some]]))
    # lines of a document: its line feeds and one more
    count = np.diff(np.searchsorted(feeds, offs)) + some
    return starts, ends, np.concatenate([[0], np.cumsum(count)])


def _fingerprints(size: int, words: int | None):
    def run(batches):
        for batch in batches:
            for i, _, buf, offs in text_blocks(batch.column(2)):
                starts, ends, first = _lines(buf, offs)
                n = len(starts)
                if not n:
                    continue
                h = RangeHasher(BYTE_VALUES[buf])(starts, ends)
                again = RangeHasher(mix(BYTE_VALUES[buf] + U64(1)))(starts, ends)  # a second hash, of other values
                over, over_again = RangeHasher(h), RangeHasher(again)
                last = np.repeat(first[1:], np.diff(first))
                if words:  # no word goes on after a line feed
                    before = np.searchsorted(Words(buf, offs).starts, np.append(starts, len(buf)))
                for k in range(1 if words else size, size + 1):
                    if n < k:
                        break
                    at = np.arange(n - k + 1)
                    valid = at + k <= last[: len(at)]
                    if k < size:
                        valid &= before[at + k] - before[at] >= words
                    chosen = window_minima(h, k, valid)
                    least = np.lib.stride_tricks.sliding_window_view(h, k).min(axis=1)
                    # every window around a chosen line whose minimum that line is
                    shift = np.arange(k)
                    begin = (chosen[:, None] - shift).ravel()
                    line = np.repeat(chosen, k)
                    ok = (begin >= 0) & (begin < len(at))
                    begin, line = begin[ok], line[ok]
                    ok = valid[begin] & (least[begin] == h[line])
                    begin, line = begin[ok], line[ok]
                    doc = pa.array(np.searchsorted(first, begin, side="right") - 1 + i)
                    place, own = ((x - first[np.asarray(doc) - i]).astype(np.int32) for x in (begin, line))
                    f = mix(h[line] + U64(size - k)) if k < size else h[line]  # windows of another number of lines are no occurrence
                    key = [pa.array(signed(mix(o(begin, begin + k) + U64(k)))) for o in (over, over_again)]
                    yield pa.RecordBatch.from_arrays([pa.array(signed(f)), batch.column(0).take(doc), batch.column(1).take(doc), pa.array(own), pa.array(place), pa.array(np.full(len(begin), k, np.int32)), *key], names=["f", "doc_id", "row", "line", "at", "n", "w", "v"])

    return run


def _repeated(texts: DataFrame, size: int, words: int | None) -> DataFrame:
    """Windows around fingerprints that stand in more than one place; a line that is the fingerprint of several windows is one place."""
    each = texts.mapInArrow(tidied(_fingerprints(size, words)), FINGERPRINTS)
    line = F.shiftleft(F.col("row").cast("long"), 32).bitwiseOR(F.col("line").cast("long"))  # of one text; as a number, so that no sort is needed to aggregate
    ends = [end(c).alias(f"{name}_{k}") for k, c in enumerate((F.col("doc_id"), line)) for name, end in (("lo", F.min), ("hi", F.max))]
    again = each.groupBy("f").agg(*ends).where("lo_0 < hi_0 OR lo_1 < hi_1").select(apart("f").alias("f"))
    return each.join(again, "f", "left_semi").drop("f", "line")


def _later_windows(texts: DataFrame, size: int, words: int | None) -> DataFrame:
    """(doc_id, row, at, n, first): windows of n lines that also start earlier, and where first."""
    windows = materialize(_repeated(texts, size, words).select("w", "v", "doc_id", "row", "at", "n").distinct(), "line-windows")
    owners = materialize(windows.groupBy("w", "v").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("k")).where("k > 1").select("w", "v", "first"), "first-windows")
    return windows.join(owners, ["w", "v"]).where(F.struct("doc_id", "at") > F.col("first")).select("doc_id", "row", "at", "n", "first")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, row (tells texts of one id apart), text of the rows that take part."""
    text = F.col(f"`{text_col}`")
    return named(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.hash(text).alias("row"), text.alias("text")))[0]


def matches(docs: DataFrame, *, size: int = 3, words: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, at, n, first_doc, first_at): maximal runs of n lines that repeat those at first_at of first_doc.

    Windows that follow one another in both places are one run; a run ends where
    the first place of its windows changes.
    """
    found = _later_windows(_texts(docs, id_col, text_col), size, words)
    # Along one diagonal of one pair of documents; a document's own windows are all that a key holds.
    keys = ["doc_id", "row", F.col("first.doc_id").alias("first_doc"), (F.col("first.at") - F.col("at")).alias("shift")]
    lists = found.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("w"))
    end = lambda s: s["at"] + s["n"]
    extend = lambda runs, s: F.when((F.size(runs) > 0) & (end(F.element_at(runs, -1)) >= s["at"]), F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(F.struct(F.element_at(runs, -1)["at"].alias("at"), (F.greatest(end(F.element_at(runs, -1)), end(s)) - F.element_at(runs, -1)["at"]).alias("n"))))).otherwise(F.concat(runs, F.array(s)))
    runs = lists.select("doc_id", "row", "first_doc", "shift", F.explode(F.aggregate("w", F.expr("cast(array() as array<struct<at:int,n:int>>)"), extend)).alias("run"))
    return runs.select("doc_id", "row", "run.at", "run.n", "first_doc", (F.col("run.at") + F.col("shift")).alias("first_at"))


def _cut(texts: pa.Array, runs: pa.Array):
    kept, n, gone = [], [], []
    for text, removed in zip(texts.to_pylist(), runs.to_pylist(), strict=True):
        lines = text.split("\n") if text else []
        drop = {r["at"] + k for r in removed or () for k in range(r["n"])}
        kept.append("\n".join([x for k, x in enumerate(lines) if k not in drop]) if drop else text)
        n.append(len(lines))
        gone.append(sum(k < len(lines) for k in drop))
    return pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())


def drop_repeated_lines(docs: DataFrame, *, size: int = 3, words: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the later repeated runs deleted from its text, and as its last two columns __n_lines and __n_removed (or with further underscores, where docs has these).

    A run is `size` lines or more, or with `words` given also fewer that hold that many words.
    """
    key, row, runs, n_lines, n_removed = fresh(docs, "__id", "__row", "__runs", "__n_lines", "__n_removed")
    found = _later_windows(_texts(docs, id_col, text_col), size, words)
    lists = found.groupBy(F.col("doc_id").alias(key), F.col("row").alias(row)).agg(F.collect_set(F.struct("at", "n")).alias(runs))
    marked = docs.withColumns({key: F.col(f"`{id_col}`").cast("long"), row: F.hash(F.col(f"`{text_col}`"))})
    joined = marked.join(lists, [key, row], "left").select(*[F.col(f"`{c}`") for c in docs.columns], runs)
    return add_columns(joined, _cut, [text_col, runs], f"`{n_lines}` long, `{n_removed}` long", replaced=text_col).drop(runs)


def line_report(docs: DataFrame, *, size: int = 3, words: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed and kept_sha256 of every document."""
    found = drop_repeated_lines(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), size=size, words=words)
    return found.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
